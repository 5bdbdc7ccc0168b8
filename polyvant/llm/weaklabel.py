"""A quality classifier without labels: overlapping heuristics vote, expectation-maximisation estimates how far
each can be trusted, and the posterior trains a hashed linear scorer of words and shape, which so learns what the
labellers do not look at.

Votes are one bounded code for each document, so EM runs over the counts of the codes (at most 3 to the power
of the number of labellers), which cover every document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear
from .common import bounded_sample, cut, scoped

#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset("the of and to in is that it for on was as with be by are this at from or an a der die und das den des mit ist von für auf dem sich nicht ein eine auch zu le la les et des un une que pour dans est sur par avec qui du de el los las y en una por con se del al lo como más".encode().split())
SYMBOLS = b"#*$%&|<>"
_MARKS = re.compile(rb"[!?]{2,}")
GOOD, BAD, NONE = 1, 0, 2
#: Buckets of words, then of the shape of a text.
WORDS, SHAPES = 60_000, 5_000


def measures(text: str | None) -> dict[str, float]:
    """Numbers that the labellers and the scorer's shape features read; all 0 for an empty text."""
    raw = (text or "").encode()
    w = raw.split()
    n = max(len(w), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    low = raw.lower().split()
    grams = list(zip(low, low[1:], low[2:]))
    size = max(sum(map(len, w)), 1)
    blocks = [low[i : i + 200] for i in range(0, len(low), 200)]
    return {
        "n": len(w), "symbols": sum(raw.count(c) for c in SYMBOLS) / n, "lines": 1 - len(set(lines)) / max(len(lines), 1),
        "grams": 1 - len(set(grams)) / max(len(grams), 1), "upper": (size - len(b"".join(w).translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size,
        "marks": len(_MARKS.findall(raw)) / n, "length": size / n, "function": sum(x.strip(b".,;:!?") in FUNCTION_WORDS for x in low) / n,
        "variety": sum(len(set(b)) for b in blocks) / n, "squeeze": len(zlib.compress(raw, 1)) / max(len(raw), 1),
    }


#: A share says nothing about fewer words than this.
FEWEST = 12
#: name: (measure, bad above or below, bad threshold, good threshold). Between the two, and for a text with too
#: few words, a labeller abstains.
LABELLERS = {
    "symbols": ("symbols", ">", 0.25, 0.02), "lines": ("lines", ">", 0.2, 0.02), "grams": ("grams", ">", 0.3, 0.08), "upper": ("upper", ">", 0.4, 0.08),
    "marks": ("marks", ">", 0.3, 0.02), "length": ("length", ">", 7.0, 6.0), "function": ("function", "<", 0.02, 0.1), "short": ("n", "<", 2, 40),
    "variety": ("variety", "<", 0.4, 0.65), "squeeze": ("squeeze", "<", 0.3, 0.4),
}


def votes(m: dict[str, float]) -> list[int]:
    out = []
    for name, way, bad, good in LABELLERS.values():
        v = m[name] if way == ">" else -m[name]
        bad, good = (bad, good) if way == ">" else (-bad, -good)
        thin = m["n"] < (1 if name == "n" else FEWEST)
        out.append(NONE if thin else BAD if v > bad else GOOD if v <= good else NONE)
    return out


def estimate(codes: dict[int, int], false_alarms: float = 0.02, steps: int = 100) -> tuple[np.ndarray, dict[int, float]]:
    """EM over counts of vote codes (base 3). Returns P(vote | class, a vote) (labellers, class, vote) and the
    posterior of a good text for each code. An abstention is no evidence.

    Class 0 is a good text; class 1 + i is a kind of bad text that starts from labeller i's vote against it. Bad
    texts come in kinds, and labellers that look at one kind agree on it: one class for all of them would take
    the votes of other kinds for noise. A labeller's votes against good texts are held to ``false_alarms``."""
    k = len(LABELLERS)
    if not codes:
        return np.full((k, k + 1, 2), 1 / 2), {}
    table = np.array([[c // 3**i % 3 for i in range(k)] for c in codes])
    n = np.array(list(codes.values()), dtype=float)
    p = np.empty((k, k + 1, 2))
    p[:] = (0.2, 0.8)  # votes: bad, good
    p[:, 0] = (false_alarms, 1 - false_alarms)
    p[np.arange(k), 1 + np.arange(k)] = (0.97, 0.03)
    share = np.array([0.85, *[0.15 / k] * k])
    hot = np.stack([table == v for v in (BAD, GOOD)], axis=2).astype(float)  # code, labeller, vote
    for _ in range(steps):
        log = np.einsum("clv,lkv->ck", hot, np.log(p)) + np.log(share)
        log -= log.max(axis=1, keepdims=True)
        post = np.exp(log)
        post /= post.sum(axis=1, keepdims=True)
        mass = post * n[:, None]
        share = (mass.sum(axis=0) + 1) / (n.sum() + k + 1)
        p = np.einsum("ck,clv->lkv", mass, hot) + 0.5
        p /= p.sum(axis=2, keepdims=True)
        over = np.minimum(p[:, 0, BAD], false_alarms)
        p[:, 0, BAD], p[:, 0, GOOD] = over, 1 - over
    return p, dict(zip(codes, post[:, 0].tolist()))


class Buckets(dict):
    """Buckets of lower-cased words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        b = self[word] = zlib.crc32(word.strip(b".,;:!?")) % WORDS
        return b

    def of(self, text: str | None, m: dict[str, float]) -> bytes:
        """The features of a text: its different words and its shape, as little-endian unsigned 16-bit numbers."""
        words = np.fromiter(map(self.__getitem__, set((text or "").encode().lower().split())), dtype="<u2")
        return np.unique(np.concatenate([words, np.array(shape_features(m), dtype="<u2")])).tobytes()


def shape_features(m: dict[str, float]) -> list[int]:
    """Hashed features of a text's measures, each in steps, so that a linear score can bend."""
    cut = {k: min(20, int(v * 20)) for k, v in m.items() if k not in ("n", "length")} | {"n": int(np.log2(m["n"] + 1)), "length": min(24, int(m["length"] * 2))}
    return [WORDS + zlib.crc32(f"{k}:{v}".encode()) % SHAPES for k, v in cut.items()]


@scoped
def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20000, threshold: float = 0.5) -> DataFrame:
    """doc_id, votes (one digit for each labeller: 0 bad, 1 good, 2 none), posterior, score, kept, for each row.

    A row is kept unless its posterior and its score both speak against it. EM covers every row; the scorer is
    fitted on at most about ``max_rows`` posteriors, chosen by a hash of the row's id and features. Null and wordless
    texts get no votes and the prior as posterior; null ids keep their row; repeated rows get equal results; an empty
    table gives no rows; very long texts are read whole; other columns are not read."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for b in batches:
            codes, features = [], []
            for t in b.column("text"):
                m = measures(t.as_py())
                codes.append(sum(v * 3**i for i, v in enumerate(votes(m))))
                features.append(buckets.of(t.as_py(), m))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(codes, pa.int32()), pa.array(features, pa.binary())], ["doc_id", "code", "f"])

    seen = cut(src.mapInArrow(run, f"doc_id {kind}, code int, f binary"), "votes")
    codes = {r["code"]: r["count"] for r in seen.groupBy("code").count().collect()}  # at most 3 ** labellers rows
    _, post = estimate(dict(sorted(codes.items())))
    key = F.xxhash64("doc_id", "f")
    sample = bounded_sample(seen.select("code", "f", key.alias("_k")), "_k", max_rows).orderBy("_k", "f").select("code", "f").toArrow()  # about max_rows
    f = [np.frombuffer(x.as_buffer(), "<u2").tolist() for x in sample.column("f")]
    w, bias = linear.fit(np.array([post[c] for c in sample.column("code").to_pylist()]), f, WORDS + SHAPES, steps=80)
    model = docs.sparkSession.sparkContext.broadcast((w, bias, post))  # WORDS + SHAPES weights, 3 ** labellers posteriors

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias, post = model.value
        for b in batches:
            z = np.array([w[np.frombuffer(x.as_buffer(), "<u2")].sum() for x in b.column("f")]) + bias
            code = b.column("code").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(["".join(str(c // 3**i % 3) for i in range(len(LABELLERS))) for c in code]), pa.array([post[c] for c in code]), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "votes", "posterior", "score"])

    out = seen.mapInArrow(judge, f"doc_id {kind}, votes string, posterior double, score double")
    return out.withColumn("kept", (F.col("score") >= threshold) | (F.col("posterior") >= threshold))

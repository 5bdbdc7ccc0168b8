"""A hidden Markov language model, trained by Baum-Welch over all training texts.

States emit word classes, classes emit words: a frequent word is a class of its own, and every other word
belongs to the class of its last letters, in which it has its share of the counts and unknown words have one
share. So the transition and emission tables are bounded, while the counts of words follow the corpus and stay
distributed. A text's likelihood is exact: the forward recursion over its whole sequence of classes, times each
word's share of its class.

The recursion runs over chunks of many texts at once. A chunk's product of scaled transition and emission
matrices maps what enters it to what leaves it; chunks are then chained within each text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, cut, lower_words, scoped

STEP = 64
TAILS = 4096
#: What ends a text; no word has white space.
END = b"\n"
#: SQL for what the start of the fit takes of a text ``x`` (two bytes a token): all of it up to 4,096 tokens, or else
#: eight stretches of 512 tokens, the first at its first token, the last up to its last.
START = """if(length(x) <= 8192, array(x), transform(sequence(0, 7), i -> substring(x, cast(1 + 2 * ((length(x) div 2 - 512) * i div 7) as int), 1024)))"""


def word_key(word: bytes) -> int:
    """Signed 64-bit hash that stands for a word in joins."""
    import xxhash

    h = xxhash.xxh64_intdigest(word, 7)
    return h - (1 << 64) if h >> 63 else h


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAILS


# ---- the recursion


@dataclass
class Chunks:
    """Chunks of the texts of a batch, the longest first."""

    x: np.ndarray  # chunk, step: classes
    size: np.ndarray
    doc: np.ndarray
    nth: np.ndarray

    @classmethod
    def of(cls, seqs: list[np.ndarray]) -> Chunks:
        n = np.array([len(s) for s in seqs])
        k = -(-n // STEP)
        doc = np.repeat(np.arange(len(seqs)), k)
        nth = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        size = np.minimum(STEP, n[doc] - nth * STEP)
        x = np.zeros((len(doc), STEP), dtype=np.int32)
        x[np.arange(STEP) < size[:, None]] = np.concatenate(seqs) if len(seqs) else []
        order = np.argsort(-size, kind="stable")
        return cls(x[order], size[order], doc[order], nth[order])

    def live(self) -> list[int]:
        """How many chunks have a token at each step."""
        return [int(np.searchsorted(-self.size, -t, side="left")) for t in range(STEP)]


def _products(c: Chunks, pi: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each chunk's scaled matrix and the log of its scale. The first step of a text starts from ``pi``."""
    s = len(pi)
    m = np.empty((len(c.x), s, s))
    log = np.zeros(len(c.x))
    for t, n in enumerate(c.live()):
        e = b[c.x[:n, t]]
        if t == 0:
            m[:] = np.where((c.nth == 0)[:, None, None], pi[None, None, :], a[None]) * e[:, None, :]
        else:
            m[:n] = (m[:n].reshape(-1, s) @ a).reshape(n, s, s) * e[:, None, :]
        if t % 16 == 15 or t == STEP - 1:
            top = m[:n].max(axis=(1, 2))
            m[:n] /= top[:, None, None]
            log[:n] += np.log(top)
    return m, log


def _chain(c: Chunks, m: np.ndarray, log: np.ndarray, docs: int, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Log likelihood of each text; with ``keep``, what enters each chunk from its left and from its right."""
    s = m.shape[1]
    total = np.bincount(c.doc, log, docs)
    by = np.lexsort((c.doc, c.nth))
    bounds = np.searchsorted(c.nth[by], np.arange(c.nth.max(initial=-1) + 2))
    v = np.full((docs, s), 1 / s)
    left = np.empty((len(c.x), s)) if keep else None
    for i, j in zip(bounds, bounds[1:]):
        k = by[i:j]
        d = c.doc[k]
        if keep:
            left[k] = v[d]
        w = np.einsum("ns,nsr->nr", v[d], m[k])
        z = w.sum(axis=1)
        total[d] += np.log(z)
        v[d] = w / z[:, None]
    right = None
    if keep:
        right, v = np.empty((len(c.x), s)), np.ones((docs, s))
        for i, j in zip(bounds[-2::-1], bounds[:0:-1]):
            k = by[i:j]
            d = c.doc[k]
            right[k] = v[d]
            w = np.einsum("nsr,nr->ns", m[k], v[d])
            v[d] = w / w.sum(axis=1)[:, None]
    return total, left, right


def log_likelihood(seqs: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural log likelihood of whole class sequences; 0 for an empty one."""
    out = np.zeros(len(seqs))
    for part in _parts(seqs):
        c = Chunks.of([seqs[i] for i in part])
        if len(c.x):
            out[part] = _chain(c, *_products(c, model.pi, model.a, model.b), len(part), False)[0]
    return out


def _parts(seqs: list[np.ndarray], tokens: int = 150_000) -> Iterator[list[int]]:
    part, held = [], 0
    for i, s in enumerate(seqs):
        part.append(i)
        held += len(s)
        if held >= tokens:
            yield part
            part, held = [], 0
    if part:
        yield part


@dataclass
class Model:
    pi: np.ndarray
    a: np.ndarray
    b: np.ndarray  # class, state


def expected_counts(seqs: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions (class, state): the E step of Baum-Welch."""
    pi, a, b = model.pi, model.a, model.b
    s = len(pi)
    starts, moves, emits = np.zeros(s), np.zeros((s, s)), np.zeros_like(b)
    for part in _parts(seqs):
        c = Chunks.of([seqs[i] for i in part])
        if not len(c.x):
            continue
        _, left, right = _chain(c, *_products(c, pi, a, b), len(part), True)
        live, first = c.live(), (c.nth == 0)[:, None]
        alpha = np.empty((STEP, len(c.x), s))
        for t, n in enumerate(live):
            step = (np.where(first, pi, left @ a) if t == 0 else alpha[t - 1, :n] @ a) * b[c.x[:n, t]]
            alpha[t, :n] = step / step.sum(axis=1)[:, None]
        beta = right
        for t in range(STEP - 1, -1, -1):
            n = live[t]
            if not n:
                continue
            gamma = alpha[t, :n] * beta[:n]
            gamma /= gamma.sum(axis=1)[:, None]
            for k in range(s):
                emits[:, k] += np.bincount(c.x[:n, t], gamma[:, k], len(b))
            q = b[c.x[:n, t]] * beta[:n]
            before = left if t == 0 else alpha[t - 1, :n]
            norm = ((before @ a) * q).sum(axis=1)[:, None]
            if t == 0:
                starts += gamma[first[:, 0]].sum(axis=0)
                rest = ~first[:, 0]
                moves += a * (before[rest].T @ (q / norm)[rest])
            else:
                moves += a * (before.T @ (q / norm))
                back = q @ a.T
                beta[:n] = back / back.sum(axis=1)[:, None]
    return starts, moves, emits


def maximise(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, share: np.ndarray) -> Model:
    """The M step; emissions are smoothed with the classes' overall shares, so none is zero."""
    pi = starts + 1
    a = moves + 1
    b = emits + 50 * share[:, None] + 1e-3
    return Model(pi / pi.sum(), a / a.sum(axis=1, keepdims=True), b / b.sum(axis=0, keepdims=True))


def initial(seqs: list[np.ndarray], share: np.ndarray, states: int, rounds: int = 12, starts: int = 3) -> Model:
    """A starting point from a bounded sample: spread-out texts seed the states, then Baum-Welch on the sample. Of
    ``starts`` such points, one that the sample is likeliest under."""
    return max((_start(seqs, share, states, rounds, seed) for seed in range(5, 5 + starts)), key=lambda x: x[0])[1]


def _start(seqs: list[np.ndarray], share: np.ndarray, states: int, rounds: int, seed: int) -> tuple[float, Model]:
    n = len(share)
    rng = np.random.default_rng(seed)
    hist = [np.sqrt(np.bincount(s, minlength=n) / max(len(s), 1)) for s in seqs if len(s) > 30][:400]
    seeds = [np.sqrt(share)]
    while hist and len(seeds) < states:
        far = np.max([[h @ x for h in hist] for x in seeds], axis=0)
        seeds.append(hist[int(np.argmin(far + 0.05 * rng.random(len(far))))])
    while len(seeds) < states:
        seeds.append(np.sqrt(share))
    b = np.stack([0.5 * x**2 + 0.5 * share for x in seeds], axis=1) * rng.uniform(0.8, 1.2, (n, states)) + 1e-9
    a = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    model = Model(np.full(states, 1 / states), a / a.sum(axis=1, keepdims=True), b / b.sum(axis=0, keepdims=True))
    for _ in range(rounds):
        model = maximise(*expected_counts(seqs, model), share)
    return float(log_likelihood(seqs, model).sum()), model


# ---- the corpus


def word_counts(docs: DataFrame, held: int = 500_000) -> DataFrame:
    """(h, tail, c) of every word and the end, over ``docs`` (text). Tasks count before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            w = list(seen)
            out = pa.RecordBatch.from_arrays([pa.array([word_key(x) for x in w], pa.int64()), pa.array([tail_class(x) for x in w], pa.int32()), pa.array([seen[x] for x in w], pa.int64())], ["h", "tail", "c"])
            seen.clear()
            return out

        for b in batches:
            for t in b.column("text"):
                seen.update(lower_words(t.as_py()))
                seen[END] += 1
                if len(seen) > held:
                    yield flush()
        yield flush()

    return cut(docs.select("text").mapInArrow(run, "h bigint, tail int, c bigint").groupBy("h").agg(F.first("tail").alias("tail"), F.sum("c").alias("c")), "counts")


def slices(texts: pa.Array, rows: int = 512, size: int = 1 << 27) -> Iterator[tuple[int, int]]:
    """(first, last) of neighbouring texts: ``rows`` or fewer, and about ``size`` bytes or one text."""
    first = held = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > first and (i - first == rows or held + n > size):
            yield first, i
            first, held = i, 0
        held += n
    if first < len(texts):
        yield first, len(texts)


class Words(dict):
    """What is known of each word, as rows of arrays: its class, log10(c + 1) for a common word, its share of a
    class with others, and its hash if it is not common. Words met before are kept, up to a bound."""

    def __init__(self, own: dict[int, int], known: dict[int, int], log_mass: np.ndarray, own_classes: int, cached: int = 400_000) -> None:
        super().__init__()
        self.own, self.common, self.log_mass, self.own_classes, self.cached = own, known, log_mass, own_classes, cached
        self.cls, self.up, self.part, self.hash = (np.zeros(0, dtype=t) for t in ("<u2", float, float, np.int64))
        self.new: list[tuple[int, float, float, int]] = []

    def __missing__(self, w: bytes) -> int:
        h = word_key(w)
        c, cls = self.common.get(h), self.own.get(h)
        up = math.log10(c + 1) if c is not None else 0.0
        if cls is None:
            tail = tail_class(w)
            self.new.append((self.own_classes + tail, up, up - self.log_mass[tail], 0 if c is not None else h))
        else:
            self.new.append((cls, up, 0.0, 0))
        i = self[w] = len(self)
        return i

    def ids(self, texts: list[list[bytes]], n: int) -> np.ndarray:
        """Rows of the words of ``texts``, which are ``n``."""
        if len(self) > self.cached:
            self.clear()
            self.cls, self.up, self.part, self.hash = (x[:0] for x in (self.cls, self.up, self.part, self.hash))
        out = np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), dtype=np.int32, count=n)
        if self.new:
            cols = zip(*self.new)
            self.cls, self.up, self.part, self.hash = (np.concatenate([x, np.array(c, dtype=x.dtype)]) for x, c in zip((self.cls, self.up, self.part, self.hash), cols))
            self.new = []
        return out


def most_frequent(counts: DataFrame, n: int) -> list:
    """The ``n`` words with the highest counts. Steps of the counts' logarithm are counted first, so that tasks
    send little more than ``n`` rows together, not ``n`` each."""
    step = F.floor(F.log2("c") * 8)
    enough, least = 0, 0
    for r in counts.groupBy(step.alias("b")).count().orderBy(F.desc("b")).collect():  # 8 for each doubling
        enough, least = enough + r["count"], r["b"]
        if enough >= n:
            break
    return counts.where(step >= least).orderBy(F.desc("c"), "h").limit(n).collect()


@scoped
def score(docs: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", states: int = 6, own_classes: int = 8192, common: int = 65536, passes: int = 2, sample: int = 400) -> DataFrame:
    """doc_id, trained, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    ``trains``: which rows (over doc_id) the model learns from. ``passes``: Baum-Welch over all of those, after
    a start from about ``sample`` different ones of them: whole up to 4,096 tokens, and eight stretches of 512 spread
    from the first to the last token of longer ones. Which ones depends on the texts alone, so equal rows in another
    order, or in other files, get equal scores. Null texts are empty: their one token is the end. Null ids keep
    their row; repeated rows each get the same score; an empty table gives no rows; without training rows
    every word is unknown and the tables are uniform. Other columns are not read."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    src = src.withColumn("trained", trains)
    spark, kind = docs.sparkSession, src.schema["doc_id"].dataType.simpleString()
    counts = word_counts(src.where("trained"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v_all = total["n"], total["v"]
    top = most_frequent(counts, common)
    own = {r["h"]: i for i, r in enumerate(top[:own_classes])}
    tails = {r["tail"]: (r["n"], r["v"]) for r in counts.groupBy("tail").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}  # TAILS rows
    for r in top[:own_classes]:
        n, v = tails[r["tail"]]
        tails[r["tail"]] = (n - r["c"], v - 1)
    share = np.zeros(own_classes + TAILS)
    share[: len(own)] = [r["c"] for r in top[:own_classes]]
    mass = np.zeros(TAILS)  # a class's counts with one for each of its words and for what is unknown
    for t in range(TAILS):
        n, v = tails.get(t, (0, 0))
        share[own_classes + t] = n + 1
        mass[t] = n + v + 1
    share /= share.sum()
    known = {r["h"]: r["c"] for r in top}
    tables = spark.sparkContext.broadcast((own, known, np.log10(mass)))  # bounded by `common` and TAILS

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*tables.value, own_classes)
        for b in batches:
            for first, last in slices(b.column("text")):
                part = b.slice(first, last - first)
                texts = [[*lower_words(t.as_py()), END] for t in part.column("text")]
                n = np.array([len(t) for t in texts])
                i = words.ids(texts, int(n.sum()))
                start = np.concatenate([[0], np.cumsum(n)])
                h = words.hash[i]
                left = h != 0
                rest = np.add.reduceat(left, start[:-1], dtype=np.int64)
                sums = (np.add.reduceat(x[i], start[:-1]) for x in (words.up, words.part))
                x = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((2 * start).astype(np.int32)), pa.py_buffer(words.cls[i])])
                hashes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rest)]).astype(np.int32)), pa.array(h[left]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("trained"), x, pa.array(n), pa.array(n - rest), *map(pa.array, sums), hashes], ["doc_id", "trained", "x", "n_tokens", "n_common", "up", "part", "rest"])

    coded = src.mapInArrow(encode, f"doc_id {kind}, trained boolean, x binary, n_tokens bigint, n_common bigint, up double, part double, rest array<bigint>")
    coded = cut(coded.withColumn("row", F.monotonically_increasing_id()), "coded")
    size, fits = own_classes + TAILS, coded.where("trained").select("x")
    n_fit = max(1, fits.count())
    k = F.xxhash64("x")  # the content: a row's number follows the files
    few = fits.where(F.pmod(k, F.lit(1_000_000)) < min(1_000_000, int(2 * sample / n_fit * 1e6) + 1)).groupBy(k.alias("k")).agg(F.min("x").alias("x")).orderBy("k").limit(sample)
    seqs = [np.frombuffer(r["x"], "<u2").astype(np.int32) for r in few.select(F.explode(F.expr(START)).alias("x")).collect()]  # a bounded start for the fit
    model = initial(seqs, share, states)

    for _ in range(passes):
        shared = spark.sparkContext.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                got = expected_counts([np.frombuffer(x.as_py(), "<u2").astype(np.int32) for x in b.column("x")], shared.value)
                total = got if total is None else tuple(p + q for p, q in zip(total, got))
            if total is not None:
                flat = np.concatenate([total[0], total[1].ravel(), total[2].ravel()])
                at = np.flatnonzero(flat)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["i", "v"])

        flat = np.zeros(states + states * states + size * states)
        for r in fits.mapInArrow(count, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toLocalIterator():  # the model's size
            flat[r["i"]] = r["v"]
        model = maximise(flat[:states], flat[states : states + states**2].reshape(states, states), flat[states + states**2 :].reshape(size, states), share)

    final = spark.sparkContext.broadcast(model)

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = log_likelihood([np.frombuffer(x.as_py(), "<u2").astype(np.int32) for x in b.column("x")], final.value) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in b.schema.names if n != "x"), pa.array(got)], [n for n in b.schema.names if n != "x"] + ["ll"])

    scored = coded.select("row", "doc_id", "trained", "n_tokens", "n_common", "up", "part", "x").mapInArrow(likelihood, f"row bigint, doc_id {kind}, trained boolean, n_tokens bigint, n_common bigint, up double, part double, ll double")
    rest = coded.select("row", F.explode("rest").alias("h")).groupBy("h", "row").agg(F.count(F.lit(1)).alias("k"))
    found = rest.join(counts.select("h", "c"), "h").groupBy("row").agg(F.sum("k").alias("n_found"), F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("found"))
    out = scored.join(found, "row", "left").na.fill(0, ["n_found", "found"])
    base = F.col("up") + F.col("found") - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))
    return out.select("doc_id", "trained", "n_tokens", (F.col("n_common") + F.col("n_found")).alias("n_known"), F.lit(int(n_all)).alias("train_tokens"), base.alias("base_score"), (F.col("ll") + F.col("part") + F.col("found")).alias("score"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 2, folds: int = 7) -> DataFrame:
    """``score`` with the rows whose crc32(id) mod ``folds`` is ``held_out`` left out of the training."""
    got = score(docs, crc_mod(F.col("doc_id"), folds) != held_out, id_col, text_col)
    return got.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

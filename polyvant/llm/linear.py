"""A hashed linear scorer: word features in a bounded table, fitted on a bounded sample."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BUCKETS = 1 << 18
_LETTERS = re.compile(r"[^\W\d_]+")


def word_features(word: bytes, prefixes: tuple[int, ...] = (4, 5, 6, 7)) -> tuple[int, ...]:
    """Buckets of a lower-cased chunk: its letter runs and their prefixes."""
    out = []
    for w in _LETTERS.findall(word.decode(errors="replace").lower()):
        out.append(zlib.crc32(b"w" + w.encode()) % BUCKETS)
        out += [zlib.crc32(b"p" + w[:n].encode()) % BUCKETS for n in prefixes if len(w) > n]
    return tuple(out)


#: A bucket is also a feature of its own where a text has it at least so often.
LEVELS = (1, 2, 3, 5)
SIZE = BUCKETS * len(LEVELS)


class Features:
    """The features of texts, limited to ``chosen`` ones if given, with a bounded cache of chunks. A feature is
    level * BUCKETS + bucket."""

    def __init__(self, chosen: np.ndarray | None = None, cached: int = 400_000) -> None:
        self.place = None if chosen is None else {int(b): i for i, b in enumerate(chosen)}
        self.bases = None if chosen is None else {int(b) % BUCKETS for b in chosen}
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.cached = cached

    def of(self, chunk: bytes) -> tuple[int, ...]:
        f = word_features(chunk)
        return f if self.bases is None else tuple(x for x in f if x in self.bases)

    def __call__(self, chunks: Iterable[bytes]) -> list[int]:
        known, found = self.known, {}
        if len(known) > self.cached:
            known.clear()
        for c, n in Counter(chunks).items():
            f = known.get(c)
            if f is None:
                f = known[c] = self.of(c)
            for x in f:
                found[x] = found.get(x, 0) + n
        ids = [level * BUCKETS + x for x, n in found.items() for level, least in enumerate(LEVELS) if n >= least]
        return sorted(ids if self.place is None else (self.place[i] for i in ids if i in self.place))


def counts(rows: DataFrame) -> np.ndarray:
    """(2, SIZE): in how many texts of ``rows`` (y double in 0..1, text) each feature is found, weighted by 1 - y
    and y. Each task sums its own; at most SIZE rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(), np.zeros((2, SIZE))
        for b in batches:
            for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()):
                f = features((t or "").encode().lower().split())
                total[0, f] += 1 - y
                total[1, f] += y
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], ["b", "n", "p"])

    out = np.zeros((2, SIZE))
    for r in rows.select("y", "text").mapInArrow(run, "b bigint, n double, p double").groupBy("b").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).where("n + p >= 4").toLocalIterator():
        out[:, r["b"]] = r["n"], r["p"]
    return out


def choose(table: np.ndarray, n_neg: float, n_pos: float, limit: int = 4096) -> np.ndarray:
    """The buckets whose shares differ most between the classes, by the z score of the difference."""
    n, p = table
    both = (n + p) / max(1e-9, n_neg + n_pos)
    z = (p / max(n_pos, 1e-9) - n / max(n_neg, 1e-9)) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / max(n_pos, 1e-9) + 1 / max(n_neg, 1e-9)))
    z[n + p < 4] = 0
    best = np.argsort(-np.abs(z))[:limit]
    return np.sort(best[np.abs(z[best]) > 2.5])


def expand(words: Iterable[bytes]) -> np.ndarray:
    """Every feature that the words have, at all levels."""
    found = {x for w in words for x in word_features(w)}
    return np.array(sorted(level * BUCKETS + x for x in found for level in range(len(LEVELS))), dtype=np.int64)


Pair = tuple[list[int], list[int]]
Counterfactuals = Callable[[list[bytes]], list[tuple[list[bytes], list[bytes]]]]


def matrix(rows: DataFrame, chosen: np.ndarray, change: Counterfactuals | None = None) -> tuple[np.ndarray, list[list[int]], list[Pair]]:
    """(y, features, counterfactual pairs) of a bounded sample, on the driver: chosen features only. ``change`` gives,
    for a text's chunks, pairs of texts that should score alike; of each pair come the features that only its first
    and only its second text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(chosen)
        for b in batches:
            here, plus, minus = [], [], []
            for t in b.column("text").to_pylist():
                chunks = (t or "").encode().lower().split()
                here.append(features(chunks))
                both = [(set(features(x)), set(features(y))) for x, y in (change(chunks) if change else [])]
                plus.append([sorted(x - y) for x, y in both])
                minus.append([sorted(y - x) for x, y in both])
            nested = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(here, pa.list_(pa.int32())), pa.array(plus, nested), pa.array(minus, nested)], ["y", "f", "p", "m"])

    found = rows.select(F.col("y").cast("double").alias("y"), "text").mapInArrow(run, "y double, f array<int>, p array<array<int>>, m array<array<int>>").collect()
    return np.array([r["y"] for r in found]), [r["f"] for r in found], [x for r in found for x in zip(r["p"], r["m"])]


def _sparse(f: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(f)), [len(x) for x in f]), np.array([i for x in f for i in x], dtype=np.int64)


def _top(times: Callable[[np.ndarray], np.ndarray], n: int) -> float:
    """Largest eigenvalue of a symmetric matrix, by its product with vectors."""
    x, top = np.random.default_rng(0).random(n), 0.0
    for _ in range(12):
        x = times(x)
        top = float(np.linalg.norm(x))
        x /= top or 1.0
    return top


def objective(w: np.ndarray, b: float, y: np.ndarray, f: list[list[int]], pairs: list[Pair], fairness: float, ridge: float, shrink: float) -> float:
    """What ``fit`` makes small."""
    z = np.array([w[x].sum() for x in f]) + b
    loss = np.mean(np.logaddexp(0, z) - y * z) + ridge / 2 * (w @ w) + shrink * np.abs(w).sum()
    return float(loss + fairness / len(y) * sum((w[p].sum() - w[m].sum()) ** 2 for p, m in pairs))


def fit(y: np.ndarray, f: list[list[int]], n: int, pairs: list[Pair] = (), fairness: float = 1.0, ridge: float = 1e-3, shrink: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights by accelerated proximal gradient, with soft labels, a ridge and an L1 term. For each of
    ``pairs`` the squared difference of the two logits is penalised by ``fairness``."""
    if not len(y):
        return np.zeros(n), 0.0
    r, c = _sparse(f)
    w, b = np.zeros(n), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    if not len(c):
        return w, b
    (pr, pc), (mr, mc) = _sparse([p for p, _ in pairs]), _sparse([m for _, m in pairs])
    dot = lambda v: np.bincount(r, v[c], len(y))
    gap = lambda v: np.bincount(pr, v[pc], len(pairs)) - np.bincount(mr, v[mc], len(pairs))
    back = lambda d: np.bincount(pc, d[pr], n) - np.bincount(mc, d[mr], n)
    push = 2 * fairness / len(y)
    steep = 0.25 * _top(lambda v: np.bincount(c, dot(v)[r], n), n) / len(y) + (push * _top(lambda v: back(gap(v)), n) if len(pairs) else 0)
    rate = 1 / (1.05 * steep + ridge + 1e-9)
    v, t = w.copy(), 1.0
    for _ in range(steps):
        z = dot(v) + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.bincount(c, e[r], n) + ridge * v
        if len(pairs):
            grad += push * back(gap(v))
        b -= 2 * e.sum()
        new = v - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * shrink, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return w, b


def score(docs: DataFrame, chosen: np.ndarray, weights: np.ndarray, bias: float, keep: list[str], text_col: str = "text") -> DataFrame:
    """``docs`` with a column score (0 to 1) and without its text. The model has a fixed size."""
    src = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").alias("_text"))
    out = src.drop("_text").withColumn("score", F.lit(0.0)).schema
    used = np.flatnonzero(weights)
    model = docs.sparkSession.sparkContext.broadcast((chosen[used], weights[used], bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, w, b0 = model.value
        features, w = Features(buckets), w.tolist()
        for b in batches:
            z = np.array([b0 + sum(w[i] for i in features((t.as_py() or "").encode().lower().split())) for t in b.column("_text")])
            rest = [b.column(n) for n in keep]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], [*keep, "score"])

    return src.mapInArrow(run, out)

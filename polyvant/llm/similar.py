"""Links between texts whose word shingles have a Jaccard similarity of at least a bound.

A 64-bit SimHash within two bits means shingles that are nearly all equal; at a similarity of 0.8, texts differ in
about ten bits, which no covering code reaches. So for a similarity bound, candidates come from min-wise hashes of
the shingles, in bands, and the similarity of each candidate is computed exactly.

Texts that share a band are compared without making all pairs: in a small bucket each with each, which is at most
``small`` for a member; in a large one each with the bucket's hub, the member whose bands are the most popular.
Copies of one text that were edited apart from each other resemble that text more than one another, and it is
the one that shares most bands with all of them. Where a large bucket is still in several groups after that, its
texts are joined by their rarest shingles (``crossing``): that leaves out no pair which is similar enough, and
makes no pair within a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_words

BANDS, ROWS = 32, 4
_RNG = np.random.default_rng(77)
_A = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def bands(shingles: np.ndarray) -> np.ndarray:
    """Keys (int64) of the bands of a set of shingle hashes (uint64). At similarity 0.8, two texts share no band
    once in 2 * 10**7 cases."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 4096):
            x = shingles[None, i : i + 4096] * _A[:, None] + _B[:, None]
            least = np.minimum(least, x.min(axis=1))
        key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(ROWS):
            key = (key ^ least[r::ROWS]) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(31)
    return key.view(np.int64)


def jaccard(a: str | None, b: str | None, shingle: int) -> float:
    x, y = (_set(t, shingle) for t in (a, b))
    return len(x & y) / max(1, len(x | y))


def _set(text: str | None, shingle: int) -> set:
    w = lower_words(text)
    return set(zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else {tuple(w)} if w else set()


def candidates(sketches: DataFrame, small: int = 16) -> tuple[DataFrame, DataFrame]:
    """(u, v) from ``sketches`` (_h, bands), one row for each different text; and (k, _h) of the buckets of more
    than ``small``, in which not all pairs are among them."""
    rows = sketches.select("_h", F.explode("bands").alias("k"))
    size = cut(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    shared = cut(rows.join(size, "k"), "shared")
    popular = shared.groupBy("_h").agg(F.sum("n").alias("popular"))
    few = shared.where(F.col("n") <= small).select("k", "_h")
    pairs = few.toDF("k", "u").join(few.toDF("k", "v").hint("merge"), "k")  # a text has a row for each band: not to be broadcast
    pairs = pairs.where("u < v").select("u", "v")
    many = cut(shared.where(F.col("n") > small).select("k", "_h").join(popular, "_h"), "many")
    hub = cut(many.groupBy("k").agg(F.max(F.struct("popular", "_h")).alias("x")).select("k", F.col("x._h").alias("v")), "hubs")
    star = many.join(hub, "k").where(F.col("_h") != F.col("v")).select(F.least("_h", "v").alias("u"), F.greatest("_h", "v").alias("v"))
    return pairs.union(star).distinct(), many.select("k", "_h")


def divided(many: DataFrame, found: DataFrame) -> DataFrame:
    """(_h, root): the texts of those buckets of ``many`` (k, _h) that are in several groups of ``found`` (node, root)."""
    rooted = many.join(found.toDF("_h", "root"), "_h", "left").withColumn("root", F.coalesce("root", "_h"))
    rooted = cut(rooted, "rooted")
    split = cut(rooted.groupBy("k").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("k"), "divided")
    return cut(rooted.join(split, "k").select("_h", "root").distinct(), "apart")


def _least(counts: DataFrame, ranked: int) -> int:
    """The lowest count that at most ``ranked`` rows of ``counts`` (x, n) reach. A sort with a limit would gather so many
    rows from each partition in one place."""
    least, rows = 1 << 62, 0
    for n, of in sorted(counts.groupBy("n").count().collect(), reverse=True):  # different counts: few
        rows += of
        if rows > ranked:
            break
        least = n
    return least


def crossing(apart: DataFrame, texts: DataFrame, similarity: float, hashes: Callable[[str], np.ndarray], ranked: int = 1 << 18) -> DataFrame:
    """(u, v): every pair of ``apart`` (_h, root) with different roots that can have the ``similarity``.

    With each text's shingles in one order for all, rarest first, the first one that two texts share has at most
    ``size - place`` shared ones from there on in either; that has to reach the overlap which the similarity asks
    for. Only the ``ranked`` most frequent shingles are told apart by frequency; the order is the same for all texts
    in any case. At a shingle, the rows outside its largest group meet all rows of other groups."""
    src = cut(apart.join(texts, "_h").select("_h", "root", "text"), "apart_texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, n = np.unique(np.concatenate([np.unique(hashes(t.as_py())) for t in b.column("text")]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(n)], ["x", "n"])

    counts = cut(src.select("text").mapInArrow(count, "x bigint, n bigint").groupBy("x").agg(F.sum("n").alias("n")).where("n > 1"), "counts")
    often = counts.where(F.col("n") >= _least(counts, ranked)).toPandas()
    by = np.argsort(often["x"].to_numpy(np.int64))
    shared = src.sparkSession.sparkContext.broadcast((often["x"].to_numpy(np.int64)[by], often["n"].to_numpy(np.int64)[by]))  # at most `ranked`

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = shared.value
        for b in batches:
            out, size = [], []
            for t in b.column("text"):
                x = np.unique(hashes(t.as_py())).view(np.int64)
                at = np.minimum(np.searchsorted(known, x), max(0, len(known) - 1))
                f = np.where(known[at] == x, n[at], 0) if len(known) else np.zeros(len(x), np.int64)
                size.append(len(x))
                out.append(x[np.lexsort((x, f))][: len(x) - int(np.ceil(similarity * len(x) - 1e-9)) + 1])
            yield pa.RecordBatch.from_arrays([b.column("_h"), b.column("root"), pa.array(size, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["_h", "root", "size", "x"])

    rows = cut(src.mapInArrow(rarest, "_h bigint, root bigint, size bigint, x array<bigint>").select("_h", "root", "size", F.posexplode("x").alias("place", "x")), "rarest")
    groups = rows.groupBy("x", "root").agg(F.count(F.lit(1)).alias("n"))
    most = cut(groups.groupBy("x").agg(F.max(F.struct("n", "root")).alias("m"), F.count(F.lit(1)).alias("groups")).where("groups > 1").select("x", F.col("m.root").alias("most")), "most")
    rows = cut(rows.join(most, "x"), "shared_shingles")
    a = rows.where("root <> most").select("x", *(F.col(c).alias(f"{c}_a") for c in ("_h", "root", "size", "place")))
    least = F.ceil((F.col("size_a") + F.col("size")) * (similarity / (1 + similarity)) - 1e-9)
    met = a.join(rows, "x").where((F.col("root_a") != F.col("root")) & (F.col("size_a") - F.col("place_a") >= least) & (F.col("size") - F.col("place") >= least))
    return met.select(F.least("_h_a", "_h").alias("u"), F.greatest("_h_a", "_h").alias("v")).distinct()


def links(pairs: DataFrame, texts: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The pairs (u, v) whose texts, of ``texts`` (_h, text) with one row for each ``_h``, are similar enough."""
    d = pairs.join(texts.toDF("u", "a"), "u").join(texts.toDF("v", "b"), "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ok = [jaccard(a.as_py(), b.as_py(), shingle) >= similarity for a, b in zip(x.column("a"), x.column("b"))]
            yield pa.RecordBatch.from_arrays([x.column("u"), x.column("v")], ["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return d.mapInArrow(run, "u bigint, v bigint")

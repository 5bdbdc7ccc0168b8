"""SimHash near-duplicates by anchor points of a covering code.

The 64 bits hold two blocks of 23. The binary Golay code of length 23 is perfect: every 23-bit word lies
within 3 bits of exactly one codeword. Pairs of codewords are the anchors. Each fingerprint is *filed* at
its one nearest anchor, and *replicated* to every anchor that lies within the covering radius plus the
threshold: if x and y differ in at most t bits, y is replicated to the anchor at which x is filed, whatever
the bits are. So comparing filed with replicated fingerprints at each anchor finds every pair, with no
limit on a bucket. Only different fingerprints are compared, and one fingerprint has at most
C(64,1) + C(64,2) = 2080 others within two bits: links grow with the number of fingerprints, never with
the square of a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similar
from .common import cut, lower_words, scoped
from .components import connected_components

BLOCK, RADIUS = 23, 3
#: Generator polynomial of the binary Golay code of length 23, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011


@lru_cache(maxsize=1)
def _syndromes() -> np.ndarray:
    """Syndrome (11 bits) of each bit of a block: x^i modulo the generator."""
    out = []
    for i in range(BLOCK):
        r = 1 << i
        for k in range(BLOCK - 1, 10, -1):
            if r >> k & 1:
                r ^= GOLAY << (k - 11)
        out.append(r)
    return np.array(out, dtype=np.int64)


@lru_cache(maxsize=4)
def _patterns(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns of up to RADIUS + threshold bits, sorted by (syndrome, weight): patterns, weights,
    and where each syndrome's patterns start."""
    s = _syndromes()
    pats, synd, weight = [], [], []
    for w in range(RADIUS + threshold + 1):
        c = np.array(list(combinations(range(BLOCK), w)), dtype=np.int64)
        pats.append((np.int64(1) << c).sum(axis=1, dtype=np.int64))
        synd.append(np.bitwise_xor.reduce(s[c], axis=1))
        weight.append(np.full(len(c), w))
    pats, synd, weight = map(np.concatenate, (pats, synd, weight))
    order = np.lexsort((weight, synd))
    return pats[order], weight[order], np.searchsorted(synd[order], np.arange(2049))


def _syndrome(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for i, s in enumerate(_syndromes()):
        out ^= np.where(x >> i & 1, s, 0)
    return out


def nearest_anchor(fp: np.ndarray) -> np.ndarray:
    """The one anchor at which each fingerprint (int64) is filed."""
    pats, _, start = _patterns(0)
    mask = (1 << BLOCK) - 1
    lo, hi = fp & mask, fp >> BLOCK & mask
    return (lo ^ pats[start[_syndrome(lo)]]) | (hi ^ pats[start[_syndrome(hi)]]) << BLOCK


def covering_anchors(fp: np.ndarray, threshold: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor) for every anchor at which a fingerprint within ``threshold`` bits may be filed:
    what the two blocks exceed the radius by adds up to ``threshold`` at most."""
    pats, weight, start = _patterns(threshold)
    mask = (1 << BLOCK) - 1
    lo, hi = fp & mask, fp >> BLOCK & mask
    s_lo, s_hi = _syndrome(lo), _syndrome(hi)
    over = np.maximum(weight - RADIUS, 0)
    # number of patterns of a syndrome with an excess of at most e
    ends = np.array([start[:-1] + np.bincount(np.repeat(np.arange(2048), np.diff(start))[over <= e], minlength=2048) for e in range(threshold + 1)])
    who, where = [], []
    for e in range(threshold + 1):  # excess of exactly e in the low block, up to threshold - e in the high one
        first = start[s_lo] if e == 0 else ends[e - 1][s_lo]
        n_lo, n_hi = ends[e][s_lo] - first, ends[threshold - e][s_hi] - start[s_hi]
        n = n_lo * n_hi
        i = np.repeat(np.arange(len(fp)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a = lo[i] ^ pats[first[i] + k // n_hi[i]]
        b = hi[i] ^ pats[start[s_hi[i]] + k % n_hi[i]]
        who.append(i)
        where.append(a | b << BLOCK)
    return np.concatenate(who), np.concatenate(where)


def shingle_hashes(text: str | None, shingle: int = 3) -> np.ndarray:
    """Hashes (uint64) of a text's word shingles, repeats included: of all its words if they are fewer."""
    import xxhash

    w = lower_words(text)
    h = xxhash.xxh64_intdigest
    if len(w) >= shingle:
        return np.array([h(b" ".join(g), 42) for g in zip(*(w[i:] for i in range(shingle)))], dtype="<u8")
    return np.array([h(b" ".join(w), 42)] if w else [], dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash: the bits set in over half the hashes; 0 for none."""
    bits = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        bits += np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    return majority(shingle_hashes(text, shingle))


def with_fingerprint(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, shingle: int = 3) -> DataFrame:
    """``docs`` with a column ``_fp`` (bigint). ``keep``: the columns to carry along, all by default. A null
    text counts as empty; other columns, nulls and repeated rows pass through."""
    src = docs.select(*(F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)), F.col(f"`{text_col}`").alias("_fp_text"))
    out = src.drop("_fp_text").withColumn("_fp", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in b.column("_fp_text")], pa.int64())
            rest = [b.column(i) for i, n in enumerate(b.schema.names) if n != "_fp_text"]
            yield pa.RecordBatch.from_arrays([*rest, fps], [n for n in b.schema.names if n != "_fp_text"] + ["_fp"])

    return src.mapInArrow(run, out)


def links(fps: DataFrame, threshold: int = 2) -> DataFrame:
    """(u, v) of the distinct fingerprints ``fps`` (_fp) that differ in 1 to ``threshold`` bits, from one side
    or both."""

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(nearest_anchor(x)), pa.array(x)], ["anchor", "u"])

    def replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(x), 2048):
                who, where = covering_anchors(x[i : i + 2048], threshold)
                yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(x[i : i + 2048][who])], ["anchor", "v"])

    left = fps.select("_fp").mapInArrow(filed, "anchor bigint, u bigint")
    right = fps.select("_fp").mapInArrow(replicated, "anchor bigint, v bigint")
    right = right.hint("merge")  # some 61 rows for each that Spark's estimate counts: not to be broadcast
    return left.join(right, "anchor").where(F.col("u") != F.col("v")).where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= threshold).select("u", "v")


def components(rows: DataFrame, id_col: str, threshold: int = 2) -> DataFrame:
    """(_fp, component_id) for each distinct ``_fp`` of ``rows``: the smallest id of the fingerprints that can
    be reached over links. Null when no row of the component has an id."""
    by_fp = cut(rows.groupBy("_fp").agg(F.min(f"`{id_col}`").alias("least_id")), "fingerprints")
    found = connected_components(links(by_fp, threshold))
    named = by_fp.join(found.toDF("_fp", "root"), "_fp", "left").withColumn("root", F.coalesce("root", "_fp"))
    least = cut(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")  # stored: a join with it can be split
    return cut(named.select("_fp", "root").join(least, "root").select("_fp", "component_id", "root"), "components")


@scoped
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 2, shingle: int = 3) -> DataFrame:
    """One row for each row of ``docs``: the id, fingerprint (16 hex digits), component_id.

    Null or wordless texts have fingerprint zero and are linked like any other; a null id keeps its row but
    names no component; repeated rows each get their row; an empty table gives an empty result; only the two
    named columns are read, so other columns cannot clash."""
    rows = cut(with_fingerprint(docs, text_col, [id_col], shingle), "rows")
    comp = components(rows, id_col, threshold)
    return rows.join(comp, "_fp").select(F.col(f"`{id_col}`"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


@scoped
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 2, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group: the smallest id, nulls last, then the smallest text hash; of rows that
    are equal in both, any one.

    Groups are what links reach: fingerprints within ``threshold`` bits, and texts whose shingles have a Jaccard
    similarity of ``similarity`` or more. Wordless and null texts are one group; an empty table stays empty."""
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    kind = d.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, keys = [], []
            for t in b.column("text"):
                h = shingle_hashes(t.as_py(), shingle)
                fps.append(majority(h))
                keys.append(similar.bands(np.unique(h)) if len(h) else [])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("_h"), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "_h", "_fp", "bands"])

    rows = cut(d.select("id", "_h", "text").mapInArrow(sketch, f"id {kind}, _h bigint, _fp bigint, bands array<bigint>"), "rows")
    of_text = cut(rows.groupBy("_h").agg(F.min("_fp").alias("_fp"), F.min("bands").alias("bands")), "sketches")
    by_fp = of_text.join(components(rows, "id", threshold).select("_fp", "root"), "_fp").select("_h", "root")
    low = cut(by_fp.groupBy("root").agg(F.min("_h").alias("v")), "low")
    near = by_fp.join(low, "root").select(F.col("_h").alias("u"), "v")
    pairs, many = similar.candidates(of_text.select("_h", "bands"))
    pairs = cut(pairs, "pairs")
    named = pairs.select(F.col("u").alias("_h")).union(pairs.select(F.col("v").alias("_h"))).distinct()
    texts = d.groupBy("_h").agg(F.first("text").alias("text")).join(named, "_h", "left_semi")  # tasks drop copies before they deal texts
    texts = cut(texts, "texts")
    edges = cut(near.union(similar.links(pairs, texts, similarity, shingle)), "near")
    found = connected_components(edges)
    apart = similar.divided(many, found)
    if not apart.isEmpty():
        more = cut(similar.crossing(apart, texts, similarity, partial(shingle_hashes, shingle=shingle)), "crossing")
        found = connected_components(edges.union(similar.links(more, texts, similarity, shingle)))
    group = rows.select("id", "_h").join(found.toDF("_h", "root"), "_h", "left").withColumn("root", F.coalesce("root", "_h"))
    rank = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("_h").alias("h"))
    best = group.groupBy("root").agg(F.min(rank).alias("b")).select(F.coalesce(F.col("b.i").cast("string"), F.lit("")).alias("_n"), F.col("b.h").alias("_k"))
    best = cut(best, "best")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    src = docs.select(row, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_k"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_n"))
    # rows that are equal in id and text: tasks drop all but one before they deal them
    return src.groupBy("_n", "_k").agg(F.first("_row").alias("_row")).join(best, ["_n", "_k"], "left_semi").select("_row.*")

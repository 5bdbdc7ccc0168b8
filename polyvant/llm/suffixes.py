"""Repeated passages by sparse suffix arrays.

Of all suffixes only those are kept that start at a minimiser: the position whose 16-gram of words hashes
lowest in a window of 35 such grams. A window spans 50 words, so every passage of 50 words holds a kept
position, and the same one wherever the passage stands. Suffixes whose gram occurs once end there. The others
are sorted by gram and following words; neighbours are compared, and a match is extended to the right and to
the left. Where neighbours leave words of a suffix open, its 50-word windows are compared within the run of its
gram, so the result is exact: a word is covered if, and only if, it lies in a passage of ``least`` words
that occurs elsewhere.

Sorting and extension read 16 bits of each word around a suffix. Words that differ can agree in those, so no span
is taken from them alone: its first and its last window of ``least`` words, which together cover it, have to be
equal in hashes of whole words too, and a span whose end fails is cut back until they are.

A run that is too long for one task (a passage that many texts share) is not sorted. Its suffixes are put together
by context, the words that their windows span: a context that occurs twice is repeated as a whole. Only one suffix
of each context deals its windows by their own hash, to be counted, which Spark combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, scoped

GRAM = 16
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Hasher:
    """64-bit hashes of words, with a bounded cache. Words are as they stand: case counts."""

    def __init__(self, cached: int = 500_000) -> None:
        self.known: dict[bytes, int] = {}
        self.cached = cached

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        w = text.encode().split() if text else []
        new = set(w).difference(self.known)
        if new:
            if len(self.known) > self.cached:
                self.known.clear()
                new = set(w)
            self.known.update((x, xxhash.xxh64_intdigest(x, 3)) for x in new)
        return np.fromiter(map(self.known.__getitem__, w), dtype=np.uint64, count=len(w))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, from prefix sums of a polynomial modulo 2**64."""
    n = len(h)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _MULT)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]), dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(h * up[:n], dtype=np.uint64)])
        return _mix((sums[k:] - sums[:-k]) * down[: n - k + 1])


def minimisers(g: np.ndarray, window: int) -> np.ndarray:
    """Positions that are the lowest, leftmost if equal, of some ``window`` neighbouring grams."""
    if len(g) < window:
        return np.zeros(0, dtype=np.int64)
    v = np.lib.stride_tricks.sliding_window_view(g, window)
    return np.unique(np.arange(len(v)) + np.concatenate([v[i : i + 20000].argmin(axis=1) for i in range(0, len(v), 20000)]))


def _runs(start: np.ndarray, end: np.ndarray) -> list[list[int]]:
    """The union of half-open intervals, as sorted [start, end] lists."""
    out: list[list[int]] = []
    for a, b in sorted(zip(start.tolist(), end.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _windows(left: np.ndarray, right: np.ndarray, least: int) -> np.ndarray:
    """Hashes of the windows of ``least`` words around each suffix: row, offset 0 to left words. Word 0 stands for
    what lies outside the text; windows that hold it get 0."""
    full = np.concatenate([left[:, ::-1], right], axis=1).astype(np.uint64)
    n, w = full.shape[1], least
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _MULT)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]), dtype=np.uint64)
        sums = np.concatenate([np.zeros((len(full), 1), np.uint64), np.cumsum(_mix(full + np.uint64(1)) * up[:n], axis=1, dtype=np.uint64)], axis=1)
        out = _mix((sums[:, w:] - sums[:, :-w]) * down[: n - w + 1])
        gaps = np.concatenate([np.zeros((len(full), 1), np.int32), np.cumsum(full == 0, axis=1, dtype=np.int32)], axis=1)
    out[gaps[:, w:] > gaps[:, :-w]] = 0
    return out


def around_hashes(h: np.ndarray, p: np.ndarray, window: int, least: int) -> np.ndarray:
    """32 bits of the hash of each window of ``least`` words that starts 0 to ``window - 1`` words before each
    position of ``p``, the furthest first; 0 for a window that the text does not hold."""
    w = (gram_hashes(h, least) >> np.uint64(32)).astype("<u4") | np.uint32(1)
    padded = np.concatenate([np.zeros(window - 1, "<u4"), w, np.zeros(least, "<u4")])
    return padded[p[:, None] + np.arange(window)]


def compare(g: np.ndarray, key: np.ndarray, pos: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, end) of repeated passages among suffixes, whole runs of ``g``, sorted by (g, right). ``own``:
    ``around_hashes`` of each."""
    none = (np.zeros(0, np.int64),) * 3
    if len(g) < 2:
        return none
    found = []
    same = g[1:] == g[:-1]
    r = np.where(same, (np.cumprod((right[1:] == right[:-1]) & (right[1:] > 0), axis=1)).sum(axis=1), 0)
    lf = np.where(same, (np.cumprod((left[1:] == left[:-1]) & (left[1:] > 0), axis=1)).sum(axis=1), 0)
    back = left.shape[1]
    while True:  # an end whose window differs agreed in 16 bits only
        hit = np.flatnonzero(r + lf >= least)
        bad_start = own[hit, back - lf[hit]] != own[hit + 1, back - lf[hit]]
        bad_end = own[hit, back + r[hit] - least] != own[hit + 1, back + r[hit] - least]
        if not (bad_start.any() or bad_end.any()):
            break
        lf[hit[bad_start]] -= 1
        r[hit[bad_end]] -= 1
    for i in (hit, hit + 1):
        found.append((key[i], pos[i] - lf[hit], pos[i] + r[hit]))
    # words around a suffix that a window of its run may still cover
    reach = np.zeros(len(g), dtype=np.int64)
    np.maximum.at(reach, hit, r[hit] + lf[hit])
    np.maximum.at(reach, hit + 1, r[hit] + lf[hit])
    size = left.shape[1] + right.shape[1]
    run = np.concatenate([[0], np.cumsum(~same)])
    many = np.bincount(run)
    open_runs = np.zeros(len(many), dtype=bool)
    np.logical_or.at(open_runs, run, reach < size)
    rows = np.flatnonzero(open_runs[run] & (many[run] > 2))  # in a run of two, neighbours are all there is
    if len(rows):
        h = _windows(left[rows], right[rows], least)
        with np.errstate(over="ignore"):
            tag = np.where(h == 0, 0, _mix(h ^ _mix(run[rows].astype(np.uint64) + np.uint64(1))[:, None] ^ own[rows].astype(np.uint64) << np.uint64(32)))
        _, inverse, count = np.unique(tag, return_inverse=True, return_counts=True)
        i, off = np.nonzero((count[inverse.reshape(tag.shape)] > 1) & (h != 0))
        t, k, at = tag[i, off], key[rows[i]], pos[rows[i]] - left.shape[1] + off
        order = np.lexsort((at, k, t))  # two suffixes of a text can see the same window: it counts once
        t, k, at = t[order], k[order], at[order]
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1]) | (at[1:] != at[:-1])])[: len(t)]
        t, k, at = t[new], k[new], at[new]
        _, inverse, count = np.unique(t, return_inverse=True, return_counts=True)
        hot = count[inverse] > 1
        found.append((k[hot], at[hot], at[hot] + least))
    return tuple(np.concatenate(x) for x in zip(*found))


def _of_long_runs(rows: DataFrame, least: int) -> DataFrame:
    """(key, s, e) of the repeated passages among contexts ``rows``: c (the context), key (the text), s (where its first
    window starts), w (hashes of its windows), x (the spans it covers, where the text holds it more than once)."""
    # stored, so that a context that many texts share can be split where they meet it again
    contexts = cut(rows.groupBy("c").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("key", "s", F.col("x").isNotNull().alias("again"))).alias("r"), F.first("w").alias("w")), "long")
    within = rows.where("x is not null").select("key", F.explode("x").alias("v")).select("key", "v.s", "v.e")
    shared = rows.where("x is null").join(contexts.where("k > 1").select("c"), "c", "left_semi").select("key", "s", (F.col("s") + F.size("w") + F.lit(least - 1)).alias("e"))
    # windows of a context that occurs once are looked up among those of all contexts; two contexts of a text can hold the same window, which counts once
    alone = ((F.col("k") == 1) & ~F.col("r.again")).alias("alone")
    windows = contexts.select(alone, "r.key", F.col("r.s").alias("s"), F.posexplode("w").alias("o", "h")).groupBy("h", "key", (F.col("s") + F.col("o")).alias("s")).agg(F.max("alone").alias("alone"))
    windows = cut(windows, "windows")
    twice = cut(windows.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "twice")
    single = windows.where("alone").join(twice, "h", "left_semi").select("key", "s", (F.col("s") + least).alias("e"))
    return within.union(shared).union(single)


@scoped
def repeats(docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text", long_run: int = 2_000) -> DataFrame:
    """(doc_id, n_words, n_repeated, spans): a row for each row of ``docs`` with words that lie in a passage of
    ``least`` or more words which occurs more than once in the table, in other texts or in the same one. Spans are
    word positions, ends exclusive, and do not touch.

    Null, empty and short texts have none; null ids keep their row; repeated rows of ``least`` words or more repeat
    each other as a whole; an empty table gives no rows; other columns are not read."""
    window = least - GRAM + 1
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    kind = src.schema["doc_id"].dataType.simpleString()

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            n, gs, ps = [], [], []
            for t in b.column("text"):
                h = hasher(t.as_py())
                g = gram_hashes(h, GRAM)
                p = minimisers(g, window)
                n.append(len(h))
                gs.append(g[p].view(np.int64))
                ps.append(p.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(n, pa.int32()), pa.array(gs, pa.list_(pa.int64())), pa.array(ps, pa.list_(pa.int32()))], ["doc_id", "key", "n", "g", "p"])

    seen = cut(src.mapInArrow(sparse, f"doc_id {kind}, key bigint, n int, g array<bigint>, p array<int>").where(F.col("n") >= least), "sparse")
    # of equal texts one goes on; the others repeat it as a whole
    texts = cut(seen.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"), F.min(F.struct("g", "p")).alias("x")), "texts")
    suffixes = texts.select("key", F.explode(F.arrays_zip("x.g", "x.p")).alias("s")).select("key", F.col("s.g").alias("g"), F.col("s.p").alias("p"))
    # stored, so that both sides of the join are dealt for it alone and a gram that many texts share can be split
    often = cut(suffixes.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "often")
    kept = suffixes.join(often, "g").groupBy("key").agg(F.collect_list(F.struct("p", "g", (F.col("k") > long_run).alias("hot"))).alias("s"))  # as long as a text
    # tasks drop copies of a text before they deal it
    around = src.groupBy("key").agg(F.first("text").alias("text")).join(kept, "key")

    context_names = ["g", "key", "p", "l", "r", "own", "c", "before", "w", "x"]
    context_types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))]

    def context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words on either side of each kept suffix, 16 bits a word, and the hashes of its windows; or, for a long
        run, whole hashes of the windows alone: a row for each context of the text, with its first suffix, the number
        of windows that start before that, and the spans that it covers where the text holds it more than once."""
        import xxhash

        hasher = Hasher()
        for b in batches:
            for i in range(0, b.num_rows, 64):
                out: list[tuple] = []
                for key, t, s in zip(b.column("key").slice(i, 64).to_pylist(), b.column("text").slice(i, 64), b.column("s").slice(i, 64).to_pylist()):
                    h = hasher(t.as_py())
                    at = np.array([x["p"] for x in s], dtype=np.int64)
                    own32 = around_hashes(h, at, window, least)
                    w = np.concatenate([np.zeros(window, np.uint16), ((h >> np.uint64(40)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16), np.zeros(least, np.uint16)])
                    whole = gram_hashes(h, least) if any(x["hot"] for x in s) else None
                    alike: dict[tuple[int, bytes], list[tuple]] = {}
                    for k, x in enumerate(s):
                        p = x["p"] + window
                        if x["hot"]:
                            first, last = max(0, x["p"] - window + 1), min(x["p"], len(h) - least)
                            alike.setdefault((x["p"] - first, whole[first : last + 1].tobytes()), []).append((x["p"], first, last + least, x["g"]))
                        else:
                            out.append((x["g"], key, x["p"], w[p - window + 1 : p][::-1].astype(">u2").tobytes(), w[p : p + least].astype(">u2").tobytes(), own32[k].tobytes(), None, None, None, None))
                    for (before, own), at_ in alike.items():
                        p, first, _, g = min(at_)
                        twice = [{"s": a, "e": e} for a, e in _runs(np.array([x[1] for x in at_]), np.array([x[2] for x in at_]))] if len(at_) > 1 else None
                        out.append((g, key, p, None, None, None, xxhash.xxh64_intdigest(own, before) - (1 << 63), before, np.frombuffer(own, np.int64), twice))
                cols = list(zip(*out)) or [()] * 10
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, context_types)], context_names)

    ctx = cut(around.mapInArrow(context, "g bigint, key bigint, p int, l binary, r binary, own binary, c bigint, before int, w array<bigint>, x array<struct<s:int,e:int>>"), "contexts")
    in_order = ctx.where("l is not null").select("g", "key", "p", "l", "r", "own").repartition("g").sortWithinPartitions("g", "r", "key", "p")

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(t: pa.Table) -> pa.RecordBatch:
            words = lambda n, k: np.frombuffer(b"".join(t.column(n).to_pylist()), dtype=">u2").reshape(-1, k).astype(np.uint16)
            k, s, e = compare(t.column("g").to_numpy(), t.column("key").to_numpy(), t.column("p").to_numpy().astype(np.int64), words("l", window - 1), words("r", least), np.frombuffer(b"".join(t.column("own").to_pylist()), dtype="<u4").reshape(-1, window), least)
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], ["key", "s", "e"])

        held: list[pa.RecordBatch] = []
        for b in batches:
            g = b.column("g").to_numpy()
            ends = np.flatnonzero(g[1:] != g[:-1]) + 1
            if held and len(g) and held[-1].column("g")[-1].as_py() != g[0]:
                if sum(x.num_rows for x in held) > 20_000:
                    yield made(pa.Table.from_batches(held))
                    held = []
            if len(ends) and sum(x.num_rows for x in held) + len(g) > 20_000:
                held.append(b.slice(0, int(ends[-1])))
                yield made(pa.Table.from_batches(held))
                held = [b.slice(int(ends[-1]))]
            elif len(g):
                held.append(b)
        if held:
            yield made(pa.Table.from_batches(held))

    spans = in_order.mapInArrow(neighbours, "key bigint, s int, e int")
    spans = spans.union(_of_long_runs(ctx.where("c is not null").select("c", "key", (F.col("p") - F.col("before")).alias("s"), "w", "x"), least))
    spans = spans.distinct().groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("x"))  # as long as a text

    joined = spans.join(texts.where("copies = 1").select("key", "n"), "key").select("key", "n", "x")
    whole = texts.where("copies > 1").select("key", F.array(F.struct(F.lit(0).alias("s"), F.col("n").alias("e"))).alias("spans"))

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_runs(np.array([v["s"] for v in x]), np.array([v["e"] for v in x])) for x in b.column("x").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([[{"s": s, "e": e} for s, e in x] for x in got], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))], ["key", "spans"])

    # stored, so that all but the first table goes when this returns
    found = cut(joined.mapInArrow(union, "key bigint, spans array<struct<s:int,e:int>>").union(whole), "spans")
    return seen.select("doc_id", "key", F.col("n").alias("n_words")).join(found, "key").select("doc_id", "n_words", F.aggregate("spans", F.lit(0), lambda a, x: a + x.e - x.s).alias("n_repeated"), "spans")

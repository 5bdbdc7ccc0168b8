"""Best-fit packing by a linear grouping scheme.

Every choice depends on a piece's length alone, so the driver plans over the histogram of lengths (at most
``capacity`` rows, whatever the size of the data) and the pieces find their places by their rank among the
pieces of their length:

1. Large lengths, in falling order, are cut into groups of equal cardinality, and each group is rounded up to
   its largest member.
2. The few rounded sizes are packed into configurations: the largest size left opens one, a subset-sum over
   the rounded sizes fills it best, and it is used as often as the counts allow.
3. Actual pieces replace the rounded ones; what rounding wasted is free again.
4. Small lengths go, in falling order, where they fit best.

Runs of equal sequences are kept as one row with a multiplicity, so the plan's size follows the number of
lengths, not the number of pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, scoped
from .tokens import Encoder


def _classes(hist: list[tuple[int, int]], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Falling (length, count) pairs into groups of equal cardinality: (rounded size, its members)."""
    total = sum(n for _, n in hist)
    each = max(1, -(-total // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length, n in hist:
        while n:
            if not room:
                out.append((length, []))
                room = each
            take = min(n, room)
            out[-1][1].append((length, take))
            n, room = n - take, room - take
    merged: list[tuple[int, list[tuple[int, int]]]] = []
    for size, members in out:  # groups that a frequent length fills alone are one size
        if merged and merged[-1][0] == size and all(m[0] == size for m in members + merged[-1][1]):
            merged[-1] = (size, [(size, merged[-1][1][0][1] + members[0][1])])
        else:
            merged.append((size, members))
    return merged


def _fill(sizes: list[int], counts: list[int], room: int) -> list[int]:
    """How many of each size to take for the largest sum within ``room``: subset sums as bits of integers."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for i, (s, c) in enumerate(zip(sizes, counts)):
        c, k = min(c, room // s), 1
        while c > 0:
            take = min(k, c)
            steps.append((i, take, reach))
            reach |= reach << (s * take) & mask
            c, k = c - take, k * 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, [0] * len(sizes)
    for i, take, before in reversed(steps):
        if not before >> at & 1:
            out[i] += take
            at -= sizes[i] * take
    return out


def plan(hist: dict[int, int], capacity: int, groups: int = 512, small: int | None = None) -> list[tuple[int, int, int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, sequences, per sequence, offset) of each run: the piece of
    rank r = first + q, of its length, is in sequence first_sequence + q // per, at offset + q % per * length."""
    small = capacity // 16 if small is None else small
    used: dict[int, int] = {}
    out: list[tuple[int, int, int, int, int, int, int]] = []
    sequence = 0
    bins: list[tuple[int, int, int]] = []  # (room, first sequence, sequences), sorted

    def place(length: int, first: int, n: int, per: int, offset: int) -> None:
        at = used.get(length, 0)
        used[length] = at + n * per
        out.append((length, at, n * per, first, n, per, offset))

    whole = hist.get(capacity, 0)
    if whole:
        place(capacity, 0, whole, 1, 0)
        sequence = whole
    large = sorted(((k, n) for k, n in hist.items() if small < k < capacity and n), reverse=True)
    classes = _classes(large, groups)
    sizes, left = [s for s, _ in classes], [sum(n for _, n in m) for _, m in classes]
    members = [[list(m) for m in ms] for _, ms in classes]
    lead = 0
    while True:
        while lead < len(sizes) and not left[lead]:
            lead += 1
        if lead == len(sizes):
            break
        left[lead] -= 1
        use = _fill(sizes[lead:], left[lead:], capacity - sizes[lead])
        left[lead] += 1
        use[0] += 1
        times = min(left[lead + i] // u for i, u in enumerate(use) if u)
        for i, u in enumerate(use):
            left[lead + i] -= u * times
        slots = [lead + i for i, u in enumerate(use) for _ in range(u)]
        while times:  # actual pieces: a run lasts until one of its slots meets another length
            need: dict[tuple[int, int], int] = {}
            heads, spare = [], {}
            for g in slots:  # slots of one group take members one after another
                k = spare.get(g, 0)
                while members[g] and k < len(members[g]) and need.get((g, k), 0) >= members[g][k][1]:
                    k += 1
                spare[g] = k
                need[g, k] = need.get((g, k), 0) + 1
                heads.append((g, k))
            n = min([times, *(members[g][k][1] // c for (g, k), c in need.items())])
            offset = 0
            per: dict[int, int] = {}
            for g, k in heads:
                per[members[g][k][0]] = per.get(members[g][k][0], 0) + 1
            for length, c in sorted(per.items(), reverse=True):
                place(length, sequence, n, c, offset)
                offset += length * c
            for (g, k), c in need.items():
                members[g][k][1] -= c * n
            for g in set(slots):
                members[g] = [m for m in members[g] if m[1]]
            if capacity > offset:
                insort(bins, (capacity - offset, sequence, n))
            sequence += n
            times -= n
    for length, count in sorted(((k, n) for k, n in hist.items() if k <= small and k < capacity and n), reverse=True):
        while count:
            i = bisect_left(bins, (length, -1, -1))
            if i == len(bins):
                per = capacity // length
                n = max(1, count // per)
                bins.append((capacity, sequence, n))
                sequence += n
                bins.sort()
                continue
            room, first, n = bins.pop(i)
            per = min(room // length, count)
            m = min(n, count // per)
            place(length, first, m, per, capacity - room)
            count -= m * per
            if n > m:
                insort(bins, (room, first + m, n - m))
            if room - per * length:
                insort(bins, (room - per * length, first, m))
    return out


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """The pieces of every row: id, piece, start, length, ids_crc32, and for ``place`` the number of the task and the
    piece's rank among those of its length in that task. A text's ids end with ``end_id``; a null text is empty; only
    what is longer than ``capacity`` is cut."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, held = Encoder(vocabulary), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in batches:
            rows: list[tuple[int, int, int, int, int, int]] = []
            for r, ids in enumerate(encoder.encode(b.column("text"))):
                ids += end
                n = len(ids) // 4
                for k, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    length = len(part) // 4
                    rows.append((r, k, start, length, zlib.crc32(part), held[length]))
                    held[length] += 1
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:]), pa.array([task] * len(rows), pa.int32())], ["doc_id", "piece", "start", "length", "ids_crc32", "_rank", "_part"])

    return src.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, _rank bigint, _part int")


def place(found: DataFrame, capacity: int = 2048, groups: int = 512) -> DataFrame:
    """``found``, as ``pieces`` gives it, with sequence_id and offset.

    A piece's rank among those of its length is its rank within its task plus what earlier tasks hold, so no task
    takes all pieces of a frequent length. Tasks rank as they write: pieces are not sorted."""
    p = cut(found, "pieces")
    hist = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    runs = plan(hist, capacity, groups)
    runs.sort()
    cols = [np.array(c, dtype=np.int64) for c in zip(*runs)] if runs else [np.zeros(0, dtype=np.int64)] * 7
    shared = p.sparkSession.sparkContext.broadcast(cols)  # follows `capacity` and `groups`, not the data
    counts = p.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_part", "length", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = p.join(before.hint("shuffle_hash"), ["_part", "length"])  # grows with the tasks: not to be broadcast
    names = [c for c in p.columns if c not in ("_part", "_rank")]
    out = ranked.select(*names, (F.col("_rank") + F.col("_before")).alias("_rank"))
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in p.schema if f.name in names) + ", sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, seq, _, per, off = shared.value
        key = length << 40 | first
        for b in batches:
            ln, rank = (b.column(n).to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            i = np.searchsorted(key, ln << 40 | rank, side="right") - 1
            q = rank - first[i]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(seq[i] + q // per[i]), pa.array(off[i] + q % per[i] * ln)], [*names, "sequence_id", "offset"])

    return out.mapInArrow(run, spec)


@scoped
def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 2048, groups: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of the end id; repeated rows are packed each; a null id stays null; an
    empty table gives no rows; other columns are not read."""
    return place(pieces(docs, vocabulary or default_vocabulary(), capacity, id_col, text_col), capacity, groups)


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))

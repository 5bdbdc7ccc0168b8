"""Token ids packed into fixed-width rows, by best-fit decreasing with a segment tree.

Documents are packed within bounded buffers of a partition: no shuffle, no driver state, and a lost task is
redone alone. A segment tree over capacities finds, for each piece, the open row with the least room that
still holds it. Documents longer than a row are cut into full rows and a rest, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import default_vocabulary
from .tokens import Encoder


class CapacityTree:
    """How many open rows have each room, as a segment tree over rooms 0 to ``capacity``."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.n = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        n = self.n
        while i:
            n[i] += by
            i >>= 1

    def open(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``least``, removed; None if there is none."""
        n, i = self.n, least + self.size
        if not n[i]:
            while i > 1:  # up to the first node with rows on its right, then down its left edge
                if not i & 1 and n[i + 1]:
                    i += 1
                    break
                i >>= 1
            if i == 1:
                return None
            while i < self.size:
                i *= 2
                if not n[i]:
                    i += 1
        room = i - self.size
        self._add(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the pieces of each row; lengths are 1 to ``capacity``. Equal lengths keep their order."""
    tree, rows = CapacityTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        got = tree.take(lengths[i])
        row, room = got if got else (len(rows), capacity)
        if not got:
            rows.append([])
        rows[row].append(i)
        if room > lengths[i]:
            tree.open(room - lengths[i], row)
    return rows


SCHEMA = "input_ids binary, n_tokens int, cu_seqlens array<int>, position_ids binary, doc_ids array<{}>, pieces array<int>, starts array<bigint>"


def pack_ids(docs: DataFrame, vocabulary: str | None = None, width: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, buffer_tokens: int = 4_000_000) -> DataFrame:
    """One row for each packed row of ids: ``input_ids`` (``width`` little-endian unsigned 32-bit ids, padded
    with ``end_id`` after ``n_tokens``), ``cu_seqlens`` (0 and the end of each segment), ``position_ids`` (as
    many 32-bit numbers, from 0 in each segment and 0 in the padding), and of each segment the document's id,
    piece and start.

    Null and empty texts are one end id; null ids stay null; repeated rows are packed each; an empty table
    gives no rows; ids keep their type; other columns are not read. A buffer holds ``buffer_tokens`` at most, and one document."""
    vocabulary = vocabulary or default_vocabulary()
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    spec = SCHEMA.format(src.schema["doc_id"].dataType.simpleString())
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    end = end_id.to_bytes(4, "little")

    def packed(buffer: list[tuple[pa.Scalar, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        rows = best_fit_decreasing([len(p[3]) // 4 for p in buffer], width)
        count = np.arange(width, dtype="<u4")
        for k in range(0, len(rows), 512):
            out: list[tuple] = []
            for row in rows[k : k + 512]:
                parts = [buffer[i] for i in row]
                ends = np.cumsum([0, *(len(p[3]) // 4 for p in parts)])
                ids = b"".join(p[3] for p in parts)
                positions = np.zeros(width, dtype="<u4")
                for a, b in zip(ends, ends[1:]):
                    positions[a:b] = count[: b - a]
                out.append((ids + end * (width - ends[-1]), int(ends[-1]), ends.tolist(), positions.tobytes(), [p[0].as_py() for p in parts], [p[1] for p in parts], [p[2] for p in parts]))
            kinds = (pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(buffer[0][0].type), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        buffer: list[tuple[pa.Scalar, int, int, bytes]] = []
        held = 0
        for b in batches:
            for doc, ids in zip(b.column("doc_id"), encoder.encode(b.column("text"))):
                ids += end
                for k, start in enumerate(range(0, len(ids) // 4, width)):
                    buffer.append((doc, k, start, ids[4 * start : 4 * (start + width)]))
                held += len(ids) // 4
                if held >= buffer_tokens:
                    yield from packed(buffer)
                    buffer, held = [], 0
        if buffer:
            yield from packed(buffer)

    return src.mapInArrow(run, spec)


def write(packed: DataFrame, path: str) -> None:
    """Stores the packed rows: Parquet holds the matrices as binary columns, and a task's file appears whole or
    not at all."""
    packed.write.parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    """A row for each packed row, without the matrices."""
    return packed.select(
        "n_tokens", F.size("doc_ids").alias("n_segments"), "doc_ids", "pieces", "starts", "cu_seqlens", F.crc32("input_ids").alias("ids_crc32"), F.crc32("position_ids").alias("positions_crc32")
    )

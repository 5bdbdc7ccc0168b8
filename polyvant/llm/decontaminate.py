"""Benchmark decontamination by latent semantic retrieval.

Passages become TF-IDF vectors over the benchmark's vocabulary. One pass multiplies their Gram matrix, together with
that of the items, with random directions, summed over partitions; from that follow its leading singular directions
and values (a randomised decomposition in one pass), which are the latent space. Each passage of every text is
compared with all items by cosine in that space; a candidate then has to hold enough of the item as a longest common
subsequence of words, and of the item's ending (its answer), so a text that shares a topic or common words stays.

An item much shorter than a passage is a small part of any passage's vector, and an item in a latent space can lie
far from a text that holds it. So items are also looked up by their rarest words, of which a text that holds enough of
the item has to hold some: that leaves nothing out, and is done for short items and wherever those words are rare
enough to be few.

Benchmarks are taken in blocks of bounded size, so the vocabulary, the basis and the item vectors that every
task holds are bounded too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, scoped

#: Words of half a passage; passages are two neighbouring halves, and each half is in two of them.
HALF = 24
_EDGE = re.compile(rb"^[^0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff]+$")


def norm(chunk: bytes) -> bytes:
    """A lower-cased chunk without punctuation at its ends."""
    return _EDGE.sub(b"", chunk)


class Coder(dict):
    """Word ids of texts: 0 for words outside the vocabulary. Chunks met before are kept, up to a bound."""

    def __init__(self, vocabulary: dict[bytes, int], cached: int = 500_000) -> None:
        super().__init__()
        self.vocabulary, self.cached, self.kind = vocabulary, cached, code_type(len(vocabulary) + 1)

    def __missing__(self, chunk: bytes) -> int:
        code = self[chunk] = self.vocabulary.get(norm(chunk), 0)
        return code

    def code(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=self.kind)
        if len(self) > self.cached:
            self.clear()
        chunks = text.encode().lower().split()
        return np.fromiter(map(self.__getitem__, chunks), dtype=self.kind, count=len(chunks))


def code_type(m: int) -> str:
    return "<u2" if m <= 1 << 16 else "<u4"


def halves(seqs: list[np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(half of each weighted word, its id, first half of each text): texts take at least one half each."""
    n = np.array([len(s) for s in seqs], dtype=np.int64)
    k = np.maximum(1, -(-n // HALF))
    start = np.concatenate([[0], np.cumsum(k)])
    if not n.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int32), start
    x = np.concatenate(seqs)
    use = np.flatnonzero(weight[x] > 0)
    doc = np.repeat(np.arange(len(seqs)), n)[use]
    return start[doc] + (use - (np.cumsum(n) - n)[doc]) // HALF, x[use], start


def segment_sums(table: np.ndarray, index: np.ndarray, first: np.ndarray, count: np.ndarray, most: int = 64) -> np.ndarray:
    """For each segment of ``index``, one or more long, the sum of those rows of ``table``. Segments are added up a
    place at a time, the longest first; what a long one has beyond ``most`` places, by itself."""
    order = np.argsort(-count, kind="stable")
    f, c = first[order], count[order]
    out = np.zeros((len(f), table.shape[1]), dtype=table.dtype)
    for j, n in enumerate(np.searchsorted(-c, -np.arange(min(int(c.max(initial=0)), most)), side="left")):
        out[:n] += table[index[f[:n] + j]]
    for i in range(int(np.searchsorted(-c, -most, side="left"))):
        out[i] += table[index[f[i] + most : f[i] + c[i]]].sum(axis=0)
    back = np.empty_like(out)
    back[order] = out
    return back


def project(at: np.ndarray, x: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    """Sums of basis rows by half. ``at`` is sorted."""
    out = np.zeros((n, basis.shape[1]), dtype=np.float32)
    if len(at):
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] = segment_sums(basis, x, first, np.diff(first, append=len(at)))
    return out


def lcs(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, with the item's positions as bits of one integer."""
    place: dict[int, int] = {}
    for i, w in enumerate(item):
        place[w] = place.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in words:
        m = place.get(w)
        if m:
            u = v & m
            v = (v + u | v - u) & full
    return len(item) - v.bit_count()


@dataclass
class Model:
    vocabulary: dict[bytes, int]
    basis: np.ndarray  # word id, dimension: TF-IDF weight times the latent basis
    weight: np.ndarray
    vectors: np.ndarray  # item, dimension; unit length
    items: list[list[int]]
    names: list
    cosine: float
    common: float
    answer: float
    exact: np.ndarray  # item: whether it is looked for by ``keys`` too
    keys: np.ndarray  # words of those items, sorted: one for each row of ``of``
    of: np.ndarray  # the item of each key
    least: np.ndarray  # item: how many of its keys a text has to hold

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.items), default=0)
        self.lengths = np.array([len(i) for i in self.items], dtype=np.int64)
        self.padded = np.zeros((len(self.items), self.longest), dtype=np.int64)  # as bounded as `longest` times the block's items
        self.padded[np.arange(self.longest) < self.lengths[:, None]] = [w for i in self.items for w in i]


def rare_keys(item: list[int], df: np.ndarray, common: float, bound: float, more: int = 2) -> tuple[list[int], int]:
    """(words, least): who holds the share ``common`` of the item as a subsequence holds its words ``least`` times or
    more. They are the rarest ones at more places than may be missing, and those at up to ``more`` other places
    that no more than ``bound`` passages have."""
    missing = len(item) - math.ceil(common * len(item) - 1e-9)
    keys, places = [], 0
    for w in sorted(set(item), key=lambda w: (df[w], w)):
        if places > missing + more or places > missing and df[w] > bound:
            break
        keys.append(w)
        places += item.count(w)
    return keys, places - missing


def by_keys(part: list[np.ndarray], start: np.ndarray, model: Model) -> Iterator[np.ndarray]:
    """half * items + item for each place of the texts ``part`` whose surroundings hold enough of the item's keys."""
    if not len(model.keys):
        return
    x = np.concatenate(part).astype(np.int64)
    n = np.array([len(s) for s in part], dtype=np.int64)
    lo, hi = np.searchsorted(model.keys, x, "left"), np.searchsorted(model.keys, x, "right")
    at = np.flatnonzero(hi > lo)
    k = (hi - lo)[at]
    doc = np.repeat(np.arange(len(part)), n)[at]
    pos = at - (np.cumsum(n) - n)[doc]
    ends = np.searchsorted(doc, np.arange(len(part)), "right")
    made = np.concatenate([[0], np.cumsum(k)])
    a = d = 0
    while a < len(at):  # whole texts, of about a million keys
        d = max(d + 1, int(np.searchsorted(made[ends], made[a] + 1_000_000, "right")))
        b = int(ends[d - 1])
        rep = np.repeat(np.arange(a, b), k[a:b])
        item = model.of[lo[at[rep]] + np.arange(len(rep)) - np.repeat(made[a:b] - made[a], k[a:b])]
        own, p, length = doc[rep], pos[rep], model.lengths[item]
        first = np.maximum((p - 2 * HALF - length) // HALF + 1, 0)  # the halves whose surroundings hold the place
        past = np.minimum((p + length) // HALF, start[own + 1] - start[own] - 1) + 1
        times = np.maximum(past - first, 0)
        half = np.repeat(start[own] + first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        found, many = np.unique(half * len(model.items) + np.repeat(item, times), return_counts=True)
        yield found[many >= model.least[found % len(model.items)]]
        a = b


def by_cosine(w: np.ndarray, size: np.ndarray, model: Model) -> Iterator[np.ndarray]:
    """half * items + item for each passage that is near the item in the latent space."""
    some = np.flatnonzero(size > 0)
    for k in range(0, len(some), 4096):
        rows = some[k : k + 4096]
        r, i = np.nonzero((w[rows] / size[rows, None]) @ model.vectors.T >= model.cosine)
        yield rows[r] * len(model.items) + i


def enough(found: np.ndarray, part: list[np.ndarray], start: np.ndarray, model: Model, cells: int = 1 << 25) -> np.ndarray:
    """Those of the candidates ``found`` (sorted half * items + item) whose surroundings hold enough of the item's words,
    in whatever order: no subsequence can be longer."""
    x, n = np.concatenate(part), np.array([len(s) for s in part], dtype=np.int64)
    base = np.cumsum(n) - n
    keep = np.zeros(len(found), dtype=bool)
    halves, row = np.unique(found // len(model.items), return_inverse=True)
    step = max(1, cells // len(model.weight))
    bounds = np.searchsorted(row, np.arange(0, len(halves) + step, step))
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        h = halves[k * step : (k + 1) * step]
        doc = np.searchsorted(start, h, side="right") - 1
        place = (h - start[doc]) * HALF
        lo = base[doc] + np.maximum(0, place - model.longest)
        size = base[doc] + np.minimum(n[doc], place + 2 * HALF + model.longest) - lo
        held = np.zeros((len(h), len(model.weight)), dtype=bool)
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        held[np.repeat(np.arange(len(h)), size), x[at]] = True
        held[:, 0] = False
        for c in range(a, b, 1 << 17):
            item = found[c : min(b, c + (1 << 17))] % len(model.items)
            words = held[(row[c : c + len(item)] - k * step)[:, None], model.padded[item]].sum(axis=1)
            keep[c : c + len(item)] = words >= model.common * model.lengths[item] - 1e-9
    return found[keep]


def hits(seqs: list[np.ndarray], model: Model) -> list[list[tuple[int, float, float, float, int]]]:
    """For each text: (item, cosine, share of the item, share of its ending, first word) of what is found, the
    best place for each item."""
    best: list[list] = []
    for lo in range(0, len(seqs), 400):
        part = seqs[lo : lo + 400]
        top: list[dict[int, tuple]] = [{} for _ in part]
        at, x, start = halves(part, model.weight)
        z = project(at, x, int(start[-1]), model.basis)
        last = np.zeros(len(z), dtype=bool)
        last[start[1:] - 1] = True
        w = z.copy()
        w[:-1] += np.where(last[:-1, None], 0, z[1:])
        size = np.sqrt(np.einsum("ij,ij->i", w, w))
        found = np.unique(np.concatenate([np.zeros(0, np.int64), *by_cosine(w, size, model), *by_keys(part, start, model)]))
        if len(found):
            found = enough(found, part, start, model)
        for half, i in zip((found // len(model.items)).tolist(), (found % len(model.items)).tolist()):
            d = int(np.searchsorted(start, half, side="right")) - 1
            first, item = (half - int(start[d])) * HALF, model.items[i]
            words = part[d][max(0, first - len(item)) : first + 2 * HALF + len(item)]
            words = words[words > 0].tolist()
            share = lcs(item, words) / len(item)
            if share < model.common:
                continue
            end = item[-max(1, len(item) // 4) :]
            ending = lcs(end, words) / len(end)
            if ending >= model.answer:
                cosine = float(w[half] @ model.vectors[i] / size[half]) if size[half] > 0 else 0.0
                if i not in top[d] or (share, cosine) > (top[d][i][2], top[d][i][1]):
                    top[d][i] = (i, cosine, share, ending, first)
        best += [[t[i] for i in sorted(t)] for t in top]
    return best


def blocks(items: DataFrame, item_id: str, text_col: str, words: int = 100_000) -> Iterator[list[tuple]]:
    """(id, words) of the items, in lists of at most about ``words`` words; items without words are left out."""
    part, held = [], 0
    rows = items.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{text_col}`").alias("t")).orderBy("i", "t")
    for r in rows.toLocalIterator():
        w = [x for x in map(norm, (r["t"] or "").encode().lower().split()) if x]
        if w:
            part.append((r["i"], w))
            held += len(w)
            if held >= words:
                yield part
                part, held = [], 0
    if part:
        yield part


def _vector_sum(rows: DataFrame, name: str) -> dict[int, np.ndarray]:
    """Sums the vectors (t, v binary float64) by t: dealt by t, summed in tasks; one row for each t is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for t, v in zip(b.column("t").to_pylist(), b.column("v")):
                x = np.frombuffer(v.as_buffer(), dtype=np.float64)
                total[t] = total[t] + x if t in total else x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["t", "v"])

    return {r["t"]: np.frombuffer(r["v"], dtype=np.float64) for r in rows.repartition("t").mapInArrow(run, "t int, v binary").toLocalIterator()}


def _seqs(b: pa.RecordBatch, first: int, n: int, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), dtype=kind) for v in b.column("x").slice(first, n)]


def fit(coded: DataFrame, block: list[tuple], vocabulary: dict[bytes, int], rank: int = 128, more: int = 16, frequent: float = 0.02, rarest: int = 8, cosine: float = 0.3, common: float = 0.6, answer: float = 0.5, chance: float = 0.5) -> Model:
    """The latent space of the passages of ``coded`` (x: word ids as binary) and of the block's items: ``rank`` leading
    singular directions, from ``more`` random ones than that. Words in more than the share ``frequent`` of the passages
    have no weight, but for the ``rarest`` words of each item. Items shorter than half a passage, or without a vector,
    are looked up by their rarest words too, and so is every item of whose keys a place holds ``chance`` or fewer on
    average."""
    m = len(vocabulary) + 1
    kind = code_type(m)
    flat = np.ones(m)
    flat[0] = 0

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(m, dtype=np.int64), 0
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                at, x, start = halves(_seqs(b, k, 1000, kind), flat)
                by = np.argsort(x, kind="stable")  # by word, then by half: a repeat within a half follows itself
                x, at = x[by], at[by]
                new = np.concatenate([[True], (x[1:] != x[:-1]) | (at[1:] != at[:-1])])[: len(x)]
                df += np.bincount(x[new], minlength=m)
                n += int(start[-1])
        df[0] = n
        t = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(df[t])], ["t", "n"])

    df = np.zeros(m)
    for r in coded.select("x").mapInArrow(frequency, "t int, n bigint").groupBy("t").agg(F.sum("n").alias("n")).collect():  # the block's vocabulary
        df[r["t"]] = r["n"]
    total = df[0]
    weight = np.log((1 + total) / (1 + df))
    codes = [[vocabulary[w] for w in words] for _, words in block]
    own = {w for c in codes for w in sorted(set(c), key=lambda w: df[w])[:rarest]}
    often = df > min(frequent, 0.25) * total
    often[list(own)] = False  # however many passages hold the item, some of its words keep a weight
    weight[often] = 0
    weight[0] = 0
    if not weight[1:].any():  # a corpus this small has no rare words: all count alike
        weight[1:] = 1
    d = min(rank + more, m)
    omega = (np.random.default_rng(11).standard_normal((m, d)) * weight[:, None]).astype(np.float32)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = np.zeros((m, d))
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                at, x, start = halves(_seqs(b, k, 1000, kind), weight)
                if len(at):
                    z = project(at, x, int(start[-1]), omega)
                    by = np.argsort(x, kind="stable")
                    first = np.flatnonzero(np.diff(x[by], prepend=-1))
                    y[x[by][first]] += segment_sums(z, at[by], first, np.diff(first, append=len(by)))
        t = np.flatnonzero(y.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array([v.tobytes() for v in y[t]], pa.binary())], ["t", "v"])

    y = np.zeros((m, d))
    for t, v in _vector_sum(coded.select("x").mapInArrow(gram, "t int, v binary"), "gram").items():
        y[t] = v
    y *= weight[:, None]
    words, first = np.concatenate(codes), np.concatenate([[0], np.cumsum([len(c) for c in codes])])
    sums = lambda basis: np.add.reduceat(weight[words, None] * basis[words], first[:-1], axis=0)
    plain = omega / np.where(weight > 0, weight, 1)[:, None]
    ground = np.zeros((m, d))
    np.add.at(ground, words, weight[words, None] * np.repeat(sums(plain), np.diff(first), axis=0))
    y = y / max(np.linalg.norm(y), 1e-9) + ground / max(np.linalg.norm(ground), 1e-9)
    q = leading(y, plain, rank)
    vectors = sums(q)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors /= np.maximum(length, 1e-9)
    keyed = {i: rare_keys(c, df, common, frequent * total) for i, c in enumerate(codes)}
    often = np.array([sum(df[w] for w in keyed[i][0]) / max(total, 1) * (3 + 2 * len(c) / HALF) for i, c in enumerate(codes)])
    exact = np.array([len(c) < HALF for c in codes]) | (length[:, 0] < 1e-9) | (often <= chance)
    keys = np.array([(w, i) for i in np.flatnonzero(exact).tolist() for w in keyed[i][0]], dtype=np.int64).reshape(-1, 2)
    keys = keys[np.argsort(keys[:, 0], kind="stable")]
    least = np.array([keyed[i][1] for i in range(len(codes))])
    return Model(vocabulary, (weight[:, None] * q).astype(np.float32), weight, vectors.astype(np.float32), codes, [i for i, _ in block], cosine, common, answer, exact, keys[:, 0], keys[:, 1], least)


def leading(y: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """The ``rank`` leading singular directions of a positive semidefinite matrix g, from y = g @ omega alone."""
    shift = np.finfo(float).eps * np.linalg.norm(y) * math.sqrt(y.shape[0])
    y = y + shift * omega
    c = omega.T @ y
    s, v = np.linalg.eigh((c + c.T) / 2)  # y c^-1 y^T approximates g; its root comes from the root of c^-1
    use = s > s[-1] * 1e-12
    u, values, _ = np.linalg.svd(y @ (v[:, use] / np.sqrt(s[use])), full_matrices=False)
    return u[:, values > values[0] * 1e-7][:, :rank] if len(values) else u


def _coded(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Coder(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([code.code(t.as_py()).tobytes() for t in b.column("text")], pa.binary())], ["doc_id", "x"])

    return cut(docs.mapInArrow(run, f"doc_id {kind}, x binary"), "coded")


def _models(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, **kw) -> Iterator[tuple[DataFrame, Model]]:
    for block in blocks(items, item_id, item_text):
        vocabulary: dict[bytes, int] = {}
        for _, words in block:
            for w in words:
                vocabulary.setdefault(w, len(vocabulary) + 1)
        coded = _coded(docs, vocabulary)
        yield coded, fit(coded, block, vocabulary, **kw)


@scoped
def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", **kw) -> DataFrame:
    """(doc_id, item_id, cosine, common_share, answer_share, start_word): a row for each row of ``docs`` and item
    that it holds, at the place that holds most of it.

    Null and empty texts hold nothing and empty items are in nothing; null ids keep their rows; repeated rows
    each get theirs; empty tables give no rows; other columns are not read."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind, of = src.schema["doc_id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    spec = f"doc_id {kind}, item_id {of}, cosine double, common_share double, answer_share double, start_word int"
    out = docs.sparkSession.createDataFrame([], spec)
    for coded, model in _models(src, items, item_id, item_text, **kw):
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names = shared.value.names
            for b in batches:
                found = hits(_seqs(b, 0, b.num_rows, code_type(len(shared.value.weight))), shared.value)
                rows = [(k, names[i], *rest) for k, hs in enumerate(found) for i, *rest in hs]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(cols[0])), pa.array(cols[1]), *(pa.array(c, pa.float64()) for c in cols[2:5]), pa.array(cols[5], pa.int32())], [c.split(" ")[0] for c in spec.split(", ")])

        out = out.union(coded.mapInArrow(run, spec))
    return out


@scoped
def remove(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item. Null and empty texts hold none and stay; null
    ids and repeated rows are judged by their text; without items, or rows, nothing changes."""
    src = docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    for _, model in _models(src, items, item_id, item_text, **kw):
        docs = docs.where(~_holds(docs.sparkSession.sparkContext.broadcast(model))(F.col(f"`{text_col}`")))
    return docs


def _holds(shared):
    def holds(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        code = Coder(shared.value.vocabulary)
        for b in batches:
            yield pa.array([bool(h) for h in hits([code.code(t.as_py()) for t in b], shared.value)], pa.bool_())

    return F.arrow_udf(holds, "boolean")

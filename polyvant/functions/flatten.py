"""JSON sidecars to ordered leaves, and the resolution of fields from them."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profiles import Profile
#: key, last and segs are the path, its last segment and its segments in canonical form, made once for all fields.
LEAF = "struct<path:string,raw:string,empty:boolean,key:string,last:string,segs:array<string>>"
SCHEMA = f"struct<leaves:array<{LEAF}>,error:string>"
_ARROW = pa.struct([("leaves", pa.list_(pa.struct([("path", pa.string()), ("raw", pa.string()), ("empty", pa.bool_()), ("key", pa.string()), ("last", pa.string()), ("segs", pa.list_(pa.string()))]))), ("error", pa.string())])


def leaves(node: dict, prefix: str = "") -> Iterator[tuple[str, Any]]:
    """(dotted path, value) in document order. Only non-empty objects are entered."""
    for name, value in node.items():
        path = f"{prefix}.{name}" if prefix else str(name)
        if isinstance(value, dict) and value:
            yield from leaves(value, path)
        else:
            yield path, value


def blank(value: Any) -> bool:
    return value is None or (isinstance(value, str) and not value.strip()) or (isinstance(value, (list, dict)) and not value)


def read(doc: bytes | str, profile: Profile) -> tuple[dict[str, Any], str | None]:
    """(values by path, error) of one sidecar. A path met twice keeps its first place and its last value, as a
    dictionary does."""
    try:
        top = profile.unwrap(json.loads(doc.decode("utf-8") if isinstance(doc, bytes) else doc))
    except (ValueError, RecursionError) as e:
        return {}, f"invalid metadata JSON: {e}"
    if not isinstance(top, dict):
        return {}, f"metadata top level is {type(top).__name__}, expected object"
    return dict(leaves(top)), None


def parse(doc: bytes | str | None, profile: Profile) -> dict | None:
    """The leaves of one sidecar, or its error; null for no sidecar."""
    if doc is None:
        return None
    found, error = read(doc, profile)
    return {"leaves": [_leaf(p, v) for p, v in found.items()], "error": error}


def _leaf(path: str, value: Any) -> dict:
    key, last, segs = spelled(path)
    return {"path": path, "raw": None if value is None else str(value), "empty": blank(value), "key": key, "last": last, "segs": list(segs)}


@lru_cache(maxsize=1 << 16)
def spelled(path: str) -> tuple[str, str, tuple[str, ...]]:
    """A path, its last segment and its segments in canonical form. Sidecars of a source share most of theirs."""
    segs = tuple(canonical(s) for s in path.split("."))
    return "".join(segs), segs[-1], segs


def canonical(name: str) -> str:
    """Lower case, without dashes, underscores, dots and white space."""
    return re.sub(r"[-_.\s]+", "", name.lower())


def flatten(doc: Column, profile: Profile) -> Column:
    """A struct of ``leaves`` (ordered) and ``error`` from a JSON string or its bytes. Python, because order,
    repeated keys and the spelling of numbers matter and no built-in parser keeps all three; one Arrow batch at
    a time."""

    def run(docs: pa.Array) -> pa.Array:
        return pa.array([parse(d.as_py(), profile) for d in docs], _ARROW)

    return F.arrow_udf(run, SCHEMA)(doc)


def fields(doc: Column, profile: Profile, names: dict[str, tuple[str, ...]], order: str = "document", prefixes: tuple[str, ...] = ()) -> Column:
    """A struct of the resolved raw text of each field of ``names``, of ``error``, and, for each of ``prefixes``,
    ``has_<prefix>``: whether a present leaf's last segment starts with it. Sidecars are parsed and resolved in one
    Arrow pass, so leaves never leave the task; ``resolve`` gives the same from stored leaves."""
    by: dict[str, list[tuple[int, int]]] = {}
    for f, spellings in enumerate(names.values()):
        for k, key in enumerate(dict.fromkeys(map(canonical, spellings))):
            by.setdefault(key, []).append((f, k if order == "registry" else 0))
    kinds = [*((n, pa.string()) for n in names), ("error", pa.string()), *((f"has_{p}", pa.bool_()) for p in prefixes)]

    def one(text: bytes | str) -> dict:
        found, error = read(text, profile)
        best: dict[int, tuple] = {}
        has = dict.fromkeys(prefixes, False)
        for i, (path, value) in enumerate(found.items()):
            key, last, segs = spelled(path)
            hits = [(0, x) for x in by.get(key, ())] + [(1, x) for x in by.get(last, ())] + [(2, x) for s in segs for x in by.get(s, ())]
            if not (hits or prefixes) or blank(value):
                continue
            for p in prefixes:
                has[p] = has[p] or last.startswith(p)
            for level, (f, k) in hits:
                rank = (level, k, i)
                if f not in best or rank < best[f][0]:
                    best[f] = (rank, value)
        out = {n: str(best[f][1]) if f in best else None for f, n in enumerate(names)}
        return out | {"error": error} | {f"has_{p}": v for p, v in has.items()}

    def run(docs: pa.Array) -> pa.Array:
        return pa.array([None if d is None else one(d) for d in docs.to_pylist()], pa.struct(kinds))

    spec = ",".join(f"`{n}`:{'boolean' if n.startswith('has_') and n[4:] in prefixes else 'string'}" for n, _ in kinds)
    return F.arrow_udf(run, f"struct<{spec}>")(doc)


def resolve(found: Column, names: tuple[str, ...], order: str = "document") -> Column:
    """The raw text of the first present leaf that a spelling names: by its whole path, else its last segment,
    else any segment. With ``order`` "registry" earlier spellings win within a pass, otherwise earlier leaves."""
    keys = list(dict.fromkeys(canonical(n) for n in names))
    groups = [keys] if order == "document" else [[k] for k in keys]
    tests = (lambda x, k: x.key.isin(*k), lambda x, k: x.last.isin(*k), lambda x, k: F.arrays_overlap(x.segs, F.array(*map(F.lit, k))))
    return F.coalesce(*(_first(found, test, k) for test in tests for k in groups))


def _first(found: Column, test, keys: list[str]) -> Column:
    return F.get(F.filter(found, lambda x: ~x.empty & test(x, keys)), F.lit(0)).raw

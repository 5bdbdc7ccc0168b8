"""Scalars, durations, flattening and resolution."""

import json

import pytest
from pyspark.sql import functions as F

from polyvant import config, profiles
from polyvant.functions import canon, durations
from polyvant.functions.flatten import fields, flatten, parse, resolve


def values(spark, rows, spec, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, spec).select(*cols).collect()]


def test_every_synonym(spark):
    for table, f in ((config.DIFFICULTY, canon.difficulty), (config.BUSINESS_SIZE, canon.business_size), (config.WORKER_TYPE, canon.worker_type)):
        pairs = [(n.upper(), k) for k, names in table.items() for n in names] + [("?", None), (None, None)]
        assert values(spark, pairs, "raw string, want string", f(F.col("raw")), "want") == [(w, w) for _, w in pairs]
    pairs = [*((t, True) for t in config.TRUE_TOKENS), *((t, False) for t in config.FALSE_TOKENS), ("maybe", None)]
    assert values(spark, pairs, "raw string, want boolean", canon.flag(F.col("raw")), "want") == [(w, w) for _, w in pairs]


def test_canon_key(spark):
    assert values(spark, [("Task-ID",), ("a.b_c d e",)], "k string", canon.canon_key(F.col("k"))) == [("taskid",), ("abcde",)]


def test_number(spark):
    rows = [("12", 12.0), (" 1.5 ", 1.5), ("1e3", 1000.0), ("nan", None), ("inf", None), ("1.0d", None), ("x", None), ("", None), (None, None), ("-.5", -0.5)]
    assert values(spark, [(r,) for r, _ in rows], "s string", canon.number(F.col("s"))) == [(w,) for _, w in rows]


def test_rounding_is_of_the_exact_value(spark):
    xs = [0.125, 2.675, 1.005, 20.004, 1.0e-9, 123456.785, 0.5]
    got = values(spark, [(x,) for x in xs], "x double", canon.rounded(F.col("x"), 2))
    assert [g for (g,) in got] == [round(x, 2) for x in xs]


def test_natural_key(spark):
    stems = ["video10", "9", "a", "Video1", "10", "video2b", "video2", "0009x", "²"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in stems], "s string").orderBy(canon.natural_key(F.col("s")), "s").collect()]
    assert got == ["9", "0009x", "10", "a", "Video1", "video2", "video2b", "video10", "²"]


S = 1_000_000


@pytest.mark.parametrize(
    "video,meta,want",
    [(100 * S, 100 * S, (100 * S, "both", False)), (100 * S, None, (100 * S, "video", False)), (None, 5 * S, (5 * S, "metadata", False)), (None, None, (0, "none", False)),
     (51 * S, 50 * S, (51 * S, "both", False)), (51 * S + 10_000, 50 * S, (51 * S + 10_000, "both", True)), (102 * S, 100 * S, (102 * S, "both", False)), (102 * S + 10_000, 100 * S, (102 * S + 10_000, "both", True))],
)
def test_durations(spark, video, meta, want):
    c = durations.resolve(F.col("v"), F.col("m"))
    assert values(spark, [(video, meta)], "v bigint, m bigint", c["duration_us"], c["duration_source"], c["duration_mismatch"]) == [want]


def test_duration_warning(spark):
    c = durations.resolve(F.col("v"), F.col("m"))
    assert values(spark, [(110 * S, 100 * S)], "v bigint, m bigint", c["duration_warning"]) == [("duration mismatch: video=110.0s vs metadata=100.0s (kept video)",)]
    assert values(spark, [(10.0, 10.0), (10.0, 11.5)], "a double, b double", durations.span_us(F.col("a"), F.col("b"))) == [(None,), (1_500_000,)]


GENERIC = profiles.get("generic")
RESOLVED = [
    ({"difficulty": "easy", "task_difficulty": "hard"}, "easy", "hard"), ({"task_difficulty": "hard", "difficulty": "easy"}, "hard", "hard"), ({"x": {"difficulty": "easy"}}, "easy", "easy"), ({"difficulty": {"label": "easy"}}, "easy", "easy"),
    ({"difficulty": "", "task-difficulty": " hard"}, " hard", " hard"), ({"difficulty": []}, None, None), ({"difficulty": 1.0}, "1.0", "1.0"), ({"difficulty": True}, "True", "True"), ({"difficulty": 0}, "0", "0"), ({}, None, None),
]


def test_resolution_passes_and_order(spark):
    d = spark.createDataFrame([(json.dumps(doc),) for doc, _, _ in RESOLVED], "j string").withColumn("f", flatten(F.col("j"), GENERIC))
    names = GENERIC.spellings()["task_difficulty"]
    got = d.select(resolve(F.col("f.leaves"), names), resolve(F.col("f.leaves"), names, "registry")).collect()
    assert [tuple(r) for r in got] == [(a, b) for _, a, b in RESOLVED]
    both = [fields(F.col("j"), GENERIC, GENERIC.spellings(), order, ("task",)) for order in ("document", "registry")]
    got = d.select(*(x.alias(f"x{i}") for i, x in enumerate(both))).collect()
    assert [(r["x0"]["task_difficulty"], r["x1"]["task_difficulty"]) for r in got] == [(a, b) for _, a, b in RESOLVED]
    assert [r["x0"]["has_task"] for r in got] == [any(k.startswith("task") and v for k, v in doc.items()) for doc, _, _ in RESOLVED]
    for k, v in GENERIC.spellings().items():
        assert [r[0] for r in d.select(resolve(F.col("f.leaves"), v)).collect()] == [r["x0"][k] for r in got]


def test_dotted_paths(spark):
    d = spark.createDataFrame([(json.dumps({"task": {"id": "t"}}),)], "j string").withColumn("f", flatten(F.col("j"), GENERIC))
    assert d.select(resolve(F.col("f.leaves"), GENERIC.spellings()["task_id"])).first()[0] == "t"


def test_profiles_do_not_leak():
    chunk = profiles.get("chunk-array-v1")
    doc = json.dumps([{"data": {"metadata": {"environment_label": "shop"}}}])
    assert parse(doc, chunk)["leaves"][0]["path"] == "environment_label"
    assert "environment_label" in chunk.spellings()["environment_l1"] and "environment_label" not in GENERIC.spellings()["environment_l1"]
    assert parse("[]", chunk)["error"] == "metadata top level is list, expected object"
    assert parse("[1]", chunk)["error"] == "metadata top level is int, expected object"
    assert parse(b"\xff", GENERIC)["error"].startswith("invalid metadata JSON")
    assert parse('{"a":1,"a":2,"b":NaN}', GENERIC)["leaves"][0]["raw"] == "2"
    with pytest.raises(KeyError):
        profiles.get("nope")

"""The checks on hand-made deliveries, and against a plain evaluator written from the rules."""

import random

import pytest
from pyspark.sql import functions as F

from polyvant.config import HOUR_US, Limits
from polyvant.operators import checks
from polyvant.operators.rows import rows_of
from polyvant.plans.evaluate import evaluate

SPEC = "ord bigint, stem string, video_us bigint, meta_us bigint, task_id string, operator_id string, environment_id string, environment_l1 string, environment_l2 string, environment_l3 string, difficulty string, business_size string, worker_type string, human_interaction boolean"
NAMES = [c.split(" ")[0] for c in SPEC.split(", ")]


def delivery(spark, episodes):
    rows = [tuple({"ord": i, "stem": f"e{i}", **e}.get(n) for n in NAMES) for i, e in enumerate(episodes)]
    return rows_of(spark.createDataFrame(rows, SPEC))


def status(spark, episodes, **kw):
    return {r["check"]: r["status"] for r in checks.verdicts(delivery(spark, episodes), **kw).collect()}


def one(hours=1.0, **kw):
    return {"video_us": round(hours * HOUR_US), **kw}


def test_one_operator(spark):
    got = status(spark, [one(task_id="t", operator_id="o", environment_id="e", environment_l1="x", difficulty="easy")] * 11)
    assert [got[k] for k in ("c1", "c2", "c3", "c4", "c5", "c6")] == ["FAIL"] * 5 + ["PASS"]
    assert [got[k] for k in ("c7", "c8", "c9")] == ["NOT_COMPUTABLE"] * 3


@pytest.mark.parametrize("extra,want", [(0, "PASS"), (1, "FAIL")])
def test_caps_are_strict(spark, extra, want):
    e = [one(10, task_id="t", environment_id="e", difficulty="easy"), {"video_us": extra, "task_id": "t", "environment_id": "e", "difficulty": "easy"}]
    assert status(spark, e)["c4"] == want


def test_unlabelled_hours_warn(spark):
    assert status(spark, [one()])["c2"] == "WARN"
    assert status(spark, [{}])["c2"] == "NOT_COMPUTABLE"


def test_sizes_without_sites_pass(spark):
    r = {r["check"]: r for r in checks.verdicts(delivery(spark, [one(business_size="small")])).collect()}
    assert (r["c7"]["status"], r["c7"]["groups"]) == ("PASS", 0)


def test_empty_delivery(spark):
    got = status(spark, [{}])
    assert set(got.values()) == {"NOT_COMPUTABLE"}
    assert len(got) == 9
    assert set(status(spark, []).values()) == {"NOT_COMPUTABLE"}


def test_severest_label_and_conflict(spark):
    e = [one(30, task_id="t", environment_id="e", difficulty="easy"), one(5, task_id="t", environment_id="e", difficulty="hard")]
    g = checks.task_env(checks.group(delivery(spark, e), checks.GRAINS["c4"])).first()
    assert (g["difficulty"], g["conflict"], g["cap_us"], g["over_cap"]) == ("hard", True, 40 * HOUR_US, False)


def test_any_factory_row_counts(spark):
    e = [one(0.9, task_id="t", environment_id="e", difficulty="hard", environment_l1="Light INDUSTRIAL"), one(0.6, task_id="t", environment_id="e", environment_l1="office", difficulty="easy")]
    rows = delivery(spark, e)
    for dynamic, over in ((False, True), (True, False)):
        g = checks.task_env(checks.group(rows, checks.GRAINS["c4"]), dynamic=dynamic).first()
        assert (g["difficulty"], g["conflict"], g["over_cap"]) == ("factory", False, over)


def test_unlabelled_groups_have_no_cap(spark):
    assert status(spark, [one(199, task_id="t", operator_id="o", environment_id="e")])["c5"] == "PASS"
    assert status(spark, [one(201, task_id="t")])["c3"] == "FAIL"


def test_share_is_rounded_before_the_test(spark):
    e = [one(0.20004, environment_l1="a")] + [one(0.79996 / 20, environment_l1=f"x{i}") for i in range(20)]
    d = {r["environment_l1"]: r["over_cap"] for r in checks.env_l1(checks.group(delivery(spark, e), checks.GRAINS["c1"])).collect()}
    assert not d["a"]


def plain(episodes, limits=Limits()):
    """Statuses by loops."""
    total = sum(e.get("video_us") or 0 for e in episodes)

    def groups(*keys):
        out = {}
        for e in episodes:
            k = tuple(e.get(x) for x in keys)
            if None not in k:
                out.setdefault(k, []).append(e)
        return out

    def level(g):
        return next((d for d in ("hard", "medium", "easy") if any(e.get("difficulty") == d for e in g)), None)

    us = lambda g: sum(e.get("video_us") or 0 for e in g)
    out = {}
    g = groups("environment_l1")
    hours = sorted((us(x) for x in g.values()), reverse=True)
    pct = lambda p, w: 100.0 * p / w if w else 0.0
    bad = any(round(pct(h, sum(hours)), 2) > 20 for h in hours) or pct(sum(hours[:5]), sum(hours)) > 60 or pct(sum(hours[:10]), sum(hours)) > 85 or len(g) < 15
    out["c1"] = "NOT_COMPUTABLE" if not g else "FAIL" if bad else "PASS"
    g = groups("task_id")
    bad = any(us(x) > 200 * HOUR_US or pct(us(x), total) > limits.task_share_pct.get(level(x), 1e9) for x in g.values())
    out["c3"] = "NOT_COMPUTABLE" if not g else "FAIL" if bad else "PASS"
    for key, keys, caps in (("c4", ("task_id", "environment_id"), limits.task_env_max_h), ("c5", ("operator_id", "task_id", "environment_id"), limits.op_task_env_max_h)):
        g = groups(*keys)
        cap = lambda x, key=key, caps=caps: 1 if key == "c4" and any("factory" in (e.get("environment_l1") or "").lower() for e in x) else caps.get(level(x), 1e9)
        out[key] = "NOT_COMPUTABLE" if not g else "FAIL" if any(us(x) > cap(x) * HOUR_US for x in g.values()) else "PASS"
    g = groups("environment_id", "operator_id")
    out["c6"] = "NOT_COMPUTABLE" if not g else "FAIL" if any(us(x) > 40 * HOUR_US for x in g.values()) else "PASS"
    return out


def random_delivery(rnd, n):
    pick = lambda *v: rnd.choice([*v, None])
    return [one(rnd.choice([0.5, 1, 3, 8]), task_id=pick("t1", "t2", "t3"), operator_id=pick("o1", "o2"), environment_id=pick("e1", "e2", "e3"), environment_l1=pick("Factory", *(f"l{i}" for i in range(20))), difficulty=pick("easy", "medium", "hard")) for _ in range(n)]


def test_against_plain_loops(spark):
    rnd = random.Random(4)
    for n in (1, 5, 40, 120):
        e = random_delivery(rnd, n)
        got = status(spark, e)
        want = plain(e)
        assert {k: got[k] for k in want} == want


def test_one_pass_equals_separate_groupings(spark):
    rows = delivery(spark, random_delivery(random.Random(9), 80)).cache()
    every = checks.all_grains(rows)
    for grain, keys in checks.GRAINS.items():
        cols = [*keys, "us", "episodes", "bits", "factory", "first_ord"]
        key = lambda r: repr(r)
        assert sorted(every.where(F.col("grain") == grain).select(*cols).collect(), key=key) == sorted(checks.group(rows, keys).select(*cols).collect(), key=key)


def test_order_of_rows_does_not_matter(spark):
    e = random_delivery(random.Random(2), 60)
    assert status(spark, e) == status(spark, e[::-1])


def test_report_text(spark):
    r = evaluate(delivery(spark, [one(11, task_id="t", operator_id="o", environment_id="e", environment_l1="x", difficulty="easy", worker_type="real")]))
    c = {c.key: c for c in r.checks}
    assert c["c4"].detail == "1 pair(s); 1 over cap; factory cap=1h (repetitive)"
    assert c["c1"].detail == "distinct=1, top-5=100.0%, top-10=100.0%; 1 category(ies) exceed 20%; top-5=100.0% > 60%; top-10=100.0% > 85%; distinct=1 < 15"
    assert c["c2"].detail == "easy=100.0% (max 30), hard=0.0% (min 5), medium=0.0% (target 40, INFO); easy=100.0% > 30%; hard=0.0% < 5%"
    assert list(c["c3"].offender_rows()) == [{"task_id": "t", "difficulty": "easy", "hours": 11.0, "pct": 100.0, "reason": "100.0% > 1.5% (easy)", "conflict": False}]
    assert c["c7"].detail == "requires business_size; field absent from delivery"
    assert r.summary == {"episodes": 1, "total_hours": 11.0, "status_counts": {"FAIL": 5, "PASS": 2, "NOT_COMPUTABLE": 2}, "any_fail": True, "factory_dynamic": False}

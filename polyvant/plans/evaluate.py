"""The library call: a fact table in, a report of lazy tables and small verdicts out. No files are touched."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HOUR_US, Limits
from ..functions import canon
from ..operators import checks

NAMES = {
    "c1": "Environment category (L1)", "c2": "Difficulty mix", "c3": "Per-task share", "c4": "Task x Environment", "c5": "Operator x Task x Environment",
    "c6": "Environment x Operator", "c7": "Business-size caps per environment", "c8": "Workforce mix", "c9": "Human-human interaction",
}
ABSENT = {
    "c1": "no environment_l1 labels present", "c3": "no task_id present", "c4": "no (task_id, environment_id) pairs present", "c5": "no (operator_id, task_id, environment_id) triples present",
    "c6": "no (environment_id, operator_id) pairs present", "c7": "requires business_size; field absent from delivery", "c8": "requires worker_type; field absent from delivery", "c9": "requires human_interaction; field absent from delivery",
}


@dataclass
class Check:
    key: str
    status: str
    detail: str
    offenders: DataFrame | None = None
    n_offenders: int = 0
    extra: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return NAMES[self.key]

    def offender_rows(self, limit: int | None = None) -> Iterator[dict]:
        """Offenders in first-seen order; all of them stream from the executors, never collected at once."""
        if self.offenders is None:
            return
        d = self.offenders if limit is None else self.offenders.limit(limit)
        for r in d.toLocalIterator():
            yield r.asDict()


@dataclass
class Report:
    checks: list[Check]
    summary: dict
    rows: DataFrame
    grains: DataFrame
    limits: Limits = Limits()

    def close(self) -> None:
        """Lets go of the groups that offenders are read from."""
        self.grains.unpersist()


def _offenders(key: str, judged: DataFrame, limits: Limits) -> DataFrame:
    d = judged.where("over_cap").withColumn("hours", canon.rounded(canon.hours(F.col("us")), 3))
    if key == "c1":
        return d.orderBy("rank").select(F.col("environment_l1").alias("label"), "hours", canon.rounded(F.col("pct"), 2).alias("pct"))
    if key == "c3":
        h = F.when(F.col("over_hours"), F.concat(canon.text(canon.hours(F.col("us")), 1), F.lit(f"h > {limits.task_max_h:g}h absolute")))
        caps = None
        for k, v in limits.task_share_pct.items():
            caps = F.when(F.col("difficulty") == k, f"{v:g}") if caps is None else caps.when(F.col("difficulty") == k, f"{v:g}")
        p = F.when(F.col("over_share"), F.concat(canon.text(F.col("pct"), 1), F.lit("% > "), caps, F.lit("% ("), F.col("difficulty"), F.lit(")")))
        return d.orderBy("first_ord", "task_id").select("task_id", "difficulty", "hours", canon.rounded(F.col("pct"), 2).alias("pct"), F.concat_ws("; ", h, p).alias("reason"), "conflict")
    keys = checks.GRAINS[key]
    d = d.withColumn("cap_h", F.col("cap_us") / F.lit(float(HOUR_US))).orderBy("first_ord", *keys)
    if key == "c5":
        return d.select(F.array(*keys).alias("group"), "difficulty", "hours", "cap_h", "conflict")
    if key == "c4":
        return d.select(*keys, "difficulty", "hours", "cap_h", "factory", "conflict")
    return d.select(*keys, "hours", "cap_h")


def evaluate(rows: DataFrame, limits: Limits = Limits(), dynamic: bool = False) -> Report:
    """Runs the nine checks in their fixed order. ``rows`` is read once and grouped once; the groups, from which
    every verdict, total and offender comes, are kept until the report is closed."""
    grains = checks.all_grains(rows).persist()
    totals_df = checks.totals_of(grains)
    t = totals_df.first().asDict()
    judged = checks.judged_grains(grains, totals_df, limits, dynamic)
    counts = {r["check"]: r for r in checks.verdicts_of(grains, limits, dynamic).collect()}  # nine rows
    out = []
    for key in NAMES:
        status = counts[key]["status"]
        extra: dict = {}
        if key in judged:
            g, bad, mixed = counts[key]["groups"], counts[key]["offenders"], counts[key]["conflicts"]
            detail = _group_detail(key, g, bad, mixed, limits, dynamic)
            if key == "c1" and status != "NOT_COMPUTABLE":
                detail, extra = _l1_detail(judged["c1"], limits)
        elif key == "c2":
            detail, extra = _difficulty_detail(t, status, limits)
        elif key == "c8":
            detail = _workforce_detail(t, limits)
        else:
            share = 100.0 * t["interactive"] / t["episodes"] if t["episodes"] else 0.0
            detail = f"{t['interactive']}/{t['episodes']} episodes = {share:.1f}% interactive (target >= {limits.interaction_min_pct:g}%)"
        if status == "NOT_COMPUTABLE" and key in ABSENT:
            detail = detail if key == "c8" and t["with_worker"] else ABSENT[key]
        n = counts[key]["offenders"]
        out.append(Check(key, status, detail, _offenders(key, judged[key], limits) if n else None, n, extra))
    n = Counter(c.status for c in out)
    summary = {"episodes": t["episodes"], "total_hours": round(t["total_us"] / HOUR_US, 3), "status_counts": dict(n), "any_fail": n["FAIL"] > 0, "factory_dynamic": dynamic}
    return Report(out, summary, rows, grains, limits)


def _group_detail(key: str, groups: int, bad: int, mixed: int, limits: Limits, dynamic: bool) -> str:
    if key == "c6":
        return f"{groups} pair(s); {bad} over {limits.env_op_max_h:g}h"
    noun = {"c3": "task(s)", "c4": "pair(s)", "c5": "group(s)", "c7": "(env, size) group(s)"}.get(key, "")
    text = f"{groups} {noun}; {bad} over cap"
    if key == "c4":
        cap = limits.factory_dynamic_h if dynamic else limits.factory_h
        text += f"; factory cap={cap:g}h ({'dynamic' if dynamic else 'repetitive'})"
    if mixed:
        text += f"; {mixed} {'task(s) ' if key == 'c3' else ''}with mixed difficulty (used most severe)"
    return text


def _l1_detail(judged: DataFrame, limits: Limits) -> tuple[str, dict]:
    v = checks.l1_verdict(judged, limits).first()
    why = [f"{v['offenders']} category(ies) exceed {limits.l1_single_pct:g}%"] if v["offenders"] else []
    why += [f"top-{k}={v[f'top{k}_pct']:.1f}% > {cap:g}%" for k, cap in ((5, limits.l1_top5_pct), (10, limits.l1_top10_pct)) if v[f"top{k}_pct"] > cap]
    why += [f"distinct={v['distinct_labels']} < {limits.l1_min_distinct}"] if v["distinct_labels"] < limits.l1_min_distinct else []
    split = [{"label": r["environment_l1"], "hours": round(r["us"] / HOUR_US, 3), "pct": round(r["pct"], 2)} for r in judged.orderBy("rank").select("environment_l1", "us", "pct").toLocalIterator()]
    return f"distinct={v['distinct_labels']}, top-5={v['top5_pct']:.1f}%, top-10={v['top10_pct']:.1f}%; " + ("; ".join(why) or "within limits"), {"distribution": split}


def _difficulty_detail(t: dict, status: str, limits: Limits) -> tuple[str, dict]:
    known, unknown = t["easy_us"] + t["medium_us"] + t["hard_us"], t["unknown_us"] / HOUR_US
    if known <= 0:
        return "no known-difficulty hours" + (f"; {unknown:.2f}h unknown" if unknown else ""), {}
    easy, medium, hard = (100.0 * t[f"{k}_us"] / known for k in ("easy", "medium", "hard"))
    text = f"easy={easy:.1f}% (max {limits.easy_max_pct:g}), hard={hard:.1f}% (min {limits.hard_min_pct:g}), medium={medium:.1f}% (target {limits.medium_target_pct:g}, INFO)"
    if unknown > 0:
        text += f"; {unknown:.2f}h unknown-difficulty (excluded)"
    if easy > limits.easy_max_pct:
        text += f"; easy={easy:.1f}% > {limits.easy_max_pct:g}%"
    if hard < limits.hard_min_pct:
        text += f"; hard={hard:.1f}% < {limits.hard_min_pct:g}%"
    return text, {"easy_pct": round(easy, 2), "medium_pct": round(medium, 2), "hard_pct": round(hard, 2), "unknown_hours": round(unknown, 3)}


def _workforce_detail(t: dict, limits: Limits) -> str:
    both = t["real_us"] + t["contractor_us"]
    if both <= 0:
        return "no hours attributed to real/contractor workers"
    real, hired = 100.0 * t["real_us"] / both, 100.0 * t["contractor_us"] / both
    text = f"real={real:.1f}%, contractor={hired:.1f}% by hours"
    if real < limits.real_min_pct:
        text += f"; real={real:.1f}% < {limits.real_min_pct:g}%"
    if hired > limits.contractor_max_pct:
        text += f"; contractor={hired:.1f}% > {limits.contractor_max_pct:g}%"
    return text

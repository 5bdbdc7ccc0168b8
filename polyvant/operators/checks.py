"""The nine checks over the fact table: lazy groups with their verdicts, and a one-row summary.

Every measure is a sum, a count, an OR or a minimum: Spark combines them before the shuffle, a hot key costs one
row for each task, and partial results can be merged exactly (see ``streaming``). Sums are whole microseconds,
so they do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Limits, microseconds
from ..functions import canon

#: Keys of each grouped check.
GRAINS: dict[str, tuple[str, ...]] = {
    "c1": ("environment_l1",),
    "c3": ("task_id",),
    "c4": ("task_id", "environment_id"),
    "c5": ("operator_id", "task_id", "environment_id"),
    "c6": ("environment_id", "operator_id"),
    "c7": ("environment_id", "business_size"),
}
STATUSES = ("PASS", "FAIL", "WARN", "NOT_COMPUTABLE")
#: What the ungrouped checks and the totals read: a row for each combination of these few labels, absent ones too.
MIX = ("difficulty", "worker_type", "human_interaction", "business_size")


def measures() -> list[Column]:
    return [F.sum("duration_us").alias("us"), F.count(F.lit(1)).alias("episodes"), F.bit_or("diff_bit").alias("bits"), F.bool_or("is_factory").alias("factory"), F.min("ord").alias("first_ord"), F.count_if("duration_mismatch").alias("mismatches")]


def group(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Measures of each group whose keys are all present."""
    d = rows
    for k in keys:
        d = d.where(F.col(k).isNotNull())
    return d.groupBy(*keys).agg(*measures())


def all_grains(rows: DataFrame) -> DataFrame:
    """The groups of every grouped check, and those of ``MIX``, in one pass: ``grain`` names the check or is "mix",
    keys of other grains are null."""
    sets = {**GRAINS, "mix": MIX}
    cols = list(dict.fromkeys(k for keys in sets.values() for k in keys))
    d = rows.groupingSets([list(k) for k in sets.values()], *cols).agg(F.grouping_id().alias("_g"), *measures())
    name = present = None
    for grain, keys in sets.items():
        here = F.col("_g") == sum(0 if c in keys else 1 << (len(cols) - 1 - i) for i, c in enumerate(cols))
        name = F.when(here, grain) if name is None else name.when(here, grain)
        whole = F.lit(True)
        for k in keys if grain != "mix" else ():  # a null key of a rolled-up column is no missing label; grouping_id tells them apart
            whole = whole & F.col(k).isNotNull()
        present = F.when(here, whole) if present is None else present.when(here, whole)
    return d.where(present).select(name.alias("grain"), *cols, "us", "episodes", "bits", "factory", "first_ord", "mismatches")


def totals_of(grains: DataFrame) -> DataFrame:
    """``totals`` from the groups of ``all_grains``."""
    us = lambda test: F.coalesce(F.sum(F.when(test, F.col("us"))), F.lit(0))
    n = lambda test: F.coalesce(F.sum(F.when(test, F.col("episodes"))), F.lit(0))
    every = F.lit(True)
    return grains.where(F.col("grain") == "mix").agg(
        n(every).alias("episodes"), us(every).alias("total_us"),
        *(us(F.col("difficulty") == k).alias(f"{k}_us") for k in ("easy", "medium", "hard")), us(F.col("difficulty").isNull()).alias("unknown_us"),
        *(us(F.col("worker_type") == k).alias(f"{k}_us") for k in ("real", "contractor")), n(F.col("worker_type").isNotNull()).alias("with_worker"), n(F.col("business_size").isNotNull()).alias("with_size"),
        n(F.col("human_interaction").isNotNull()).alias("with_interaction"), n(F.col("human_interaction")).alias("interactive"), F.coalesce(F.sum("mismatches"), F.lit(0)).alias("mismatches"),
    )


def _cap(level: Column, caps: dict[str, float], scale) -> Column:
    out = None
    for k, v in caps.items():
        out = F.when(level == k, F.lit(scale(v))) if out is None else out.when(level == k, F.lit(scale(v)))
    return out


def _judged(groups: DataFrame, caps: dict[str, float]) -> DataFrame:
    """difficulty, conflict, cap_us and over_cap of groups whose cap follows their severest label; a group
    without one has no cap."""
    d = groups.withColumns({"difficulty": canon.severest(F.col("bits")), "conflict": canon.mixed(F.col("bits"))})
    d = d.withColumn("cap_us", _cap(F.col("difficulty"), caps, microseconds))
    return d.withColumn("over_cap", F.coalesce(F.col("us") > F.col("cap_us"), F.lit(False)))


def env_l1(groups: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """C1 groups: share of labelled hours, rank, and over_cap on the share rounded to two places. The few labels
    of a delivery's vocabulary are ranked in one window."""
    total, rank = Window.partitionBy(), Window.orderBy(F.desc("us"), "first_ord", "environment_l1")
    d = groups.withColumns({"total_us": F.sum("us").over(total), "rank": F.row_number().over(rank)})
    d = d.withColumn("pct", canon.pct(F.col("us"), F.col("total_us")))
    return d.withColumn("over_cap", canon.rounded(F.col("pct"), 2) > limits.l1_single_pct)


def env_l1_verdict(groups: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row: distinct labels, offenders, top-5 and top-10 shares, status."""
    return l1_verdict(env_l1(groups, limits), limits)


def l1_verdict(judged: DataFrame, limits: Limits) -> DataFrame:
    d = judged.agg(
        F.count(F.lit(1)).alias("distinct_labels"), F.count_if("over_cap").alias("offenders"), F.coalesce(F.sum("us"), F.lit(0)).alias("total_us"),
        F.coalesce(F.sum(F.when(F.col("rank") <= 5, F.col("us"))), F.lit(0)).alias("top5_us"), F.coalesce(F.sum(F.when(F.col("rank") <= 10, F.col("us"))), F.lit(0)).alias("top10_us"),
    )
    d = d.withColumns({"top5_pct": canon.pct(F.col("top5_us"), F.col("total_us")), "top10_pct": canon.pct(F.col("top10_us"), F.col("total_us"))})
    bad = (F.col("offenders") > 0) | (F.col("top5_pct") > limits.l1_top5_pct) | (F.col("top10_pct") > limits.l1_top10_pct) | (F.col("distinct_labels") < limits.l1_min_distinct)
    return d.withColumn("status", F.when(F.col("distinct_labels") == 0, "NOT_COMPUTABLE").when(bad, "FAIL").otherwise("PASS"))


def task_share(groups: DataFrame, total_us: DataFrame | None, limits: Limits = Limits()) -> DataFrame:
    """C3 groups: share of *all* hours (``total_us``: one row; None if ``groups`` has that column), both ways to be
    over."""
    d = groups if total_us is None else groups.crossJoin(total_us.select(F.col("total_us")))  # one row beside each group
    d = d.withColumns({"difficulty": canon.severest(F.col("bits")), "conflict": canon.mixed(F.col("bits")), "pct": canon.pct(F.col("us"), F.col("total_us"))})
    d = d.withColumns({"share_cap_pct": _cap(F.col("difficulty"), limits.task_share_pct, float), "over_hours": F.col("us") > microseconds(limits.task_max_h)})
    d = d.withColumn("over_share", F.coalesce(F.col("pct") > F.col("share_cap_pct"), F.lit(False)))
    return d.withColumn("over_cap", F.col("over_hours") | F.col("over_share"))


def task_env(groups: DataFrame, limits: Limits = Limits(), dynamic: bool = False) -> DataFrame:
    """C4 groups: a factory pair has the factory's cap, no difficulty and no conflict."""
    d = _judged(groups, limits.task_env_max_h)
    plant = F.col("factory")
    flat = microseconds(limits.factory_dynamic_h if dynamic else limits.factory_h)
    d = d.withColumns({"difficulty": F.when(plant, "factory").otherwise(F.col("difficulty")), "conflict": ~plant & F.col("conflict"), "cap_us": F.when(plant, F.lit(flat)).otherwise(F.col("cap_us"))})
    return d.withColumn("over_cap", F.coalesce(F.col("us") > F.col("cap_us"), F.lit(False)))


def op_task_env(groups: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """C5 groups."""
    return _judged(groups, limits.op_task_env_max_h)


def env_op(groups: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """C6 groups: one flat cap."""
    cap = microseconds(limits.env_op_max_h)
    return groups.withColumns({"cap_us": F.lit(cap), "over_cap": F.col("us") > cap})


def business(groups: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """C7 groups."""
    d = groups.withColumn("cap_us", _cap(F.col("business_size"), limits.business_max_h, microseconds))
    return d.withColumn("over_cap", F.coalesce(F.col("us") > F.col("cap_us"), F.lit(False)))


def _sum_if(test: Column) -> Column:
    return F.coalesce(F.sum(F.when(test, F.col("duration_us"))), F.lit(0))


def totals(rows: DataFrame) -> DataFrame:
    """One row that the ungrouped checks, the gates and the summary read."""
    return rows.agg(
        F.count(F.lit(1)).alias("episodes"), F.coalesce(F.sum("duration_us"), F.lit(0)).alias("total_us"),
        *(_sum_if(F.col("difficulty") == k).alias(f"{k}_us") for k in ("easy", "medium", "hard")), _sum_if(F.col("difficulty").isNull()).alias("unknown_us"),
        *(_sum_if(F.col("worker_type") == k).alias(f"{k}_us") for k in ("real", "contractor")), F.count("worker_type").alias("with_worker"), F.count("business_size").alias("with_size"),
        F.count("human_interaction").alias("with_interaction"), F.count_if("human_interaction").alias("interactive"), F.count_if("duration_mismatch").alias("mismatches"),
    )


def difficulty_mix(t: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """C2: one row. Without known hours it warns if there are unknown ones, else it cannot be computed."""
    known = F.col("easy_us") + F.col("medium_us") + F.col("hard_us")
    d = t.select("easy_us", "medium_us", "hard_us", "unknown_us", known.alias("known_us"))
    d = d.withColumns({f"{k}_pct": canon.pct(F.col(f"{k}_us"), F.col("known_us")) for k in ("easy", "medium", "hard")})
    bad = (F.col("easy_pct") > limits.easy_max_pct) | (F.col("hard_pct") < limits.hard_min_pct)
    unknown = F.col("unknown_us") > 0
    return d.withColumn("status", F.when((F.col("known_us") <= 0) & ~unknown, "NOT_COMPUTABLE").when(F.col("known_us") <= 0, "WARN").when(bad, "FAIL").when(unknown, "WARN").otherwise("PASS"))


def workforce(t: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """C8: one row."""
    both = F.col("real_us") + F.col("contractor_us")
    d = t.select("with_worker", "real_us", "contractor_us", both.alias("joint_us"))
    d = d.withColumns({f"{k}_pct": canon.pct(F.col(f"{k}_us"), F.col("joint_us")) for k in ("real", "contractor")})
    bad = (F.col("real_pct") < limits.real_min_pct) | (F.col("contractor_pct") > limits.contractor_max_pct)
    return d.withColumn("status", F.when((F.col("with_worker") == 0) | (F.col("joint_us") <= 0), "NOT_COMPUTABLE").when(bad, "FAIL").otherwise("PASS"))


def interaction(t: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """C9: one row; a share of all episodes, and a target rather than a limit."""
    d = t.select("episodes", "with_interaction", "interactive", canon.pct(F.col("interactive"), F.col("episodes")).alias("pct"))
    return d.withColumn("status", F.when(F.col("with_interaction") == 0, "NOT_COMPUTABLE").when(F.col("pct") >= limits.interaction_min_pct, "PASS").otherwise("WARN"))


def duration_sources(rows: DataFrame) -> DataFrame:
    return rows.groupBy("duration_source").agg(F.count(F.lit(1)).alias("episodes"), F.sum("duration_us").alias("us"))


def judged_grains(grains: DataFrame, total: DataFrame, limits: Limits = Limits(), dynamic: bool = False) -> dict[str, DataFrame]:
    """The judged groups of every grouped check, from those of ``all_grains``. Each reads ``grains`` by itself, and
    Spark would push the choice of a grain below the grouping: persist it, or store it, first."""
    of = lambda g: grains.where(F.col("grain") == g).select(*GRAINS[g], "us", "episodes", "bits", "factory", "first_ord")
    return {
        "c1": env_l1(of("c1"), limits), "c3": task_share(of("c3"), total, limits), "c4": task_env(of("c4"), limits, dynamic),
        "c5": op_task_env(of("c5"), limits), "c6": env_op(of("c6"), limits), "c7": business(of("c7"), limits),
    }


VERDICT = "check string, status string, groups bigint, offenders bigint, conflicts bigint"


def verdicts(rows: DataFrame, limits: Limits = Limits(), dynamic: bool = False) -> DataFrame:
    """(check, status, groups, offenders, conflicts): nine rows. Ungrouped checks have no groups. The facts are read
    once and grouped once: the groups are kept until the nine verdicts, which are made here, are known."""
    grains = all_grains(rows).persist()
    try:
        return verdicts_of(grains, limits, dynamic)
    finally:
        grains.unpersist()


def _flagged(grains: DataFrame, total_us: int, limits: Limits, dynamic: bool) -> DataFrame:
    """``over`` and ``mixed`` of the groups of c3 to c7, in one plan over all of them: each check judges every row, and
    a row keeps the verdict of its own grain."""
    names = [*grains.columns, "over", "mixed"]
    d = grains.where(F.col("grain").isin("c3", "c4", "c5", "c6", "c7")).withColumns({"over": F.lit(False), "mixed": F.lit(False)})
    judges = {
        "c3": lambda x: task_share(x.withColumn("total_us", F.lit(total_us)), None, limits), "c4": lambda x: task_env(x, limits, dynamic),
        "c5": lambda x: op_task_env(x, limits), "c6": lambda x: env_op(x, limits), "c7": lambda x: business(x, limits),
    }
    for grain, judge in judges.items():
        x = judge(d)
        here = F.col("grain") == grain
        mixed = F.when(here, F.col("conflict")).otherwise(F.col("mixed")) if "conflict" in x.columns else F.col("mixed")
        d = x.withColumns({"over": F.when(here, F.col("over_cap")).otherwise(F.col("over")), "mixed": mixed}).select(*names)
    return d


def verdicts_of(grains: DataFrame, limits: Limits = Limits(), dynamic: bool = False) -> DataFrame:
    """``verdicts`` from the groups of ``all_grains``, or of several such tables, merged. ``grains`` is read three times:
    persist it, or store it, first. What comes to the driver is a row for each check."""
    spark, summed = grains.sparkSession, totals_of(grains)
    t = summed.first()
    one = spark.createDataFrame([t], summed.schema)
    by = {r["grain"]: r for r in _flagged(grains, t["total_us"], limits, dynamic).groupBy("grain").agg(F.count(F.lit(1)).alias("groups"), F.count_if("over").alias("offenders"), F.count_if("mixed").alias("conflicts")).collect()}
    first = l1_verdict(env_l1(grains.where("grain = 'c1'").select("environment_l1", "us", "first_ord"), limits), limits).first()
    out = [("c1", first["status"], first["distinct_labels"], first["offenders"], 0)]
    for name in ("c3", "c4", "c5", "c6", "c7"):
        groups, bad, mixed = (by[name][k] if name in by else 0 for k in ("groups", "offenders", "conflicts"))
        nothing = t["with_size"] == 0 if name == "c7" else groups == 0  # c7: present at all, even where no group is complete
        out.append((name, "NOT_COMPUTABLE" if nothing else "FAIL" if bad else "PASS", groups, bad, mixed))
    for name, d in (("c2", difficulty_mix(one, limits)), ("c8", workforce(one, limits)), ("c9", interaction(one, limits))):
        out.append((name, d.first()["status"], 0, 0, 0))
    return spark.createDataFrame(out, VERDICT)


def status_counts(found: DataFrame) -> DataFrame:
    """(status, checks) of ``verdicts``, for all four statuses."""
    d = found.sparkSession.createDataFrame([(x,) for x in STATUSES], "status string")
    return d.join(found.groupBy("status").agg(F.count(F.lit(1)).alias("checks")), "status", "left").fillna(0, ["checks"])

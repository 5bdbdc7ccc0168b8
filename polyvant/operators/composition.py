"""What a delivery is made of: queries of the report. They read hours rounded to four places, as whole units of
1e-4 hours, so that sums are exact and do not depend on order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ENVIRONMENT_NAMES, Limits
from ..functions import canon


def _units() -> Column:
    return F.rint(F.col("hours_4dp") * 10000).cast("bigint")


def hours_by(rows: DataFrame, key: str) -> DataFrame:
    """label, units (1e-4 hours), first_ord of each label."""
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("label")).agg(F.sum(_units()).alias("units"), F.min("ord").alias("first_ord"))


def ranked(groups: DataFrame) -> DataFrame:
    return groups.orderBy(F.desc("units"), "first_ord", "label")


def ratio(rows: DataFrame, key: str, values: tuple[str, ...]) -> DataFrame:
    """A row for each of ``values``, also those without hours: units and share of all labelled hours."""
    spark = rows.sparkSession
    d = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "label string, place int").join(hours_by(rows, key).select("label", "units"), "label", "left").fillna(0, ["units"])
    return d.withColumn("pct", canon.pct(F.col("units"), F.sum("units").over(Window.partitionBy())))


def difficulty_ratio(rows: DataFrame) -> DataFrame:
    return ratio(rows, "difficulty", ("hard", "medium", "easy"))


def workforce_ratio(rows: DataFrame) -> DataFrame:
    return ratio(rows, "worker_type", ("real", "contractor"))


def length_stats(rows: DataFrame) -> DataFrame:
    """Count, shortest, longest and mean of the minutes of episodes with a duration."""
    u = _units()
    d = rows.where(u > 0).agg(F.count(F.lit(1)).alias("episodes"), F.min(u).alias("min_units"), F.max(u).alias("max_units"), F.sum(u).alias("sum_units"))
    minutes = lambda c: F.col(c) * F.lit(60.0) / F.lit(10000.0)
    return d.select("episodes", minutes("min_units").alias("min_minutes"), minutes("max_units").alias("max_minutes"), F.try_divide(minutes("sum_units"), F.col("episodes")).alias("mean_minutes"))


def length_histogram(rows: DataFrame, bins: int = 12) -> DataFrame:
    """Episodes in ``bins`` equal bands of length; the last is closed, and equal lengths make bands of one unit's
    width. Empty bands have rows. The bounds are one row, so the join needs no shuffle."""
    u = rows.where(_units() > 0).select(_units().alias("u"))
    ends = u.agg(F.min("u").alias("lo"), F.max("u").alias("hi")).withColumn("hi", F.when(F.col("hi") == F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi"))).where("lo is not null")
    at = F.least(F.floor((F.col("u") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))).cast("int"), F.lit(bins - 1))
    counts = u.crossJoin(F.broadcast(ends)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("episodes"))
    grid = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    return grid.join(counts, "bin", "left").select("bin", (F.col("lo") * bins + F.col("bin") * (F.col("hi") - F.col("lo"))).alias("from_units_x_bins"), F.coalesce("episodes", F.lit(0)).alias("episodes"))


def vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, n, i) for i, (c, n) in enumerate(ENVIRONMENT_NAMES.items())], "code string, name string, place int")


def env_reference(rows: DataFrame) -> DataFrame:
    """Every environment of the vocabulary, captured or not, and every id beyond it. Shares are of all hours."""
    names = F.broadcast(vocabulary(rows.sparkSession))  # 19 rows
    used = hours_by(rows, "environment_id").select(F.col("label").alias("code"), "units")
    total = rows.agg(F.coalesce(F.sum(_units()), F.lit(0)).alias("total"))
    known = names.join(used, "code", "left").select("code", "name", "place", "units")
    extra = used.join(names, "code", "left_anti").select("code", F.lit(None).cast("string").alias("name"), F.lit(len(ENVIRONMENT_NAMES)).alias("place"), "units")
    d = known.union(extra).crossJoin(F.broadcast(total))
    return d.select("code", "name", "place", F.coalesce("units", F.lit(0)).alias("units"), (F.coalesce("units", F.lit(0)) > 0).alias("captured"), canon.pct(F.coalesce("units", F.lit(0)), F.col("total")).alias("pct"))


def unknown_environments(rows: DataFrame) -> DataFrame:
    used = rows.where(F.col("environment_id").isNotNull()).select(F.col("environment_id").alias("code")).distinct()
    return used.join(F.broadcast(vocabulary(rows.sparkSession)), "code", "left_anti")


def coverage(rows: DataFrame) -> DataFrame:
    """How many environments of the vocabulary appear, with or without hours. Episodes are looked up where they are,
    and each task passes on a row for each of its environments, 19 at most: no task reads all episodes of one."""
    used = rows.select(F.col("environment_id").alias("code"))
    found = used.join(F.broadcast(vocabulary(rows.sparkSession).select("code")), "code", "left_semi")
    return found.agg(F.count_distinct("code").alias("covered")).withColumn("of", F.lit(len(ENVIRONMENT_NAMES)))


def labels_over(groups: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Offenders of a grouped check in first-seen order."""
    return groups.where("over_cap").orderBy("first_ord")


def placed(d: DataFrame, *order: Column) -> DataFrame:
    """``d`` with ``place``, from 1 in ``order``: rows are dealt by ranges of the order and sorted there, and what
    earlier ranges hold is added, so no task sorts all. Equal rows have places in any order. ``d`` is read twice (to
    count the ranges, and to place), so it should give its rows in the same order again, as stored tables do."""
    names = [f"_o{i}" for i in range(len(order))]
    ranges = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that both readings have the same
    near = d.withColumns(dict(zip(names, order))).repartitionByRange(ranges, *names).sortWithinPartitions(*names).drop(*names)
    near = near.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    counts = {r["_part"]: r["n"] for r in near.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each range
    before, total = [], 0
    for part in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(part, 0)
    at = F.element_at(F.array(*map(F.lit, before)), F.col("_part") + 1) if before else F.lit(0)
    return near.withColumn("place", at + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_row")

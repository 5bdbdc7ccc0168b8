"""Episodes to the fact table that every check reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Limits
from ..functions import canon, durations
from ..functions.flatten import fields
from ..profiles import PROFILES, Profile

COLUMNS = (
    "ord", "stem", "duration_us", "hours", "hours_4dp", "duration_source", "task_id", "operator_id", "environment_id", "environment_l1", "environment_l2", "environment_l3",
    "difficulty", "diff_bit", "is_factory", "business_size", "worker_type", "human_interaction", "row_warnings", "ingest_warnings",
)


def is_factory(l1: Column, limits: Limits = Limits()) -> Column:
    return F.coalesce(F.lower(l1).rlike("|".join(limits.factory_words)), F.lit(False))


def rows_of(labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``labels`` has ord, stem, video_us, meta_us, canonical labels and, if known, row_warnings and
    ingest_warnings. Everything else of a row follows."""
    time = durations.resolve(F.col("video_us"), F.col("meta_us"), limits)
    d = labels.withColumns(time)
    none = F.array().cast("array<string>")
    for name in ("row_warnings", "ingest_warnings"):
        if name not in labels.columns:
            d = d.withColumn(name, none)
    h = canon.hours(F.col("duration_us"))
    d = d.withColumns({
        "hours": h, "hours_4dp": canon.rounded(h, 4), "diff_bit": canon.difficulty_bit(F.col("difficulty")), "is_factory": is_factory(F.col("environment_l1"), limits),
        "row_warnings": F.array_compact(F.concat(F.array("duration_warning"), F.col("row_warnings"))),
    })
    return d.select(*COLUMNS, "duration_mismatch", "video_us", "meta_us")


def resolve_labels(episodes: DataFrame, profile: Profile = PROFILES["generic"], order: str = "document") -> DataFrame:
    """``episodes`` (ord, stem, meta_json, video_us, error, ingest_warnings) with its sidecars' fields resolved."""
    names = profile.spellings()
    d = episodes.withColumn("_f", fields(F.col("meta_json"), profile, names, order))
    d = d.withColumns({f"_{k}": F.col("_f").getField(k) for k in names})
    raw = F.col("_task_difficulty")
    level = canon.difficulty(raw)
    warning = F.when(raw.isNull(), "difficulty absent; excluded from difficulty checks").when(level.isNull(), F.concat(F.lit("unrecognized difficulty '"), raw, F.lit("'; excluded from difficulty checks")))
    unread = [F.when(F.col(f"_{k}").isNotNull() & c.isNull(), F.concat(F.lit(f"{k} unrecognized: '"), F.col(f"_{k}"), F.lit("'"))) for k, c in (("business_size", canon.business_size(F.col("_business_size"))), ("worker_type", canon.worker_type(F.col("_worker_type"))), ("human_interaction", canon.flag(F.col("_human_interaction"))))]
    start, end = canon.number(F.col("_start_time_unix")), canon.number(F.col("_end_time_unix"))
    return d.select(
        "ord", "stem", "video_us", durations.span_us(start, end).alias("meta_us"),
        *(F.col(f"_{k}").alias(k) for k in ("task_id", "operator_id", "environment_id", "environment_l1", "environment_l2", "environment_l3")),
        level.alias("difficulty"), canon.business_size(F.col("_business_size")).alias("business_size"), canon.worker_type(F.col("_worker_type")).alias("worker_type"),
        canon.flag(F.col("_human_interaction")).alias("human_interaction"), F.array_compact(F.array(warning)).alias("row_warnings"),
        F.array_compact(F.concat(F.coalesce("ingest_warnings", F.array().cast("array<string>")), F.array(F.col("_f.error")), F.array(*unread))).alias("ingest_warnings"),
    )


def enrich(rows: DataFrame, side: DataFrame, key: str = "stem") -> DataFrame:
    """Labels that a side table (key, worker_type, business_size) adds where an episode has none. The side table
    holds a row for each episode at most; it is not broadcast unless its size allows."""
    names = [c for c in ("worker_type", "business_size") if c in side.columns]
    s = side.select(key, *(F.col(c).alias(f"_side_{c}") for c in names)).dropDuplicates([key])
    d = rows.join(s, key, "left")
    return d.withColumns({c: F.coalesce(c, f"_side_{c}") for c in names}).drop(*(f"_side_{c}" for c in names)).select(*rows.columns)


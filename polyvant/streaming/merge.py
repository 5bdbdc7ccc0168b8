"""Checks over episodes that keep arriving.

Every measure of a group is a sum, a count, an OR or a minimum, so the groups of a micro-batch merge with stored
ones exactly. Each batch writes its partial groups under its own number; a batch that is run again overwrites
its own part and nothing counts twice. Reading merges the parts: groups, totals and all nine verdicts. ``compact`` folds
finished parts into one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Limits
from ..operators import checks


def writer(path: str) -> Callable[[DataFrame, int], None]:
    def put(batch: DataFrame, number: int) -> None:
        checks.all_grains(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return put


def start(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keeps the partial groups of the streaming fact table ``rows`` below ``path``."""
    return rows.writeStream.foreachBatch(writer(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _merge(parts: DataFrame) -> DataFrame:
    keys = ["grain", *dict.fromkeys(k for keys in (*checks.GRAINS.values(), checks.MIX) for k in keys)]
    return parts.groupBy(*keys).agg(F.sum("us").alias("us"), F.sum("episodes").alias("episodes"), F.bit_or("bits").alias("bits"), F.bool_or("factory").alias("factory"), F.min("first_ord").alias("first_ord"), F.sum("mismatches").alias("mismatches"))


def merged(spark: SparkSession, path: str) -> DataFrame:
    """The groups of all batches so far, as ``checks.all_grains`` gives them."""
    return _merge(spark.read.parquet(path).drop("batch"))


def verdicts(spark: SparkSession, path: str, limits: Limits = Limits(), dynamic: bool = False) -> DataFrame:
    """The verdicts of all nine checks over the batches so far."""
    grains = merged(spark, path).persist()
    try:
        return checks.verdicts_of(grains, limits, dynamic)
    finally:
        grains.unpersist()


def compact(spark: SparkSession, path: str, to: str) -> None:
    """Writes the merged groups of ``path`` to the new folder ``to``, as one part that later batches can join. Call it
    between two runs of the stream, and go on with ``to``."""
    merged(spark, path).write.mode("errorifexists").parquet(f"{to}/batch=-1")

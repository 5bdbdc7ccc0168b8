"""Episodes from the star-schema tables: one order line stands for one episode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Limits
from ..operators.rows import rows_of

US = 1_000_000


def labels(spark: SparkSession, sf_dir: str, l1: str = "n_name") -> DataFrame:
    """ord, stem, video_us, meta_us and labels. Dimensions are joined by key; Spark broadcasts those that are
    small enough. Lines have no unique key, so ``ord`` is the order's key and line number, with ties."""
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")}
    d = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    if l1 == "r_name":
        d = d.join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    d = d.join(t["part"], F.col("l_partkey") == F.col("p_partkey")).join(t["supplier"].select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    whole = F.round(F.col("l_quantity") * 60).cast("bigint") * US
    size = F.lower("p_type")
    return d.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"), F.concat(F.lit("ep_"), "l_orderkey", F.lit("_"), "l_linenumber").alias("stem"),
        F.when(F.col("l_discount") != 0, whole).alias("video_us"), F.when(F.col("l_tax") != 0, whole + F.when(F.col("l_tax") == 0.08, 90 * US).otherwise(0)).alias("meta_us"),
        F.col("p_brand").alias("task_id"), F.col("s_name").alias("operator_id"), F.col("n_name").alias("environment_id"), F.col(l1).alias("environment_l1"), F.col("c_mktsegment").alias("environment_l2"), F.col("p_type").alias("environment_l3"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "hard").when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "medium").when(F.col("o_orderpriority") == "5-LOW", "easy").alias("difficulty"),
        F.when(size.isin("small", "medium", "large"), size).alias("business_size"), F.when(F.col("l_returnflag") == "R", "contractor").otherwise("real").alias("worker_type"),
        F.when(F.col("l_tax") != 0.05, F.col("l_linestatus") == "O").alias("human_interaction"),
    )


def rows(spark: SparkSession, sf_dir: str, limits: Limits = Limits(), l1: str = "n_name") -> DataFrame:
    return rows_of(labels(spark, sf_dir, l1), limits)


#: The same episodes in SQL, with every derived column, for engines without this library.
SQL = """
WITH base AS (
  SELECT l_orderkey * 8 + l_linenumber AS ord, concat('ep_', l_orderkey, '_', l_linenumber) AS stem,
    CASE WHEN l_discount <> 0 THEN CAST(round(l_quantity * 60) AS BIGINT) * 1000000 END AS video_us,
    CASE WHEN l_tax <> 0 THEN CAST(round(l_quantity * 60) AS BIGINT) * 1000000 + CASE WHEN l_tax = 8e-2 THEN 90000000 ELSE 0 END END AS meta_us,
    p_brand AS task_id, s_name AS operator_id, n_name AS environment_id, n_name AS environment_l1, r_name, c_mktsegment AS environment_l2, p_type AS environment_l3,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'hard' WHEN '2-HIGH' THEN 'medium' WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'easy' END AS difficulty,
    CASE WHEN lower(p_type) IN ('small', 'medium', 'large') THEN lower(p_type) END AS business_size,
    CASE WHEN l_returnflag = 'R' THEN 'contractor' ELSE 'real' END AS worker_type,
    CASE WHEN l_tax <> 5e-2 THEN l_linestatus = 'O' END AS human_interaction
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
), ep AS (
  SELECT *, CAST(coalesce(video_us, meta_us, 0) AS BIGINT) AS us,
    CASE WHEN video_us IS NOT NULL AND meta_us IS NOT NULL THEN 'both' WHEN video_us IS NOT NULL THEN 'video' WHEN meta_us IS NOT NULL THEN 'metadata' ELSE 'none' END AS duration_source,
    coalesce(abs(video_us - meta_us) > 1000000 AND CAST(abs(video_us - meta_us) AS DOUBLE) / meta_us > 2e-2, FALSE) AS duration_mismatch,
    CAST(round(CAST(printf('%.4f', coalesce(video_us, meta_us, 0) / 3600e6) AS DOUBLE) * 10000) AS BIGINT) AS units
  FROM base
)
"""

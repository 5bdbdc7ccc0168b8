"""The engine's registered queries over the star-schema tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ENVIRONMENT_NAMES, HOUR_US, Limits
from ..functions import canon
from ..functions.flatten import flatten
from ..operators import checks, composition, coverage
from ..operators import rows as rows_op
from ..profiles import PROFILES
from ..sources import pairing
from . import bridge

L = Limits()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = bridge.SQL + sql
        return f

    return add


def _groups(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    return checks.group(bridge.rows(spark, sf_dir), checks.GRAINS[grain])


LEVEL = "CASE WHEN max(CASE difficulty WHEN 'easy' THEN 1 WHEN 'medium' THEN 2 WHEN 'hard' THEN 3 END) = 3 THEN 'hard' WHEN max(CASE difficulty WHEN 'easy' THEN 1 WHEN 'medium' THEN 2 WHEN 'hard' THEN 3 END) = 2 THEN 'medium' WHEN max(CASE difficulty WHEN 'easy' THEN 1 WHEN 'medium' THEN 2 WHEN 'hard' THEN 3 END) = 1 THEN 'easy' END"
SUM_US = "CAST(sum(us) AS BIGINT)"


def _cap_sql(level: str, caps: dict[str, float]) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN CAST({round(v * HOUR_US)} AS BIGINT)" for k, v in caps.items()) + " END"


# ---- the nine checks

C1 = """, g AS (SELECT environment_l1, CAST(sum(us) AS BIGINT) AS us, min(ord) AS first_ord FROM ep WHERE environment_l1 IS NOT NULL GROUP BY 1),
r AS (SELECT *, 100e0 * us / CAST(sum(us) OVER () AS BIGINT) AS pct, row_number() OVER (ORDER BY us DESC, first_ord, environment_l1) AS rank FROM g)"""


@query(C1 + "SELECT environment_l1, us, pct, CAST(rank AS INT) AS rank, CAST(printf('%.2f', pct) AS DOUBLE) > 20e0 AS over_cap FROM r")
def c1_env_l1_distribution(spark, sf_dir):
    return checks.env_l1(_groups(spark, sf_dir, "c1")).select("environment_l1", "us", "pct", "rank", "over_cap")


C1V = """, v AS (SELECT count(*) AS distinct_labels, count(*) FILTER (WHERE CAST(printf('%.2f', pct) AS DOUBLE) > 20e0) AS offenders, CAST(sum(us) AS BIGINT) AS total_us,
  CAST(sum(us) FILTER (WHERE rank <= 5) AS BIGINT) AS top5_us, CAST(sum(us) FILTER (WHERE rank <= 10) AS BIGINT) AS top10_us FROM r)
SELECT *, 100e0 * top5_us / total_us AS top5_pct, 100e0 * top10_us / total_us AS top10_pct,
  CASE WHEN offenders > 0 OR 100e0 * top5_us / total_us > 60 OR 100e0 * top10_us / total_us > 85 OR distinct_labels < 15 THEN 'FAIL' ELSE 'PASS' END AS status FROM v"""


@query(C1 + C1V)
def c1_env_l1_verdict(spark, sf_dir):
    return checks.env_l1_verdict(_groups(spark, sf_dir, "c1"))


@query(C1.replace("environment_l1", "r_name") + C1V)
def c1_five_categories(spark, sf_dir):
    """The same check where the label has five values only: it fails on the distinct count."""
    return checks.env_l1_verdict(checks.group(bridge.rows(spark, sf_dir, l1="r_name"), checks.GRAINS["c1"]))


TOTALS = """, t AS (SELECT count(*) AS episodes, CAST(sum(us) AS BIGINT) AS total_us,
  CAST(coalesce(sum(us) FILTER (WHERE difficulty = 'easy'), 0) AS BIGINT) AS easy_us, CAST(coalesce(sum(us) FILTER (WHERE difficulty = 'medium'), 0) AS BIGINT) AS medium_us,
  CAST(coalesce(sum(us) FILTER (WHERE difficulty = 'hard'), 0) AS BIGINT) AS hard_us, CAST(coalesce(sum(us) FILTER (WHERE difficulty IS NULL), 0) AS BIGINT) AS unknown_us,
  CAST(coalesce(sum(us) FILTER (WHERE worker_type = 'real'), 0) AS BIGINT) AS real_us, CAST(coalesce(sum(us) FILTER (WHERE worker_type = 'contractor'), 0) AS BIGINT) AS contractor_us,
  count(worker_type) AS with_worker, count(business_size) AS with_size, count(human_interaction) AS with_interaction, count(*) FILTER (WHERE human_interaction) AS interactive,
  count(*) FILTER (WHERE duration_mismatch) AS mismatches FROM ep)"""


@query(TOTALS + """SELECT easy_us, medium_us, hard_us, unknown_us, easy_us + medium_us + hard_us AS known_us, 100e0 * easy_us / (easy_us + medium_us + hard_us) AS easy_pct,
  100e0 * medium_us / (easy_us + medium_us + hard_us) AS medium_pct, 100e0 * hard_us / (easy_us + medium_us + hard_us) AS hard_pct,
  CASE WHEN 100e0 * easy_us / (easy_us + medium_us + hard_us) > 30 OR 100e0 * hard_us / (easy_us + medium_us + hard_us) < 5 THEN 'FAIL' WHEN unknown_us > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM t""")
def c2_difficulty_mix(spark, sf_dir):
    return checks.difficulty_mix(checks.totals(bridge.rows(spark, sf_dir)))


@query(f""", g AS (SELECT task_id, {SUM_US} AS us, {LEVEL} AS difficulty, count(DISTINCT difficulty) > 1 AS conflict FROM ep WHERE task_id IS NOT NULL GROUP BY 1),
s AS (SELECT g.*, 100e0 * g.us / (SELECT CAST(sum(us) AS BIGINT) FROM ep) AS pct, CASE difficulty WHEN 'hard' THEN 6e0 WHEN 'medium' THEN 4e0 WHEN 'easy' THEN 1.5e0 END AS share_cap_pct FROM g)
SELECT task_id, us, difficulty, conflict, pct, share_cap_pct, us > 720000000000 AS over_hours, coalesce(pct > share_cap_pct, FALSE) AS over_share, us > 720000000000 OR coalesce(pct > share_cap_pct, FALSE) AS over_cap FROM s""")
def c3_task_share(spark, sf_dir):
    rows = bridge.rows(spark, sf_dir)
    d = checks.task_share(checks.group(rows, checks.GRAINS["c3"]), rows.agg(F.sum("duration_us").alias("total_us")))
    return d.select("task_id", "us", "difficulty", "conflict", "pct", "share_cap_pct", "over_hours", "over_share", "over_cap")


def _c4_sql(factory_h: float, l1: str = "environment_l1") -> str:
    return f""", g AS (SELECT task_id, environment_id, {SUM_US} AS us, {LEVEL} AS level, count(DISTINCT difficulty) > 1 AS mixed,
  bool_or(regexp_matches(lower({l1}), 'factory|manufactur|industrial')) AS factory FROM ep WHERE task_id IS NOT NULL AND environment_id IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN factory THEN CAST({round(factory_h * HOUR_US)} AS BIGINT) ELSE {_cap_sql('level', L.task_env_max_h)} END AS cap_us FROM g)
SELECT task_id, environment_id, us, CASE WHEN factory THEN 'factory' ELSE level END AS difficulty, NOT factory AND mixed AS conflict, factory, cap_us, coalesce(us > cap_us, FALSE) AS over_cap FROM s"""


def _c4(d: DataFrame) -> DataFrame:
    return d.select("task_id", "environment_id", "us", "difficulty", "conflict", "factory", "cap_us", "over_cap")


@query(_c4_sql(L.factory_h))
def c4_task_env(spark, sf_dir):
    return _c4(checks.task_env(_groups(spark, sf_dir, "c4")))


def _plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge with some sites named as plants."""
    names = bridge.labels(spark, sf_dir).withColumn("environment_l1", F.when(F.col("environment_id").isin("NATION_1", "NATION_2"), F.concat(F.lit("Light INDUSTRIAL "), "environment_id")).otherwise(F.col("environment_id")))
    return rows_op.rows_of(names)


PLANT_L1 = "CASE WHEN environment_id IN ('NATION_1', 'NATION_2') THEN concat('Light INDUSTRIAL ', environment_id) ELSE environment_id END"


@query(_c4_sql(L.factory_dynamic_h, PLANT_L1))
def c4_task_env_dynamic(spark, sf_dir):
    return _c4(checks.task_env(checks.group(_plants(spark, sf_dir), checks.GRAINS["c4"]), dynamic=True))


@query(f""", g AS (SELECT operator_id, task_id, environment_id, {SUM_US} AS us, {LEVEL} AS difficulty, count(DISTINCT difficulty) > 1 AS conflict FROM ep
  WHERE operator_id IS NOT NULL AND task_id IS NOT NULL AND environment_id IS NOT NULL GROUP BY 1, 2, 3)
SELECT *, {_cap_sql('difficulty', L.op_task_env_max_h)} AS cap_us, coalesce(us > {_cap_sql('difficulty', L.op_task_env_max_h)}, FALSE) AS over_cap FROM g""")
def c5_op_task_env(spark, sf_dir):
    return checks.op_task_env(_groups(spark, sf_dir, "c5")).select("operator_id", "task_id", "environment_id", "us", "difficulty", "conflict", "cap_us", "over_cap")


@query(f"SELECT environment_id, operator_id, {SUM_US} AS us, CAST({40 * HOUR_US} AS BIGINT) AS cap_us, sum(us) > {40 * HOUR_US} AS over_cap FROM ep WHERE environment_id IS NOT NULL AND operator_id IS NOT NULL GROUP BY 1, 2")
def c6_env_op(spark, sf_dir):
    return checks.env_op(_groups(spark, sf_dir, "c6")).select("environment_id", "operator_id", "us", "cap_us", "over_cap")


@query(f""", g AS (SELECT environment_id, business_size, {SUM_US} AS us FROM ep WHERE environment_id IS NOT NULL AND business_size IS NOT NULL GROUP BY 1, 2)
SELECT *, {_cap_sql('business_size', L.business_max_h)} AS cap_us, us > {_cap_sql('business_size', L.business_max_h)} AS over_cap FROM g""")
def c7_business_size(spark, sf_dir):
    return checks.business(_groups(spark, sf_dir, "c7")).select("environment_id", "business_size", "us", "cap_us", "over_cap")


@query(TOTALS + """SELECT with_worker, real_us, contractor_us, real_us + contractor_us AS joint_us, 100e0 * real_us / (real_us + contractor_us) AS real_pct, 100e0 * contractor_us / (real_us + contractor_us) AS contractor_pct,
  CASE WHEN 100e0 * real_us / (real_us + contractor_us) < 70 OR 100e0 * contractor_us / (real_us + contractor_us) > 30 THEN 'FAIL' ELSE 'PASS' END AS status FROM t""")
def c8_workforce(spark, sf_dir):
    return checks.workforce(checks.totals(bridge.rows(spark, sf_dir)))


@query(TOTALS + "SELECT episodes, with_interaction, interactive, 100e0 * interactive / episodes AS pct, CASE WHEN 100e0 * interactive / episodes >= 5 THEN 'PASS' ELSE 'WARN' END AS status FROM t")
def c9_interaction(spark, sf_dir):
    return checks.interaction(checks.totals(bridge.rows(spark, sf_dir)))


@query(TOTALS + "SELECT * FROM t")
def summary(spark, sf_dir):
    return checks.totals(bridge.rows(spark, sf_dir))


@query(f""", g AS (SELECT environment_l1, task_id, operator_id, environment_id, business_size, grouping(environment_l1, task_id, operator_id, environment_id, business_size) AS gid, {SUM_US} AS us, count(*) AS episodes
  FROM ep GROUP BY GROUPING SETS ((environment_l1), (task_id), (task_id, environment_id), (operator_id, task_id, environment_id), (environment_id, operator_id), (environment_id, business_size)))
SELECT CASE gid WHEN 15 THEN 'c1' WHEN 23 THEN 'c3' WHEN 21 THEN 'c4' WHEN 17 THEN 'c5' WHEN 25 THEN 'c6' WHEN 28 THEN 'c7' END AS grain, count(*) AS groups, CAST(sum(us) AS BIGINT) AS us, max(us) AS max_us, CAST(sum(episodes) AS BIGINT) AS episodes
FROM g WHERE NOT (gid = 28 AND business_size IS NULL) GROUP BY 1""")
def multi_grain(spark, sf_dir):
    """Every grouping of the checks in one pass, rolled up by grain."""
    d = checks.all_grains(bridge.rows(spark, sf_dir)).where("grain <> 'mix'")
    return d.groupBy("grain").agg(F.count(F.lit(1)).alias("groups"), F.sum("us").alias("us"), F.max("us").alias("max_us"), F.sum("episodes").alias("episodes"))


@query(C1 + f""", v AS (SELECT count(*) AS d, count(*) FILTER (WHERE CAST(printf('%.2f', pct) AS DOUBLE) > 20e0) AS o, 100e0 * CAST(sum(us) FILTER (WHERE rank <= 5) AS BIGINT) / CAST(sum(us) AS BIGINT) AS p5, 100e0 * CAST(sum(us) FILTER (WHERE rank <= 10) AS BIGINT) / CAST(sum(us) AS BIGINT) AS p10 FROM r)""" + TOTALS + f""",
g3 AS (SELECT {SUM_US} AS us, {LEVEL} AS level, count(DISTINCT difficulty) > 1 AS mixed FROM ep GROUP BY task_id),
g4 AS (SELECT {SUM_US} AS us, {LEVEL} AS level, count(DISTINCT difficulty) > 1 AS mixed, bool_or(regexp_matches(lower(environment_l1), 'factory|manufactur|industrial')) AS plant FROM ep GROUP BY task_id, environment_id),
g5 AS (SELECT {SUM_US} AS us, {LEVEL} AS level, count(DISTINCT difficulty) > 1 AS mixed FROM ep GROUP BY operator_id, task_id, environment_id),
g6 AS (SELECT {SUM_US} AS us FROM ep GROUP BY environment_id, operator_id), g7 AS (SELECT {SUM_US} AS us, business_size FROM ep WHERE business_size IS NOT NULL GROUP BY environment_id, business_size),
c AS (SELECT 'c3' AS "check", count(*) AS groups, count(*) FILTER (WHERE us > 720000000000 OR 100e0 * us / (SELECT total_us FROM t) > CASE level WHEN 'hard' THEN 6e0 WHEN 'medium' THEN 4e0 WHEN 'easy' THEN 1.5e0 END) AS offenders, count(*) FILTER (WHERE mixed) AS conflicts FROM g3
  UNION ALL SELECT 'c4', count(*), count(*) FILTER (WHERE us > CASE WHEN plant THEN {HOUR_US} ELSE {_cap_sql('level', L.task_env_max_h)} END), count(*) FILTER (WHERE mixed AND NOT plant) FROM g4
  UNION ALL SELECT 'c5', count(*), count(*) FILTER (WHERE us > {_cap_sql('level', L.op_task_env_max_h)}), count(*) FILTER (WHERE mixed) FROM g5
  UNION ALL SELECT 'c6', count(*), count(*) FILTER (WHERE us > {40 * HOUR_US}), 0 FROM g6
  UNION ALL SELECT 'c7', count(*), count(*) FILTER (WHERE us > {_cap_sql('business_size', L.business_max_h)}), 0 FROM g7)
SELECT "check", CASE WHEN offenders > 0 THEN 'FAIL' ELSE 'PASS' END AS status, groups, offenders, conflicts FROM c
UNION ALL SELECT 'c1', CASE WHEN o > 0 OR p5 > 60 OR p10 > 85 OR d < 15 THEN 'FAIL' ELSE 'PASS' END, d, o, 0 FROM v
UNION ALL SELECT 'c2', CASE WHEN 100e0 * easy_us / (easy_us + medium_us + hard_us) > 30 OR 100e0 * hard_us / (easy_us + medium_us + hard_us) < 5 THEN 'FAIL' WHEN unknown_us > 0 THEN 'WARN' ELSE 'PASS' END, 0, 0, 0 FROM t
UNION ALL SELECT 'c8', CASE WHEN 100e0 * real_us / (real_us + contractor_us) < 70 OR 100e0 * contractor_us / (real_us + contractor_us) > 30 THEN 'FAIL' ELSE 'PASS' END, 0, 0, 0 FROM t
UNION ALL SELECT 'c9', CASE WHEN 100e0 * interactive / episodes >= 5 THEN 'PASS' ELSE 'WARN' END, 0, 0, 0 FROM t""")
def nine_checks(spark, sf_dir):
    """The verdict of every check, with its groups, offenders and groups of mixed difficulty."""
    return checks.verdicts(bridge.rows(spark, sf_dir))


NINE_SQL = ORACLE_SQL["nine_checks"].removeprefix(bridge.SQL)


def status_counts(spark, sf_dir):
    """How many checks have each status."""
    return checks.status_counts(checks.verdicts(bridge.rows(spark, sf_dir)))


QUERIES["status_counts"] = status_counts
_AT = NINE_SQL.rindex('SELECT "check", CASE')
ORACLE_SQL["status_counts"] = bridge.SQL + NINE_SQL[:_AT] + f""", nine AS ({NINE_SQL[_AT:]})
SELECT s AS status, (SELECT count(*) FROM nine WHERE status = s) AS checks FROM (VALUES ('PASS'), ('FAIL'), ('WARN'), ('NOT_COMPUTABLE')) AS x(s)"""


def unlabelled(spark, sf_dir):
    """Episodes without a label or a duration: every check says that it cannot be computed."""
    d = bridge.labels(spark, sf_dir)
    bare = d.select(*(F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("ord", "stem") else F.col(f.name) for f in d.schema))
    return checks.verdicts(rows_op.rows_of(bare))


QUERIES["unlabelled"] = unlabelled
ORACLE_SQL["unlabelled"] = """SELECT "check", 'NOT_COMPUTABLE' AS status, CAST(0 AS BIGINT) AS groups, CAST(0 AS BIGINT) AS offenders, CAST(0 AS BIGINT) AS conflicts
FROM (VALUES ('c1'), ('c2'), ('c3'), ('c4'), ('c5'), ('c6'), ('c7'), ('c8'), ('c9')) AS x("check") WHERE (SELECT count(*) FROM lineitem) > 0"""


@query(C1 + """SELECT environment_l1 AS label, us, pct FROM r WHERE CAST(printf('%.2f', pct) AS DOUBLE) > 4e0""")
def c1_offenders(spark, sf_dir):
    """Labels over a limit of four per cent."""
    d = checks.env_l1(_groups(spark, sf_dir, "c1"), Limits(l1_single_pct=4.0))
    return d.where("over_cap").select(F.col("environment_l1").alias("label"), "us", "pct")


# ---- durations

@query("SELECT duration_source, count(*) AS episodes, CAST(sum(us) AS BIGINT) AS us FROM ep GROUP BY 1")
def duration_sources(spark, sf_dir):
    return checks.duration_sources(bridge.rows(spark, sf_dir))


@query("SELECT stem, us AS duration_us, duration_source, duration_mismatch, units FROM ep")
def durations_resolved(spark, sf_dir):
    return bridge.rows(spark, sf_dir).select("stem", "duration_us", "duration_source", "duration_mismatch", F.rint(F.col("hours_4dp") * 10000).cast("bigint").alias("units"))


@query("""SELECT stem, video_us, meta_us, concat('duration mismatch: video=', printf('%.1f', video_us / 1e6), 's vs metadata=', printf('%.1f', meta_us / 1e6), 's (kept video)') AS warning FROM ep WHERE duration_mismatch""")
def duration_mismatches(spark, sf_dir):
    return bridge.rows(spark, sf_dir).where("duration_mismatch").select("stem", "video_us", "meta_us", F.col("row_warnings")[0].alias("warning"))


# ---- composition

def _by(key: str) -> None:
    def f(spark, sf_dir):
        return composition.hours_by(bridge.rows(spark, sf_dir), key)

    f.__name__ = "hours_by_" + {"environment_l1": "l1", "environment_l2": "l2", "environment_l3": "l3", "environment_id": "env", "task_id": "task", "operator_id": "operator"}[key]
    query(f"SELECT {key} AS label, CAST(sum(units) AS BIGINT) AS units, min(ord) AS first_ord FROM ep WHERE {key} IS NOT NULL GROUP BY 1")(f)


for _key in ("environment_l1", "environment_l2", "environment_l3", "environment_id", "task_id", "operator_id"):
    _by(_key)


def _ratio_sql(key: str, values: list[str]) -> str:
    table = " UNION ALL ".join(f"SELECT '{v}' AS label, {i} AS place" for i, v in enumerate(values))
    return f""", g AS (SELECT {key} AS label, sum(units) AS units FROM ep WHERE {key} IS NOT NULL GROUP BY 1), v AS ({table}),
s AS (SELECT label, place, CAST(coalesce(units, 0) AS BIGINT) AS units FROM v LEFT JOIN g USING (label)) SELECT *, 100e0 * units / CAST(sum(units) OVER () AS BIGINT) AS pct FROM s"""


@query(_ratio_sql("difficulty", ["hard", "medium", "easy"]))
def difficulty_ratio(spark, sf_dir):
    return composition.difficulty_ratio(bridge.rows(spark, sf_dir))


@query(_ratio_sql("worker_type", ["real", "contractor"]))
def workforce_ratio(spark, sf_dir):
    return composition.workforce_ratio(bridge.rows(spark, sf_dir))


@query("""SELECT count(*) AS episodes, min(units) * 60e0 / 10000e0 AS min_minutes, max(units) * 60e0 / 10000e0 AS max_minutes, CAST(sum(units) AS BIGINT) * 60e0 / 10000e0 / count(*) AS mean_minutes FROM ep WHERE units > 0""")
def length_stats(spark, sf_dir):
    return composition.length_stats(bridge.rows(spark, sf_dir))


@query(""", b AS (SELECT min(units) AS lo, CASE WHEN max(units) = min(units) THEN min(units) + 1 ELSE max(units) END AS hi FROM ep WHERE units > 0),
c AS (SELECT least((units - lo) * 12 // (hi - lo), 11) AS bin, count(*) AS episodes FROM ep, b WHERE units > 0 GROUP BY 1)
SELECT CAST(k AS INT) AS bin, lo * 12 + k * (hi - lo) AS from_units_x_bins, coalesce(episodes, 0) AS episodes FROM b, range(12) AS r(k) LEFT JOIN c ON c.bin = k""")
def length_histogram(spark, sf_dir):
    return composition.length_histogram(bridge.rows(spark, sf_dir))


CODES = list(ENVIRONMENT_NAMES)


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge with environment ids from the vocabulary, and some beyond it: by the length and first letter of
    the site's name, so that some ids are shared and some are never used."""
    code = F.element_at(F.array(*(F.lit(c) for c in CODES)), ((F.length("environment_id") * 3 + F.ascii(F.substring("environment_id", 1, 1))) % 19 + 1).cast("int"))
    names = bridge.labels(spark, sf_dir).withColumn("environment_id", F.when(F.length("environment_id") % 9 == 0, F.concat(F.lit("X"), F.substring("environment_id", 1, 2))).otherwise(code))
    return rows_op.rows_of(names)


_CODED_SQL = f""", co AS (SELECT units, us, CASE WHEN length(environment_id) % 9 = 0 THEN concat('X', substring(environment_id, 1, 2)) ELSE list_extract([{", ".join(f"'{c}'" for c in CODES)}], (length(environment_id) * 3 + ascii(substring(environment_id, 1, 1))) % 19 + 1) END AS code FROM ep),
voc AS ({" UNION ALL ".join(f"SELECT '{c}' AS code, '{n}' AS name, {i} AS place" for i, (c, n) in enumerate(ENVIRONMENT_NAMES.items()))}), used AS (SELECT code, CAST(sum(units) AS BIGINT) AS units FROM co GROUP BY 1)"""


@query(_CODED_SQL + """SELECT coalesce(voc.code, used.code) AS code, name, coalesce(place, 19) AS place, coalesce(units, 0) AS units, coalesce(units, 0) > 0 AS captured, 100e0 * coalesce(units, 0) / (SELECT CAST(sum(units) AS BIGINT) FROM co) AS pct FROM voc FULL JOIN used ON voc.code = used.code""")
def env_reference(spark, sf_dir):
    return composition.env_reference(_coded(spark, sf_dir))


@query(_CODED_SQL + "SELECT code FROM used WHERE code NOT IN (SELECT code FROM voc)")
def unknown_envs(spark, sf_dir):
    return composition.unknown_environments(_coded(spark, sf_dir))


@query(_CODED_SQL + "SELECT count(*) AS covered, 19 AS \"of\" FROM voc WHERE code IN (SELECT code FROM used)")
def env_coverage(spark, sf_dir):
    return composition.coverage(_coded(spark, sf_dir))


# ---- normalisation

def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw spellings of the bridge's labels."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    n = F.col("o_orderkey") % 4
    pick = lambda *v: F.element_at(F.array(*(F.lit(x) for x in v)), (n + 1).cast("int"))
    return o.select("o_orderkey", pick("E", " Med. ", "dif-ficult", "unsure").alias("d"), pick("S m", "Medium-Sized Business", "BIG", "").alias("b"), pick("real_worker", "Contract-Worker", "External", "robot").alias("w"), pick("YES", "n", "0", "maybe").alias("h"))


_SPELLED_SQL = "SELECT o_orderkey, {} FROM orders".format(", ".join(f"CASE o_orderkey % 4 WHEN 0 THEN {a} WHEN 1 THEN {b} WHEN 2 THEN {c} END AS {k}" for k, a, b, c in (("difficulty", "'easy'", "'medium'", "'hard'"), ("business_size", "'small'", "'medium'", "'large'"), ("worker_type", "'real'", "'contractor'", "'contractor'"), ("human_interaction", "TRUE", "FALSE", "FALSE"))))


def normalize_labels(spark, sf_dir):
    d = _spelled(spark, sf_dir)
    return d.select("o_orderkey", canon.difficulty(F.col("d")).alias("difficulty"), canon.business_size(F.col("b")).alias("business_size"), canon.worker_type(F.col("w")).alias("worker_type"), canon.flag(F.col("h")).alias("human_interaction"))


QUERIES["normalize_labels"], ORACLE_SQL["normalize_labels"] = normalize_labels, _SPELLED_SQL


def resolve_sidecar(spark, sf_dir):
    """Sidecars written as nested JSON with mixed spellings, resolved back to the orders' own columns."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    doc = F.to_json(F.struct(
        F.struct(F.col("o_orderkey").alias("Task-ID")).alias("task info"), F.col("o_custkey").alias("OPERATOR_ID"), F.struct(F.struct(F.col("o_orderstatus").alias("id")).alias("environment")).alias("site"),
        F.col("o_orderpriority").alias("venue"), F.lit("").alias("difficulty"), F.element_at(F.array(F.lit("easy"), F.lit("2"), F.lit("HARD")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("task_difficulty"),
        F.struct(F.col("o_orderkey").alias("start time unix")).alias("clock"), (F.col("o_orderkey") + 90).alias("end.time.unix")))
    episodes = o.select(F.col("o_orderkey").alias("ord"), F.col("o_orderkey").cast("string").alias("stem"), F.lit(None).cast("bigint").alias("video_us"), doc.alias("meta_json"), F.lit(None).cast("array<string>").alias("ingest_warnings"))
    d = rows_op.resolve_labels(episodes, PROFILES["generic"])
    return d.select("stem", "task_id", "operator_id", "environment_l2", "difficulty", "meta_us")


QUERIES["resolve_sidecar"] = resolve_sidecar
ORACLE_SQL["resolve_sidecar"] = """SELECT CAST(o_orderkey AS VARCHAR) AS stem, CAST(o_orderkey AS VARCHAR) AS task_id, CAST(o_custkey AS VARCHAR) AS operator_id, o_orderpriority AS environment_l2,
  CASE o_orderkey % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END AS difficulty, CAST(90000000 AS BIGINT) AS meta_us FROM orders"""


def flatten_leaves(spark, sf_dir):
    """Leaves of each event's JSON properties."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", F.explode(flatten(F.col("props"), PROFILES["generic"]).leaves).alias("x")).select("event_id", "x.path", "x.raw", "x.empty")


QUERIES["flatten_leaves"] = flatten_leaves
ORACLE_SQL["flatten_leaves"] = "SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS raw, FALSE AS empty FROM events"


def natural_order(spark, sf_dir):
    """Suppliers by the natural order of unpadded names."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.concat(F.when(F.col("s_suppkey") % 2 == 0, "Clip").otherwise("clip"), "s_suppkey", F.lit("_x")).alias("stem"))
    return composition.placed(s, canon.natural_key(F.col("stem")), F.col("stem"))


QUERIES["natural_order"] = natural_order
ORACLE_SQL["natural_order"] = "SELECT s_suppkey, concat(CASE WHEN s_suppkey % 2 = 0 THEN 'Clip' ELSE 'clip' END, s_suppkey, '_x') AS stem, CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS place FROM supplier"


def pair_local(spark, sf_dir):
    """Files of a directory tree made from orders, paired by directory and stem; some lack one side, some collide."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    at = F.concat(F.lit("/in/d"), F.col("o_orderkey") % 7, F.lit("/ep"), F.col("o_orderkey"))
    n = F.col("o_orderkey")
    files = o.where(n % 3 != 0).select(F.concat(at, F.lit(".mp4")).alias("path")).union(o.where(n % 4 == 0).select(F.concat(at, F.lit(".MOV")))).union(o.where(n % 5 != 0).select(F.concat(at, F.lit(".Meta.JSON")))).union(o.select(F.concat(at, F.lit(".txt"))))
    return pairing.local(files).select("stem", "video_path", "meta_path", F.size("ingest_warnings").alias("n_warnings"))


QUERIES["pair_local"] = pair_local
ORACLE_SQL["pair_local"] = """SELECT concat('ep', o_orderkey) AS stem, CASE WHEN k % 4 = 0 THEN concat(p, '.MOV') WHEN k % 3 <> 0 THEN concat(p, '.mp4') END AS video_path, CASE WHEN k % 5 <> 0 THEN concat(p, '.Meta.JSON') END AS meta_path,
  CAST((CASE WHEN k % 4 = 0 AND k % 3 <> 0 THEN 1 ELSE 0 END) + (CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) + (CASE WHEN k % 3 = 0 AND k % 4 <> 0 THEN 1 ELSE 0 END) AS INT) AS n_warnings
FROM (SELECT o_orderkey, o_orderkey AS k, concat('/in/d', o_orderkey % 7, '/ep', o_orderkey) AS p FROM orders) WHERE k % 3 <> 0 OR k % 4 = 0 OR k % 5 <> 0"""


def pair_folders(spark, sf_dir):
    """Objects made from orders, grouped by their first segment below a prefix."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    n, at = F.col("o_orderkey"), F.concat(F.lit("in/u"), F.col("o_orderkey"), F.lit("/"))
    keys = o.where(n % 3 != 0).select(F.concat(at, F.lit("x/v.mov")).alias("key")).union(o.where(n % 5 != 0).select(F.concat(at, F.lit("metadata.json")))).union(o.select(F.concat(at, F.lit("hands_metadata.json")))).union(o.select(F.concat(F.lit("in/stray"), n, F.lit(".mp4"))))
    return pairing.folders(keys, "in").select("stem", "video_path", "meta_path", "directory", F.size("ingest_warnings").alias("n_warnings"))


QUERIES["pair_folders"] = pair_folders
ORACLE_SQL["pair_folders"] = """SELECT concat('u', o_orderkey) AS stem, CASE WHEN o_orderkey % 3 <> 0 THEN concat('in/u', o_orderkey, '/x/v.mov') END AS video_path, CASE WHEN o_orderkey % 5 <> 0 THEN concat('in/u', o_orderkey, '/metadata.json') END AS meta_path,
  concat('in/u', o_orderkey, '/') AS directory, CAST((CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) AS INT) AS n_warnings FROM orders"""


def chunk_sidecars(spark, sf_dir):
    """Arrays of chunk records, unwrapped by their profile: payload, bare record, and what is no object."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    n = F.col("o_orderkey")
    doc = F.when(n % 4 == 0, F.concat(F.lit('[{"data":{"metadata":{"environment_label":"l'), n, F.lit('"}}}]'))).when(n % 4 == 1, F.concat(F.lit('[{"metadata":{"environment":{"label":"l'), n, F.lit('"}}},{}]'))).when(n % 4 == 2, F.concat(F.lit('{"environment-label":"l'), n, F.lit('"}'))).otherwise("[]")
    episodes = o.select(n.alias("ord"), n.cast("string").alias("stem"), F.lit(None).cast("bigint").alias("video_us"), doc.alias("meta_json"), F.lit(None).cast("array<string>").alias("ingest_warnings"))
    return rows_op.resolve_labels(episodes, PROFILES["chunk-array-v1"]).select("stem", "environment_l1", F.get("ingest_warnings", F.lit(0)).alias("error"))


QUERIES["chunk_sidecars"] = chunk_sidecars
ORACLE_SQL["chunk_sidecars"] = "SELECT CAST(o_orderkey AS VARCHAR) AS stem, CASE WHEN o_orderkey % 4 <> 3 THEN concat('l', o_orderkey) END AS environment_l1, CASE WHEN o_orderkey % 4 = 3 THEN 'metadata top level is list, expected object' END AS error FROM orders"


def flatten_nested(spark, sf_dir):
    """Nested, empty and repeated keys: leaves in document order."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    doc = F.concat(F.lit('{"a":{"b":{"c":'), "o_orderkey", F.lit('},"d":{}},"e":[],"a.b":null,"f":true,"f":1.50}'))
    x = F.posexplode(flatten(doc, PROFILES["generic"]).leaves).alias("place", "x")
    return o.select("o_orderkey", x).select("o_orderkey", "place", "x.path", "x.raw", "x.empty")


QUERIES["flatten_nested"] = flatten_nested
ORACLE_SQL["flatten_nested"] = """SELECT o_orderkey, place, path, CASE WHEN place = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE raw END AS raw, empty FROM orders, (VALUES (0, 'a.b.c', NULL, FALSE), (1, 'a.d', '{}', TRUE), (2, 'e', '[]', TRUE), (3, 'a.b', NULL, TRUE), (4, 'f', '1.5', FALSE)) AS x(place, path, raw, empty)"""


def pair_full_outer(spark, sf_dir):
    """Videos and sidecars of a listing made from orders, paired by stem; some lack one side."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    video = o.where("o_orderkey % 3 <> 0").select(F.concat(F.lit("videos/"), "o_orderkey", F.lit(".mp4")).alias("key"))
    meta = o.where("o_orderkey % 5 <> 0").select(F.concat(F.lit("metadata/"), "o_orderkey", F.lit(".json")).alias("key"))
    d = pairing.paired(video.union(meta))
    return d.select("stem", "video_path", "meta_path", F.size("ingest_warnings").alias("n_warnings"))


QUERIES["pair_full_outer"] = pair_full_outer
ORACLE_SQL["pair_full_outer"] = """SELECT CAST(o_orderkey AS VARCHAR) AS stem, CASE WHEN o_orderkey % 3 <> 0 THEN concat('videos/', o_orderkey, '.mp4') END AS video_path,
  CASE WHEN o_orderkey % 5 <> 0 THEN concat('metadata/', o_orderkey, '.json') END AS meta_path, CAST(CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INT) AS n_warnings FROM orders WHERE o_orderkey % 15 <> 0"""


def enrich_labels(spark, sf_dir):
    """A side table adds a worker type where an episode has none."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = o.select(F.col("o_orderkey").cast("string").alias("stem"), F.when(F.col("o_orderkey") % 2 == 0, "real").alias("worker_type"), F.lit(None).cast("string").alias("business_size"))
    side = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("string").alias("stem"), F.lit("contractor").alias("worker_type"), F.lit("small").alias("business_size"))
    return rows_op.enrich(rows, side)


QUERIES["enrich_labels"] = enrich_labels
ORACLE_SQL["enrich_labels"] = """SELECT CAST(o_orderkey AS VARCHAR) AS stem, CASE WHEN o_orderkey % 2 = 0 THEN 'real' WHEN o_orderkey % 3 = 0 THEN 'contractor' END AS worker_type, CASE WHEN o_orderkey % 3 = 0 THEN 'small' END AS business_size FROM orders"""


def _sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    doc = F.to_json(F.struct(
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).alias("session-uuid"), F.struct(F.col("o_orderstatus").alias("City")).alias("place"), F.lit("").alias("country"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("g1")).alias("Glove-Device-ID"), F.lit("pick it up").alias("instruction")))
    return o.select("o_orderkey", doc.alias("meta_json"))


def field_coverage(spark, sf_dir):
    return coverage.field_coverage(_sidecars(spark, sf_dir))


QUERIES["field_coverage"] = field_coverage
_FIELDS = " UNION ALL ".join(f"SELECT '{t}' AS tier, '{s}' AS section, '{f}' AS field" for t, ss in coverage.REGISTRY.items() for s, fs in ss.items() for f in fs)
ORACLE_SQL["field_coverage"] = f"""WITH f AS ({_FIELDS}), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS uuids, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS gloves FROM orders)
SELECT tier, section, field, CASE tier WHEN 'glove' THEN gloves WHEN 'handheld' THEN 0 ELSE n END AS asked,
  CASE field WHEN 'episode_uuid' THEN uuids WHEN 'city' THEN n WHEN 'task_description' THEN n WHEN 'glove_device_id' THEN gloves ELSE 0 END AS present FROM f, n"""


def episode_ids(spark, sf_dir):
    d = _sidecars(spark, sf_dir).withColumn("f", flatten(F.col("meta_json"), PROFILES["generic"]))
    return d.select("o_orderkey", coverage.episode_id(F.col("f.leaves"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.lit("stem")), F.lit("source")).alias("episode_id"))


QUERIES["episode_ids"] = episode_ids
ORACLE_SQL["episode_ids"] = "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 3 = 0 THEN 'source' ELSE 'stem' END AS episode_id FROM orders"

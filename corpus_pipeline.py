"""A training-data pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from polyvant.llm import common, decontaminate, packing, rules, secrets, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list, or a base rule, rejects go."""
    return rules.keep_good(docs, rules.learn_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; shingles of five words."""
    return simhash.keep_one(docs, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; the documents stay."""
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece, with its sequence and place."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing)]

#: Rules are learned, tokens come from a tokenizer and the latent space from random directions: no SQL says that.
ORACLE_SQL = None


@common.scoped
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table documents. Disk holds what a stage stores on its way, its input and
    its output: all but the output goes once that is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        with common.Scope() as scope:
            docs = common.cut(stage(spark, docs, sf_dir), name)
            scope.free(keep=docs)
            if before:
                before.free()
            before = common.Scope()
            before.tables, scope.tables = scope.tables, {}
    out = common.cut(STAGES[-1][1](spark, docs, sf_dir), "packed")
    before.free()
    return out

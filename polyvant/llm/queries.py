"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hmm, packing, rules, secrets, simhash, suffixes, tokenpack, toxicity, weaklabel


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabel.classify(_table(spark, sf_dir, "documents"))


def op4_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(_table(spark, sf_dir, "documents")))


def op6_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = rules.learn_from(docs, _table(spark, sf_dir, "labels"))
    judged = rules.judge(docs.select("doc_id", "text"), found)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("rule"))


def op8_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenpack.digest(tokenpack.pack_ids(_table(spark, sf_dir, "documents")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_best_fit_packing, op2_latent_decontamination, op3_weak_label_quality, op4_hmm_scoring, op5_secret_scan, op6_simhash_anchors, op7_quality_rules, op8_token_packing, op9_toxicity, op10_sparse_suffixes)}

ORACLE_SQL: dict[str, str] = {}

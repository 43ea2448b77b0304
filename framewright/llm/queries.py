"""The registered queries: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ship
from . import decontaminate, line_dedup, near_dedup, oracles, packing, quality_classifier, quality_rules, substring_dedup, token_counts, token_files, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(spark, _table(spark, sf_dir, "documents"), digest=True)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", F.size("spans").cast("long").alias("n_spans"), "left_sha256")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_totals(spark, _table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(spark, _table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"), with_text=False)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.verdicts(quality_rules.ledger(_table(spark, sf_dir, "documents")))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_upper", "failures")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_quality_classifier, op3_simhash_near_dedup, op4_decontamination, op5_token_counts, op6_token_files, op7_substring_dedup, op8_best_fit_packing, op9_toxicity, op10_quality_rules)}
ORACLES = oracles.ORACLES

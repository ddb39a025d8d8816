"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, hmm_lm, line_dedup, mixing, quality_bt, quality_rules, secrets, simhash, sql, suffix_dedup, wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_report(table(spark, sf_dir, "documents"))
    return found.withColumn("dropped", F.array_join(found["dropped"].cast("array<string>"), ","))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op3_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_bt.score(docs, quality_bt.train(docs, table(spark, sf_dir, "labels"))).drop("text")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.weak_quality(table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *counts, "base_failed", "kept", "quality")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op7_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_documents(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(table(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op4 SQL can express."""
    return op4_quality_rules(spark, sf_dir).drop("kept", "quality")


def token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op7 SQL can express."""
    found = op7_hmm_score(spark, sf_dir).drop("score")
    return found.withColumn("base_score", F.round("base_score", 4) + 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_line_dedup, op2_secrets, op3_quality_ranking, op4_quality_rules, op5_simhash, op6_suffix_dedup, op7_hmm_score, op8_main_text, op9_decontaminate, op10_mix_sources, rule_counts, token_scores)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": sql.LINE_DEDUP,
        "op6_suffix_dedup": sql.SUFFIX_DEDUP,
        "op9_decontaminate": sql.DECONTAMINATION,
        "op10_mix_sources": mixing.ORACLE_SQL,
        "rule_counts": sql.RULE_COUNTS,
        "token_scores": sql.TOKEN_SCORES,
    }

"""Corpus preparation in five stages: quality, lines, near duplicates, benchmark leaks, mixture.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents that it keeps, as it
leaves them. All but the last return the columns of documents; the last adds ``taken`` (words the mix takes) and
``copies`` (times the document is begun). ``run`` applies them to the documents table, each stage's result written as
Parquet to the shared folder and read again.

Defined results: an empty table gives an empty one at every stage. Null and empty texts are judged like any other by the
classifier; they have no lines to lose, are near duplicates of each other, leak nothing, and the mix, which takes words, leaves
them out. Rows with a null doc_id are never near duplicates and stay; of rows that repeat doc_id and text one is left by the
near-duplicate stage. Further columns pass through all stages, whatever their names, but for ``taken`` and ``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontam, line_dedup, mixing, quality_bt, simhash
from tessella.llm.common import Scratch
from tessella.workers import importable


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry classifier predicts to be of quality 1; it is trained on the stage's own input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_bt.score(docs, quality_bt.train(docs, labels))
    return scored.filter("predicted = 1").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one up to one word; those that have no line left go."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: Jaccard similarity of five-word shingles from 0.8 on, or 3 bits of 64.

    Fingerprints of such texts differ in 10 bits on average, too many for blocks alone (see README), so the shingles that a
    similar pair must share serve as blocks, and SimHashes of the sets are compared before the texts are.
    """
    return simhash.one_of_each(docs, shingle=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.find_leaks(docs, benchmark).filter("NOT contaminated").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the water-filled mixture takes, with ``taken`` and ``copies``."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality_classifier", importable(quality_classifier)),
    ("line_dedup", importable(line_dedup_stage)),
    ("simhash_near_dedup", importable(near_dedup)),
    ("benchmark_decontamination", importable(decontamination)),
    ("source_mixing", importable(source_mixing)),
]

#: SQL expresses neither the classifier nor the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), keep=True)
    return docs

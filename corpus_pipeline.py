"""The corpus pipeline: stages (name, function), each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import decontaminate, importance, line_dedup, mixing, similar, simhash
from headway.llm.common import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return importance.accept(docs, table(spark, sf_dir, "labels")).select(COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of windows that occur earlier; n_chars follows, and texts of which nothing stays go."""
    out = line_dedup.dedup(docs).where("n_removed = 0 or trim(text) <> ''")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles have a Jaccard similarity of 0.8 or more."""
    return simhash.keep_one(docs, similar.near_duplicates, n=5, percent=80).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no span with the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): what the mix takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: Hashes and sampling decide what stays, which DuckDB's SQL can't repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = cut(docs) if i + 1 < len(STAGES) else docs
    return docs

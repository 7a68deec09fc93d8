"""The corpus pipeline: stages over documents, each written and read again by its runner.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and
returns the columns of documents; the last one adds the ids of each text. Rows of docs with
null or clashing columns are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import bpe, decontamination, neardup, perplexity, pii, shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or fall out of their language's perplexity band go."""
    shared.small_batches(spark)
    return perplexity.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    shared.small_batches(spark)
    return neardup.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts."""
    shared.small_batches(spark)
    return pii.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' token ids (little-endian unsigned 32-bit integers) and their number."""
    shared.small_batches(spark)
    return bpe.encoded(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("personal data", personal_data),
    ("encoding", encoded),
]
#: Perplexity and signatures have no form in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            shared.discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

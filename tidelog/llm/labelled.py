"""Bounded samples of labelled rows, and the fold that stays out of training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labelled rows that a classifier is fitted on, at most; those with the least hash of doc_id.
TRAINING_ROWS = 8000
#: Crc32 of doc_id as text, modulo FOLDS; rows of remainder 0 are held out.
FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """True where doc_id is in the fold that no label is learned from; a null doc_id isn't."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % FOLDS == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, bound: int = TRAINING_ROWS) -> DataFrame:
    """doc_id (as text), text, label of at most bound labelled ids outside the held-out fold.

    Rows with a null id, text or label are no labelled rows. An id has one row, however often it
    occurs: of several labels the least, of several texts that of the least hash, so the sample
    never has more than bound rows. The chosen ids are broadcast: bound of them at most.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "label").agg(F.min_by("text", F.md5("text")).alias("text"))
    return one.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "label")

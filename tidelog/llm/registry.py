"""The queries of the training-data operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelog.llm import bpe, decontamination, htmltext, labelled, licenses, neardup, perplexity, pii, quality, shared, sharding, toxicity


def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared.small_batches(spark)
    text = htmltext.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"))
    return text.select("page_id", "text", F.char_length("text").cast("long").alias("n_chars"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(shared.documents(spark, sf_dir))


def op3_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judged(shared.documents(spark, sf_dir).select("doc_id", "text", "lang"), ["doc_id"])
    return judged.select("doc_id", *perplexity.RESULTS, "base_failed", "kept", "perplexity")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.decoded(bpe.encoded(shared.documents(spark, sf_dir).select("doc_id", "text")))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.documents(spark, sf_dir).select("doc_id", "text")
    return decontamination.passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(shared.documents(spark, sf_dir))


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detected(shared.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def _classified(module, spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.documents(spark, sf_dir).select("doc_id", "text")
    model = module.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return module.scored(docs, model).select("doc_id", labelled.held_out().alias("held_out"), "score", "predicted")


def op8_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(quality, spark, sf_dir)


def op9_fm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(toxicity, spark, sf_dir)


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(shared.documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "kept")


def queries() -> dict:
    known = (
        op1_html_layout,
        op2_feistel_shards,
        op3_perplexity_bands,
        op4_byte_bpe,
        op5_spaced_seeds,
        op6_license_paragraphs,
        op7_boosted_pii,
        op8_nbsvm_quality,
        op9_fm_toxicity,
        op10_bagminhash,
    )
    return {f.__name__: f for f in known}


def oracle_sql() -> dict[str, str]:
    return {}

"""Whole ingest runs as queries: events into a queue, through the job, and what the table then holds.

Each run has a folder of its own in the session's shared folder and is small enough to be one
of the registered queries; what it returns is read from the files that the run left.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelog.functions import scalars as S
from tidelog.operators import signals
from tidelog.plans.logs import COORDINATES, with_logs
from tidelog.session import prepare
from tidelog.sources.queue import Queue
from tidelog.streaming.config import IngestConfig
from tidelog.streaming.ingest import IngestJob
from tidelog.streaming.ledger import Ledger
from tidelog.streaming.sink import DryRunSink, TableSink

#: Descriptors to a poll, and the estimate of a batch's bytes that fits them.
POLL, ESTIMATE = 64, 1 << 20


def run_folder(spark: SparkSession) -> str:
    """A new folder that all executors see: in spark.checkpoint.dir, or on this machine if the session runs there."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tidelog-run-")
    return f"{shared.rstrip('/')}/ingest-{uuid.uuid4().hex}"


def filled(spark: SparkSession, sf_dir: str, folder: str) -> Queue:
    """A queue that holds the log relation, a batch for each sequence with a metadata range for each entry."""
    entries = signals.encoded_entries(prepare(spark), sf_dir, "logs")
    one = F.struct("src_entry_index", "raw_bytes", "src_ingest_ms")
    batches = entries.groupBy("src_sequence").agg(F.array_sort(F.collect_list(one)).alias("e"))
    ranges = F.transform("e", lambda x: F.struct(x["src_entry_index"].cast("int").alias("start_index"), x["src_ingest_ms"].alias("ingestion_time_ms"), F.unhex(F.lit("01020100")).alias("payload")))
    queue = Queue(spark, f"{folder}/queue")
    queue.append(batches.select("src_sequence", F.col("e.raw_bytes").alias("entries"), ranges.alias("metadata")))
    return queue


def job(spark: SparkSession, folder: str, consumer: str, **runtime) -> IngestJob:
    values = {
        "source": {"root": f"{folder}/queue", "max_descriptors_per_poll": POLL, "estimated_max_batch_bytes": ESTIMATE},
        "sink": {"max_chunk_rows": 12},
        "runtime": {"dry_run": False} | runtime,
    }
    ledger = Ledger(spark, f"{folder}/ledger", "demo", "table")
    ledger.acquire()
    sink = DryRunSink() if runtime.get("dry_run") else TableSink(f"{folder}/table")
    return IngestJob(spark, IngestConfig.load(json.dumps(values), {}), sink, ledger, f"{folder}/checkpoint-{consumer}")


def ingest_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the table after a streaming run over all events."""
    folder = run_folder(spark)
    filled(spark, sf_dir, folder)
    one = job(spark, folder, "a")
    one.run()
    rows = one.sink.final(spark)
    return rows.select(
        *COORDINATES,
        "log_date",
        "time_ns",
        "severity_number",
        "severity_text",
        "service_name",
        "body",
        S.pairs_text(F.col("resource_attributes")).alias("resource"),
        S.pairs_text(F.col("log_attributes")).alias("pairs"),
        "trace_id",
        "gateway_ns",
        "map_version",
        "src_ingest_ms",
    )


def ingest_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts after a poller stopped half way, a streaming consumer took over, and a third lost the ledger's newest records."""
    folder = run_folder(spark)
    queue = filled(spark, sf_dir, folder)
    first = job(spark, folder, "a")
    for _ in range(max(1, len(queue.sequences()) // POLL // 2)):
        first.poll()
    second = job(spark, folder, "b")
    second.run()
    third = job(spark, folder, "c")
    for name in third.ledger.files.names(f"acks/{third.ledger.source}/{third.ledger.sink}"):
        third.ledger.files.remove(f"acks/{third.ledger.source}/{third.ledger.sink}/{name}")
    for low, high in third.ledger._ranges():
        if low % 4 == 3:
            third.ledger.files.remove(third.ledger._name(low, high))
    third.run()
    raw, final = third.sink.raw(spark), third.sink.final(spark)
    counts = raw.agg(F.count("*").alias("raw_rows"), F.count_distinct("token").alias("tokens")).crossJoin(final.agg(F.count("*").alias("final_rows")))
    held = third.ledger.commits().agg(F.count("*").alias("commits"), F.sum("rows").alias("committed_rows"), F.max("high").alias("head"))
    return counts.crossJoin(held).withColumn("frontier", F.lit(third.ledger.frontier()).cast("long")).withColumn("acked", F.lit(third.ledger.acked()).cast("long"))


def ingest_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a dry run counts, and that it leaves no commit."""
    folder = run_folder(spark)
    filled(spark, sf_dir, folder)
    one = job(spark, folder, "a", dry_run=True)
    done = one.run()
    return spark.createDataFrame([(done["batches"], done["entries"], done["records"], one.ledger.commits().count(), one.ledger.acked())], "batches long, entries long, records long, commits long, acked long")


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the counters and gauges of a run that don't depend on its pace."""
    folder = run_folder(spark)
    filled(spark, sf_dir, folder)
    one = job(spark, folder, "a", ack_every=1000)
    one.run()
    names = ["runtime_descriptors_handed_out_total", "ingestor_records_decoded_total", "runtime_ack_frontier", "runtime_pending_ranges", "buffer_consumer_sequence_lag", "table_rows_committed_total"]
    return one.registry.table(spark).where(F.col("name").isin(names)).select("name", F.col("value").cast("long").alias("value"))


_PAIRS = "concat_ws(',', CASE WHEN attr_k IS NOT NULL THEN 'k=' || attr_k END, CASE WHEN attr_run IS NOT NULL THEN 'run_id=' || attr_run END, 'topic=' || attr_topic)"

ENTRIES = {
    ingest_round_trip: with_logs(
        f"""SELECT {", ".join(COORDINATES)}, log_date, time_ns, CAST(severity_number AS SMALLINT) AS severity_number, severity_text, service_name, body, 'service.name=' || service_name || ',user=' || res_user AS resource,
            {_PAIRS} AS pairs, trace_id, gateway_ns, map_version, min(src_ingest_ms) OVER (PARTITION BY src_sequence, src_entry_index) AS src_ingest_ms FROM logs"""
    ),
    ingest_replay: with_logs(
        """, per AS (SELECT src_sequence, count(*) AS n FROM logs GROUP BY 1)
        SELECT (SELECT count(*) FROM logs) AS raw_rows, CAST(sum((n + 11) // 12) AS BIGINT) AS tokens, (SELECT count(*) FROM logs) AS final_rows, count(*) AS commits,
               CAST(sum(n) AS BIGINT) AS committed_rows, max(src_sequence) AS head, max(src_sequence) AS frontier, max(src_sequence) AS acked FROM per"""
    ),
    ingest_dry_run: with_logs("SELECT count(DISTINCT src_sequence) AS batches, count(DISTINCT (src_sequence, src_entry_index)) AS entries, count(*) AS records, 0 AS commits, -1 AS acked FROM logs"),
    ingest_metrics: with_logs(
        """SELECT 'runtime_descriptors_handed_out_total' AS name, count(DISTINCT src_sequence) AS value FROM logs
        UNION ALL SELECT 'ingestor_records_decoded_total', count(*) FROM logs UNION ALL SELECT 'table_rows_committed_total', count(*) FROM logs
        UNION ALL SELECT 'runtime_ack_frontier', max(src_sequence) FROM logs UNION ALL SELECT 'runtime_pending_ranges', 0 UNION ALL SELECT 'buffer_consumer_sequence_lag', 0"""
    ),
}

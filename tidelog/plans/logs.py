"""The log relation: one typed row per record, derived from the events table.

`logs` is the DataFrame; LOGS_SQL is the same relation as a DuckDB common table expression.
Times are whole nanoseconds in BIGINT columns, since timestamps hold microseconds only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelog.functions import scalars as S
from tidelog.session import prepare

MANIFEST = "ingest/demo/manifest"
DATA_PREFIX = "ingest/demo/data/"
PER_BATCH, PER_ENTRY = 50, 10
#: Severity numbers and texts by kind of event (fixed values).
SEVERITY = {"error": (17, "ERROR"), "purchase": (10, "INFO"), "signup": (9, "INFO"), "click": (5, "DEBUG"), "view": (1, "TRACE")}
#: Columns that name a record.
COORDINATES = ["src_sequence", "src_entry_index", "src_record_index"]
#: The table's sort and replacement key.
TABLE_KEY = ["log_date", "service_name", *COORDINATES]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log relation over the events of sf_dir."""
    return from_events(events(spark, sf_dir))


def from_events(df: DataFrame) -> DataFrame:
    number, text = F.lit(0), F.lit("")
    for kind, (n, name) in SEVERITY.items():
        number = F.when(F.col("event_type") == kind, n).otherwise(number)
        text = F.when(F.col("event_type") == kind, name).otherwise(text)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    time_ns = us * 1000 + F.col("event_id") % 1000
    stamp = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, "bad").otherwise(time_ns.cast("string"))
    service = F.concat(F.lit("svc-"), (F.col("user_id") % 8).cast("string"))
    run = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("run-"), (F.col("event_id") % 3).cast("string")))
    present = lambda m: F.map_filter(m, lambda _, v: v.isNotNull())
    resource = present(F.create_map(F.lit("service.name"), service, F.lit("user"), F.col("user_id").cast("string"), F.lit("gateway_received_at"), stamp))
    own = present(F.create_map(F.lit("topic"), F.col("event_type"), F.lit("k"), F.get_json_object("props", "$.k"), F.lit("run_id"), run))
    return df.select(
        F.expr(f"event_id div {PER_BATCH}").alias("src_sequence"),
        F.expr(f"(event_id % {PER_BATCH}) div {PER_ENTRY}").alias("src_entry_index"),
        (F.col("event_id") % PER_ENTRY).alias("src_record_index"),
        F.lit(MANIFEST).alias("src_manifest_path"),
        F.concat(F.lit(DATA_PREFIX), F.expr(f"event_id div {PER_BATCH}").cast("string")).alias("src_data_path"),
        (F.floor(us / 1000) + 250).alias("src_ingest_ms"),
        time_ns.alias("time_ns"),
        F.to_date(F.col("ts")).alias("log_date"),
        number.cast("smallint").alias("severity_number"),
        text.alias("severity_text"),
        service.alias("service_name"),
        F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("body"),
        resource.alias("resource_attributes"),
        own.alias("log_attributes"),
        F.md5(F.col("event_id").cast("string").cast("binary")).alias("trace_id"),
        F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 16).alias("span_id"),
        F.lit(1).cast("bigint").alias("map_version"),
        S.parse_unsigned(stamp).alias("gateway_ns"),
        (time_ns + (F.col("event_id") % 97) * 1_000_000).alias("inserted_ns"),
    )


LOGS_SQL = f"""base AS (
    SELECT *, epoch_us(ts) AS us, epoch_us(ts) * 1000 + event_id % 1000 AS t_ns FROM events
), logs AS (
    SELECT event_id // {PER_BATCH} AS src_sequence,
           (event_id % {PER_BATCH}) // {PER_ENTRY} AS src_entry_index,
           event_id % {PER_ENTRY} AS src_record_index,
           '{MANIFEST}' AS src_manifest_path,
           '{DATA_PREFIX}' || CAST(event_id // {PER_BATCH} AS VARCHAR) AS src_data_path,
           us // 1000 + 250 AS src_ingest_ms,
           t_ns AS time_ns,
           CAST(ts AS DATE) AS log_date,
           CASE event_type WHEN 'error' THEN 17 WHEN 'purchase' THEN 10 WHEN 'signup' THEN 9
                           WHEN 'click' THEN 5 WHEN 'view' THEN 1 ELSE 0 END AS severity_number,
           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'INFO' WHEN 'signup' THEN 'INFO'
                           WHEN 'click' THEN 'DEBUG' WHEN 'view' THEN 'TRACE' ELSE '' END AS severity_text,
           'svc-' || CAST(user_id % 8 AS VARCHAR) AS service_name,
           event_type || ' ' || CAST(event_id AS VARCHAR) AS body,
           CAST(user_id AS VARCHAR) AS res_user,
           CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'bad'
                ELSE CAST(t_ns AS VARCHAR) END AS res_gateway,
           event_type AS attr_topic,
           json_extract_string(props, '$.k') AS attr_k,
           CASE WHEN event_id % 5 <> 0 THEN 'run-' || CAST(event_id % 3 AS VARCHAR) END AS attr_run,
           md5(CAST(event_id AS VARCHAR)) AS trace_id,
           substr(md5(CAST(event_id AS VARCHAR)), 1, 16) AS span_id,
           CAST(1 AS BIGINT) AS map_version,
           CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE t_ns END AS gateway_ns,
           t_ns + (event_id % 97) * 1000000 AS inserted_ns
    FROM base
)"""


def with_logs(sql: str, recursive: bool = False) -> str:
    """sql over the relation logs, as one DuckDB statement; further CTEs may begin with a comma."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{LOGS_SQL}{sql if sql.lstrip().startswith(',') else ' ' + sql}"


def replayed(df: DataFrame) -> DataFrame:
    """df with every fourth batch again at map version 2; ingest_ordinal tells the copies apart."""
    again = df.where(F.col("src_sequence") % 4 == 0).withColumn("map_version", F.lit(2).cast("bigint"))
    return df.withColumn("ingest_ordinal", F.lit(1)).unionByName(again.withColumn("ingest_ordinal", F.lit(2)))


REPLAYED_SQL = """, twice AS (
    SELECT *, 1 AS ingest_ordinal FROM logs
    UNION ALL SELECT * REPLACE (CAST(2 AS BIGINT) AS map_version), 2 AS ingest_ordinal FROM logs WHERE src_sequence % 4 = 0
)"""

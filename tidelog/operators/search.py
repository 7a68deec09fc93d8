"""Filters, lookups, newest rows and counts over the log relation."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelog.functions import scalars as S
from tidelog.plans.logs import COORDINATES, REPLAYED_SQL, logs, replayed, with_logs

LEAST_SEVERITY = 9


def date_bounds(low_ns: int, high_ns: int) -> Column:
    """The dates that a range of nanoseconds can touch, so that a scan by log_date is pruned."""
    day = lambda ns: datetime.date(1970, 1, 1) + datetime.timedelta(days=ns // 86_400_000_000_000)
    return F.col("log_date").between(F.lit(day(low_ns)), F.lit(day(high_ns)))


def in_window(df: DataFrame, low_s: int, high_s: int, severity: int = LEAST_SEVERITY) -> DataFrame:
    """Records from low_s to high_s (seconds, both included) at or above a severity."""
    low, high = low_s * 1_000_000_000, high_s * 1_000_000_000
    return df.where(date_bounds(low, high) & F.col("time_ns").between(low, high) & (F.col("severity_number") >= severity))


def of_service(df: DataFrame, service: str) -> DataFrame:
    return df.where(F.col("service_name") == service)


def with_attribute(df: DataFrame, key: str, value: str) -> DataFrame:
    """Records whose attribute equals value; a missing one counts as the empty string."""
    return df.where(S.attribute(F.col("log_attributes"), key, "") == value)


def newest(df: DataFrame, n: int) -> DataFrame:
    """The n newest rows; equal times are ordered by their coordinates."""
    return df.orderBy(F.desc("time_ns"), *COORDINATES).limit(n)


WINDOW = (1704672000, 1705708800)  # 2024-01-08 to 2024-01-20


def flagship_severity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_window(logs(spark, sf_dir), *WINDOW).agg(F.count("*").alias("n"))


def severity_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_window(logs(spark, sf_dir), *WINDOW).select(*COORDINATES, "time_ns", "severity_number", "body")


def last_n_for_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(of_service(logs(spark, sf_dir), "svc-3"), 100).select("time_ns", *COORDINATES, "body")


def count_for_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_service(logs(spark, sf_dir), "svc-3").agg(F.count("*").alias("n"))


def attribute_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_attribute(logs(spark, sf_dir), "k", "7").select(*COORDINATES, "body")


def attribute_lookup_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_attribute(logs(spark, sf_dir), "k", "7").agg(F.count("*").alias("n"))


def attribute_missing_is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_attribute(logs(spark, sf_dir), "run_id", "").agg(F.count("*").alias("n"))


def newest_with_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(logs(spark, sf_dir), 5).select("time_ns", "service_name", "body", *COORDINATES, "src_manifest_path", "src_data_path", "src_ingest_ms")


def rows_by_run_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = S.attribute(F.col("log_attributes"), "run_id", "unknown")
    return logs(spark, sf_dir).groupBy(run.alias("run_id")).agg(F.count("*").alias("n"))


def global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).agg(F.count("*").alias("n"))


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed(logs(spark, sf_dir)).agg(F.count_distinct(F.struct(*COORDINATES)).alias("n"))


def distinct_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).agg(F.count_distinct("service_name").alias("services"), F.count_distinct("severity_text").alias("severities"))


def any_of_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows an unordered limit gives; which ones is left open."""
    return with_attribute(logs(spark, sf_dir), "topic", "click").limit(100).agg(F.count("*").alias("n"))


def suite(df: DataFrame, service: str, low_s: int, high_s: int, key: str, value: str, limit: int = 100) -> DataFrame:
    """shape, found, given: what the three standard queries find, and what is left of it under the limit.

    The newest rows of a service, rows of a time range from severity 9 on (without a limit), and
    rows with an attribute. Each is one aggregation over the scan.
    """
    shapes = {"last_n_for_service": of_service(df, service), "time_range_with_severity": in_window(df, low_s, high_s), "attribute_lookup": with_attribute(df, key, value)}
    out = None
    for shape, rows in shapes.items():
        n = F.count("*")
        given = n if shape == "time_range_with_severity" else F.least(n, F.lit(limit).cast("bigint"))
        one = rows.agg(n.alias("found"), given.alias("given")).select(F.lit(shape).alias("shape"), "found", "given")
        out = one if out is None else out.unionByName(one)
    return out


def query_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite(logs(spark, sf_dir), "svc-3", *WINDOW, "topic", "click")


#: The suite's usual parameters (fixed values).
SUITE = ("controller", 1_700_000_000, 1_700_010_000, "topic", "foo")


def query_suite_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite(logs(spark, sf_dir), *SUITE)


def newest_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows with where they come from, a line of JSON each."""
    rows = newest_with_provenance(spark, sf_dir)
    return rows.select("time_ns", F.to_json(F.struct(*rows.columns)).alias("line"))


def _suite_sql(service: str, low_s: int, high_s: int, key: str, value: str) -> str:
    held = {"topic": "attr_topic", "k": "attr_k", "run_id": "attr_run"}[key]
    return f"""SELECT 'last_n_for_service' AS shape, count(*) AS found, least(count(*), 100) AS given FROM logs WHERE service_name = '{service}'
        UNION ALL SELECT 'time_range_with_severity', count(*), count(*) FROM logs WHERE time_ns BETWEEN {low_s * 10**9} AND {high_s * 10**9} AND severity_number >= {LEAST_SEVERITY}
        UNION ALL SELECT 'attribute_lookup', count(*), least(count(*), 100) FROM logs WHERE coalesce({held}, '') = '{value}'"""


_COORDS = ", ".join(COORDINATES)
_WHERE = f"time_ns BETWEEN {WINDOW[0] * 10**9} AND {WINDOW[1] * 10**9} AND severity_number >= {LEAST_SEVERITY}"

ENTRIES = {
    flagship_severity_window: with_logs(f"SELECT count(*) AS n FROM logs WHERE {_WHERE}"),
    severity_window_rows: with_logs(f"SELECT {_COORDS}, time_ns, severity_number, body FROM logs WHERE {_WHERE}"),
    last_n_for_service: with_logs(f"SELECT time_ns, {_COORDS}, body FROM logs WHERE service_name = 'svc-3' ORDER BY time_ns DESC, {_COORDS} LIMIT 100"),
    count_for_service: with_logs("SELECT count(*) AS n FROM logs WHERE service_name = 'svc-3'"),
    attribute_lookup: with_logs(f"SELECT {_COORDS}, body FROM logs WHERE coalesce(attr_k, '') = '7'"),
    attribute_lookup_count: with_logs("SELECT count(*) AS n FROM logs WHERE coalesce(attr_k, '') = '7'"),
    attribute_missing_is_empty: with_logs("SELECT count(*) AS n FROM logs WHERE coalesce(attr_run, '') = ''"),
    newest_with_provenance: with_logs(f"SELECT time_ns, service_name, body, {_COORDS}, src_manifest_path, src_data_path, src_ingest_ms FROM logs ORDER BY time_ns DESC, {_COORDS} LIMIT 5"),
    any_of_limit: with_logs("SELECT count(*) AS n FROM (SELECT 1 FROM logs WHERE attr_topic = 'click' LIMIT 100)"),
    query_suite: with_logs(_suite_sql("svc-3", *WINDOW, "topic", "click")),
    query_suite_defaults: with_logs(_suite_sql(*SUITE)),
    newest_as_json: with_logs(
        f"""SELECT time_ns, '{{"time_ns":' || time_ns || ',"service_name":"' || service_name || '","body":"' || body || '","src_sequence":' || src_sequence || ',"src_entry_index":' || src_entry_index
            || ',"src_record_index":' || src_record_index || ',"src_manifest_path":"' || src_manifest_path || '","src_data_path":"' || src_data_path || '","src_ingest_ms":' || src_ingest_ms || '}}' AS line
            FROM logs ORDER BY time_ns DESC, {_COORDS} LIMIT 5"""
    ),
    rows_by_run_id: with_logs("SELECT coalesce(attr_run, 'unknown') AS run_id, count(*) AS n FROM logs GROUP BY 1"),
    global_count: with_logs("SELECT count(*) AS n FROM logs"),
    distinct_keys: with_logs(f"{REPLAYED_SQL} SELECT count(DISTINCT ({_COORDS})) AS n FROM twice"),
    distinct_services: with_logs("SELECT count(DISTINCT service_name) AS services, count(DISTINCT severity_text) AS severities FROM logs"),
}

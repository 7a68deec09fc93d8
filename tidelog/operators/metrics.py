"""Latency quantiles, cumulative histograms, ratios, and their text form."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelog.operators import frontier
from tidelog.plans.logs import logs, with_logs

#: Upper bounds of histogram buckets (fixed values).
SECONDS = (0.001, 0.0025, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0)
SIZES = (1024, 4096, 16384, 65536, 262144, 1048576, 4194304, 16777216, 67108864)
ROW_COUNTS = (100, 500, 1000, 5000, 10000, 50000, 100000, 500000, 1000000)
PER_CALL = (0, 1, 2, 4, 8, 16, 32, 64)


def cumulative(df: DataFrame, value: Column, bounds: tuple, by: list[str] | None = None) -> DataFrame:
    """by, le, n: rows at or below each bound, and of all as +Inf, in one aggregation."""
    counts = [F.sum((value <= b).cast("bigint")).alias(f"_{i}") for i, b in enumerate(bounds)]
    grouped = df.groupBy(*(by or [])).agg(*counts, F.count(value).alias("_all"))
    pairs = [F.struct(F.lit(str(b)).alias("le"), F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("bigint").alias("n")) for i, b in enumerate(bounds)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("_all").alias("n")))
    return grouped.select(*(by or []), F.inline(F.array(*pairs)))


def latency_ms(df: DataFrame) -> DataFrame:
    """Records with a gateway stamp, with ms from it to insertion."""
    return df.where(F.col("gateway_ns").isNotNull()).withColumn("ms", (F.col("inserted_ns") - F.col("gateway_ns")) / 1_000_000)


def prometheus_text(samples: DataFrame, kind: dict[str, str] | None = None) -> str:
    """The text format of samples (name, labels map, value); a bounded table of metrics, collected."""
    out, last = [], None
    rows = samples.select("name", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("labels")))).alias("labels"), "value").orderBy("name", "labels").collect()
    for r in rows:
        if r.name != last:
            out.append(f"# TYPE {r.name} {(kind or {}).get(r.name, 'gauge')}")
            last = r.name
        labels = ",".join(f'{k}="{v}"' for k, v in json.loads(r.labels or "{}").items())
        value = int(r.value) if float(r.value).is_integer() else r.value
        out.append(f"{r.name}{{{labels}}} {value}" if labels else f"{r.name} {value}")
    return "\n".join([*out, "# EOF", ""])


def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = lambda p: F.percentile("ms", F.lit(p))
    return latency_ms(logs(spark, sf_dir)).groupBy("service_name").agg(q(0.5).alias("p50"), q(0.9).alias("p90"), q(0.99).alias("p99"), F.count("*").alias("n"))


def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative(latency_ms(logs(spark, sf_dir)), F.col("ms") / 1000, SECONDS)


def rows_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = logs(spark, sf_dir).groupBy("service_name", "log_date").agg(F.count("*").alias("rows"))
    return cumulative(per, F.col("rows"), ROW_COUNTS, ["service_name"])


def bytes_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches by size."""
    per = logs(spark, sf_dir).groupBy("src_sequence").agg((F.sum(F.octet_length("body") * 40)).cast("bigint").alias("bytes"))
    return cumulative(per, F.col("bytes"), SIZES)


def per_call_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptors handed out by each poll of up to eight, one poll in five coming back after three."""
    d = logs(spark, sf_dir).select("src_sequence").distinct()
    polls = d.groupBy(F.expr("src_sequence div 8").alias("poll")).agg(F.count_if(F.expr("src_sequence div 8 % 5 <> 4 or src_sequence % 8 < 3")).alias("k"))
    return cumulative(polls, F.col("k"), PER_CALL)


def ratio(part: Column, whole: Column) -> Column:
    """The quotient of two sums; null where nothing was summed or the whole is 0."""
    return F.try_divide(F.sum(part).cast("double"), F.sum(whole).cast("double"))


def serialize_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of insert time that serialising takes, by service."""
    spent = F.col("inserted_ns") - F.col("time_ns")
    return logs(spark, sf_dir).groupBy("service_name").agg(ratio(spent, spent * 3 + F.col("severity_number")).alias("fraction"))


#: Outcomes of commits as labels (fixed values).
OUTCOMES = ("committed", "verified_already_committed", "failed_retryable", "failed_fatal")


def commit_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the commit counter by outcome, from a ledger with each attempt."""
    attempts = logs(spark, sf_dir).select("src_sequence").distinct()
    kind = F.when(F.col("src_sequence") % 31 == 30, OUTCOMES[3]).when(F.col("src_sequence") % 11 == 10, OUTCOMES[2]).when(F.col("src_sequence") % 7 == 6, OUTCOMES[1]).otherwise(OUTCOMES[0])
    return attempts.groupBy(kind.alias("result")).agg(F.count("*").alias("value")).select(F.lit("runtime_sink_commits_total").alias("name"), "result", "value")


def run_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, source, value: the frontier, pending ranges and lag of each source as samples."""
    reached = frontier.ack_frontier(spark, sf_dir).select(F.lit("runtime_ack_frontier").alias("name"), "source", F.col("frontier").alias("value"))
    open_ = frontier.pending_totals(spark, sf_dir).select(F.lit("runtime_pending_ranges").alias("name"), "source", F.col("pending").alias("value"))
    lag = frontier.source_lag(spark, sf_dir).select(F.lit("buffer_consumer_sequence_lag").alias("name"), "source", F.col("lag").alias("value"))
    return reached.unionByName(open_).unionByName(lag)


def admission_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptors handed out for each poll of up to eight."""
    d = logs(spark, sf_dir).select("src_sequence").distinct()
    polls = d.groupBy(F.expr("src_sequence div 8").alias("poll")).agg(F.count("*").alias("k"))
    return polls.agg(F.sum("k").alias("descriptors"), F.count("*").alias("calls"), (F.sum("k") / F.count("*")).alias("per_call"))


ENTRIES = {
    latency_quantiles: with_logs(
        ", l AS (SELECT service_name, (inserted_ns - gateway_ns) / 1000000 AS ms FROM logs WHERE gateway_ns IS NOT NULL) SELECT service_name, quantile_cont(ms, 0.5) AS p50, quantile_cont(ms, 0.9) AS p90, quantile_cont(ms, 0.99) AS p99, count(*) AS n FROM l GROUP BY 1"
    ),
    latency_histogram: with_logs(
        f""", l AS (SELECT (inserted_ns - gateway_ns) / 1000000 / 1000 AS s FROM logs WHERE gateway_ns IS NOT NULL),
        b AS (SELECT * FROM (VALUES {", ".join(f"('{x}', CAST({x} AS DOUBLE))" for x in SECONDS)}, ('+Inf', CAST('Infinity' AS DOUBLE))) AS t(le, top))
        SELECT le, CAST((SELECT count(*) FROM l WHERE s <= top) AS BIGINT) AS n FROM b"""
    ),
    rows_histogram: with_logs(
        f""", p AS (SELECT service_name, log_date, count(*) AS k FROM logs GROUP BY 1, 2),
        b AS (SELECT * FROM (VALUES {", ".join(f"('{x}', CAST({x} AS DOUBLE))" for x in ROW_COUNTS)}, ('+Inf', CAST('Infinity' AS DOUBLE))) AS t(le, top))
        SELECT service_name, le, count(*) FILTER (k <= top) AS n FROM p CROSS JOIN b GROUP BY 1, 2"""
    ),
    bytes_histogram: with_logs(
        f""", p AS (SELECT src_sequence, sum(strlen(body) * 40) AS k FROM logs GROUP BY 1),
        b AS (SELECT * FROM (VALUES {", ".join(f"('{x}', CAST({x} AS DOUBLE))" for x in SIZES)}, ('+Inf', CAST('Infinity' AS DOUBLE))) AS t(le, top))
        SELECT le, count(*) FILTER (k <= top) AS n FROM p CROSS JOIN b GROUP BY 1"""
    ),
    per_call_histogram: with_logs(
        f""", d AS (SELECT DISTINCT src_sequence FROM logs), p AS (SELECT src_sequence // 8 AS poll, count(*) FILTER (src_sequence // 8 % 5 <> 4 OR src_sequence % 8 < 3) AS k FROM d GROUP BY 1),
        b AS (SELECT * FROM (VALUES {", ".join(f"('{x}', CAST({x} AS DOUBLE))" for x in PER_CALL)}, ('+Inf', CAST('Infinity' AS DOUBLE))) AS t(le, top))
        SELECT le, count(*) FILTER (k <= top) AS n FROM p CROSS JOIN b GROUP BY 1"""
    ),
    serialize_fraction: with_logs("SELECT service_name, CAST(sum(inserted_ns - time_ns) AS DOUBLE) / CAST(sum((inserted_ns - time_ns) * 3 + severity_number) AS DOUBLE) AS fraction FROM logs GROUP BY 1"),
    commit_outcomes: with_logs(
        f""", d AS (SELECT DISTINCT src_sequence AS s FROM logs)
        SELECT 'runtime_sink_commits_total' AS name, CASE WHEN s % 31 = 30 THEN '{OUTCOMES[3]}' WHEN s % 11 = 10 THEN '{OUTCOMES[2]}' WHEN s % 7 = 6 THEN '{OUTCOMES[1]}' ELSE '{OUTCOMES[0]}' END AS result, count(*) AS value FROM d GROUP BY 2"""
    ),
    run_gauges: with_logs(
        f"""{frontier.COMMITS_SQL} SELECT 'runtime_ack_frontier' AS name, source, frontier AS value FROM f
        UNION ALL SELECT 'runtime_pending_ranges', source, count(*) FROM p GROUP BY source
        UNION ALL SELECT 'buffer_consumer_sequence_lag', source, (SELECT max(src_sequence) FROM d) - frontier FROM f"""
    ),
    admission_ratios: with_logs(", p AS (SELECT src_sequence // 8 AS poll, count(DISTINCT src_sequence) AS k FROM logs GROUP BY 1) SELECT CAST(sum(k) AS BIGINT) AS descriptors, count(*) AS calls, sum(k) / count(*) AS per_call FROM p"),
}

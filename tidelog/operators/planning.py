"""Deterministic chunks of a batch, their tokens, record numbering and integrity guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tidelog.functions import scalars as S
from tidelog.plans.logs import COORDINATES, MANIFEST, logs, with_logs

MAX_CHUNK_ROWS, MAX_CHUNK_BYTES = 100_000, 32 << 20
SOURCE, SINK, SCHEMA_VERSION = "demo", "table", 1
DATABASE, TABLE, VERSION = "obs", "logs", 1
#: Columns that name a batch.
BATCH = ["src_manifest_path", "src_sequence"]


def chunked(df: DataFrame, max_rows: int = MAX_CHUNK_ROWS, max_bytes: int = MAX_CHUNK_BYTES, size: Column | None = None) -> DataFrame:
    """df with record_bytes and chunk_index, numbered in each batch in coordinate order.

    A new chunk starts where a record would pass either limit; limits below one count as one. The
    fold over one batch depends on every record before, so the sizes of a batch (which the source
    bounds) meet in one row; it keeps only where chunks start, and rows find theirs from that.
    Records of equal coordinates fall into one chunk. size: bytes of a record, a log's if not given.
    """
    max_rows, max_bytes = max(max_rows, 1), max(max_bytes, 1)
    sized = df.withColumn("record_bytes", S.record_bytes() if size is None else size)
    batch = BATCH
    place = F.struct("src_entry_index", "src_record_index")
    sizes = F.array_sort(F.collect_list(F.struct("src_entry_index", "src_record_index", "record_bytes")))

    def step(held, x):
        full = (held["rows"] > 0) & ((held["rows"] + 1 > max_rows) | (held["used"] + x["record_bytes"] > max_bytes))
        begins = full | (held["rows"] == 0)
        here = F.array(F.struct(x["src_entry_index"].alias("src_entry_index"), x["src_record_index"].alias("src_record_index")))
        return F.struct(
            F.when(full, 1).otherwise(held["rows"] + 1).cast("long").alias("rows"),
            F.when(full, x["record_bytes"]).otherwise(held["used"] + x["record_bytes"]).alias("used"),
            F.when(begins, F.concat(held["starts"], here)).otherwise(held["starts"]).alias("starts"),
        )

    kinds = dict(df.dtypes)
    none = F.array().cast(f"array<struct<src_entry_index:{kinds['src_entry_index']},src_record_index:{kinds['src_record_index']}>>")
    first = F.struct(F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("used"), none.alias("starts"))
    starts = sized.groupBy(*batch).agg(F.aggregate(sizes, first, step)["starts"].alias("_starts"))
    index = F.size(F.filter("_starts", lambda s: s <= place)) - 1
    return sized.join(starts, batch).withColumn("chunk_index", index.cast("long")).drop("_starts")


def chunked_by_rows(df: DataFrame, max_rows: int) -> DataFrame:
    """The case without a byte limit, in built-in functions alone."""
    order = Window.partitionBy("src_manifest_path", "src_sequence").orderBy("src_entry_index", "src_record_index")
    return df.withColumn("chunk_index", F.floor((F.row_number().over(order) - 1) / max(max_rows, 1)))


def token(max_rows: int, max_bytes: int, database: str = DATABASE, table: str = TABLE, version: int = VERSION, signal: str = "logs") -> Column:
    """The idempotency token of a row's chunk."""
    mark = S.fingerprint(F.lit(S.fingerprint_text(database, table, version, max_rows, max_bytes, signal=signal)))
    sequence = F.col("src_sequence")
    return S.dedupe_token(F.col("src_manifest_path"), f"{database}.{table}", sequence, sequence, version, mark, F.col("chunk_index"))


def tokens(chunks: DataFrame, max_rows: int, max_bytes: int, database: str = DATABASE, table: str = TABLE, version: int = VERSION, signal: str = "logs") -> DataFrame:
    """One row for each chunk with its rows and idempotency token."""
    grouped = chunks.groupBy(*BATCH, "chunk_index").agg(F.count("*").alias("chunk_rows"))
    return grouped.withColumn("token", token(max_rows, max_bytes, database, table, version, signal))


def one_manifest(df: DataFrame) -> DataFrame:
    """df, or an error at run time where a batch holds rows of several manifests."""
    per = Window.partitionBy("src_sequence")
    same = F.min("src_manifest_path").over(per) == F.max("src_manifest_path").over(per)
    return df.withColumn("_ok", F.when(same, True).otherwise(F.raise_error(F.lit("a batch holds several manifests")).cast("boolean"))).where("_ok").drop("_ok")


def conserved(planned: DataFrame, given: DataFrame) -> None:
    """Raise where planning changed the number of rows."""
    a, b = planned.count(), given.count()
    if a != b:
        raise ValueError(f"planned {a} of {b} rows")


def record_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records numbered from 0 in each entry."""
    order = Window.partitionBy("src_sequence", "src_entry_index").orderBy("time_ns", "body")
    return logs(spark, sf_dir).select("src_sequence", "src_entry_index", "body", (F.row_number().over(order) - 1).cast("bigint").alias("record_index"))


def chunk_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_by_rows(logs(spark, sf_dir), 12).select(*COORDINATES, "chunk_index")


ROWS, BYTES = 12, 5000


def chunk_by_rows_and_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked(logs(spark, sf_dir), ROWS, BYTES).select(*COORDINATES, "record_bytes", "chunk_index")


def dedupe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(chunked_by_rows(logs(spark, sf_dir), 12), 12, MAX_CHUNK_BYTES).select("token", "chunk_rows")


ENDPOINT, QUORUM, TIMEOUT_S = "http://table.test:8123/", "a b/2*~", 30


def insert_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address and statement of each chunk's insert."""
    found = dedupe_tokens(spark, sf_dir)
    return found.select("token", S.insert_url(ENDPOINT, F.col("token"), QUORUM, TIMEOUT_S).alias("url"), F.lit(S.insert_statement(DATABASE, TABLE, "JSONEachRow")).alias("statement"))


def chunk_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = [("default", S.fingerprint_text(DATABASE, TABLE, VERSION, MAX_CHUNK_ROWS, MAX_CHUNK_BYTES)), ("quorum", S.fingerprint_text(DATABASE, TABLE, VERSION, MAX_CHUNK_ROWS, MAX_CHUNK_BYTES, "2"))]
    return spark.createDataFrame(texts, "name string, text string").select("name", S.fingerprint(F.col("text")).alias("fingerprint"))


def commit_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.col("src_sequence")
    identity = S.commit_identity(F.lit(SOURCE), F.lit(SINK), low, low, F.lit(SCHEMA_VERSION))
    return logs(spark, sf_dir).select("src_sequence").distinct().select("src_sequence", identity.alias("identity"))


def row_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each batch before and after planning, where they differ or not."""
    df = logs(spark, sf_dir)
    before = df.groupBy("src_sequence").agg(F.count("*").alias("rows_in"))
    after = tokens(chunked_by_rows(df, 12), 12, MAX_CHUNK_BYTES).groupBy("src_sequence").agg(F.sum("chunk_rows").alias("rows_out"), F.count("*").alias("chunks"))
    return before.join(after, "src_sequence").withColumn("conserved", F.col("rows_in") == F.col("rows_out"))


def batch_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded bytes of each batch: records plus the coordinate columns."""
    coordinates = F.octet_length("src_manifest_path") + F.octet_length("src_data_path") + S.COORDINATE_BYTES
    return logs(spark, sf_dir).groupBy("src_sequence").agg(F.sum(S.record_bytes()).alias("record_bytes"), F.sum(coordinates.cast("bigint")).alias("coordinate_bytes"), F.count("*").alias("n"))


#: A limit that some of the batches of the log relation pass and most don't.
ESTIMATE, MULTIPLIER = 6175, 4


def oversize(batches: DataFrame, size: Column, estimate: int, multiplier: int) -> DataFrame:
    """src_sequence, bytes of the batches larger than the estimate times the multiplier (at most the largest BIGINT)."""
    return batches.select("src_sequence", size.alias("bytes")).where(F.col("bytes") > min(estimate * multiplier, (1 << 63) - 1))


def oversize_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose bytes pass the estimate times the fault multiplier."""
    return oversize(batch_bytes(spark, sf_dir), F.col("record_bytes") + F.col("coordinate_bytes"), ESTIMATE, MULTIPLIER)


def spans_of_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last sequence of each date, as the admission log reports them."""
    return logs(spark, sf_dir).groupBy("log_date").agg(F.min("src_sequence").alias("low"), F.max("src_sequence").alias("high"), F.min_by("body", F.struct(*COORDINATES)).alias("first_body"))


_BYTES = f"""({S.RECORD_BYTES} + strlen(severity_text) + strlen(body) + strlen(service_name) + strlen(trace_id) + strlen(span_id)
    + 12 + strlen(service_name) + 4 + strlen(res_user) + coalesce(19 + strlen(res_gateway), 0)
    + 5 + strlen(attr_topic) + coalesce(1 + strlen(attr_k), 0) + coalesce(6 + strlen(attr_run), 0))"""
_COORDS = ", ".join(COORDINATES)
_BY_ROWS = "(row_number() OVER (PARTITION BY src_sequence ORDER BY src_entry_index, src_record_index) - 1) // 12"
_MARK = f"substr(sha256('{S.fingerprint_text(DATABASE, TABLE, VERSION, 12, MAX_CHUNK_BYTES)}'), 1, 16)"

ENTRIES = {
    record_index: with_logs("SELECT src_sequence, src_entry_index, body, row_number() OVER (PARTITION BY src_sequence, src_entry_index ORDER BY time_ns, body) - 1 AS record_index FROM logs"),
    chunk_by_rows: with_logs(f"SELECT {_COORDS}, {_BY_ROWS} AS chunk_index FROM logs"),
    chunk_by_rows_and_bytes: with_logs(
        f""", sized AS (
            SELECT {_COORDS}, {_BYTES} AS record_bytes, row_number() OVER (PARTITION BY src_sequence ORDER BY src_entry_index, src_record_index) AS r FROM logs
        ), fold AS (
            SELECT {_COORDS}, record_bytes, r, CAST(0 AS BIGINT) AS chunk_index, CAST(1 AS BIGINT) AS held, record_bytes AS used FROM sized WHERE r = 1
            UNION ALL
            SELECT s.src_sequence, s.src_entry_index, s.src_record_index, s.record_bytes, s.r,
                   f.chunk_index + CASE WHEN f.held + 1 > {ROWS} OR f.used + s.record_bytes > {BYTES} THEN 1 ELSE 0 END,
                   CASE WHEN f.held + 1 > {ROWS} OR f.used + s.record_bytes > {BYTES} THEN 1 ELSE f.held + 1 END,
                   CASE WHEN f.held + 1 > {ROWS} OR f.used + s.record_bytes > {BYTES} THEN s.record_bytes ELSE f.used + s.record_bytes END
            FROM fold f JOIN sized s ON s.src_sequence = f.src_sequence AND s.r = f.r + 1
        ) SELECT {_COORDS}, record_bytes, chunk_index FROM fold""",
        recursive=True,
    ),
    dedupe_tokens: with_logs(
        f""", c AS (SELECT src_sequence, {_BY_ROWS} AS chunk_index FROM logs)
        SELECT '{MANIFEST}:{DATABASE}.{TABLE}:' || CAST(src_sequence AS VARCHAR) || '-' || CAST(src_sequence AS VARCHAR) || ':{VERSION}:' || {_MARK} || ':' || CAST(chunk_index AS VARCHAR) AS token,
               count(*) AS chunk_rows FROM c GROUP BY src_sequence, chunk_index"""
    ),
    insert_urls: with_logs(
        f""", c AS (SELECT DISTINCT src_sequence, {_BY_ROWS} AS chunk_index FROM logs),
        t AS (SELECT '{MANIFEST}:{DATABASE}.{TABLE}:' || CAST(src_sequence AS VARCHAR) || '-' || CAST(src_sequence AS VARCHAR) || ':{VERSION}:' || {_MARK} || ':' || CAST(chunk_index AS VARCHAR) AS token FROM c)
        SELECT token, '{ENDPOINT}?async_insert=0&date_time_input_format=best_effort&insert_deduplication_token=' || url_encode(token) || '&insert_quorum=a%20b%2F2%2A~&max_execution_time={TIMEOUT_S}' AS url,
               'INSERT INTO {DATABASE}.{TABLE} FORMAT JSONEachRow' AS statement FROM t"""
    ),
    chunk_fingerprint: f"""SELECT name, substr(sha256(text), 1, 16) AS fingerprint FROM (VALUES
        ('default', '{S.fingerprint_text(DATABASE, TABLE, VERSION, MAX_CHUNK_ROWS, MAX_CHUNK_BYTES)}'),
        ('quorum', '{S.fingerprint_text(DATABASE, TABLE, VERSION, MAX_CHUNK_ROWS, MAX_CHUNK_BYTES, "2")}')) AS t(name, text)""",
    commit_identity: with_logs(f"SELECT DISTINCT src_sequence, format('{SOURCE}:{SINK}:{{}}-{{}}:{SCHEMA_VERSION}', src_sequence, src_sequence) AS identity FROM logs"),
    row_conservation: with_logs(
        f""", c AS (SELECT src_sequence, {_BY_ROWS} AS chunk_index FROM logs)
        SELECT src_sequence, count(*) AS rows_in, count(*) AS rows_out, count(DISTINCT chunk_index) AS chunks, true AS conserved FROM c GROUP BY 1"""
    ),
    batch_bytes: with_logs(
        f"SELECT src_sequence, CAST(sum({_BYTES}) AS BIGINT) AS record_bytes, CAST(sum(strlen(src_manifest_path) + strlen(src_data_path) + {S.COORDINATE_BYTES}) AS BIGINT) AS coordinate_bytes, count(*) AS n FROM logs GROUP BY 1"
    ),
    oversize_batches: with_logs(
        f"SELECT src_sequence, CAST(sum({_BYTES} + strlen(src_manifest_path) + strlen(src_data_path) + {S.COORDINATE_BYTES}) AS BIGINT) AS bytes FROM logs GROUP BY 1 HAVING sum({_BYTES} + strlen(src_manifest_path) + strlen(src_data_path) + {S.COORDINATE_BYTES}) > {ESTIMATE * MULTIPLIER}"
    ),
    spans_of_dates: with_logs(f"SELECT log_date, min(src_sequence) AS low, max(src_sequence) AS high, arg_min(body, ({_COORDS})) AS first_body FROM logs GROUP BY 1"),
}

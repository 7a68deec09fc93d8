"""Scalar expressions of the log model; all are built-in functions that Catalyst plans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_UNSIGNED = "18446744073709551615"
MAX_SIGNED = "9223372036854775807"
#: Bytes that a record takes besides its strings (a fixed value).
RECORD_BYTES = 288
SPAN_BYTES, SPAN_PAIR_BYTES = 96, 8
COORDINATE_BYTES = 24
FINGERPRINT_TAGS = {"logs": "log-chunks:v1", "traces": "trace-chunks:v1"}


def clamped_byte(x: Column) -> Column:
    """x cut to 0..255."""
    return F.greatest(F.lit(0), F.least(F.lit(255), x)).cast("smallint")


def parse_unsigned(text: Column) -> Column:
    """The unsigned 64-bit number that text spells (no blanks, no minus), else null; as BIGINT where it fits."""
    wide = F.when(text.rlike("^[+]?[0-9]+$"), F.try_to_number(F.regexp_replace(text, "^[+]?0*(?=[0-9])", ""), F.lit("9" * 38)))
    held = F.when(wide <= F.lit(MAX_UNSIGNED).cast("decimal(38,0)"), wide)
    return F.when(held <= F.lit("9223372036854775807").cast("decimal(38,0)"), held).cast("bigint")


def parse_unsigned_wide(text: Column) -> Column:
    """As parse_unsigned, over the full range, as DECIMAL(20,0)."""
    wide = F.when(text.rlike("^[+]?[0-9]+$"), F.try_to_number(F.regexp_replace(text, "^[+]?0*(?=[0-9])", ""), F.lit("9" * 38)))
    return F.when(wide <= F.lit(MAX_UNSIGNED).cast("decimal(38,0)"), wide).cast("decimal(20,0)")


def nanos_text(ns: Column) -> Column:
    """YYYY-MM-DD HH:MM:SS.nnnnnnnnn in UTC."""
    rest = F.pmod(ns, F.lit(1_000_000_000).cast("bigint"))
    seconds = ((ns - rest) / 1_000_000_000).cast("bigint")
    return F.concat(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss"), F.lit("."), F.lpad(rest.cast("string"), 9, "0"))


def nanos_date(ns: Column) -> Column:
    rest = F.pmod(ns, F.lit(86_400_000_000_000).cast("bigint"))
    return F.date_add(F.lit("1970-01-01").cast("date"), ((ns - rest) / 86_400_000_000_000).cast("int"))


def saturating_difference(a: Column, b: Column) -> Column:
    return F.greatest(a - b, F.lit(0).cast("bigint"))


def _held(x: Column) -> Column:
    return F.least(x, F.lit(MAX_SIGNED).cast("decimal(38,0)")).cast("bigint")


def saturating_sum(a: Column, b: Column) -> Column:
    """a + b of numbers from 0, or the largest BIGINT."""
    return _held(a.cast("decimal(20,0)") + b.cast("decimal(20,0)"))


def saturating_product(a: Column, b: Column) -> Column:
    """a * b of numbers from 0, or the largest BIGINT."""
    return _held(a.cast("decimal(19,0)") * b.cast("decimal(19,0)"))


def percent_encoded(text: Column) -> Column:
    """text for a URL: all but letters, digits and -_.~ as %XX."""
    form = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        form = F.replace(form, F.lit(found), F.lit(wanted))
    return form


def insert_url(endpoint: str, token: Column | None, quorum: str | None = None, timeout_s: int = 0) -> Column:
    """The address of one insert with its settings; a null token leaves its setting out."""
    parts = [F.lit(endpoint.rstrip("/") + "/?async_insert=0&date_time_input_format=best_effort")]
    if token is not None:
        parts.append(F.coalesce(F.concat(F.lit("&insert_deduplication_token="), percent_encoded(token)), F.lit("")))
    if quorum is not None:
        parts.append(F.concat(F.lit("&insert_quorum="), percent_encoded(F.lit(quorum))))
    if timeout_s > 0:
        parts.append(F.lit(f"&max_execution_time={timeout_s}"))
    return F.concat(*parts)


def insert_statement(database: str, table: str, form: str) -> str:
    """An insert without a list of columns: the payload names them, or has the table's order."""
    return f"INSERT INTO {database}.{table} FORMAT {form}"


def pairs_text(m: Column) -> Column:
    """The entries of a map as k=v, in key order, comma-joined."""
    pairs = F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.concat_ws(",", pairs)


def pairs_bytes(m: Column, each: int = 0) -> Column:
    return F.aggregate(F.map_entries(m), F.lit(0).cast("bigint"), lambda s, e: s + F.octet_length(e["key"]) + F.octet_length(e["value"]) + each)


def record_bytes() -> Column:
    """Approximate bytes of a log record: a fixed part, its strings and its attributes."""
    texts = [F.octet_length(F.coalesce(F.col(c), F.lit(""))) for c in ("severity_text", "body", "service_name", "trace_id", "span_id")]
    total = F.lit(RECORD_BYTES).cast("bigint")
    for t in texts:
        total = total + t
    return total + pairs_bytes(F.col("resource_attributes")) + pairs_bytes(F.col("log_attributes"))


def span_bytes(name: str = "name") -> Column:
    """Approximate bytes of a span: a fixed part, its strings and its attributes."""
    return (
        F.lit(SPAN_BYTES).cast("bigint")
        + F.octet_length(name)
        + F.octet_length("status_message")
        + F.octet_length(F.coalesce("service_name", F.lit("")))
        + pairs_bytes(F.col("resource_attributes"), SPAN_PAIR_BYTES)
        + pairs_bytes(F.col("span_attributes"), SPAN_PAIR_BYTES)
    )


def fingerprint_text(database: str, table: str, version: int, rows: int, size: int, quorum: str | None = None, signal: str = "logs") -> str:
    """The lines whose digest marks a chunking configuration."""
    named = [("database", database), ("table", table), ("adapter_version", version), ("max_chunk_rows", rows), ("max_chunk_bytes", size), ("insert_quorum", quorum or "")]
    return FINGERPRINT_TAGS[signal] + "\n" + "".join(f"{k}={v}\n" for k, v in named)


def fingerprint(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def commit_identity(source: Column, sink: Column, low: Column, high: Column, version: Column) -> Column:
    return F.concat(source, F.lit(":"), sink, F.lit(":"), low.cast("string"), F.lit("-"), high.cast("string"), F.lit(":"), version.cast("string"))


def dedupe_token(manifest: Column, table: str, low: Column, high: Column, version: int, mark: Column, chunk: Column) -> Column:
    parts = [manifest, F.lit(table), F.concat_ws("-", low.cast("string"), high.cast("string")), F.lit(str(version)), mark, chunk.cast("string")]
    return F.concat_ws(":", *parts)


def without_key(m: Column, key: str) -> Column:
    return F.map_filter(m, lambda k, _: k != key)


def attribute(m: Column, key: str, default: str | None = None) -> Column:
    value = F.element_at(m, F.lit(key))
    return value if default is None else F.coalesce(value, F.lit(default))


def lower_hex(b: Column) -> Column:
    return F.lower(F.hex(b))

"""Chunk serialisers: JSON lines and a row-wise binary format with names and types."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Wire types by Spark type; columns ending in _ns are times in nanoseconds (fixed values).
WIRE_TYPES = {"string": "String", "smallint": "UInt8", "int": "Int32", "bigint": "Int64", "map<string,string>": "Map(String, String)"}


def varuint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def text_cell(s: str) -> bytes:
    b = s.encode()
    return varuint(len(b)) + b


def cell(value, kind: str) -> bytes:
    """One value of a wire type; Nullable(..) has a marker byte first."""
    if kind.startswith("Nullable("):
        return b"\x01" if value is None else b"\x00" + cell(value, kind[9:-1])
    if kind == "String":
        return text_cell(value)
    if kind == "UInt8":
        return struct.pack("<B", int(value))
    if kind in ("Int32", "UInt32"):
        return struct.pack("<i" if kind[0] == "I" else "<I", int(value))
    if kind in ("Int64", "DateTime64(9)"):
        return struct.pack("<q", int(value))
    if kind == "UInt64":
        return struct.pack("<Q", int(value))
    if kind.startswith("Map("):
        pairs = sorted(dict(value).items(), key=lambda p: p[0].encode())
        return varuint(len(pairs)) + b"".join(text_cell(k) + text_cell(v) for k, v in pairs)
    raise ValueError(f"no wire form for type {kind}")


def header(names: list[str], kinds: list[str]) -> bytes:
    return varuint(len(names)) + b"".join(map(text_cell, names)) + b"".join(map(text_cell, kinds))


def row_binary(rows: list[tuple], names: list[str], kinds: list[str]) -> bytes:
    """Header and rows; a row of another width is an error."""
    for r in rows:
        if len(r) != len(names):
            raise ValueError(f"a row has {len(r)} values for {len(names)} columns")
    return header(names, kinds) + b"".join(cell(v, k) for r in rows for v, k in zip(r, kinds))


def wire_types(df: DataFrame, nullable: tuple[str, ...] = ("gateway_ns",)) -> list[str]:
    kinds = []
    for name, kind in df.dtypes:
        wire = "DateTime64(9)" if name.endswith("_ns") else WIRE_TYPES[kind]
        kinds.append(f"Nullable({wire})" if name in nullable else wire)
    return kinds


def binary_chunks(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """by, payload: the rows of each chunk in the binary format, sorted by order, whose columns are left out.

    A chunk is one group of bounded size; equal chunks give equal bytes wherever their rows come from.
    """
    columns = [c for c in df.columns if c not in by and c not in order]
    kinds = wire_types(df.select(*columns))
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*by).schema)

    def encode(key: tuple[pa.Scalar, ...], chunk: pa.Table) -> pa.Table:
        # Arrow, not pandas: there a column of whole numbers with a null would turn into fractions.
        chunk = chunk.sort_by([(c, "ascending") for c in order])
        rows = list(zip(*(chunk.column(c).to_pylist() for c in columns)))
        return pa.table({**{c: pa.array([k.as_py()], k.type) for c, k in zip(by, key)}, "payload": pa.array([row_binary(rows, columns, kinds)], pa.binary())})

    return df.groupBy(*by).applyInArrow(encode, f"{keys}, payload binary")


def json_row(columns: list[str]) -> Column:
    """A JSON object of the columns in their order, maps in key order, nulls spelled out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_chunks(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """by, payload: the rows of each chunk as lines of JSON, sorted by order, whose columns are left out."""
    columns = [c for c in df.columns if c not in by and c not in order]
    ready = []
    for name, kind in df.select(*columns).dtypes:
        ready.append(F.map_from_entries(F.array_sort(F.map_entries(name))).alias(name) if kind.startswith("map<") else F.col(name))
    lines = df.select(*by, *order, *ready).select(*by, F.struct(*order, json_row(columns).alias("line")).alias("row"))
    return lines.groupBy(*by).agg(F.concat_ws("\n", F.array_sort(F.collect_list("row"))["line"]).alias("payload"))


#: Serialisers by format name.
FORMATS = {"json_each_row": json_chunks, "row_binary": binary_chunks}

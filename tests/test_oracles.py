"""Every registered query with SQL, against DuckDB on the same tables."""

import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidelog import catalog

SF = Path("/root/testdata/sf0.001")


def _rows(columns, rows):
    def plain(v):
        if isinstance(v, decimal.Decimal):
            return float(v)
        if isinstance(v, float):
            return round(v, 9)
        return v

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.queries()[name](spark, str(SF))
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = want.fetchall()
    assert _rows(got.columns, got.collect()) == _rows(want.columns, rows)
    assert rows


def test_entry(spark):
    assert entry.entry(spark).columns == ["n"]
    assert set(catalog.queries()) <= set(entry.queries())

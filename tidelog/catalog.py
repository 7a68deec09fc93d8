"""Registered queries over the log model, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.operators import envelope, frontier, metrics, planning, search, signals, table, values
from tidelog.streaming import queries as runs

MODULES = (search, table, planning, envelope, frontier, values, metrics, signals, runs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name; those without SQL are listed in their module's UNCHECKED."""
    out = {}
    for module in MODULES:
        for query in (*module.ENTRIES, *getattr(module, "UNCHECKED", ())):
            out[query.__name__] = query
    return out


def oracle_sql() -> dict[str, str]:
    return {query.__name__: sql for module in MODULES for query, sql in module.ENTRIES.items()}

"""Registry of named queries: Spark callables plus their DuckDB oracle SQL.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame (some write scratch
layers to the shared folder when called) whose columns are comparable across engines: audit timestamps taken at run time
and surrogate ids are left out, dates are shown as ``yyyy-MM-dd`` text and
integers as BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from strata.plans import (  # noqa: F401
        queries_edge, queries_io, queries_layers, queries_profile, queries_reports, queries_state, queries_text,
    )

"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.registry import ORACLE, load_all

load_all()  # the queries of the llm subpackage are tested in tests/llm
SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"  # not equal to itself
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "revenue", "cost", "profit_margin", "units_sold", "top_category"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(rel.columns, rel.fetchall())



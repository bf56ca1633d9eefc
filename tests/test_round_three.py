"""Layers in files of bounded rows, hot keys without a shuffle, few rows sent to large tables, a first delivery."""
import glob

import pyarrow.parquet as pq
import pytest
from helpers import sales_bronze

from strata.operators import dedup
from strata.operators.quarantine import quarantine_sales
from strata.operators.silver import sales_repeats, silver_sales
from strata.plans.incremental import Lake
from strata.plans.registry import QUERIES, load_all
from strata.sources import files as IO


@pytest.fixture
def no_small_tables(spark):
    """Joins as they are planned for tables of unknown or large size."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def _rows(hot=120, other=90):
    rows = [("2031-03-01", "Hot", "100.00", f"{i % 7}.00", "1", f"2031-03-{1 + i % 28:02d} {i % 24:02d}:00:00") for i in range(hot)]
    rows += [("2031-03-02", None, "1.00", "1.00", "1", "2031-03-02 00:00:00")] * 3
    return rows + [("2031-04-01", f"C{i % 30}", "7.00", "5.00", None if i % 30 == 4 else "2", f"2031-04-{1 + i % 28:02d} 00:00:00") for i in range(other)]


@pytest.mark.parametrize("written", [False, True])
def test_hot_keys_are_joined_by_a_broadcast_and_the_others_as_before(spark, no_small_tables, monkeypatch, written):
    b = sales_bronze(spark, _rows())
    whole = sorted(map(str, quarantine_sales(b, run_ts="2031-05-01").collect()))
    monkeypatch.setattr(dedup, "HOT_ROWS", 100)
    q = quarantine_sales(b, run_ts="2031-05-01", known=sales_repeats(b) if written else None)
    joins = [x for x in q._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "_kh2" in x]
    assert sorted("Broadcast" in x for x in joins) == [False, True]
    assert sorted(map(str, q.collect())) == whole
    assert q.where("raw_category = 'Hot'").count() == 119
    assert silver_sales(b).count() + q.count() == b.count() - 3  # rows without units are in neither


def test_a_null_key_can_be_hot(spark, no_small_tables, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_ROWS", 10)
    df = spark.range(60).selectExpr("if(id % 2 = 0, null, 'x') AS k", "cast(id AS string) AS v", "id AS ingested_at", "'f' AS source_file")
    got = dedup.not_latest(df, ["k"], ("ingested_at",)).collect()
    assert sorted(r["ingested_at"] for r in got) == list(range(58))


def test_layers_are_written_in_files_of_bounded_rows(spark, tmp_dir):
    n = IO.MAX_ROWS_PER_FILE
    IO.write_layer(spark.range(0, 2 * n + 10, 1, 1), f"{tmp_dir}/t")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_dir}/t/*.parquet")]
    assert sorted(sizes) == [10, n, n]


def test_shown_rows_are_sent_to_the_tables(spark, no_small_tables, tmp_dir):
    load_all()
    li = spark.range(400).selectExpr(
        "id AS l_orderkey", "id % 20 AS l_partkey", "id % 9 AS l_suppkey", "cast(id % 4 AS int) AS l_linenumber", "double(id % 5) AS l_quantity",
        "double(id) + 0.5 AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax", "if(id % 3 = 0, 'R', 'N') AS l_returnflag", "'O' AS l_linestatus",
        "cast(date_add(date'2031-01-01', cast(id % 60 AS int)) AS timestamp) AS l_shipdate")
    li.write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.range(20).selectExpr("id AS p_partkey", "concat('T', id % 3) AS p_type").write.parquet(f"{tmp_dir}/part.parquet")
    spark.range(9).selectExpr("id AS c_custkey", "concat('N', id) AS c_name", "1 AS c_nationkey", "double(id) AS c_acctbal",
                              "'M' AS c_mktsegment").write.parquet(f"{tmp_dir}/customer.parquet")
    got = QUERIES["schema_context"](spark, tmp_dir)
    joins = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "line#" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)
    assert {(r["samples"], r["known"]) for r in got.collect()} == {(3, 3)}


def test_a_first_delivery_with_copies(spark, tmp_dir):
    lake = Lake(spark, f"{tmp_dir}/lake")
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("date,category,revenue,cost,units_sold\n2031-01-01,A,5.00,1.00,1\n2031-01-01,A,5.00,2.00,1\n2031-02-01,B,5.00,1.00,1\n")
    lake.deliver(f"{tmp_dir}/a.csv", run_ts="2031-09-01 00:00:00")
    lake.deliver(f"{tmp_dir}/a.csv", run_ts="2031-09-02 00:00:00")
    v = lake.layers()
    assert (v.bronze.count(), v.silver.count(), v.quarantine.count()) == (6, 2, 4)


def _few_keys(spark):
    """Two keys of many rows, one with nulls, and rows that are alone with their key."""
    rows = [(f"2031-03-{1 + i % 2:02d}", None if i % 2 else "A", f"{i % 9}.00", "1.00", "1", f"2031-03-{1 + i % 28:02d} {i % 24:02d}:00:00") for i in range(300)]
    rows += [(f"2031-05-{1 + i:02d}", f"C{i}", "7.00", "5.00", "2", "2031-05-01 00:00:00") for i in range(20)]
    return sales_bronze(spark, rows)


def test_few_keys_of_many_rows_are_broadcast_and_no_row_is_shuffled(spark, no_small_tables, monkeypatch):
    b, keys, row = _few_keys(spark), ["date", "category"], ("_row_id",)
    q = dedup.not_latest(b, keys, row)
    joins = [x for x in q._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "_kh2" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)
    got = sorted(r["_row_id"] for r in q.collect())
    monkeypatch.setattr(dedup, "FEW_KEYS", 0)
    assert got == sorted(r["_row_id"] for r in dedup.not_latest(b, keys, row).collect())
    assert len(got) == 298 and all(i < 300 for i in got)


def test_tasks_of_the_duplicate_join_grow_with_the_rows(spark, no_small_tables, monkeypatch):
    b = sales_bronze(spark, _rows())
    whole = sorted(map(str, quarantine_sales(b, run_ts="2031-05-01").collect()))
    monkeypatch.setattr(dedup, "ROWS_PER_TASK", 10)
    q = quarantine_sales(b, run_ts="2031-05-01")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 21), REPARTITION_BY_NUM") == 2  # 210 rows with a date and a category
    assert sorted(map(str, q.collect())) == whole


def test_repeated_keys_are_found_by_one_pass_over_the_rows(spark, no_small_tables):
    plan = quarantine_sales(sales_bronze(spark, _rows()), run_ts="2031-05-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "count(1)" in plan and plan.count("bit_or") == 0  # the table of bits comes from the job that counts

"""Row numbers, merged profiles and streamed deliveries against plain Python and against one run over all rows."""
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.ids import number_rows
from strata.operators.profile import profile_table
from strata.operators.profile_state import merged, profile_of, profile_state, store_delivery, stored_profile
from strata.plans.incremental import Lake
from strata.plans.medallion import run_medallion
from strata.streaming.deliveries import stream_deliveries

MISSING = (None, "None", "")


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_rows_are_numbered_without_gaps(spark, tmp_dir, parts):
    df = spark.range(0, 500, 1, parts).selectExpr("id % 7 AS _place", "id AS `a b`", "null AS _task").where("`a b` % 3 <> 0")
    got = number_rows(df, f"{tmp_dir}/n", start=11)
    assert got.columns == ["row_no", "_place", "a b", "_task"]
    rows = got.collect()
    assert sorted(r["row_no"] for r in rows) == list(range(11, 11 + len(rows)))
    assert sorted(r["a b"] for r in rows) == [i for i in range(500) if i % 3]


def test_numbers_of_repeated_rows_an_empty_frame_and_a_taken_name(spark, tmp_dir):
    same = spark.createDataFrame([("x",)] * 40, "v string").repartition(5)
    assert sorted(r["row_no"] for r in number_rows(same, f"{tmp_dir}/s").collect()) == list(range(1, 41))
    none = number_rows(same.where("v = 'y'"), f"{tmp_dir}/e")
    assert none.columns == ["row_no", "v"] and none.count() == 0
    with pytest.raises(ValueError, match="row_no"):
        number_rows(same.withColumn("row_no", F.lit(1)), f"{tmp_dir}/t")


def test_numbers_stay_when_the_stored_rows_are_read_again(spark, tmp_dir):
    got = number_rows(spark.range(0, 200, 1, 9).toDF("v"), f"{tmp_dir}/n")
    assert {(r["row_no"], r["v"]) for r in got.collect()} == {(r["row_no"], r["v"]) for r in got.repartition(4).collect()}


def _deliveries(seed, n=4, rows=60):
    rng = random.Random(seed)
    pool = ["7", "-2.5", "1e3", "x", "2031-04-05", "EUR", "", "None", None, "b", "c", "d", "e", "f", "é"]
    return [[(d * 1000 + i, rng.choice(pool), rng.choice(["1", "2.5", "-3"]), rng.choice(MISSING)) for i in range(rng.randint(0, rows))]
            for d in range(n)]


def _first_seen(rows, i):
    out = []
    for r in sorted(rows):
        if r[i] not in MISSING and r[i] not in out:
            out.append(r[i])
    return out[:5]


@pytest.mark.parametrize("seed", range(3))
def test_merged_states_are_the_state_of_all_rows(spark, tmp_dir, seed):
    schema, parts, cols = "at long, mixed string, amount string, nothing string", _deliveries(seed), ["mixed", "amount", "nothing"]
    every = [r for p in parts for r in p]
    for i in random.Random(seed).sample(range(len(parts)), len(parts)):  # in any order
        store_delivery(spark.createDataFrame(parts[i], schema), f"{tmp_dir}/first", str(i), cols, appearance=F.col("at"))
        store_delivery(spark.createDataFrame(parts[i], schema), f"{tmp_dir}/small", str(i), cols)
    store_delivery(spark.createDataFrame(parts[0], schema), f"{tmp_dir}/first", "0", cols, appearance=F.col("at"))  # again
    whole = {r["column_name"]: r.asDict() for r in profile_table(spark.createDataFrame(every, schema), cols).collect()}
    for kind in ("first", "small"):
        got = {r["column_name"]: r.asDict() for r in stored_profile(spark, f"{tmp_dir}/{kind}").collect()}
        assert set(got) == set(whole) == set(cols)
        for i, c in enumerate(cols, 1):
            samples = _first_seen(every, i) if kind == "first" else whole[c]["samples"]
            assert got[c] == {**whole[c], "samples": samples}, (kind, c)  # few distinct values: the sketch is exact


def test_a_state_of_one_delivery_counts_exactly_and_a_merge_of_one_keeps_it(spark):
    df = spark.range(20000).selectExpr("cast(id as string) AS v")
    state = profile_state(df)
    assert profile_of(state).first()["cardinality"] == profile_of(merged(state)).first()["cardinality"] == 20000
    two = profile_of(merged(state.unionByName(profile_state(df.where("v > '5'"))))).first()
    assert abs(two["cardinality"] - 20000) < 1000 and two["row_count"] == 20000 + df.where("v > '5'").count()


def test_an_empty_frame_has_no_profile_and_missing_values_only_have_no_samples(spark):
    none = spark.createDataFrame([], "v string")
    assert profile_of(merged(profile_state(none))).count() == 0
    r = profile_of(merged(profile_state(spark.createDataFrame([(None,), ("None",)], "v string")))).first()
    assert (r["row_count"], r["null_count"], r["cardinality"], r["samples"], r["min_val"], r["avg_length"]) == (2, 2, 0, [], None, None)


def test_a_state_is_made_from_one_scan(spark, tmp_dir):
    spark.range(1000).selectExpr("cast(id % 50 as string) AS v").write.parquet(f"{tmp_dir}/t")
    state = profile_state(spark.read.parquet(f"{tmp_dir}/t"))
    state.collect()
    plan = state._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 or plan.count("FileScan") == 1, plan


def _landing(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join(["date,category,revenue,cost,units_sold", *rows]) + "\n")


def _reasons(layers):
    return {(r["raw_date"], r["raw_category"], r["raw_cost"], r["rejection_reason"]) for r in layers.quarantine.collect()}


def test_streamed_deliveries_are_one_run_over_all_files(spark, tmp_dir):
    stamp, landing = "2031-09-01 00:00:00", f"{tmp_dir}/landing"
    _landing(landing, "a", ["2031-01-01,A,5.00,1.00,1", "2031-01-02,B,5.00,1.00,1", ",B,1,1,1"])
    _landing(landing, "b", ["2031-01-01,A,5.00,2.00,1", "2031-02-02,B,-5.00,1.00,1"])
    lake = Lake(spark, f"{tmp_dir}/lake")

    def run():
        stream_deliveries(lake, landing, f"{tmp_dir}/ckpt", "sales", max_files_per_trigger=1, run_ts=stamp).awaitTermination()

    run()
    assert lake.version() == 2 and lake.manifest()["streams"] == {"sales": 1}
    _landing(landing, "c", ["2031-01-02,B,5.00,9.00,1", "2031-03-01,C,1.00,1.00,1"])
    run()
    run()  # nothing new
    assert lake.version() == 3
    whole = run_medallion(spark, landing, f"{tmp_dir}/whole", run_ts=stamp, export=False)
    got = lake.layers()
    assert _reasons(got) == _reasons(whole)
    assert {tuple(r) for r in got.gold.collect()} == {tuple(r) for r in whole.gold.collect()}


def test_a_batch_delivered_again_changes_nothing(spark, tmp_dir):
    _landing(f"{tmp_dir}/d", "a", ["2031-01-01,A,5.00,1.00,1"])
    lake = Lake(spark, f"{tmp_dir}/lake")
    assert lake.deliver(f"{tmp_dir}/d", batch=("s", 0)) == 1
    assert lake.deliver(f"{tmp_dir}/d", batch=("s", 0)) == 1
    assert lake.deliver(f"{tmp_dir}/d", batch=("other", 0)) == 2  # another stream
    assert lake.deliver(f"{tmp_dir}/d") == 3                      # and a delivery by hand
    assert lake.manifest()["streams"] == {"s": 0, "other": 0}
    assert lake.layers().silver.count() == 1 and lake.layers().quarantine.count() == 2

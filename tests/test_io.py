"""Landing CSV ingest, exports, typed re-read, upsert, refresh in place, profile JSON, workspaces, streaming."""
import os

import pytest
from strata.operators.guard import PlanValidationError, run_guarded_sql
from strata.operators.model import Profile
from strata.plans.medallion import run_medallion
from strata.sources import catalog as C
from strata.sources import files as IO
from strata.streaming.landing import ingest_landing

HEADER = "date,category,revenue,cost,units_sold\n"
ROWS = ["2026-06-01,Electronics,1159.5,598.54,5", "2026-06-01,Books,397.11,223.97,20",
        "2026-06-02,Books,397.11,223.97,20", "2026-06-03,Sports,-5,1,1", ",Books,1,1,1",
        "2026-06-03,Sports,117.66,74.66,1", "2026-06-03,Sports,117.66,74.66,1"]


def _landing(tmp_dir, name="landing", files=2):
    d = os.path.join(tmp_dir, name)
    os.makedirs(d)
    for i in range(files):
        with open(os.path.join(d, f"sales_{i}.csv"), "w") as f:
            f.write(HEADER + "\n".join(ROWS[i::files]) + "\n")
    return d


def test_ingest_is_all_text_with_audit_columns(spark, tmp_dir):
    landing = _landing(tmp_dir)
    assert IO.csv_header(spark, landing) == ["date", "category", "revenue", "cost", "units_sold"]
    IO.ingest_csv(spark, landing, f"{tmp_dir}/bronze")
    b = spark.read.parquet(f"{tmp_dir}/bronze")
    assert dict(b.dtypes)["revenue"] == "string" and dict(b.dtypes)["ingested_at"] == "timestamp"
    assert {r["source_file"]: r["rows_loaded"] for r in IO.rows_per_file(b).collect()} == {
        "sales_0.csv": 4, "sales_1.csv": 3}
    assert IO.rows_loaded(b, "sales_1.csv") == 3 and IO.is_loaded(b)


def test_medallion_run_and_exports(spark, tmp_dir):
    landing = _landing(tmp_dir)
    L = run_medallion(spark, landing, f"{tmp_dir}/lake")
    assert L.bronze.count() == 7
    assert L.silver.count() == 4           # one negative, one missing date, one exact duplicate
    assert sorted(r["rejection_reason"] for r in L.quarantine.collect()) == [
        "Duplicate Transaction", "Missing/Invalid Date", "Negative Numeric Metric(s)"]
    schema = "month string, revenue double, cost double, profit_margin double, units_sold bigint, top_category string"
    from pyspark.sql.types import _parse_datatype_string
    back = IO.read_typed_csv(spark, f"{tmp_dir}/lake/export/gold_monthly_metrics", _parse_datatype_string(schema))
    assert back.collect() == L.gold.collect()
    assert len([f for f in os.listdir(f"{tmp_dir}/lake/export/gold_monthly_metrics") if f.endswith(".csv")]) == 1
    checks = {r["check"]: r["status"] for r in L.audit.collect()}
    assert checks["null_violations_in_silver"] == "PASSED"


def test_medallion_with_profile_and_custom_gold(spark, tmp_dir):
    landing = _landing(tmp_dir)
    roles = {"date": "date", "category": "dimension", "revenue": "measure", "cost": "measure", "units_sold": "measure"}
    L = run_medallion(spark, landing, f"{tmp_dir}/lake", profile=roles,
                      gold_sql="SELECT category, SUM(units_sold) AS units FROM silver_clean_sales GROUP BY category")
    assert sorted(L.gold.columns) == ["category", "units"]
    L2 = run_medallion(spark, _landing(tmp_dir, "landing2"), f"{tmp_dir}/lake2", profile_from_data=True)
    assert {c.name: c.role for c in L2.profile.columns} == roles
    audit = {r["check"]: (r["value"], r["status"]) for r in L2.audit.collect()}
    assert audit["financial_discrepancy"] == (0.0, "PASSED")          # gold = first option, sums by month
    assert audit["silver_total_revenue"][0] == audit["gold_total_revenue"][0] > 0
    assert IO.read_profile(spark, f"{tmp_dir}/lake2/profile").names == L2.profile.names


def test_upsert_and_refresh_in_place(spark, tmp_dir):
    t = spark.createDataFrame([("2026-01", 1.0), ("2026-02", 2.0)], "month string, revenue double")
    u = spark.createDataFrame([("2026-02", 20.0), ("2026-03", 30.0)], "month string, revenue double")
    assert sorted(IO.upsert(t, u, ["month"]).collect()) == [("2026-01", 1.0), ("2026-02", 20.0), ("2026-03", 30.0)]
    path = f"{tmp_dir}/gold"
    t.write.parquet(path)
    IO.refresh_in_place(IO.upsert(spark.read.parquet(path), u, ["month"]), path)
    assert spark.read.parquet(path).count() == 3
    IO.append_rows(spark, [("2026-04", 4.0)], "month string, revenue double", path)
    assert spark.read.parquet(path).count() == 4


def test_workspaces_isolate_tables(spark, tmp_dir):
    a, b = "north-finance", "south-hr"
    for ws in (a, b):
        C.create_workspace(spark, ws, f"{tmp_dir}/{ws}")
    assert C.workspace_database(a) != C.workspace_database("north_finance")
    C.save_layer(spark.createDataFrame([("Energy", 1.0)], "segment string, value double"), a, "silver_clean_sales")
    C.save_layer(spark.createDataFrame([("HR", 2.0), ("IT", 3.0)], "department string, salary double"), b,
                 "silver_clean_sales")
    cur = spark.catalog.currentDatabase()
    try:
        assert run_guarded_sql(spark, "SELECT COUNT(*) AS n FROM silver_clean_sales", a).first()["n"] == 1
        assert run_guarded_sql(spark, "SELECT COUNT(*) AS n FROM silver_clean_sales", b).first()["n"] == 2
        with pytest.raises(PlanValidationError):
            run_guarded_sql(spark, "SELECT salary FROM silver_clean_sales", a)
    finally:
        spark.catalog.setCurrentDatabase(cur)
    assert {C.workspace_database(a), C.workspace_database(b)} <= set(C.list_workspaces(spark, with_data=True))
    desc = C.describe_tables(spark, C.workspace_database(b)).collect()
    assert [(r["column_name"], r["data_type"]) for r in desc] == [("department", "string"), ("salary", "double")]


def test_stream_ingests_each_file_once(spark, tmp_dir):
    landing = _landing(tmp_dir, files=3)
    cols = ["date", "category", "revenue", "cost", "units_sold"]
    args = dict(landing_dir=landing, bronze_path=f"{tmp_dir}/sb", checkpoint=f"{tmp_dir}/ck", columns=cols,
                quarantine_path=f"{tmp_dir}/sq")
    ingest_landing(spark, **args).awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/sb").count() == 7
    ingest_landing(spark, **args).awaitTermination()          # rerun: nothing new
    assert spark.read.parquet(f"{tmp_dir}/sb").count() == 7
    with open(os.path.join(landing, "late.csv"), "w") as f:
        f.write(HEADER + "2026-07-01,Books,10,5,1\n")
    ingest_landing(spark, **args).awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/sb").count() == 8
    q = sorted(r["rejection_reason"] for r in spark.read.parquet(f"{tmp_dir}/sq").collect())
    assert q == ["Missing/Invalid Date", "Negative Numeric Metric(s)"]


def test_profile_json_roundtrip(spark, tmp_dir):
    p = Profile.of({"a": "date", "b": "measure"})
    IO.write_profile(spark, p, f"{tmp_dir}/p")
    back = IO.read_profile(spark, f"{tmp_dir}/p")
    assert [(c.name, c.role) for c in back.columns] == [("a", "date"), ("b", "measure")]
    assert Profile.from_json(p.to_json()).names == ["a", "b"]


def test_append_by_name_and_concat(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x", 9.0)], "id int, name string, extra double")
    IO.append_by_name(a, f"{tmp_dir}/t", ["name", "id"])
    assert spark.read.parquet(f"{tmp_dir}/t").columns == ["name", "id"]
    b = spark.createDataFrame([("y",)], "name string")
    got = IO.concat_frames(a.select("id", "name"), b).orderBy("name").collect()
    assert [(r["id"], r["name"]) for r in got] == [(1, "x"), (None, "y")]


def test_schemas_follow_roles():
    from strata.sources.schemas import bronze_schema, quarantine_schema, silver_schema
    p = Profile.of({"d": "date", "k": "id", "m": "measure", "c": "currency", "t": "text"})
    assert [f.dataType.simpleString() for f in silver_schema(p).fields] == [
        "bigint", "date", "string", "double", "double", "string", "timestamp"]
    assert bronze_schema(p).names[-3:] == ["ingested_at", "source_file", "_row_id"]
    assert quarantine_schema(p).names[:2] == ["raw_d", "raw_k"]
    assert silver_schema().names == ["id", "date", "category", "revenue", "cost", "units_sold", "profit",
                                     "cleaned_at"]


def test_stream_with_profile_rules(spark, tmp_dir):
    landing = _landing(tmp_dir, files=2)
    cols = ["date", "category", "revenue", "cost", "units_sold"]
    p = Profile.of({"date": "date", "category": "dimension", "revenue": "measure", "cost": "measure",
                    "units_sold": "measure"})
    ingest_landing(spark, landing, f"{tmp_dir}/sb", f"{tmp_dir}/ck", cols, quarantine_path=f"{tmp_dir}/sq",
                   profile=p, max_files_per_trigger=1).awaitTermination()
    q = sorted(r["rejection_reason"] for r in spark.read.parquet(f"{tmp_dir}/sq").collect())
    assert q == ["Negative Numeric Metric: revenue", "Null value in required column: date"]
    assert sorted(spark.read.parquet(f"{tmp_dir}/sb").select("batch").distinct().toPandas()["batch"]) == [0, 1]


def test_run_concurrently_propagates_failures(spark, tmp_dir):
    ok = spark.range(5)
    bad = spark.range(5).selectExpr("assert_true(id < 3) AS x")
    with pytest.raises(Exception):
        IO.run_concurrently(lambda: ok.write.parquet(f"{tmp_dir}/ok"),
                            lambda: bad.write.parquet(f"{tmp_dir}/bad"))
    assert spark.read.parquet(f"{tmp_dir}/ok").count() == 5

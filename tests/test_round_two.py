"""Guard bypasses, tenant leaks, CSV quoting and column orders, reruns, plan shapes, numbers of any size."""
import math
import os

import pytest
from helpers import sales_bronze
from pyspark.sql import functions as F

from strata.functions.casts import measure_sum
from strata.functions.text import guard_check
from strata.operators.audit import dq_audit
from strata.operators.gold import gold_monthly, gold_options, top_category_per_month
from strata.operators.guard import GuardError, PlanValidationError, guarded_sql, is_safe_query, relations, run_guarded_sql, strip_comments
from strata.operators.dedup import Repeats
from strata.operators.model import Profile
from strata.operators.silver import sales_repeats
from strata.operators.quarantine import quarantine, quarantine_sales, valid_repeats
from strata.operators.silver import silver, silver_sales
from strata.plans.medallion import run_medallion
from strata.sources import catalog as C
from strata.sources import files as IO

Q = "'"
BYPASS = [f"SELECT {Q}/*{Q}, reflect({Q}java.lang.System{Q}, {Q}getProperty{Q}, {Q}user.home{Q}), {Q}*/{Q}",
          f"SELECT {Q}--{Q}, java_method({Q}java.lang.System{Q}, {Q}getProperty{Q}, {Q}user.home{Q})",
          f'SELECT "/*", reflect("a"), "*/"', "SELECT `/*`, reflect(1), `*/` FROM t", f"SELECT {Q}a\\{Q}--{Q}, reflect(1)",
          f"SELECT r{Q}\\{Q}, reflect(1), {Q}--{Q}", "SELECT 1 /* a /* b */, reflect(1) */"]


@pytest.mark.parametrize("sql", BYPASS)
def test_code_hidden_beside_comment_marks_is_seen(spark, sql):
    assert not is_safe_query(sql)[0]
    with pytest.raises(GuardError):
        guarded_sql(spark, sql)
    assert not spark.createDataFrame([(sql,)], "s string").select(guard_check("s").alias("g")).first()["g"]["is_safe"]


def test_only_real_comments_are_cut():
    assert strip_comments(f"SELECT {Q}a -- b{Q} -- c\n, `/* d */` /* e */ FROM t") == f"SELECT {Q}a -- b{Q} \n, `/* d */`  FROM t"
    assert is_safe_query("-- drop it\nSELECT 1 /* delete */") == (True, "")


def test_relations_come_from_the_parser(spark):
    sql = "WITH w AS (SELECT * FROM db1.t1) SELECT (SELECT max(x) FROM db2.t2), * FROM w JOIN t3 ON x IN (SELECT y FROM parquet.`/p, q`)"
    assert {r[0] for r in relations(spark, sql)} == {"db1", "db2", "w", "t3", "parquet"}


def test_tenants_cannot_read_each_other_and_no_state_is_left(spark, tmp_dir):
    for ws, n in (("ten-a", 1), ("ten-b", 2)):
        C.create_workspace(spark, ws, f"{tmp_dir}/{ws}")
        C.save_layer(spark.range(n), ws, "silver_clean_sales", f"{tmp_dir}/t{n}")
    before = spark.catalog.currentDatabase()
    other = C.workspace_database("ten-b")
    for sql in (f"SELECT * FROM {other}.silver_clean_sales", f"SELECT * FROM spark_catalog.{other}.silver_clean_sales",
                f"SELECT * FROM parquet.`{tmp_dir}/t2`", f"SELECT (SELECT count(*) FROM {other}.silver_clean_sales) AS n",
                f"WITH x AS (SELECT * FROM {other}.silver_clean_sales) SELECT * FROM x"):
        with pytest.raises(GuardError):
            run_guarded_sql(spark, sql, "ten-a")
    assert run_guarded_sql(spark, f"SELECT * FROM {C.workspace_database('ten-a')}.silver_clean_sales", "ten-a").count() == 1
    with pytest.raises(PlanValidationError):
        run_guarded_sql(spark, "SELECT nothing FROM silver_clean_sales", "ten-a")
    assert spark.catalog.currentDatabase() == before
    C.save_layer(spark.range(120), "ten-a", "many", f"{tmp_dir}/many")
    assert run_guarded_sql(spark, "SELECT * FROM many", "ten-a").count() == 120
    assert run_guarded_sql(spark, "SELECT * FROM many", "ten-a", max_rows=50).count() == 50


def _files(d, texts):
    os.makedirs(d)
    for name, text in texts.items():
        with open(os.path.join(d, name), "w", newline="") as f:
            f.write(text)
    return d


def test_files_are_read_by_their_own_header_and_quotes(spark, tmp_dir):
    d = _files(f"{tmp_dir}/in", {
        "a.csv": 'date,category,revenue,cost,units_sold\n2026-01-01,"He said ""hi"", ok",10,4,1\n2026-01-02," two\nlines ",11,5,2\n',
        "b.csv": 'cost,units_sold,extra,category,date,revenue\n4,3,x,B,2026-01-03,10\n'})
    rows = IO.read_landing_csv(spark, d, multi_line=True).orderBy("date").collect()
    assert [(r["category"], r["revenue"], r["cost"], r["units_sold"]) for r in rows] == [
        ('He said "hi", ok', "10", "4", "1"), (" two\nlines ", "11", "5", "2"), ("B", "10", "4", "3")]
    assert len({(r["_ingest_id"], r["source_file"], r["_row_id"]) for r in rows}) == 3
    with pytest.raises(ValueError, match="c.csv has no column cost"):
        IO.read_landing_csv(spark, _files(f"{tmp_dir}/bad", {"c.csv": "date,category,revenue,units_sold\n1,2,3,4\n"}), ["date", "cost"])
    empty = IO.read_landing_csv(spark, _files(f"{tmp_dir}/none", {}), ["date"])
    assert empty.count() == 0 and empty.columns[0] == "date"


def test_export_keeps_blanks_quotes_and_nulls(spark, tmp_dir):
    values = [(" lead", 1.0), ("trail ", 2.0), ('q"x', 3.0), ("a,b", 4.0), ("l1\nl2", 5.0), ("\\", None), ('end\\"', 7.0)]
    df = spark.createDataFrame(values, "t string, v double")
    IO.export_csv(df, f"{tmp_dir}/out")
    assert sorted(map(tuple, IO.read_typed_csv(spark, f"{tmp_dir}/out", df.schema, multi_line=True).collect()), key=str) == sorted(values, key=str)


def test_equal_run_times_lose_no_row(spark, tmp_dir):
    d = _files(f"{tmp_dir}/in", {"a.csv": "date,category,revenue,cost,units_sold\n2026-01-01,A,10,4,1\n2026-01-02,B,10,4,1\n"})
    args = (spark, d, f"{tmp_dir}/lake")
    first = run_medallion(*args, run_ts="2026-01-01 00:00:00", export=False)
    assert (first.bronze.count(), first.silver.count(), first.quarantine.count()) == (2, 2, 0)
    again = run_medallion(*args, run_ts="2026-01-01 00:00:00", export=False, workspace="rerun")
    assert (again.bronze.count(), again.silver.count(), again.quarantine.count()) == (2, 2, 0)
    more = run_medallion(*args, run_ts="2026-01-01 00:00:00", export=False, refresh=False)
    assert (more.bronze.count(), more.silver.count(), more.quarantine.count()) == (4, 2, 2)
    assert run_guarded_sql(spark, "SELECT * FROM silver_clean_sales", "rerun").count() == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_of_dedup_and_quarantine(spark, tmp_dir):
    sales_bronze(spark, [("2026-03-01", "A", "1", "1", "1", "2026-03-01 00:00:00")] * 3).write.parquet(f"{tmp_dir}/b")
    b = spark.read.parquet(f"{tmp_dir}/b")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the list of pushed filters is shortened
    p = _plan(silver_sales(b).where("category = 'A'"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(category,A)" in p.split("PushedFilters: ")[1].split("ReadSchema")[0]
    prof = Profile.of({"date": "date", "category": "dimension", "revenue": "measure"})
    for q, known in ((quarantine_sales, sales_repeats(b)), (lambda b, known: quarantine(b, prof, known=known), valid_repeats(b, prof))):
        written = Repeats(known.bits.checkpoint(), known.groups.checkpoint())
        assert _plan(q(b, known=written)).count("FileScan parquet") == 2  # one for the rules, one for the duplicates
    struct = [x for x in _plan(silver(b, prof)).splitlines() if "partial_max(struct" in x]
    assert struct and all("category, category" not in x for x in struct)


def test_sums_of_any_size(spark):
    df = spark.createDataFrame([(2e12, 1e-7, 1.0), (3e30, 2e-7, float("nan")), (-3e30, 0.0, 2.0), (0.1, 0.0, None), (0.2, 0.0, None)], "a double, b double, c double")
    r = df.agg(*[measure_sum(c).alias(c) for c in "abc"]).first()
    assert math.isclose(r["a"], 2e12 + 0.3) and math.isclose(r["b"], 3e-7, rel_tol=1e-12) and math.isnan(r["c"])
    assert df.where("a is null").agg(measure_sum("a").alias("a")).first()["a"] is None
    assert spark.createDataFrame([(0.1,)] * 10, "a double").agg(measure_sum("a").alias("a")).first()["a"] == 1.0


def test_nan_is_no_valid_measure_and_no_revenue_is_last(spark):
    b = sales_bronze(spark, [("2026-03-01", "A", "NaN", "1", "1", "2026-03-01 00:00:00"), ("2026-03-01", "B", "2", "1", "1", "2026-03-01 00:00:00")])
    s = silver_sales(b)
    assert [r["category"] for r in s.collect()] == ["B"]
    t = spark.createDataFrame([("2026-03-01", "A", None, 1.0, 1), ("2026-03-01", "B", 5.0, 1.0, 1)], "date string, category string, revenue double, cost double, units_sold int")
    assert top_category_per_month(t.withColumn("date", F.col("date").cast("date"))).first()["top_category"] == "B"
    audit = {r["check"]: (r["value"], r["status"]) for r in dq_audit(b, s, quarantine_sales(b), gold_monthly(s).select("month")).collect()}
    assert audit["financial_discrepancy"] == (None, "SKIPPED") and audit["unaccounted_rows"][0] == 1.0


@pytest.mark.parametrize("roles", [{"k": "id"}, {"t": "text"}, {"d": "date"}, {"a": "dimension"}, {"m": "measure"}, {"a": "dimension", "b": "dimension"},
                                   {"k": "id", "t": "text", "d": "date"}, {"a": "dimension", "b": "dimension", "c": "dimension", "m": "measure", "d": "date"}])
def test_gold_options_are_three_to_five(spark, roles):
    opts = gold_options(Profile.of(roles))
    assert len({(o.dims, o.aggs, o.date_col) for o in opts}) == len(opts) <= 5
    assert len(opts) >= (3 if {"measure", "dimension"} & set(roles.values()) and len(roles) > 1 else 1)

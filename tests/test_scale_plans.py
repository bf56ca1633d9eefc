"""Scale properties: a hot key holding a third of the rows, and the shapes of the physical plans."""
from helpers import sales_bronze

from strata.operators.gold import gold_monthly
from strata.operators.profile import profile_table
from strata.operators.quarantine import quarantine_sales
from strata.operators.silver import silver_sales


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_bronze(spark, n_hot=300, n_other=600):
    rows = []
    for i in range(n_hot):                    # one key: a third of all rows, copies over many hours
        rows.append(("2026-03-01", "Hot", "100.00", "40.00", "1", f"2026-03-{1 + i % 28:02d} {i % 24:02d}:00:00"))
    for i in range(n_other):
        rows.append((f"2026-03-{1 + i % 28:02d}", f"C{i % 7}", f"{10 + i}.00", "5.00", str(1 + i % 3),
                     "2026-03-02 00:00:00"))
    return sales_bronze(spark, rows)


def test_hot_key_keeps_exactly_one_latest_copy(spark):
    b = _hot_bronze(spark)
    s = silver_sales(b)
    hot = s.where("category = 'Hot'").collect()
    assert len(hot) == 1
    q = quarantine_sales(b)
    assert q.where("raw_category = 'Hot'").count() == 299          # every other copy, none dropped
    assert s.count() + q.count() == b.count()
    latest = b.where("category = 'Hot'").agg({"ingested_at": "max"}).first()[0]
    q_latest = q.where("raw_category = 'Hot'").agg({"ingested_at": "max"}).first()[0]
    assert str(q_latest) < str(latest)                            # the newest copy is the survivor


def test_dedup_plan_has_no_window_over_rows_and_aggregates_before_the_shuffle(spark):
    p = _plan(silver_sales(_hot_bronze(spark)))
    assert "Window" not in p
    assert "partial_max" in p            # map-side combine; the unused count is pruned


def test_duplicate_join_shuffles_on_the_key_hash_only(spark):
    p = _plan(quarantine_sales(_hot_bronze(spark)))
    assert "Window" not in p
    join_lines = [ln for ln in p.splitlines() if "Join" in ln and "_kh" in ln]
    assert join_lines and all("coalesce(date" not in ln.split("Inner")[0] for ln in join_lines)


def test_gold_has_no_join_and_no_window(spark):
    p = _plan(gold_monthly(silver_sales(_hot_bronze(spark))))
    assert "Window" not in p and "Join" not in p


def test_profile_samples_limited_before_shuffle(spark):
    df = spark.range(5000).selectExpr("cast(id % 97 as string) as a", "cast(id as string) as b")
    p = _plan(profile_table(df))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_reach_the_parquet_scan(spark, tmp_dir):
    _hot_bronze(spark).write.parquet(f"{tmp_dir}/b")
    b = spark.read.parquet(f"{tmp_dir}/b")
    p = _plan(silver_sales(b))
    assert "PushedFilters: [IsNotNull(date)" in p or "IsNotNull(date)" in p.split("PushedFilters")[1]

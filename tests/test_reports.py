"""Reports: metric formatting, chart series, trends, KPIs and the sample questions."""
import datetime as dt

from strata.operators import report as R

GOLD = "month string, revenue double, cost double, profit_margin double, units_sold bigint, top_category string"


def _gold(spark):
    return spark.createDataFrame([
        ("2026-02", 148119.77, 100734.01, 0.3199, 1369, "Electronics"),
        ("2026-01", 189242.94, 113237.9, 0.4016, 1902, "Electronics"),
        ("2026-04", 1234.5, None, None, None, "Books"),
    ], GOLD)


def test_format_metrics(spark):
    rows = [r.asDict() for r in R.format_metrics(_gold(spark)).collect()]
    assert [r["month"] for r in rows] == ["2026-01", "2026-02", "2026-04"]     # sorted by first column
    assert rows[0] == {"month": "2026-01", "revenue": "$189,242.94", "cost": "$113,237.90",
                       "profit_margin": "40.16%", "units_sold": "1,902", "top_category": "Electronics"}
    assert rows[2]["cost"] == "" and rows[2]["profit_margin"] == "" and rows[2]["units_sold"] == ""


def test_percent_not_scaled_when_first_value_is_already_a_percent(spark):
    df = spark.createDataFrame([("a", 40.5), ("b", 0.5)], "k string, margin_pct double")
    assert [r["margin_pct"] for r in R.format_metrics(df).collect()] == ["40.50%", "0.50%"]


def test_format_metrics_empty(spark):
    assert R.format_metrics(spark.createDataFrame([], GOLD)).count() == 0


def test_chart_series(spark):
    rows = R.chart_series(_gold(spark)).collect()
    assert [(r["x"], r["x_label"]) for r in rows][:2] == [("2026-01", "Jan '26"), ("2026-02", "Feb '26")]
    assert rows[0]["bar_label"] == "$189.2k" and abs(rows[0]["y"] - 189.24294) < 1e-9
    small = spark.createDataFrame([("a", 3), ("b", 900)], "k string, units bigint")
    got = R.chart_series(small).collect()
    assert [r["bar_label"] for r in got] == ["3", "900"] and got[0]["x_label"] is None


def test_mom_growth_uses_calendar_months(spark):
    rows = {r["month"]: r for r in R.mom_growth(_gold(spark), "revenue").collect()}
    assert rows["2026-01"]["prev_revenue"] is None
    assert rows["2026-02"]["growth"] == round((148119.77 - 189242.94) / 189242.94, 4)
    assert rows["2026-04"]["prev_revenue"] is None                      # March is missing, no lag across gaps


def _silver(spark):
    d = dt.date
    rows = [(d(2026, 1, 5), "A", 100.0, 50.0, 1), (d(2026, 1, 6), "B", 300.0, 100.0, 2),
            (d(2026, 2, 5), "A", 100.0, 95.0, 1), (d(2026, 2, 6), "B", 100.0, 40.0, 3),
            (d(2026, 3, 5), "A", 200.0, 100.0, 1), (d(2026, 3, 9), "A", 100.0, 50.0, 1)]
    return spark.createDataFrame(rows, "date date, category string, revenue double, cost double, units_sold int") \
        .withColumn("profit", __import__("pyspark.sql.functions", fromlist=["col"]).col("revenue")
                    - __import__("pyspark.sql.functions", fromlist=["col"]).col("cost"))


def test_category_share_and_anomalies(spark):
    s = _silver(spark)
    share = {(r["month"], r["category"]): r for r in R.category_share(s).collect()}
    assert share[("2026-01", "B")]["share"] == 0.75
    assert share[("2026-02", "A")]["growth"] == 0.0 and share[("2026-03", "A")]["growth"] == 2.0
    low = R.margin_anomalies(s, k=1.0).collect()
    assert [(r["month"], r["category"]) for r in low] == [("2026-02", "A")]


def test_sample_questions(spark):
    s = _silver(spark)
    assert [(r["category"], r["total_revenue"]) for r in R.revenue_by_category(s).collect()] == [
        ("A", 500.0), ("B", 400.0)]
    cmp = {r["category"]: r for r in R.compare_two_months(s, "2026-01", "2026-03").collect()}
    assert (cmp["A"]["revenue_first"], cmp["A"]["revenue_second"], cmp["A"]["difference"]) == (100.0, 300.0, 200.0)
    assert cmp["B"]["revenue_second"] == 0.0
    top = R.month_category_rows(s, "2026-03", "A", n=1).collect()
    assert len(top) == 1 and top[0]["revenue"] == 200.0
    best = R.best_avg_profit_category(s).collect()
    assert [(r["category"], r["avg_profit"]) for r in best] == [("B", 130.0)]


def test_kpi_summary(spark):
    s = _silver(spark)
    b = spark.range(10)
    q = spark.range(3)
    k = R.kpi_summary(b, s, q).first()
    assert (k["bronze_rows"], k["silver_rows"], k["quarantine_rows"], k["total_revenue"]) == (10, 6, 3, 900.0)
    assert abs(k["avg_margin"] - (0.5 + 2 / 3 + 0.05 + 0.6 + 0.5 + 0.5) / 6) < 1e-12


def test_as_text_and_preview(spark):
    s = _silver(spark)
    p = R.as_text(R.preview(s, 2))
    assert dict(p.dtypes) == {c: "string" for c in s.columns} and p.count() == 2

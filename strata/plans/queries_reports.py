"""Registered queries: audit, KPIs, previews, formatting, trends, sample questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import report as R
from strata.operators.audit import dq_audit, layer_counts
from strata.operators.silver import with_margin_pct
from strata.plans import oracle as O
from strata.plans.fixtures import stored_sales_layers
from strata.plans.registry import register


def _layers(spark, d):
    """Stored bronze, silver, quarantine and gold (reports read the written layers)."""
    return stored_sales_layers(spark, d)


SALES_QUARANTINE = f"""
sales_quarantine AS (
  SELECT 'Missing/Invalid Date' AS rejection_reason FROM sales_bronze WHERE {O.missing('date')}
  UNION ALL SELECT 'Missing/Invalid Category' FROM sales_bronze WHERE {O.present('date')} AND {O.missing('category')}
  UNION ALL SELECT 'Negative Numeric Metric(s)' FROM sales_bronze WHERE {O.SALES_DATED} AND {O.SALES_NEG}
  UNION ALL SELECT 'Duplicate Transaction' FROM sales_ranked WHERE rn > 1 AND {O.SALES_NONNEG}
)"""

ALL_LAYERS = f"{O.GOLD_MONTHLY}, {SALES_QUARANTINE}"


@register("layer_counts", f"""
{ALL_LAYERS}
SELECT 'bronze' AS layer, CAST(COUNT(*) AS BIGINT) AS row_count FROM sales_bronze
UNION ALL SELECT 'silver', COUNT(*) FROM sales_silver
UNION ALL SELECT 'quarantine', COUNT(*) FROM sales_quarantine
UNION ALL SELECT 'gold', COUNT(*) FROM gold""")
def layer_counts_q(spark, d):
    b, s, q, g = _layers(spark, d)
    return layer_counts(bronze=b, silver=s, quarantine=q, gold=g)


@register("dq_audit", f"""
{ALL_LAYERS},
t AS (
  SELECT (SELECT COUNT(*) FROM sales_bronze) AS b, (SELECT COUNT(*) FROM sales_silver) AS s,
         (SELECT COUNT(*) FROM sales_quarantine) AS q,
         (SELECT COUNT(*) FROM sales_silver WHERE date IS NULL OR category IS NULL OR revenue IS NULL
             OR cost IS NULL OR units_sold IS NULL) AS nulls,
         (SELECT CAST(ROUND(COALESCE(SUM(CAST(revenue AS DECIMAL(18,6))), 0), 2) AS DOUBLE) FROM sales_silver) AS st,
         (SELECT CAST(ROUND(COALESCE(SUM(CAST(revenue AS DECIMAL(18,6))), 0), 2) AS DOUBLE) FROM gold) AS gt
)
SELECT 'bronze_row_count' AS "check", CAST(b AS DOUBLE) AS value, 'INFO' AS status FROM t
UNION ALL SELECT 'silver_row_count', CAST(s AS DOUBLE), 'INFO' FROM t
UNION ALL SELECT 'quarantine_row_count', CAST(q AS DOUBLE), 'INFO' FROM t
UNION ALL SELECT 'unaccounted_rows', CAST(b - s - q AS DOUBLE), 'INFO' FROM t
UNION ALL SELECT 'null_violations_in_silver', CAST(nulls AS DOUBLE), CASE WHEN nulls = 0 THEN 'PASSED' ELSE 'FAILED' END FROM t
UNION ALL SELECT 'silver_total_revenue', st, 'INFO' FROM t
UNION ALL SELECT 'gold_total_revenue', gt, 'INFO' FROM t
UNION ALL SELECT 'financial_discrepancy', ROUND(ABS(st - gt), 2),
                 CASE WHEN ROUND(ABS(st - gt), 2) = 0 THEN 'PASSED' ELSE 'WARNING' END FROM t
UNION ALL SELECT 'rejections: ' || rejection_reason, CAST(COUNT(*) AS DOUBLE), 'INFO'
          FROM sales_quarantine GROUP BY rejection_reason""")
def dq_audit_q(spark, d):
    b, s, q, g = _layers(spark, d)
    return dq_audit(b, s, q, g)


@register("kpi_summary", f"""
{ALL_LAYERS}
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM sales_bronze) AS bronze_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM sales_silver) AS silver_rows,
       (SELECT CAST(COUNT(*) AS BIGINT) FROM sales_quarantine) AS quarantine_rows,
       (SELECT CAST(ROUND(COALESCE(SUM(CAST(revenue AS DECIMAL(18,6))), 0), 2) AS DOUBLE) FROM sales_silver)
         AS total_revenue,
       (SELECT ROUND(COALESCE(AVG((revenue - cost) / NULLIF(revenue, 0)), 0), 6) FROM sales_silver) AS avg_margin""")
def kpi_summary_q(spark, d):
    b, s, q, _ = _layers(spark, d)
    return R.kpi_summary(b, s, q).withColumn("avg_margin", F.round("avg_margin", 6))


SILVER_TEXT_COLS = ["date", "category", "revenue", "cost", "units_sold", "profit"]


def _silver_text(s):
    return s.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "category", "revenue", "cost",
                    F.col("units_sold").cast("bigint").alias("units_sold"), "profit")


@register("preview_silver", f"""
{O.SALES_SILVER_WITH}
SELECT strftime(date, '%Y-%m-%d') AS date, category, CAST(revenue AS VARCHAR) AS revenue, CAST(cost AS VARCHAR) AS cost,
       CAST(units_sold AS VARCHAR) AS units_sold, CAST(profit AS VARCHAR) AS profit,
       CAST(round((revenue - cost) / NULLIF(revenue, 0) * 100, 2) AS VARCHAR) AS margin_pct
FROM sales_silver ORDER BY date, category, sales_silver.revenue, sales_silver.cost, sales_silver.units_sold,
                           sales_silver.profit LIMIT 10""")
def preview_silver(spark, d):
    """First ten silver rows with the row margin percent, every value as text."""
    s = _silver_text(_layers(spark, d)[1])
    return R.as_text(with_margin_pct(R.preview(s, 10)))


@register("metric_format", f"""
{O.GOLD_MONTHLY},
m AS (SELECT CASE WHEN abs(arg_min(profit_margin, month)) <= 1 THEN 100.0 ELSE 1.0 END AS mult
      FROM gold WHERE profit_margin IS NOT NULL)
SELECT month,
       CASE WHEN revenue IS NULL THEN '' ELSE '$' || format('{{:,.2f}}', revenue) END AS revenue,
       CASE WHEN cost IS NULL THEN '' ELSE '$' || format('{{:,.2f}}', cost) END AS cost,
       CASE WHEN profit_margin IS NULL THEN '' ELSE printf('%.2f%%', profit_margin * m.mult) END AS profit_margin,
       CASE WHEN units_sold IS NULL THEN '' ELSE format('{{:,}}', CAST(trunc(units_sold) AS BIGINT)) END AS units_sold,
       top_category
FROM gold, m""")
def metric_format(spark, d):
    _, _, _, g = _layers(spark, d)
    return R.format_metrics(g)


@register("chart_series", f"""
{O.GOLD_MONTHLY},
mx AS (SELECT MAX(revenue) > 1000 AS scale FROM gold)
SELECT month AS x, strftime(strptime(month, '%Y-%m'), '%b ''%y') AS x_label,
       CASE WHEN scale THEN revenue / 1000.0 ELSE revenue END AS y,
       CASE WHEN scale THEN '$' || format('{{:,.1f}}', revenue / 1000.0) || 'k'
            ELSE '$' || format('{{:,.0f}}', revenue) END AS bar_label,
       'revenue' AS y_column
FROM gold, mx""")
def chart_series(spark, d):
    _, _, _, g = _layers(spark, d)
    return R.chart_series(g)


NEXT_MONTH = "strftime(strptime(p.month, '%Y-%m') + INTERVAL 1 MONTH, '%Y-%m')"


@register("mom_growth", f"""
{O.GOLD_MONTHLY}
SELECT g.month, g.revenue, p.revenue AS prev_revenue,
       ROUND((g.revenue - p.revenue) / NULLIF(p.revenue, 0), 4) AS growth
FROM gold g LEFT JOIN gold p ON g.month = {NEXT_MONTH}""")
def mom_growth(spark, d):
    _, _, _, g = _layers(spark, d)
    return R.mom_growth(g, "revenue")


CM = """
cm AS (
  SELECT strftime(date, '%Y-%m') AS month, category,
         CAST(ROUND(SUM(CAST(revenue AS DECIMAL(18,6))), 2) AS DOUBLE) AS revenue,
         CAST(ROUND(SUM(CAST(cost AS DECIMAL(18,6))), 2) AS DOUBLE) AS cost,
         CAST(SUM(CAST(revenue AS DECIMAL(18,6))) - SUM(CAST(cost AS DECIMAL(18,6))) AS DOUBLE)
           / NULLIF(CAST(SUM(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE), 0) AS margin
  FROM sales_silver GROUP BY 1, 2
)"""


@register("margin_anomalies", f"""
{O.SALES_SILVER_WITH}, {CM},
st AS (SELECT category, AVG(margin) AS mean_margin, STDDEV_SAMP(margin) AS sd_margin FROM cm GROUP BY category)
SELECT cm.month, cm.category, cm.revenue, cm.cost, ROUND(cm.margin, 4) AS margin,
       ROUND((cm.margin - st.mean_margin) / NULLIF(st.sd_margin, 0), 3) AS z_score
FROM cm JOIN st ON cm.category = st.category
WHERE cm.margin < st.mean_margin - 2.0 * st.sd_margin""")
def margin_anomalies(spark, d):
    _, s, _, _ = _layers(spark, d)
    return R.margin_anomalies(s, 2.0)


@register("category_share", f"""
{O.SALES_SILVER_WITH}, {CM},
tot AS (SELECT month, CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS month_revenue FROM cm GROUP BY month)
SELECT c.month, c.category, c.revenue, ROUND(c.revenue / NULLIF(t.month_revenue, 0), 4) AS share,
       p.revenue AS prev_revenue, ROUND((c.revenue - p.revenue) / NULLIF(p.revenue, 0), 4) AS growth
FROM cm c JOIN tot t ON c.month = t.month
LEFT JOIN cm p ON c.month = {NEXT_MONTH} AND c.category = p.category""")
def category_share(spark, d):
    _, s, _, _ = _layers(spark, d)
    return R.category_share(s)


@register("revenue_by_category", f"""
{O.SALES_SILVER_WITH}
SELECT category, CAST(ROUND(SUM(CAST(revenue AS DECIMAL(18,6))), 2) AS DOUBLE) AS total_revenue
FROM sales_silver GROUP BY category""")
def revenue_by_category(spark, d):
    _, s, _, _ = _layers(spark, d)
    return R.revenue_by_category(s)


@register("compare_two_months", f"""
{O.SALES_SILVER_WITH},
c AS (
  SELECT category,
    CAST(ROUND(COALESCE(SUM(CASE WHEN strftime(date, '%Y-%m') = '1998-01' THEN CAST(revenue AS DECIMAL(18,6)) END), 0), 2) AS DOUBLE) AS revenue_first,
    CAST(ROUND(COALESCE(SUM(CASE WHEN strftime(date, '%Y-%m') = '1998-06' THEN CAST(revenue AS DECIMAL(18,6)) END), 0), 2) AS DOUBLE) AS revenue_second
  FROM sales_silver WHERE strftime(date, '%Y-%m') IN ('1998-01', '1998-06') GROUP BY category
)
SELECT category, revenue_first, revenue_second, ROUND(revenue_second - revenue_first, 2) AS difference FROM c""")
def compare_two_months(spark, d):
    _, s, _, _ = _layers(spark, d)
    return R.compare_two_months(s, "1998-01", "1998-06")


@register("low_margin_months", f"""
{O.GOLD_MONTHLY}
SELECT * FROM gold WHERE profit_margin < 0.05""")
def low_margin_months(spark, d):
    _, _, _, g = _layers(spark, d)
    return R.low_margin_months(g, 0.05)


@register("month_category_rows", f"""
{O.SALES_SILVER_WITH}
SELECT strftime(date, '%Y-%m-%d') AS date, category, revenue, cost, CAST(units_sold AS BIGINT) AS units_sold, profit
FROM sales_silver WHERE strftime(date, '%Y-%m') = '1998-06' AND category = 'PROMO'
ORDER BY revenue DESC, cost DESC, units_sold DESC, date LIMIT 5""")
def month_category_rows(spark, d):
    _, s, _, _ = _layers(spark, d)
    return _silver_text(R.month_category_rows(s, "1998-06", "PROMO", 5))


@register("best_avg_profit_category", f"""
{O.SALES_SILVER_WITH}
SELECT category,
       ROUND(CAST(SUM(CAST(revenue AS DECIMAL(18,6))) - SUM(CAST(cost AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*), 4)
         AS avg_profit
FROM sales_silver GROUP BY category ORDER BY avg_profit DESC, category LIMIT 1""")
def best_avg_profit_category(spark, d):
    _, s, _, _ = _layers(spark, d)
    return R.best_avg_profit_category(s)

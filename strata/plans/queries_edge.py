"""Registered queries on the inputs that clean tables never hold: NaN, missing and malformed measures, measures of any
size, dates that are timestamps or no dates, layers that share no measure."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.audit import dq_audit
from strata.operators.gold import gold, gold_agg, gold_from_sql, gold_monthly, gold_options, top_category_per_month
from strata.operators.profile import build_profile, profile_table
from strata.operators.quarantine import quarantine_sales
from strata.operators.silver import silver, silver_sales
from strata.plans import oracle as O
from strata.plans.fixtures import EDGE_ROW_ID, SALES_ROW_ID, edge_bronze, stored_bronze, stored_sales_layers, table
from strata.plans.queries_layers import SALES_PROFILE
from strata.plans.queries_profile import CUSTOM_GOLD_SQL, LINEITEM_COLS, SALES_DYN_SILVER_CTE, _profile_oracle
from strata.plans.registry import register

_EDGE_DEDUP = O.order_desc(["ingested_at", "source_file", "cost", "l_orderkey", "l_linenumber"])

EDGE_SILVER = f"""WITH {O.EDGE_BRONZE},
edge_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY date, category, units_sold, revenue ORDER BY {_EDGE_DEDUP}) AS rn FROM edge_bronze
),
sales_silver AS (
  SELECT TRY_CAST(date AS DATE) AS date, category, TRY_CAST(revenue AS DOUBLE) AS revenue, TRY_CAST(cost AS DOUBLE) AS cost,
         CAST(ROUND(TRY_CAST(units_sold AS DOUBLE)) AS INTEGER) AS units_sold
  FROM edge_ranked WHERE rn = 1 AND {O.SALES_NONNEG}
)"""


@register("edge_silver", f"""
{EDGE_SILVER}
SELECT strftime(date, '%Y-%m-%d') AS date, category, revenue, cost, CAST(units_sold AS BIGINT) AS units_sold FROM sales_silver""")
def edge_silver(spark, d):
    """Timestamp text becomes a date, text that is none a null date; NaN, malformed and missing measures stay out."""
    s = silver_sales(edge_bronze(spark, d), row_id=EDGE_ROW_ID)
    return s.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "category", "revenue", "cost",
                    F.col("units_sold").cast("bigint").alias("units_sold"))


@register("edge_gold", f"""
{EDGE_SILVER}, {O.PER_CATEGORY},{O.GOLD_CTE.replace("m.month = r.month", "m.month IS NOT DISTINCT FROM r.month")}
SELECT * FROM gold""")
def edge_gold(spark, d):
    """Gold of the dirty deliveries; rows without a date are a month of their own."""
    return gold_monthly(silver_sales(edge_bronze(spark, d), row_id=EDGE_ROW_ID))


@register("edge_audit", f"""
{EDGE_SILVER},
edge_quarantine AS (
  SELECT 'Duplicate Transaction' AS rejection_reason FROM edge_ranked WHERE rn > 1 AND {O.SALES_NONNEG}
),
t AS (
  SELECT (SELECT COUNT(*) FROM edge_bronze) AS b, (SELECT COUNT(*) FROM sales_silver) AS s, (SELECT COUNT(*) FROM edge_quarantine) AS q,
         (SELECT COUNT(*) FROM sales_silver WHERE date IS NULL OR category IS NULL OR revenue IS NULL OR cost IS NULL OR units_sold IS NULL) AS nulls
)
SELECT 'bronze_row_count' AS "check", CAST(b AS DOUBLE) AS value, 'INFO' AS status FROM t
UNION ALL SELECT 'silver_row_count', s, 'INFO' FROM t
UNION ALL SELECT 'quarantine_row_count', q, 'INFO' FROM t
UNION ALL SELECT 'unaccounted_rows', b - s - q, 'INFO' FROM t
UNION ALL SELECT 'null_violations_in_silver', nulls, CASE WHEN nulls = 0 THEN 'PASSED' ELSE 'FAILED' END FROM t
UNION ALL SELECT 'silver_total_measure', NULL, 'SKIPPED'
UNION ALL SELECT 'gold_total_measure', NULL, 'SKIPPED'
UNION ALL SELECT 'financial_discrepancy', NULL, 'SKIPPED'
UNION ALL SELECT 'rejections: ' || rejection_reason, COUNT(*), 'INFO' FROM edge_quarantine GROUP BY rejection_reason""")
def edge_audit(spark, d):
    """The audit of the dirty deliveries beside a gold that shares no measure with silver."""
    b = edge_bronze(spark, d)
    s = silver_sales(b, row_id=EDGE_ROW_ID)
    return dq_audit(b, s, quarantine_sales(b, row_id=EDGE_ROW_ID), gold_from_sql(spark, s, CUSTOM_GOLD_SQL))


@register("measure_extremes", """
SELECT l_returnflag, SUM(l_quantity * 8796093022208) AS huge, SUM(l_linenumber * pow(2, -30)) AS tiny,
       SUM(l_linenumber * pow(2, -30)) / COUNT(*) AS mean_tiny, CAST(COUNT(*) AS BIGINT) AS n,
       SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN CAST('NaN' AS DOUBLE) ELSE l_quantity END) AS with_nan
FROM lineitem GROUP BY l_returnflag""")
def measure_extremes(spark, d):
    """Measures of 1e13 and of 1e-9, and a measure with NaN, summed whole. (Whole multiples of powers of two add up
    alike in any order, so both engines must agree to the last bit.)"""
    li = table(spark, d, "lineitem").select(
        "l_returnflag", (F.col("l_quantity") * 8796093022208).alias("huge"), (F.col("l_linenumber") * F.lit(2.0 ** -30)).alias("tiny"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N"), F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("with_nan"))
    return gold_agg(li, ["l_returnflag"], [("sum", "huge", "huge"), ("sum", "tiny", "tiny"), ("avg", "tiny", "mean_tiny"),
                                           ("count", None, "n"), ("sum", "with_nan", "with_nan")])


@register("top_category_without_revenue", """
WITH s AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag AS category,
         CASE WHEN l_returnflag = 'A' OR month(l_shipdate) = 2 THEN NULL ELSE l_quantity END AS revenue FROM lineitem
),
c AS (SELECT month, category, SUM(revenue) AS r FROM s GROUP BY 1, 2),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY month ORDER BY r DESC NULLS LAST, category) AS rk FROM c)
SELECT month, category AS top_category, ROUND(r, 2) AS category_revenue FROM k WHERE rk = 1""")
def top_category_without_revenue(spark, d):
    """A category without revenue is never on top unless all are (every February)."""
    li = table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("date"), F.col("l_returnflag").alias("category"),
        F.when((F.col("l_returnflag") == "A") | (F.month("l_shipdate") == 2), F.lit(None)).otherwise(F.col("l_quantity")).alias("revenue"),
        F.lit(0.0).alias("cost"), F.lit(1).alias("units_sold"))
    return top_category_per_month(li)


def _proposed(spark, d):
    bronze = stored_bronze(spark, d, "sales")
    prof = build_profile(bronze, SALES_PROFILE.names, approx=True)
    return prof, silver(bronze, prof, row_id=SALES_ROW_ID)


_MEASURES = ("revenue", "cost", "units_sold")
_TOTALS = ", ".join(f"CAST(SUM(CAST({m} AS DECIMAL(38,6))) AS DOUBLE) AS {m}" for m in _MEASURES)
_MEANS = ", ".join(f"CAST(SUM(CAST({m} AS DECIMAL(38,6))) AS DOUBLE) / COUNT({m}) AS {m}" for m in _MEASURES)


@register("gold_options", f"""
WITH {SALES_DYN_SILVER_CTE},
m AS (SELECT *, strftime(date, '%Y-%m') AS month FROM dyn)
SELECT 0 AS option_no, month, category, {_TOTALS}, CAST(NULL AS BIGINT) AS row_count FROM m GROUP BY month, category
UNION ALL SELECT 1, month, category, {_MEANS}, NULL FROM m GROUP BY month, category
UNION ALL SELECT 2, month, NULL, NULL, NULL, NULL, CAST(COUNT(*) AS BIGINT) FROM m GROUP BY month""")
def gold_options_q(spark, d):
    """Every aggregate that the rules propose for the profiled sales bronze, run over silver."""
    prof, s = _proposed(spark, d)
    out = None
    for i, o in enumerate(gold_options(prof)):
        g = o.apply(s)
        g = g.select([F.col(c).alias(c.removeprefix("avg_")) for c in g.columns]).withColumn("option_no", F.lit(i))
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out.select("option_no", "month", "category", *_MEASURES, "row_count")


@register("gold_first_option", f"""
WITH {SALES_DYN_SILVER_CTE}
SELECT strftime(date, '%Y-%m') AS month, category, {_TOTALS} FROM dyn GROUP BY 1, 2""")
def gold_first_option(spark, d):
    """From profile to gold: the first proposal over the profiled sales bronze."""
    prof, s = _proposed(spark, d)
    return gold(s, prof)


@register("profile_lineitem_approx", _profile_oracle(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_COLS).replace(
    "SELECT * FROM p", "SELECT * EXCLUDE (cardinality), true AS close FROM p"))
def profile_lineitem_approx(spark, d):
    """Large-table mode: sketches for the distinct counts (within 5% of the exact ones), all else as in the exact profile."""
    bronze = stored_bronze(spark, d, "lineitem")
    approx = profile_table(bronze, LINEITEM_COLS, approx=True).withColumn("samples", F.array_join("samples", "|"))
    exact = profile_table(bronze, LINEITEM_COLS, samples=0).select("column_name", F.col("cardinality").alias("exact"))
    close = F.abs(F.col("cardinality") - F.col("exact")) <= 0.05 * F.col("exact")
    return approx.join(exact, "column_name").withColumn("close", close).drop("cardinality", "exact")


@register("surrogate_ids", f"""
WITH {O.SALES_BRONZE}, {O.SALES_RANKED}, {O.SALES_SILVER}
SELECT COUNT(*) AS silver_rows, COUNT(*) AS distinct_ids, CAST(0 AS BIGINT) AS null_ids FROM sales_silver""")
def surrogate_ids(spark, d):
    """Every silver row has an id of its own."""
    s = stored_sales_layers(spark, d)[1]
    return s.agg(F.count(F.lit(1)).alias("silver_rows"), F.count_distinct("id").alias("distinct_ids"),
                 F.count_if(F.col("id").isNull()).alias("null_ids"))

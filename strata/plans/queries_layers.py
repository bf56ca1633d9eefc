"""Registered queries: bronze → silver / quarantine → gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.constants import SALES_COLUMNS
from strata.functions.predicates import missing
from strata.operators.gold import gold_monthly, gold_monthly_percent, top_category_per_month
from strata.operators.model import Profile
from strata.operators.quarantine import quarantine, quarantine_sales
from strata.operators.silver import silver, silver_sales
from strata.plans import oracle as O
from strata.plans.fixtures import SALES_ROW_ID, TABLE_ROW_ID, sales_bronze, stored_bronze
from strata.plans.registry import register


def _sales_silver(spark, d):
    return silver_sales(stored_bronze(spark, d, "sales"), row_id=SALES_ROW_ID)


def _date_text(c="date"):
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


QCOLS = ["raw_" + c for c in SALES_COLUMNS] + ["source_file", "ingested_at", "rejection_reason"]

# ---------------------------------------------------------------- bronze

@register("bronze_all_text", f"""
WITH {O.SALES_BRONZE}
SELECT date, category, revenue, cost, units_sold, CAST(ingested_at AS VARCHAR) AS ingested_at, source_file
FROM sales_bronze""")
def bronze_all_text(spark, d):
    b = sales_bronze(spark, d)  # the derivation itself (the ingest step), not the stored copy
    return b.select(*SALES_COLUMNS, F.col("ingested_at").cast("string").alias("ingested_at"), "source_file")


@register("bronze_file_counts", f"""
WITH {O.SALES_BRONZE}
SELECT source_file, COUNT(*) AS rows_loaded FROM sales_bronze GROUP BY source_file""")
def bronze_file_counts(spark, d):
    from strata.sources.files import rows_per_file
    return rows_per_file(sales_bronze(spark, d))


@register("missing_predicate", f"""
WITH {O.SALES_BRONZE}
SELECT COUNT(*) AS total_rows,
       CAST(SUM(CASE WHEN {O.missing('date')} THEN 1 ELSE 0 END) AS BIGINT) AS missing_date,
       CAST(SUM(CASE WHEN {O.missing('category')} THEN 1 ELSE 0 END) AS BIGINT) AS missing_category,
       CAST(SUM(CASE WHEN {O.missing('revenue')} THEN 1 ELSE 0 END) AS BIGINT) AS missing_revenue,
       CAST(SUM(CASE WHEN {O.present('date')} AND {O.present('category')} THEN 1 ELSE 0 END) AS BIGINT)
         AS present_date_and_category
FROM sales_bronze""")
def missing_predicate(spark, d):
    b = sales_bronze(spark, d)
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return b.agg(F.count(F.lit(1)).alias("total_rows"),
                 n(missing("date")).alias("missing_date"),
                 n(missing("category")).alias("missing_category"),
                 n(missing("revenue")).alias("missing_revenue"),
                 n(~missing("date") & ~missing("category")).alias("present_date_and_category"))

# ---------------------------------------------------------------- static path

@register("quarantine_static", f"""
WITH {O.SALES_BRONZE}, {O.SALES_RANKED}
SELECT date AS raw_date, category AS raw_category, revenue AS raw_revenue, cost AS raw_cost,
       units_sold AS raw_units_sold, source_file, CAST(ingested_at AS VARCHAR) AS ingested_at,
       'Missing/Invalid Date' AS rejection_reason
FROM sales_bronze WHERE {O.missing('date')}
UNION ALL
SELECT date, category, revenue, cost, units_sold, source_file, CAST(ingested_at AS VARCHAR),
       'Missing/Invalid Category'
FROM sales_bronze WHERE {O.present('date')} AND {O.missing('category')}
UNION ALL
SELECT date, category, revenue, cost, units_sold, source_file, CAST(ingested_at AS VARCHAR),
       'Negative Numeric Metric(s)'
FROM sales_bronze WHERE {O.SALES_DATED} AND {O.SALES_NEG}
UNION ALL
SELECT date, category, revenue, cost, units_sold, source_file, CAST(ingested_at AS VARCHAR),
       'Duplicate Transaction'
FROM sales_ranked WHERE rn > 1 AND {O.SALES_NONNEG}""")
def quarantine_static(spark, d):
    return quarantine_sales(stored_bronze(spark, d, "sales"), row_id=SALES_ROW_ID).select(*QCOLS)


@register("rejection_breakdown", f"""
WITH {O.SALES_BRONZE}, {O.SALES_RANKED},
q AS (
  SELECT 'Missing/Invalid Date' AS rejection_reason FROM sales_bronze WHERE {O.missing('date')}
  UNION ALL SELECT 'Missing/Invalid Category' FROM sales_bronze WHERE {O.present('date')} AND {O.missing('category')}
  UNION ALL SELECT 'Negative Numeric Metric(s)' FROM sales_bronze WHERE {O.SALES_DATED} AND {O.SALES_NEG}
  UNION ALL SELECT 'Duplicate Transaction' FROM sales_ranked WHERE rn > 1 AND {O.SALES_NONNEG}
)
SELECT rejection_reason, COUNT(*) AS row_count FROM q GROUP BY rejection_reason""")
def rejection_breakdown(spark, d):
    from strata.operators.audit import rejection_breakdown as rb
    return rb(quarantine_sales(stored_bronze(spark, d, "sales"), row_id=SALES_ROW_ID))


@register("silver_static", f"""
{O.SALES_SILVER_WITH}
SELECT strftime(date, '%Y-%m-%d') AS date, category, revenue, cost, CAST(units_sold AS BIGINT) AS units_sold, profit
FROM sales_silver""")
def silver_static(spark, d):
    s = _sales_silver(spark, d)
    return s.select(_date_text(), "category", "revenue", "cost",
                    F.col("units_sold").cast("bigint").alias("units_sold"), "profit")


@register("gold_monthly", f"""
{O.GOLD_MONTHLY}
SELECT * FROM gold""")
def gold_monthly_q(spark, d):
    return gold_monthly(_sales_silver(spark, d))


@register("gold_monthly_percent", f"""
{O.SALES_SILVER_WITH}, {O.PER_CATEGORY},
g AS (
  SELECT m.month, CAST(ROUND(m.rev, 2) AS DOUBLE) AS total_revenue, CAST(ROUND(m.cst, 2) AS DOUBLE) AS total_cost,
         CAST(m.units AS BIGINT) AS total_units_sold, r.category AS top_category
  FROM monthly m JOIN ranked_cat r ON m.month = r.month AND r.rk = 1
)
SELECT month, total_revenue, total_cost,
       CASE WHEN total_revenue <> 0 THEN ROUND((total_revenue - total_cost) / total_revenue * 100, 2) ELSE 0.0 END
         AS margin_pct,
       total_units_sold, top_category
FROM g""")
def gold_monthly_percent_q(spark, d):
    return gold_monthly_percent(_sales_silver(spark, d))


@register("top_category_per_month", f"""
{O.SALES_SILVER_WITH}, {O.PER_CATEGORY}
SELECT month, category AS top_category, CAST(ROUND(category_revenue, 2) AS DOUBLE) AS category_revenue
FROM ranked_cat WHERE rk = 1""")
def top_category_per_month_q(spark, d):
    return top_category_per_month(_sales_silver(spark, d))

# ---------------------------------------------------------------- profile-driven path

SALES_PROFILE = Profile.of({"date": "date", "category": "dimension", "revenue": "measure",
                            "cost": "measure", "units_sold": "measure"})
LINEITEM_PROFILE = Profile.of({
    "l_orderkey": "id", "l_partkey": "dimension", "l_suppkey": "dimension", "l_linenumber": "id",
    "l_quantity": "measure", "l_extendedprice": "measure", "l_discount": "measure", "l_tax": "measure",
    "l_returnflag": "dimension", "l_linestatus": "dimension", "l_shipdate": "date"})
CUSTOMER_PROFILE = Profile.of({"c_custkey": "id", "c_name": "text", "c_nationkey": "dimension",
                               "c_acctbal": "measure", "c_mktsegment": "dimension"})

SALES_DYN_VALID = O.dyn_valid(["date", "category"], ["revenue", "cost", "units_sold"])
SALES_DYN_RANKED = f"""
dyn_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY category, date ORDER BY {O.SALES_ORDER}) AS rn
  FROM sales_bronze WHERE {SALES_DYN_VALID}
)"""


def _dyn_quarantine_sql(bronze_cte: str, bronze: str, profile: Profile, keys: list[str]) -> str:
    cols = profile.names
    raw = ", ".join(f"{c} AS raw_{c}" for c in cols)
    parts = []
    for c in profile.required:
        parts.append(f"SELECT {raw}, source_file, CAST(ingested_at AS VARCHAR) AS ingested_at, "
                     f"'Null value in required column: {c}' AS rejection_reason FROM {bronze} WHERE {O.missing(c)}")
    for c in profile.measures:
        parts.append(f"SELECT {raw}, source_file, CAST(ingested_at AS VARCHAR) AS ingested_at, "
                     f"'Negative Numeric Metric: {c}' AS rejection_reason FROM {bronze} "
                     f"WHERE {O.present(c)} AND TRY_CAST({c} AS DOUBLE) < 0")
    order = O.order_desc(["ingested_at", "source_file"] + cols)
    valid = O.dyn_valid(profile.required, profile.measures)
    parts.append(f"SELECT {raw}, source_file, CAST(ingested_at AS VARCHAR) AS ingested_at, "
                 f"'Duplicate Transaction' AS rejection_reason FROM ("
                 f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn "
                 f"FROM {bronze} WHERE {valid}) t WHERE rn > 1")
    return f"WITH {bronze_cte}\n" + "\nUNION ALL\n".join(parts)


def _dyn_silver_sql(bronze_cte: str, bronze: str, profile: Profile, keys: list[str]) -> str:
    order = O.order_desc(["ingested_at", "source_file"] + profile.names)
    valid = O.dyn_valid(profile.required, profile.measures)
    sel = []
    for c in profile.columns:
        if c.role == "date":
            sel.append(f"strftime(CAST({c.name} AS DATE), '%Y-%m-%d') AS {c.name}")
        elif c.role in ("measure", "currency"):
            sel.append(f"TRY_CAST({c.name} AS DOUBLE) AS {c.name}")
        else:
            sel.append(c.name)
    return (f"WITH {bronze_cte}\nSELECT {', '.join(sel)} FROM ("
            f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn "
            f"FROM {bronze} WHERE {valid}) t WHERE rn = 1")


def _dates_as_text(df, profile: Profile):
    return df.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if profile.role_of(c) == "date" else F.col(c)
                       for c in profile.names])


def _qcols(profile: Profile):
    return ["raw_" + c for c in profile.names] + ["source_file", "ingested_at", "rejection_reason"]


@register("quarantine_dynamic",
          _dyn_quarantine_sql(O.SALES_BRONZE, "sales_bronze", SALES_PROFILE, SALES_PROFILE.dedup_keys()))
def quarantine_dynamic(spark, d):
    return quarantine(stored_bronze(spark, d, "sales"), SALES_PROFILE, row_id=SALES_ROW_ID).select(*_qcols(SALES_PROFILE))


@register("silver_dynamic_dims",
          _dyn_silver_sql(O.SALES_BRONZE, "sales_bronze", SALES_PROFILE, SALES_PROFILE.dedup_keys()))
def silver_dynamic_dims(spark, d):
    return _dates_as_text(silver(stored_bronze(spark, d, "sales"), SALES_PROFILE, row_id=SALES_ROW_ID), SALES_PROFILE)


@register("silver_dynamic_id",
          _dyn_silver_sql(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_PROFILE, LINEITEM_PROFILE.dedup_keys()))
def silver_dynamic_id(spark, d):
    return _dates_as_text(silver(stored_bronze(spark, d, "lineitem"), LINEITEM_PROFILE, row_id=TABLE_ROW_ID),
                          LINEITEM_PROFILE)


@register("quarantine_dynamic_id",
          _dyn_quarantine_sql(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_PROFILE,
                              LINEITEM_PROFILE.dedup_keys()))
def quarantine_dynamic_id(spark, d):
    return quarantine(stored_bronze(spark, d, "lineitem"), LINEITEM_PROFILE, row_id=TABLE_ROW_ID) \
        .select(*_qcols(LINEITEM_PROFILE))


@register("negative_balance_quarantine",
          _dyn_quarantine_sql(O.CUSTOMER_BRONZE, "customer_bronze", CUSTOMER_PROFILE,
                              CUSTOMER_PROFILE.dedup_keys()))
def negative_balance_quarantine(spark, d):
    return quarantine(stored_bronze(spark, d, "customer"), CUSTOMER_PROFILE, row_id=TABLE_ROW_ID) \
        .select(*_qcols(CUSTOMER_PROFILE))


# ---------------------------------------------------------------- hot keys
# Dedup lineitem on its return flag: three keys, each holding about a third of
# all rows — the skew case the window-free dedup is built for.

HOT_KEYS = ["l_returnflag"]


@register("silver_hot_keys",
          _dyn_silver_sql(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_PROFILE, HOT_KEYS))
def silver_hot_keys(spark, d):
    return _dates_as_text(silver(stored_bronze(spark, d, "lineitem"), LINEITEM_PROFILE, row_id=TABLE_ROW_ID,
                                 dedup_keys=HOT_KEYS), LINEITEM_PROFILE)


@register("quarantine_hot_keys",
          _dyn_quarantine_sql(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_PROFILE, HOT_KEYS))
def quarantine_hot_keys(spark, d):
    return quarantine(stored_bronze(spark, d, "lineitem"), LINEITEM_PROFILE, row_id=TABLE_ROW_ID,
                      dedup_keys=HOT_KEYS).select(*_qcols(LINEITEM_PROFILE))

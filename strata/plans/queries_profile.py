"""Registered queries: column profile, role classification, gold options and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.gold import gold_agg, gold_from_sql
from strata.operators.profile import (
    CURRENCY_PATTERN, DATE_PATTERN, NUMERIC_PATTERN, TEXT_MEAN_LENGTH, TEXT_NAME_TOKENS,
    classify_roles, profile_table,
)
from strata.operators.silver import silver
from strata.plans import oracle as O
from strata.plans.fixtures import SALES_ROW_ID, TABLE_ROW_ID, stored_bronze, stored_sales_layers
from strata.plans.queries_layers import CUSTOMER_PROFILE, LINEITEM_PROFILE, SALES_PROFILE
from strata.plans.registry import register

LINEITEM_COLS = LINEITEM_PROFILE.names
CUSTOMER_COLS = CUSTOMER_PROFILE.names


def _profile_oracle(bronze_cte: str, bronze: str, cols: list[str], with_roles: bool = False) -> str:
    long = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS ordinal, "
        f"CASE WHEN {c} IS NULL OR {c} IN ('None', '') THEN NULL ELSE CAST({c} AS VARCHAR) END AS value FROM {bronze}"
        for i, c in enumerate(cols))
    stats = f"""
d AS (SELECT column_name, ordinal, value, COUNT(*) AS n FROM long GROUP BY column_name, ordinal, value),
s AS (
  SELECT column_name, ordinal, CAST(SUM(n) AS BIGINT) AS row_count,
         CAST(SUM(CASE WHEN value IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_count,
         CAST(COUNT(value) AS BIGINT) AS cardinality,
         CAST(SUM(CASE WHEN regexp_matches(value, '{NUMERIC_PATTERN}') THEN n ELSE 0 END) AS BIGINT) AS numeric_count,
         CAST(SUM(CASE WHEN regexp_matches(value, '{DATE_PATTERN}') THEN n ELSE 0 END) AS BIGINT) AS date_like_count,
         CAST(SUM(CASE WHEN regexp_matches(value, '{CURRENCY_PATTERN}') THEN n ELSE 0 END) AS BIGINT) AS currency_like_count,
         MIN(CASE WHEN regexp_matches(value, '{NUMERIC_PATTERN}') THEN TRY_CAST(value AS DOUBLE) END) AS mn,
         MAX(CASE WHEN regexp_matches(value, '{NUMERIC_PATTERN}') THEN TRY_CAST(value AS DOUBLE) END) AS mx,
         SUM(length(value) * n) AS len
  FROM d GROUP BY column_name, ordinal
),
smp AS (
  SELECT column_name, string_agg(value, '|' ORDER BY value) AS samples FROM (
    SELECT column_name, value, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value) AS rk
    FROM d WHERE value IS NOT NULL) t
  WHERE rk <= 5 GROUP BY column_name
),
p AS (
  SELECT s.column_name, CAST(s.ordinal AS INTEGER) AS ordinal, 'string' AS dtype, row_count, null_count,
         printf('%d.%02d%%', ((null_count * 20000 + row_count) // (row_count * 2)) // 100,
                ((null_count * 20000 + row_count) // (row_count * 2)) % 100) AS null_pct,
         cardinality,
         CASE WHEN row_count - null_count > 0 AND numeric_count = row_count - null_count THEN mn END AS min_val,
         CASE WHEN row_count - null_count > 0 AND numeric_count = row_count - null_count THEN mx END AS max_val,
         coalesce(smp.samples, '') AS samples,
         numeric_count, date_like_count, currency_like_count,
         CASE WHEN row_count - null_count > 0 THEN len / (row_count - null_count) END AS avg_length
  FROM s LEFT JOIN smp ON s.column_name = smp.column_name
)"""
    sql = f"WITH {bronze_cte},\nlong AS (\n  {long}\n),{stats}\n"
    if not with_roles:
        return sql + "SELECT * FROM p"
    tokens = ", ".join(f"'{t}'" for t in TEXT_NAME_TOKENS)
    pres = "(row_count - null_count)"
    name = "lower(column_name)"
    return sql + f"""SELECT column_name, ordinal, CASE
  WHEN {name} = 'id' OR suffix({name}, '_id') OR suffix({name}, 'key') THEN 'id'
  WHEN {pres} > 0 AND date_like_count = {pres} THEN 'date'
  WHEN {pres} > 0 AND numeric_count = {pres} THEN 'measure'
  WHEN contains({name}, 'currency') AND {pres} > 0 AND currency_like_count = {pres} THEN 'currency'
  WHEN len(list_intersect(string_split_regex({name}, '[^a-z0-9]+'), [{tokens}])) > 0
       OR coalesce(avg_length > {TEXT_MEAN_LENGTH}, false) THEN 'text'
  ELSE 'dimension' END AS role
FROM p"""


def _profile_q(df, cols):
    return profile_table(df, cols).withColumn("samples", F.array_join("samples", "|"))


@register("profile_lineitem", _profile_oracle(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_COLS))
def profile_lineitem(spark, d):
    return _profile_q(stored_bronze(spark, d, "lineitem"), LINEITEM_COLS)


@register("profile_customer", _profile_oracle(O.CUSTOMER_BRONZE, "customer_bronze", CUSTOMER_COLS))
def profile_customer(spark, d):
    return _profile_q(stored_bronze(spark, d, "customer"), CUSTOMER_COLS)


@register("classify_roles", _profile_oracle(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_COLS, with_roles=True))
def classify_roles_q(spark, d):
    return classify_roles(profile_table(stored_bronze(spark, d, "lineitem"), LINEITEM_COLS, samples=0)).select(
        "column_name", "ordinal", "role")


def _sales_dyn_silver(spark, d):
    return silver(stored_bronze(spark, d, "sales"), SALES_PROFILE, row_id=SALES_ROW_ID)


SALES_DYN_SILVER_CTE = f"""{O.SALES_BRONZE},
dyn AS (
  SELECT CAST(date AS DATE) AS date, category, TRY_CAST(revenue AS DOUBLE) AS revenue,
         TRY_CAST(cost AS DOUBLE) AS cost, TRY_CAST(units_sold AS DOUBLE) AS units_sold
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY category, date ORDER BY {O.SALES_ORDER}) AS rn
        FROM sales_bronze WHERE {O.dyn_valid(['date', 'category'], ['revenue', 'cost', 'units_sold'])}) t
  WHERE rn = 1
)"""


@register("gold_month_dim_sum", f"""
WITH {SALES_DYN_SILVER_CTE}
SELECT strftime(date, '%Y-%m') AS month, category,
       CAST(SUM(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE) AS revenue,
       CAST(SUM(CAST(units_sold AS DECIMAL(18,6))) AS DOUBLE) AS units_sold
FROM dyn GROUP BY 1, 2""")
def gold_month_dim_sum(spark, d):
    return gold_agg(_sales_dyn_silver(spark, d), ["category"],
                    [("sum", "revenue", "revenue"), ("sum", "units_sold", "units_sold")], date_col="date")


LI_SILVER_CTE = f"""{O.LINEITEM_BRONZE},
li_silver AS (
  SELECT l_orderkey, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
         TRY_CAST(l_extendedprice AS DOUBLE) AS l_extendedprice
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY {O.order_desc(['ingested_at', 'source_file'] + LINEITEM_COLS)}) AS rn
        FROM lineitem_bronze WHERE {O.dyn_valid(LINEITEM_PROFILE.required, LINEITEM_PROFILE.measures)}) t
  WHERE rn = 1
)"""


@register("gold_month_dim_avg_count", f"""
WITH {LI_SILVER_CTE}
SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,6))) AS DOUBLE) / COUNT(l_extendedprice) AS avg_extendedprice,
       CAST(COUNT(l_orderkey) AS BIGINT) AS order_line_count
FROM li_silver GROUP BY 1, 2""")
def gold_month_dim_avg_count(spark, d):
    s = silver(stored_bronze(spark, d, "lineitem"), LINEITEM_PROFILE, row_id=TABLE_ROW_ID)
    return gold_agg(s, ["l_returnflag"], [("avg", "l_extendedprice", "avg_extendedprice"),
                                          ("count", "l_orderkey", "order_line_count")], date_col="l_shipdate")


@register("gold_dim_only", f"""
WITH {O.CUSTOMER_BRONZE},
cs AS (
  SELECT c_mktsegment, TRY_CAST(c_acctbal AS DOUBLE) AS c_acctbal
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey
                                     ORDER BY {O.order_desc(['ingested_at', 'source_file'] + CUSTOMER_COLS)}) AS rn
        FROM customer_bronze WHERE {O.dyn_valid(CUSTOMER_PROFILE.required, CUSTOMER_PROFILE.measures)}) t
  WHERE rn = 1
)
SELECT c_mktsegment, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,6))) AS DOUBLE) AS total_acctbal,
       CAST(COUNT(*) AS BIGINT) AS customers
FROM cs GROUP BY c_mktsegment""")
def gold_dim_only(spark, d):
    s = silver(stored_bronze(spark, d, "customer"), CUSTOMER_PROFILE, row_id=TABLE_ROW_ID)
    return gold_agg(s, ["c_mktsegment"], [("sum", "c_acctbal", "total_acctbal"), ("count", None, "customers")])


CUSTOM_GOLD_SQL = ("SELECT category, CAST(SUM(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE) AS total_revenue, "
                   "CAST(SUM(units_sold) AS BIGINT) AS total_units "
                   "FROM silver_clean_sales GROUP BY category")


@register("gold_custom_sql", f"""
{O.SALES_SILVER_WITH}
SELECT category, CAST(SUM(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE) AS total_revenue,
       CAST(SUM(units_sold) AS BIGINT) AS total_units
FROM sales_silver GROUP BY category""")
def gold_custom_sql(spark, d):
    return gold_from_sql(spark, stored_sales_layers(spark, d)[1], CUSTOM_GOLD_SQL)

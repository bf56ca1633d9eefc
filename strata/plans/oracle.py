"""DuckDB SQL of the fixture views and of the reference semantics.

These strings are the *oracle*: the same results written as plain SQL
(window functions, UNION ALL per rule) the way the behaviour was first
specified, run by DuckDB on the same parquet files.  Only the test
harness uses them.
"""

# bronze text derived from the driver tables (mirrors strata.plans.fixtures)
SALES_BRONZE = """
sales_base AS (
  SELECT
    CASE l.l_orderkey % 97 WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN ''
         ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS date,
    CASE l.l_partkey % 89 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p.p_type END AS category,
    CAST(CAST(CASE WHEN l.l_suppkey % 83 = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END
              AS DECIMAL(18,2)) AS VARCHAR) AS revenue,
    CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS VARCHAR) AS cost,
    CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS units_sold,
    l.l_shipdate, l.l_returnflag
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
sales_bronze AS (
  SELECT date, category, revenue, cost, units_sold, l_shipdate AS ingested_at,
         'sales_' || strftime(l_shipdate, '%Y_%m') || '.csv' AS source_file
  FROM sales_base
  UNION ALL
  SELECT date, category, revenue, cost, units_sold, l_shipdate + INTERVAL 1 DAY AS ingested_at,
         'resend_' || strftime(l_shipdate, '%Y_%m') || '.csv' AS source_file
  FROM sales_base WHERE l_returnflag = 'R'
)"""

LINEITEM_BRONZE = """
lineitem_bronze AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
         CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS l_quantity,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS l_extendedprice,
         CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS l_discount,
         CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) AS l_tax,
         l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
         l_shipdate AS ingested_at,
         'lineitem_' || strftime(l_shipdate, '%Y_%m') || '.csv' AS source_file
  FROM lineitem
)"""

CUSTOMER_BRONZE = """
customer_bronze AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
         TIMESTAMP '2026-01-01 00:00:00' AS ingested_at, 'customer.csv' AS source_file
  FROM customer
)"""


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> 'None' AND {c} <> '')"


def missing(c: str) -> str:
    return f"({c} IS NULL OR {c} = 'None' OR {c} = '')"


def order_desc(cols) -> str:
    """The total order used for keep-latest (DESC, NULLs last)."""
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


SALES_ORDER = order_desc(["ingested_at", "source_file", "date", "category", "revenue", "cost", "units_sold"])
SALES_DATED = f"{present('date')} AND {present('category')}"
SALES_NONNEG = ("TRY_CAST(revenue AS DOUBLE) >= 0 AND TRY_CAST(cost AS DOUBLE) >= 0 "
                "AND NOT isnan(TRY_CAST(revenue AS DOUBLE)) AND NOT isnan(TRY_CAST(cost AS DOUBLE)) "
                "AND CAST(ROUND(TRY_CAST(units_sold AS DOUBLE)) AS INTEGER) >= 0")
SALES_NEG = ("(TRY_CAST(revenue AS DOUBLE) < 0 OR TRY_CAST(cost AS DOUBLE) < 0 "
             "OR CAST(ROUND(TRY_CAST(units_sold AS DOUBLE)) AS INTEGER) < 0)")

SALES_RANKED = f"""
sales_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY date, category, units_sold, revenue
                               ORDER BY {SALES_ORDER}) AS rn
  FROM sales_bronze WHERE {SALES_DATED}
)"""

SALES_SILVER = f"""
sales_silver AS (
  SELECT CAST(date AS DATE) AS date, category,
         TRY_CAST(revenue AS DOUBLE) AS revenue, TRY_CAST(cost AS DOUBLE) AS cost,
         CAST(ROUND(TRY_CAST(units_sold AS DOUBLE)) AS INTEGER) AS units_sold,
         TRY_CAST(revenue AS DOUBLE) - TRY_CAST(cost AS DOUBLE) AS profit
  FROM sales_ranked WHERE rn = 1 AND {SALES_NONNEG}
)"""

SALES_SILVER_WITH = f"WITH {SALES_BRONZE}, {SALES_RANKED}, {SALES_SILVER}"

PER_CATEGORY = """
per_cat AS (
  SELECT strftime(date, '%Y-%m') AS month, category,
         SUM(CAST(revenue AS DECIMAL(18,6))) AS category_revenue,
         SUM(CAST(cost AS DECIMAL(18,6))) AS category_cost,
         SUM(units_sold) AS category_units
  FROM sales_silver GROUP BY 1, 2
),
ranked_cat AS (
  SELECT month, category, category_revenue,
         ROW_NUMBER() OVER (PARTITION BY month ORDER BY category_revenue DESC, category ASC) AS rk
  FROM per_cat
),
monthly AS (
  SELECT month, SUM(category_revenue) AS rev, SUM(category_cost) AS cst, SUM(category_units) AS units
  FROM per_cat GROUP BY month
)"""

GOLD_CTE = """
gold AS (
  SELECT m.month, CAST(ROUND(m.rev, 2) AS DOUBLE) AS revenue, CAST(ROUND(m.cst, 2) AS DOUBLE) AS cost,
         ROUND(CAST(m.rev - m.cst AS DOUBLE) / NULLIF(CAST(m.rev AS DOUBLE), 0), 4) AS profit_margin,
         CAST(m.units AS BIGINT) AS units_sold, r.category AS top_category
  FROM monthly m JOIN ranked_cat r ON m.month = r.month AND r.rk = 1
)"""

GOLD_MONTHLY = f"""
{SALES_SILVER_WITH}, {PER_CATEGORY},{GOLD_CTE}"""


def dyn_valid(required, measures) -> str:
    conds = [present(c) for c in required]
    conds += [f"({present(c)[1:-1]} AND TRY_CAST({c} AS DOUBLE) >= 0 AND NOT isnan(TRY_CAST({c} AS DOUBLE)))" for c in measures]
    return " AND ".join(conds) if conds else "1=1"


# Texts with the branches that the driver tables lack, by key arithmetic. These expressions are read by both
# engines as they are.
STATEMENT_TEXT = """CASE (conv_id * 7 + turn) % 13
  WHEN 0 THEN 'SELECT month FROM gold_monthly_metrics'
  WHEN 1 THEN 'WITH t AS (SELECT 1 AS x) SELECT x FROM t -- drop table t'
  WHEN 2 THEN '/* update */ select category from silver_clean_sales'
  WHEN 3 THEN 'DROP TABLE silver_clean_sales'
  WHEN 4 THEN 'SELECT 1; DELETE FROM t; drop table x; delete from y'
  WHEN 5 THEN 'SELECT ' || chr(39) || '/*' || chr(39) || ', reflect(1), ' || chr(39) || '*/' || chr(39)
  WHEN 6 THEN 'SELECT ' || chr(39) || '--' || chr(39) || ', java_method(2)'
  WHEN 7 THEN '  ' || chr(10) || 'select ' || chr(39) || 'a -- fine' || chr(39) || ' as a --' || chr(10) || ' from t'
  WHEN 8 THEN 'insert into t select 1'
  WHEN 9 THEN '-- only a comment'
  WHEN 10 THEN 'SELECT "a /* b" FROM t /* exec */'
  WHEN 11 THEN 'explain select 1'
  ELSE text END"""

FENCED_TEXT = """CASE (conv_id + turn) % 6
  WHEN 0 THEN 'Here: ```sql' || chr(10) || 'SELECT 1' || chr(10) || '``` and ```other```'
  WHEN 1 THEN '```' || chr(10) || text || chr(10) || '```'
  WHEN 2 THEN 'SELECT 3' || chr(92) || 'nFROM t' || chr(92) || 't'
  WHEN 3 THEN text || ' ```SQL SELECT 2 ``` '
  ELSE text END"""

JSON_TEXT = """CASE event_id % 7
  WHEN 0 THEN '```json' || chr(10) || props || chr(10) || '```'
  WHEN 1 THEN '{oops'
  WHEN 2 THEN '{"j": 3}'
  WHEN 3 THEN '{"k": "x"}'
  WHEN 4 THEN '  ' || props || ' ' || chr(10)
  WHEN 5 THEN '```' || chr(10) || '{"k": 5}' || chr(10) || '```'
  ELSE props END"""

# Bronze with dates that are timestamps or no dates, and measures that are missing, malformed or NaN.
EDGE_BRONZE = """
edge_bronze AS (
  SELECT CASE l_orderkey % 11 WHEN 0 THEN 'not-a-date' WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 13:45:00'
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
         'C' || CAST(l_partkey % 5 AS VARCHAR) AS category,
         CASE l_suppkey % 13 WHEN 0 THEN 'NaN' WHEN 1 THEN 'abc' WHEN 2 THEN '' WHEN 3 THEN NULL
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS revenue,
         CASE l_linenumber WHEN 3 THEN 'NaN' ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS VARCHAR) END AS cost,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS units_sold,
         l_shipdate AS ingested_at, 'edge.csv' AS source_file, l_orderkey, l_linenumber
  FROM lineitem
)"""

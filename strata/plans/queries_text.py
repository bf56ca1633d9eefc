"""Registered queries: SQL guard over whole text tables, fence extraction, JSON validation,
guarded execution."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.constants import GUARD_COMMENT, GUARD_FORBIDDEN_KEYWORDS, GUARD_QUOTED, GUARD_SPARK_EXTRA_KEYWORDS
from strata.functions.formatting import markdown_row
from strata.functions.text import extract_fenced_sql, guard_check, json_valid, strip_json_fence
from strata.operators.guard import guarded_sql, temp_views
from strata.operators.report import format_metrics
from strata.plans import oracle as O
from strata.plans.fixtures import stored_sales_layers, table
from strata.plans.registry import register

_KW = ", ".join(f"'{k}'" for k in GUARD_FORBIDDEN_KEYWORDS + GUARD_SPARK_EXTRA_KEYWORDS)
_NONWORD = r"[^\p{L}\p{Nd}_]"


# the statement texts: each conversation turn as it is, and a derived statement beside it
_QUOTED = GUARD_QUOTED.replace("++", "+").replace("*+", "*")
_COMMENT = GUARD_COMMENT.replace("*+", "*")
_CUT = f"({_QUOTED})|{_COMMENT}".replace("'", "''")


def _with_derived(df, expr: str):
    return df.select("conv_id", "turn", F.lit(0).alias("variant"), "text").unionByName(
        df.select("conv_id", "turn", F.lit(1).alias("variant"), F.expr(expr).alias("text")))


def _texts(expr: str) -> str:
    return (f"texts AS (SELECT conv_id, turn, 0 AS variant, text FROM conversations UNION ALL "
            f"SELECT conv_id, turn, 1, {expr} FROM conversations)")


@register("sql_guard_audit", rf"""
WITH {_texts(O.STATEMENT_TEXT)},
g AS (
  SELECT conv_id, turn, variant, regexp_replace(regexp_replace(text, '{_CUT}', '\1', 'g'), '\A\s+|\s+\z', '', 'g') AS clean
  FROM texts
),
k AS (
  SELECT conv_id, turn, variant, regexp_matches(clean, '^(?i)(select|with)({_NONWORD}|$)') AS ro,
         list_filter(regexp_split_to_array(lower(clean), '{_NONWORD}+'), lambda w: list_contains([{_KW}], w)) AS kw
  FROM g
),
kd AS (SELECT conv_id, turn, variant, ro, list_filter(kw, lambda x, i: list_position(kw, x) = i) AS kw FROM k)
SELECT conv_id, turn, variant, ro AND len(kw) = 0 AS is_safe,
       CASE WHEN NOT ro THEN 'Query must be a read-only SELECT or WITH statement.'
            WHEN len(kw) > 0 THEN 'Query contains forbidden write/modify keyword(s): ' || array_to_string(kw, ', ')
            ELSE '' END AS message
FROM kd""")
def sql_guard_audit(spark, d):
    rows = _with_derived(table(spark, d, "conversations"), O.STATEMENT_TEXT)
    return rows.select("conv_id", "turn", "variant", guard_check("text").alias("g")).select(
        "conv_id", "turn", "variant", "g.is_safe", "g.message")


@register("fence_extract", rf"""
WITH {_texts(O.FENCED_TEXT)}
SELECT conv_id, turn, variant,
  replace(replace(regexp_replace(
    CASE WHEN regexp_matches(text, '(?is)```sql(.*?)```') THEN regexp_extract(text, '(?is)```sql(.*?)```', 1)
         WHEN regexp_matches(text, '(?s)```(.*?)```') THEN regexp_extract(text, '(?s)```(.*?)```', 1)
         ELSE text END, '\A\s+|\s+\z', '', 'g'), '\n', chr(10)), '\t', chr(9)) AS extracted
FROM texts""")
def fence_extract(spark, d):
    rows = _with_derived(table(spark, d, "conversations"), O.FENCED_TEXT)
    return rows.select("conv_id", "turn", "variant", extract_fenced_sql("text").alias("extracted"))


PROPS_SCHEMA = StructType([StructField("k", LongType())])


@register("json_validate", rf"""
WITH e AS (
  SELECT event_id, variant,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(props, '\A\s+|\s+\z', '', 'g'),
           '(?i)\A```(json)?[ \t]*\n?', '', 'g'), '\n?```\z', '', 'g'), '\A\s+|\s+\z', '', 'g') AS body
  FROM (SELECT event_id, 0 AS variant, props FROM events UNION ALL SELECT event_id, 1, {O.JSON_TEXT} FROM events) x
),
v AS (SELECT event_id, variant, CASE WHEN json_valid(body) THEN TRY_CAST(json_extract_string(body, '$.k') AS BIGINT) END AS k FROM e)
SELECT event_id, variant, k IS NOT NULL AS is_valid, k FROM v""")
def json_validate(spark, d):
    ev = table(spark, d, "events")
    rows = ev.select("event_id", F.lit(0).alias("variant"), "props").unionByName(
        ev.select("event_id", F.lit(1).alias("variant"), F.expr(O.JSON_TEXT).alias("props")))
    body = strip_json_fence("props")
    parsed = F.from_json(body, PROPS_SCHEMA)
    return rows.select("event_id", "variant", json_valid(body, PROPS_SCHEMA, ["k"]).alias("is_valid"),
                       parsed.getField("k").alias("k"))


@register("guarded_sql", f"""
{O.SALES_SILVER_WITH}
SELECT category, CAST(COUNT(*) AS BIGINT) AS sales, CAST(SUM(units_sold) AS BIGINT) AS units
FROM sales_silver GROUP BY category""")
def guarded_sql_q(spark, d):
    with temp_views(spark, silver_clean_sales=stored_sales_layers(spark, d)[1]):
        return guarded_sql(spark, "-- sales per category\nSELECT category, COUNT(*) AS sales, "
                                  "CAST(SUM(units_sold) AS BIGINT) AS units FROM silver_clean_sales "
                                  "GROUP BY category")


@register("gold_markdown", f"""
{O.GOLD_MONTHLY},
m AS (SELECT CASE WHEN abs(arg_min(profit_margin, month)) <= 1 THEN 100.0 ELSE 1.0 END AS mult
      FROM gold WHERE profit_margin IS NOT NULL)
SELECT month, '| ' || concat_ws(' | ', month,
       '$' || format('{{:,.2f}}', revenue), '$' || format('{{:,.2f}}', cost),
       printf('%.2f%%', profit_margin * m.mult), format('{{:,}}', CAST(trunc(units_sold) AS BIGINT)),
       top_category) || ' |' AS line
FROM gold, m""")
def gold_markdown(spark, d):
    g = format_metrics(stored_sales_layers(spark, d)[3])
    return g.select("month", markdown_row(g.columns).alias("line"))

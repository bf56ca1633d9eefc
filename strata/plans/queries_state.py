"""Registered queries: row numbers, profiles in order of appearance and by delivery, streamed deliveries, run clock, row limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.constants import SALES_COLUMNS
from strata.operators.guard import guarded_sql, temp_views
from strata.operators.ids import number_rows
from strata.operators.profile import profile_table
from strata.operators.profile_state import profile_of, profile_state, store_delivery, stored_profile
from strata.operators.silver import silver_sales
from strata.plans import oracle as O
from strata.plans.fixtures import SALES_ROW_ID, stored_bronze, stored_sales_layers
from strata.plans.incremental import Lake
from strata.plans.queries_io import ODD_BRONZE, _write_landing
from strata.plans.queries_profile import LINEITEM_COLS, _profile_oracle
from strata.plans.registry import register
from strata.session import scratch_path
from strata.streaming.deliveries import stream_deliveries


@register("numbered_rows", f"""
{O.SALES_SILVER_WITH}
SELECT category, COUNT(*) AS row_count, (SELECT COUNT(*) FROM sales_silver) AS last_id,
       (SELECT COUNT(*) FROM sales_silver) AS distinct_ids, CAST(1 AS BIGINT) AS first_id
FROM sales_silver GROUP BY category""")
def numbered_rows(spark, d):
    """Silver numbered without gaps: rows per category, and the ids' extremes and number over the whole table."""
    s = number_rows(stored_sales_layers(spark, d)[1], scratch_path(spark, "numbered"))
    ids = s.agg(F.min("row_no").alias("first_id"), F.max("row_no").alias("last_id"), F.count_distinct("row_no").alias("distinct_ids"))
    per = s.groupBy("category").agg(F.count("row_no").alias("row_count"))
    return per.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in ids.first().asDict().items()])


def _by_appearance(sql: str, position: str) -> str:
    """The profile's SQL with samples in order of appearance."""
    return (sql.replace(" AS value FROM", f" AS value, {position} AS pos FROM")
            .replace("value, COUNT(*) AS n FROM long", "value, COUNT(*) AS n, MIN(pos) AS pos FROM long")
            .replace("SELECT column_name, value, ROW_NUMBER()", "SELECT column_name, value, pos, ROW_NUMBER()")
            .replace("ORDER BY value", "ORDER BY pos, value"))


@register("profile_first_seen", _by_appearance(_profile_oracle(O.LINEITEM_BRONZE, "lineitem_bronze", LINEITEM_COLS),
                                               "CAST(l_orderkey AS BIGINT) * 100 + CAST(l_linenumber AS BIGINT)"))
def profile_first_seen(spark, d):
    """The profile with the first five values of each column as samples, rows taken in the order of their order lines."""
    bronze = stored_bronze(spark, d, "lineitem")
    at = F.col("l_orderkey").cast("bigint") * 100 + F.col("l_linenumber").cast("bigint")
    return profile_of(profile_state(bronze, LINEITEM_COLS, appearance=at)).withColumn("samples", F.array_join("samples", "|"))


@register("profile_deliveries", _profile_oracle(O.SALES_BRONZE, "sales_bronze", list(SALES_COLUMNS)).replace(
    "SELECT * FROM p", "SELECT * EXCLUDE (cardinality), true AS close FROM p"))
def profile_deliveries(spark, d):
    """The first delivery and the corrections profiled apart and merged: as the profile of all rows, with estimates of
    the distinct values that are within 5%."""
    bronze, path = stored_bronze(spark, d, "sales"), scratch_path(spark, "profiles")
    for i in (0, 1):
        store_delivery(bronze.where(F.col("_batch") == i), path, str(i), SALES_COLUMNS)
    got = stored_profile(spark, path).withColumn("samples", F.array_join("samples", "|"))
    exact = profile_table(bronze, SALES_COLUMNS, samples=0).select("column_name", F.col("cardinality").alias("exact"))
    close = F.abs(F.col("cardinality") - F.col("exact")) <= 0.05 * F.col("exact")
    return got.join(exact, "column_name").withColumn("close", close).drop("cardinality", "exact")


@register("streamed_deliveries", f"""
WITH {ODD_BRONZE}, {O.SALES_RANKED},
q AS (
  SELECT 'Missing/Invalid Date' AS rejection_reason FROM sales_bronze WHERE {O.missing('date')}
  UNION ALL SELECT 'Missing/Invalid Category' FROM sales_bronze WHERE {O.present('date')} AND {O.missing('category')}
  UNION ALL SELECT 'Negative Numeric Metric(s)' FROM sales_bronze WHERE {O.SALES_DATED} AND {O.SALES_NEG}
  UNION ALL SELECT 'Duplicate Transaction' FROM sales_ranked WHERE rn > 1 AND {O.SALES_NONNEG})
SELECT rejection_reason, COUNT(*) AS row_count FROM q GROUP BY rejection_reason""")
def streamed_deliveries(spark, d):
    """Landing files streamed in several micro-batches: the rejections, those of duplicates in other micro-batches
    included, are those of one run over all files. The last batch is delivered a second time, which changes nothing."""
    landing, root = f"{_write_landing(spark, d)[0].rsplit('/', 1)[0]}/*", scratch_path(spark, "streamed")
    lake = Lake(spark, f"{root}/lake")
    stream_deliveries(lake, landing, f"{root}/checkpoint", "landing", max_files_per_trigger=5, multi_line=True, keep=1).awaitTermination()
    last = lake.manifest()["streams"]["landing"]
    lake.deliver(landing, multi_line=True, batch=("landing", last))
    return lake.layers().quarantine.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("row_count"))


@register("run_clock", f"""
{O.SALES_SILVER_WITH}
SELECT COUNT(*) AS silver_rows, CAST(1 AS BIGINT) AS clocks, true AS within_the_day FROM sales_silver""")
def run_clock(spark, d):
    """Without a run time of its own a run is stamped with the present, once for all rows."""
    s = silver_sales(stored_bronze(spark, d, "sales"), row_id=SALES_ROW_ID)
    near = F.abs(F.unix_timestamp("cleaned_at") - F.unix_timestamp(F.current_timestamp())) < 86400
    return s.agg(F.count(F.lit(1)).alias("silver_rows"), F.count_distinct("cleaned_at").alias("clocks"), F.every(near).alias("within_the_day"))


@register("limited_sql", f"""
{O.SALES_SILVER_WITH}
SELECT category, CAST(COUNT(*) AS BIGINT) AS sales FROM sales_silver GROUP BY category ORDER BY sales DESC, category LIMIT 4""")
def limited_sql(spark, d):
    """A guarded statement with a row limit: the limit is the feature."""
    with temp_views(spark, silver_clean_sales=stored_sales_layers(spark, d)[1]):
        return guarded_sql(spark, "SELECT category, COUNT(*) AS sales FROM silver_clean_sales GROUP BY category ORDER BY sales DESC, category", 4)

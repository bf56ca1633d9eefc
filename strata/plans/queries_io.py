"""Registered queries: CSV landing → bronze → gold → CSV export round trip, keyed
upsert, streaming landing zone, profile JSON, catalog and workspaces."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from strata.constants import BRONZE_TABLE, GOLD_TABLE, QUARANTINE_TABLE, SALES_COLUMNS, SILVER_TABLE
from strata.operators.gold import gold_monthly
from strata.operators.guard import GuardError, PlanValidationError, run_guarded_sql
from strata.operators.model import Profile
from strata.operators.profile import build_profile
from strata.operators.silver import silver, silver_sales
from strata.plans import oracle as O
from strata.operators.layers import FIELD_COUNT, MALFORMED
from strata.plans.fixtures import SALES_ROW_ID, TABLE_ROW_ID, lent_bronze, stored_bronze, stored_sales_layers, table
from strata.plans.incremental import Lake
from strata.plans.medallion import run_medallion
from strata.plans.queries_layers import CUSTOMER_PROFILE
from strata.plans.queries_profile import CUSTOMER_COLS, _profile_oracle
from strata.plans.registry import register
from strata.session import discard, scratch_path
from strata.sources import catalog as C
from strata.sources import files as IO
from strata.sources.schemas import silver_schema
from strata.streaming.landing import ingest_landing

GOLD_SCHEMA = StructType([
    StructField("month", StringType()), StructField("revenue", DoubleType()),
    StructField("cost", DoubleType()), StructField("profit_margin", DoubleType()),
    StructField("units_sold", LongType()), StructField("top_category", StringType()),
])


# Landing values that need quoting: a separator, quotes, blanks at the ends, a line break. Both engines read this.
ODD_CATEGORY = """CASE length(category) % 5 WHEN 0 THEN category || ', "' || category || '"' WHEN 1 THEN ' ' || category || ' '
  WHEN 2 THEN category || chr(10) || 'x' WHEN 3 THEN '"' || category ELSE category END"""
ODD_BRONZE = O.SALES_BRONZE.replace("sales_bronze AS (", "plain_bronze AS (") + f""",
sales_bronze AS (SELECT date, CASE WHEN category = '' THEN '' ELSE {ODD_CATEGORY} END AS category, revenue, cost, units_sold, ingested_at, source_file
  FROM plain_bronze)"""


#: Tasks that write the landing files: as many as the deployment has cores, since a file of quoted line breaks is read by one task.
LANDING_TASKS = 12
LANDING_OPTIONS = {**IO.CSV_OPTIONS, "compression": "gzip"}


def _write_landing(spark, d) -> list[str]:
    """Drop the sales bronze text as landing CSV files (the raw columns only): half of the rows in files of another
    column order, with one column more. They are compressed, as a file of quoted line breaks is read by one task anyway."""
    odd = F.when(F.col("category") == "", "").otherwise(F.expr(ODD_CATEGORY))
    half = F.pmod(F.xxhash64("_src_file", "_src_row", "_batch"), F.lit(2)) == 0
    root = scratch_path(spark, "landing")
    with lent_bronze(spark, d, "sales") as bronze:
        rows = bronze.withColumn("category", odd).coalesce(LANDING_TASKS)  # a task writes one file of each kind
        for name, part, cols in (("a", half, list(SALES_COLUMNS)), ("b", ~half, ["units_sold", "cost", "_batch", "revenue", "date", "category"])):
            (rows.where(part).select(*cols).write.options(**LANDING_OPTIONS, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
             .csv(f"{root}/{name}"))
    return [f"{root}/a", f"{root}/b"]


_ODD_SILVER = f"WITH {ODD_BRONZE}, {O.SALES_RANKED}, {O.SALES_SILVER}"


@register("csv_roundtrip", f"""
{_ODD_SILVER}, {O.PER_CATEGORY},{O.GOLD_CTE}
SELECT * FROM gold""")
def csv_roundtrip(spark, d):
    """landing CSV → all-text bronze (append) → silver → gold → CSV export → typed re-read."""
    landing = _write_landing(spark, d)
    bronze_path, gold_dir = scratch_path(spark, "bronze"), scratch_path(spark, "gold_csv")
    assert IO.csv_header(spark, landing) == list(SALES_COLUMNS)
    IO.ingest_csv(spark, landing, bronze_path, SALES_COLUMNS, multi_line=True)
    bronze = spark.read.parquet(bronze_path)
    IO.export_csv(gold_monthly(silver_sales(bronze)), gold_dir, single_file=True)
    return IO.read_typed_csv(spark, gold_dir, GOLD_SCHEMA, multi_line=True)


@register("csv_landing_values", f"""
WITH {ODD_BRONZE}
SELECT date, category, revenue, cost, units_sold, COUNT(*) AS copies FROM sales_bronze GROUP BY ALL""")
def csv_landing_values(spark, d):
    """Every landed value as it was written, whatever its file's column order."""
    rows = IO.read_landing_csv(spark, _write_landing(spark, d), SALES_COLUMNS, multi_line=True)
    return rows.groupBy(*SALES_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))


#: What becomes of a record by its order key: a separator too many, a field too few, a field too many, units that no
#: 32-bit number holds, none of these. Both engines read this.
_BREAK = "CAST(l_orderkey % 11 AS INTEGER)"


@register("malformed_rows", f"""
WITH r AS (SELECT {_BREAK} AS k FROM lineitem)
SELECT layer, reason, field_count, COUNT(*) AS row_count FROM (
  SELECT CASE WHEN k < 4 THEN 'quarantine' ELSE 'silver' END AS layer,
         CASE WHEN k < 3 THEN 'Malformed Row' WHEN k = 3 THEN 'Numeric Metric Out of Range' END AS reason,
         CASE k WHEN 0 THEN 6 WHEN 1 THEN 4 WHEN 2 THEN 7 END AS field_count FROM r
  UNION ALL SELECT 'bronze', NULL, CASE k WHEN 0 THEN 6 WHEN 1 THEN 4 WHEN 2 THEN 7 END FROM r) GROUP BY ALL""")
def malformed_rows(spark, d):
    """Landing files with records of too few and too many fields and with units beyond 32 bits, through the whole flow:
    every bronze row is in silver or, with a reason of its own, in quarantine. Quarantined records by their fields."""
    li, k = table(spark, d, "lineitem").select("*", "_metadata.file_name", "_metadata.row_index"), F.expr(_BREAK)
    category = F.concat_ws("-", F.lit("C"), F.hex(F.xxhash64("file_name")), "row_index")  # no two records are copies
    fields = [F.date_format("l_shipdate", "yyyy-MM-dd"), F.when(k == 0, F.concat(category, F.lit(", x"))).otherwise(category), F.lit("12.50"), F.lit("3.25"),
              F.when(k == 1, F.lit(None)).when(k == 3, "3000000000").otherwise("7"), F.when(k == 2, "surplus"), F.when(k == 2, "more")]
    root = scratch_path(spark, "malformed")
    line = F.concat_ws(",", *fields).alias(",".join(SALES_COLUMNS))  # a line a record, under the header of its file
    li.select(line).write.options(header=True, sep=chr(1), quote="").csv(f"{root}/landing")
    layers = run_medallion(spark, f"{root}/landing", f"{root}/lake", run_ts="2026-01-01 00:00:00", export=False)
    noted = layers.bronze.select(F.lit("bronze").alias("layer"), F.lit(None).cast("string").alias("reason"), F.col(FIELD_COUNT).alias("field_count"))
    # the text of a quarantined record names its fields: those of the header, and what ingestion noted beside them
    of = layers.bronze.where(F.col(MALFORMED).isNotNull()).select(F.col("category").alias("raw_category"), FIELD_COUNT)
    rejected = layers.quarantine.join(of, "raw_category", "left").select(F.lit("quarantine"), "rejection_reason", FIELD_COUNT)
    kept = layers.silver.select(F.lit("silver"), F.lit(None).cast("string"), F.lit(None).cast("int"))
    return noted.union(rejected).union(kept).groupBy("layer", "reason", "field_count").agg(F.count(F.lit(1)).alias("row_count"))


def _gold_chain(prefix: str, where: str) -> str:
    """Static silver → gold CTE chain over a filtered sales_bronze (names prefixed)."""
    p = prefix
    return f"""
{p}ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY date, category, units_sold, revenue ORDER BY {O.SALES_ORDER}) AS rn
  FROM sales_bronze WHERE {O.SALES_DATED} AND {where}
),
{p}silver AS (
  SELECT CAST(date AS DATE) AS date, category, TRY_CAST(revenue AS DOUBLE) AS revenue,
         TRY_CAST(cost AS DOUBLE) AS cost, CAST(ROUND(TRY_CAST(units_sold AS DOUBLE)) AS INTEGER) AS units_sold
  FROM {p}ranked WHERE rn = 1 AND {O.SALES_NONNEG}
),
{p}per_cat AS (
  SELECT strftime(date, '%Y-%m') AS month, category, SUM(CAST(revenue AS DECIMAL(18,6))) AS category_revenue,
         SUM(CAST(cost AS DECIMAL(18,6))) AS category_cost, SUM(units_sold) AS category_units
  FROM {p}silver GROUP BY 1, 2
),
{p}top AS (
  SELECT month, category FROM (
    SELECT month, category, ROW_NUMBER() OVER (PARTITION BY month ORDER BY category_revenue DESC, category) AS rk
    FROM {p}per_cat) t WHERE rk = 1
),
{p}gold AS (
  SELECT m.month, CAST(ROUND(m.rev, 2) AS DOUBLE) AS revenue, CAST(ROUND(m.cst, 2) AS DOUBLE) AS cost,
         ROUND(CAST(m.rev - m.cst AS DOUBLE) / NULLIF(CAST(m.rev AS DOUBLE), 0), 4) AS profit_margin,
         CAST(m.units AS BIGINT) AS units_sold, t.category AS top_category
  FROM (SELECT month, SUM(category_revenue) AS rev, SUM(category_cost) AS cst, SUM(category_units) AS units
        FROM {p}per_cat GROUP BY month) m JOIN {p}top t ON m.month = t.month
)"""


@register("upsert_gold", f"""
WITH {O.SALES_BRONZE}, {_gold_chain('t_', "source_file LIKE 'sales_%'")}, {_gold_chain('u_', '1=1')}
SELECT * FROM t_gold WHERE month NOT IN (SELECT month FROM u_gold WHERE month >= '2000-01')
UNION ALL
SELECT * FROM u_gold WHERE month >= '2000-01'""")
def upsert_gold(spark, d):
    """Gold of the original deliveries, with the months from 2000 on restated from
    all deliveries (corrections included): insert-or-replace on ``month``.  The
    restated months are cut out by date before the dedup and written once."""
    b = stored_bronze(spark, d, "sales")
    target = gold_monthly(silver_sales(b.where(F.col("_batch") == 0), row_id=SALES_ROW_ID))
    path = scratch_path(spark, "restated")
    IO.write_layer(gold_monthly(silver_sales(b.where(F.col("date") >= "2000-01"), row_id=SALES_ROW_ID)).where(F.col("month") >= "2000-01"), path)
    return IO.upsert(target, spark.read.parquet(path), ["month"])


@register("stream_landing", f"""
WITH {ODD_BRONZE}
SELECT rejection_reason, COUNT(*) AS row_count FROM (
  SELECT 'Missing/Invalid Date' AS rejection_reason FROM sales_bronze WHERE {O.missing('date')}
  UNION ALL SELECT 'Missing/Invalid Category' FROM sales_bronze WHERE {O.present('date')} AND {O.missing('category')}
  UNION ALL SELECT 'Negative Numeric Metric(s)' FROM sales_bronze WHERE {O.SALES_DATED} AND {O.SALES_NEG}
) q GROUP BY rejection_reason""")
def stream_landing(spark, d):
    """Landing files ingested by a Structured Streaming query (a few files per
    micro-batch, available-now trigger), each by its own header; the row-rule
    quarantine written per batch, counted by reason."""
    landing = _write_landing(spark, d)[0].rsplit("/", 1)[0] + "/*"
    bronze_path, q_path = scratch_path(spark, "stream_bronze"), scratch_path(spark, "stream_quarantine")
    q = ingest_landing(spark, landing, bronze_path, scratch_path(spark, "stream_ckpt"), SALES_COLUMNS,
                       quarantine_path=q_path, max_files_per_trigger=5, multi_line=True)
    q.awaitTermination()
    return (spark.read.parquet(q_path).groupBy("rejection_reason")
            .agg(F.count(F.lit(1)).cast("bigint").alias("row_count")))


@register("medallion_run", f"""
{_ODD_SILVER},
n AS (SELECT (SELECT COUNT(*) FROM sales_bronze) AS b,
             (SELECT COUNT(*) FROM (SELECT DISTINCT date, category, units_sold, revenue FROM sales_bronze WHERE {O.SALES_DATED} AND {O.SALES_NONNEG})) AS s)
SELECT run, layer, CAST(CASE layer WHEN 'bronze' THEN b * f WHEN 'silver' THEN s WHEN 'quarantine' THEN b * f - s ELSE 0 END AS BIGINT) AS row_count
FROM n, (VALUES ('first', 1), ('again', 1), ('appended', 2)) r(run, f), (VALUES ('bronze'), ('silver'), ('quarantine'), ('unaccounted')) l(layer)""")
def medallion_run(spark, d):
    """The whole flow three times over the same files and with the same run time: anew, anew again (the layers are
    the same), and appended (every row is there twice, and none is lost). Layers are read as the tenant's tables."""
    landing, root, ws = f"{_write_landing(spark, d)[0].rsplit('/', 1)[0]}/*", scratch_path(spark, "lake"), "medallion-run"
    C.create_workspace(spark, ws, f"{root}/db")
    out = None
    for run, refresh in (("first", True), ("again", True), ("appended", False)):
        run_medallion(spark, landing, root, run_ts="2026-01-01 00:00:00", export=False, workspace=ws, refresh=refresh, multi_line=True)
        n = {layer: run_guarded_sql(spark, f"SELECT COUNT(*) AS n FROM {t}", ws).first()["n"]
             for layer, t in (("bronze", BRONZE_TABLE), ("silver", SILVER_TABLE), ("quarantine", QUARANTINE_TABLE))}
        n["unaccounted"] = n["bronze"] - n["silver"] - n["quarantine"]
        part = spark.createDataFrame([(run, k, v) for k, v in n.items()], "run string, layer string, row_count bigint")
        out = part if out is None else out.unionByName(part)
    discard(spark, landing[:-2])
    return out


@register("delivered_layers", f"""
WITH {O.SALES_BRONZE}, {O.SALES_RANKED}, {O.SALES_SILVER}, {O.PER_CATEGORY},{O.GOLD_CTE}
SELECT 'bronze' AS layer, NULL AS label, COUNT(*) AS row_count, NULL AS revenue FROM sales_bronze
UNION ALL SELECT 'silver', NULL, COUNT(*), CAST(round(SUM(CAST(revenue AS DECIMAL(18,6))), 2) AS DOUBLE) FROM sales_silver
UNION ALL SELECT 'gold', month, units_sold, revenue FROM gold
UNION ALL SELECT 'quarantine', 'Missing/Invalid Date', COUNT(*), NULL FROM sales_bronze WHERE {O.missing('date')}
UNION ALL SELECT 'quarantine', 'Missing/Invalid Category', COUNT(*), NULL FROM sales_bronze WHERE {O.present('date')} AND {O.missing('category')}
UNION ALL SELECT 'quarantine', 'Negative Numeric Metric(s)', COUNT(*), NULL FROM sales_bronze WHERE {O.SALES_DATED} AND {O.SALES_NEG}
UNION ALL SELECT 'quarantine', 'Duplicate Transaction', COUNT(*), NULL FROM sales_ranked WHERE rn > 1 AND {O.SALES_NONNEG}""")
def delivered_layers(spark, d):
    """The layers after three deliveries (the early days, the others, the corrections of both), each merged into the
    state that the ones before it left. The third touches months of both."""
    root = scratch_path(spark, "deliveries")
    early = F.coalesce(F.col("date") < "1996-07", F.lit(True))
    parts = ((F.col("_batch") == 0) & early, (F.col("_batch") == 0) & ~early, F.col("_batch") == 1)
    with lent_bronze(spark, d, "sales") as rows:
        for i, part in enumerate(parts):
            rows.where(part).select(*SALES_COLUMNS).write.options(**LANDING_OPTIONS).csv(f"{root}/{i}")
    lake = Lake(spark, f"{root}/lake")
    for i in range(len(parts)):
        lake.deliver(f"{root}/{i}", run_ts=f"2026-01-0{i + 1} 00:00:00")
        lake.vacuum()  # nobody reads the version before
        discard(spark, f"{root}/{i}")
    v = lake.layers()
    label, none = F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("revenue")
    n = F.count(F.lit(1)).alias("row_count")
    return (v.bronze.agg(n).select(F.lit("bronze").alias("layer"), label, "row_count", none)
            .unionByName(v.silver.agg(n, F.round(F.sum(F.col("revenue").cast("decimal(18,6)")), 2).cast("double").alias("revenue")).select(F.lit("silver").alias("layer"), label, "row_count", "revenue"))
            .unionByName(v.gold.select(F.lit("gold").alias("layer"), F.col("month").alias("label"), F.col("units_sold").alias("row_count"), "revenue"))
            .unionByName(v.quarantine.groupBy(F.col("rejection_reason").alias("label")).agg(n).select(F.lit("quarantine").alias("layer"), "label", "row_count", none)))


@register("profile_json_roundtrip", _profile_oracle(O.CUSTOMER_BRONZE, "customer_bronze", CUSTOMER_COLS, with_roles=True)
          .replace("SELECT column_name, ordinal, CASE", "SELECT column_name, ordinal, dtype, null_pct, cardinality, min_val, max_val, samples, CASE"))
def profile_json_roundtrip(spark, d):
    """Profile, roles and statistics of customer written as nested JSON and read back in full."""
    prof = build_profile(stored_bronze(spark, d, "customer"), CUSTOMER_COLS)
    path = scratch_path(spark, "profile_json")
    IO.write_profile(spark, prof, path)
    back = IO.read_profile(spark, path)
    rows = [(c.name, i, c.role, c.stats["dtype"], c.stats["null_pct"], c.stats["cardinality"], c.stats["min_val"], c.stats["max_val"],
             "|".join(c.stats["samples"])) for i, c in enumerate(back.columns)]
    return spark.createDataFrame(rows, "column_name string, ordinal int, role string, dtype string, null_pct string, cardinality bigint, "
                                       "min_val double, max_val double, samples string")


def _two_workspaces(spark, d):
    root = scratch_path(spark, "workspaces")
    sales_ws, cust_ws = "sales-ops", "customer-care"
    for ws in (sales_ws, cust_ws):
        C.create_workspace(spark, ws, f"{root}/{C.workspace_database(ws)}")
    _, s, q, _ = stored_sales_layers(spark, d)
    C.save_layer(s, sales_ws, SILVER_TABLE, f"{root}/s1")
    C.save_layer(q, sales_ws, QUARANTINE_TABLE, f"{root}/q1")
    C.save_layer(silver(stored_bronze(spark, d, "customer"), CUSTOMER_PROFILE, row_id=TABLE_ROW_ID), cust_ws, SILVER_TABLE, f"{root}/s2")
    return sales_ws, cust_ws


_CUSTOMERS = f"(SELECT COUNT(DISTINCT c_custkey) FROM customer_bronze WHERE {O.dyn_valid(CUSTOMER_PROFILE.required, CUSTOMER_PROFILE.measures)})"


@register("workspace_isolation", f"""
WITH {O.SALES_BRONZE}, {O.SALES_RANKED}, {O.SALES_SILVER}, {O.CUSTOMER_BRONZE},
n AS (SELECT 'sales-ops' AS workspace, (SELECT COUNT(*) FROM sales_silver) AS silver_rows UNION ALL SELECT 'customer-care', {_CUSTOMERS})
SELECT workspace, attempt, CASE WHEN attempt LIKE 'own%' THEN CAST(silver_rows AS BIGINT) END AS silver_rows,
       CASE WHEN attempt LIKE 'own%' THEN 'answered' WHEN attempt = 'column' THEN 'rejected' ELSE 'blocked' END AS outcome
FROM n, (VALUES ('own'), ('own qualified'), ('column'), ('database'), ('catalog'), ('path'), ('subquery'), ('identifier'), ('identifier in join'),
  ('identifier of catalog'), ('identifier in cte'), ('composed identifier'), ('identifier function'), ('function'), ('exists'), ('view')) a(attempt)""")
def workspace_isolation(spark, d):
    """The same table name in two workspaces: a tenant reads its own rows only; a column of the other tenant does not
    resolve, and its database, by any name or expression, through a view or a subquery, or a path is refused."""
    spaces = _two_workspaces(spark, d)
    rows = []
    for ws, other, column in ((spaces[0], spaces[1], "c_acctbal"), (spaces[1], spaces[0], "revenue")):
        db, own = C.workspace_database(other), C.workspace_database(ws)
        spark.sql(f"CREATE OR REPLACE VIEW `{own}`.peek AS SELECT * FROM `{db}`.{SILVER_TABLE}")
        attempts = {"own": f"SELECT COUNT(*) AS n FROM {SILVER_TABLE}", "column": f"SELECT COUNT({column}) AS n FROM {SILVER_TABLE}",
                    "database": f"SELECT COUNT(*) AS n FROM `{db}`.{SILVER_TABLE}", "catalog": f"SELECT COUNT(*) AS n FROM spark_catalog.{db}.{SILVER_TABLE}",
                    "path": "SELECT COUNT(*) AS n FROM parquet.`/any/path`",
                    "subquery": f"WITH t AS (SELECT 1 AS x) SELECT (SELECT COUNT(*) FROM {db}.{SILVER_TABLE}) AS n FROM t",
                    "own qualified": f"SELECT COUNT(*) AS n FROM {own}.{SILVER_TABLE}",
                    "identifier": f"SELECT COUNT(*) AS n FROM IDENTIFIER('{db}.{SILVER_TABLE}')",
                    "identifier in join": f"SELECT COUNT(*) AS n FROM {SILVER_TABLE} a CROSS JOIN IDENTIFIER('{db}.{SILVER_TABLE}') b",
                    "identifier of catalog": f"SELECT COUNT(*) AS n FROM IDENTIFIER('spark_catalog.{db}.{SILVER_TABLE}')",
                    "identifier in cte": f"WITH t AS (SELECT * FROM IDENTIFIER('{db}.{SILVER_TABLE}')) SELECT COUNT(*) AS n FROM t",
                    "composed identifier": f"SELECT COUNT(*) AS n FROM IDENTIFIER('{db}' || '.{SILVER_TABLE}')",
                    "identifier function": "SELECT IDENTIFIER('java_' || 'method')('java.lang.Math', 'abs', 1) AS n",
                    "function": "SELECT input_file_block_start() AS n",
                    "exists": f"SELECT COUNT(*) AS n FROM {SILVER_TABLE} WHERE EXISTS (SELECT 1 FROM `{db}`.{SILVER_TABLE})",
                    "view": "SELECT COUNT(*) AS n FROM peek"}
        for attempt, sql in attempts.items():
            try:
                rows.append((ws, attempt, int(run_guarded_sql(spark, sql, ws).first()["n"]), "answered"))
            except PlanValidationError:
                rows.append((ws, attempt, None, "rejected"))
            except GuardError:
                rows.append((ws, attempt, None, "blocked"))
        spark.sql(f"DROP VIEW `{own}`.peek")
    return spark.createDataFrame(rows, "workspace string, attempt string, silver_rows bigint, outcome string")


@register("schema_context", """
SELECT * FROM (VALUES
  ('quarantine_rejected_sales', 'raw_date string, raw_category string, raw_revenue string, raw_cost string, raw_units_sold string, source_file string, '
   || 'ingested_at string, rejection_reason string, quarantined_at timestamp', 3, 3),
  ('silver_clean_sales', 'id bigint, date date, category string, revenue double, cost double, units_sold int, profit double, cleaned_at timestamp', 3, 3)
) t(table_name, columns, samples, known)""")
def schema_context(spark, d):
    """Tables and typed columns of one workspace, with how many sample rows there are and how many of them the
    tables hold."""
    sales_ws, _ = _two_workspaces(spark, d)
    db = C.workspace_database(sales_ws)
    ctx = C.schema_context(spark, db, samples=3)
    lines = None
    for t in (QUARANTINE_TABLE, SILVER_TABLE):
        df = spark.table(f"`{db}`.`{t}`")
        part = df.select(F.lit(t).alias("table_name"), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in df.columns]).alias("line"))
        lines = part if lines is None else lines.unionByName(part)
    # the tables' rows stay where they are; the few shown ones are sent to them
    shown = ctx.select("table_name", F.explode(F.array_distinct("sample_rows")).alias("line"))
    known = lines.join(F.broadcast(shown), ["table_name", "line"], "left_semi").distinct().groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("distinct_known"))
    distinct = F.size(F.array_distinct("sample_rows"))
    return (ctx.join(known, "table_name").select("table_name", "columns", F.size("sample_rows").alias("samples"),
                                                 (F.size("sample_rows") - distinct + F.col("distinct_known")).cast("int").alias("known")))


@register("layer_maintenance", f"""
{O.GOLD_MONTHLY},
m AS (SELECT month, revenue FROM gold UNION ALL SELECT month || '-x', revenue FROM gold WHERE month >= '2000-01' UNION ALL SELECT 'note', 1.5)
SELECT step, CAST(CASE step WHEN 'refreshed' THEN (SELECT COUNT(*) FROM gold) WHEN 'appended by name' THEN (SELECT COUNT(*) FROM gold WHERE month >= '2000-01')
  WHEN 'appended rows' THEN 1 WHEN 'table' THEN (SELECT COUNT(*) FROM m) WHEN 'concatenated' THEN 2 * (SELECT COUNT(*) FROM m) ELSE 1 END AS BIGINT) AS row_count,
  CASE WHEN step IN ('table', 'concatenated') THEN (SELECT round(SUM(revenue), 2) FROM m) * CASE step WHEN 'table' THEN 1 ELSE 2 END END AS revenue
FROM (VALUES ('refreshed'), ('appended by name'), ('appended rows'), ('table'), ('concatenated'), ('loaded')) s(step)""")
def layer_maintenance(spark, d):
    """Full refresh, insert by column list, append of a row batch, create-table-as, append of frames, non-empty check."""
    gold, path, ws = stored_sales_layers(spark, d)[3], scratch_path(spark, "maintained"), "maintenance"
    IO.write_layer(gold.select("month", "revenue"), path)
    IO.refresh_in_place(spark.read.parquet(path).where("revenue IS NOT NULL"), path)
    steps = {"refreshed": spark.read.parquet(path).count()}
    more = gold.where(F.col("month") >= "2000-01").select("cost", "revenue", F.concat("month", F.lit("-x")).alias("month"))
    for step, write in (("appended by name", lambda: IO.append_by_name(more, path, ["month", "revenue"])),
                        ("appended rows", lambda: IO.append_rows(spark, [("note", 1.5)], "month string, revenue double", path))):
        before = spark.read.parquet(path).count()
        write()
        steps[step] = spark.read.parquet(path).count() - before
    C.create_workspace(spark, ws, scratch_path(spark, "maintained_db"))
    t = spark.table(C.save_layer(spark.read.parquet(path), ws, GOLD_TABLE, scratch_path(spark, "maintained_table")))
    both = IO.concat_frames(t, t.select("revenue", "month"))
    total = lambda df: df.agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("revenue"), 2).alias("revenue"))
    none = F.lit(None).cast("double").alias("revenue")
    rows = spark.createDataFrame([*steps.items(), ("loaded", int(IO.is_loaded(t)))], "step string, row_count bigint").select("*", none)
    for name, df in (("table", t), ("concatenated", both)):
        rows = rows.unionByName(total(df).select(F.lit(name).alias("step"), "row_count", "revenue"))
    return rows


_TYPES = {"date": "date", "measure": "double"}
_SALES_ROLES = {"date": "date", "category": "dimension", "revenue": "measure", "cost": "measure", "units_sold": "measure"}


def _catalog_values() -> str:
    own = {SILVER_TABLE: [("id", "bigint"), ("date", "date"), ("category", "string"), ("revenue", "double"), ("cost", "double"),
                          ("units_sold", "int"), ("profit", "double"), ("cleaned_at", "timestamp")],
           QUARANTINE_TABLE: [(f"raw_{c}", "string") for c in SALES_COLUMNS] + [("source_file", "string"), ("ingested_at", "string"),
                                                                                ("rejection_reason", "string"), ("quarantined_at", "timestamp")]}
    rows = [("sales", t, i, c, k) for t, cols in own.items() for i, (c, k) in enumerate(cols)]
    rows += [("profiled", "silver", i, c, k) for i, (c, k) in enumerate(
        [("id", "bigint"), *[(c, _TYPES.get(r, "string")) for c, r in _SALES_ROLES.items()], ("cleaned_at", "timestamp")])]
    return ", ".join(f"('{a}', '{t}', {i}, '{c}', '{k}')" for a, t, i, c, k in rows)


@register("catalog_tables", f"SELECT * FROM (VALUES {_catalog_values()}) v(origin, table_name, ordinal, column_name, data_type)")
def catalog_tables(spark, d):
    """The written layers of a workspace as the catalog describes them, and the silver schema that a profile gives.
    The workspace must be among those that hold data."""
    sales_ws, _ = _two_workspaces(spark, d)
    db = C.workspace_database(sales_ws)
    if db not in C.list_workspaces(spark, with_data=True):
        raise RuntimeError(f"{db} is not listed")
    described = C.describe_tables(spark, db).select(F.lit("sales").alias("origin"), "table_name", "ordinal", "column_name", "data_type")
    fields = silver_schema(Profile.of(_SALES_ROLES)).fields
    derived = spark.createDataFrame([("profiled", "silver", i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], described.schema)
    return described.unionByName(derived)

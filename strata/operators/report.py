"""KPIs, previews, trend and anomaly reports over the layers.

Global facts a row needs (e.g. the percent multiplier, the chart scale)
come from scalar subqueries — a one-row aggregate Spark evaluates once and
inlines — never from a window without a partition, which would move all
rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strata.constants import CHART_SCALE_THRESHOLD, CURRENCY_KEYWORDS
from strata.functions.casts import (
    exact_part, joined_total, measure_sums, month_of, other_part, rounded_total,
)
from strata.functions.formatting import column_class, currency, integer, month_label, percent

# ------------------------------------------------------------------ KPIs

def kpi_summary(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame,
                revenue_col: str = "revenue", cost_col: str = "cost") -> DataFrame:
    """One row: bronze/silver/quarantine counts, total revenue, average row margin.

    One pass over a narrow union of the three layers and a single global
    aggregate (partial per partition)."""
    none = [F.lit(None).cast("double").alias("rev"), F.lit(None).cast("double").alias("m")]
    u = (bronze.select(F.lit(0).alias("layer"), *none)
         .unionByName(silver.select(
             F.lit(1).alias("layer"), F.col(revenue_col).cast("double").alias("rev"),
             ((F.col(revenue_col) - F.col(cost_col)) / F.nullif(F.col(revenue_col), F.lit(0.0))).alias("m")))
         .unionByName(quarantine.select(F.lit(2).alias("layer"), *none)))
    cnt = lambda k: F.sum(F.when(F.col("layer") == k, 1).otherwise(0)).cast("bigint")
    return u.agg(cnt(0).alias("bronze_rows"), cnt(1).alias("silver_rows"), cnt(2).alias("quarantine_rows"),
                 F.coalesce(rounded_total(*measure_sums("rev")), F.lit(0.0)).alias("total_revenue"),
                 F.coalesce(F.avg("m"), F.lit(0.0)).alias("avg_margin"))


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to text (result rows shown to people or sent as JSON)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def preview(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    """First ``n`` rows in a stable order (top-k: per-partition heaps, then a merge)."""
    cols = order_by or df.columns
    return df.orderBy(*cols).limit(n)

# ------------------------------------------------------------------ formatting

def format_metrics(df: DataFrame) -> DataFrame:
    """Sort by the first column and render each column by its name class:
    currency ``$1,234.50``, percent ``12.34%`` (×100 when the first non-null
    value, in that order, is within ±1), counts ``1,234``; others as text."""
    first = df.columns[0]
    out = []
    for c in df.columns:
        kind = column_class(c)
        if kind == "currency":
            out.append(currency(c).alias(c))
        elif kind == "percent":
            lead = df.where(F.col(c).isNotNull()).select(F.min_by(F.col(c).cast("double"), F.col(first)).alias("v"))
            mult = F.when(F.abs(lead.scalar()) <= 1.0, F.lit(100.0)).otherwise(F.lit(1.0))
            out.append(percent(c, mult).alias(c))
        elif kind == "count":
            out.append(integer(c).alias(c))
        else:
            out.append(F.col(c).cast("string").alias(c))
    return df.orderBy(first).select(*out)


def chart_series(gold: DataFrame) -> DataFrame:
    """(x, y, bar_label, y_column): x = first column, y = first numeric column
    after it (else the second column); values above 1000 shown in thousands."""
    x = gold.columns[0]
    numeric = [f.name for f in gold.schema.fields[1:] if isinstance(f.dataType, NumericType)]
    y = numeric[0] if numeric else (gold.columns[1] if len(gold.columns) > 1 else x)
    yv = F.col(y).cast("double")
    scale = F.coalesce(gold.select(F.max(yv)).scalar() > CHART_SCALE_THRESHOLD, F.lit(False))
    prefix = "$" if any(k in y.lower() for k in CURRENCY_KEYWORDS) else ""
    shown = F.when(scale, yv / 1000.0).otherwise(yv)
    label = F.when(scale, F.concat(F.lit(prefix), F.format_number(shown, 1), F.lit("k"))) \
        .otherwise(F.concat(F.lit(prefix), F.format_number(shown, 0)))
    return gold.select(F.col(x).cast("string").alias("x"), month_label(F.col(x).cast("string")).alias("x_label"),
                       shown.alias("y"), label.alias("bar_label"), F.lit(y).alias("y_column")).orderBy("x")

# ------------------------------------------------------------------ trends

def _next_month(m) -> F.Column:
    return F.date_format(F.add_months(F.to_date(m, "yyyy-MM"), 1), "yyyy-MM")


def mom_growth(gold: DataFrame, metric: str = "revenue") -> DataFrame:
    """month, metric, previous calendar month's metric, growth (4 dp).

    Equi-join of each month to the month before (no global window)."""
    cur = gold.select("month", F.col(metric).alias("value"))
    prev = gold.select(_next_month("month").alias("month"), F.col(metric).alias("prev_value"))
    g = F.round((F.col("value") - F.col("prev_value")) / F.nullif(F.col("prev_value"), F.lit(0.0)), 4)
    return cur.join(prev, "month", "left").select("month", F.col("value").alias(metric),
                                                  F.col("prev_value").alias(f"prev_{metric}"),
                                                  g.alias("growth"))


def category_month_margins(silver: DataFrame, date_col="date", category_col="category",
                           revenue_col="revenue", cost_col="cost") -> DataFrame:
    """(month, category, revenue, cost, margin) with exact sums."""
    t = (silver.groupBy(month_of(date_col).alias("month"), F.col(category_col).alias("category"))
         .agg(*[p.alias(n) for c, k in ((revenue_col, "r"), (cost_col, "c"))
                for p, n in zip(measure_sums(c), (k, f"{k}_other"), strict=True)]))
    rev = joined_total("r", "r_other")
    profit = F.when(F.col("r_other").isNull() & F.col("c_other").isNull(), (F.col("r") - F.col("c")).cast("double")) \
        .otherwise(rev - joined_total("c", "c_other"))
    return t.select("month", "category", rounded_total("r", "r_other").alias("revenue"),
                    rounded_total("c", "c_other").alias("cost"), F.try_divide(profit, rev).alias("margin"))


def margin_anomalies(silver: DataFrame, k: float = 2.0, **cols) -> DataFrame:
    """(month, category) cells whose margin is more than ``k`` standard
    deviations below that category's mean margin across months."""
    cm = category_month_margins(silver, **cols)
    stats = cm.groupBy("category").agg(F.avg("margin").alias("mean_margin"),
                                       F.stddev_samp("margin").alias("sd_margin"))
    z = (F.col("margin") - F.col("mean_margin")) / F.nullif(F.col("sd_margin"), F.lit(0.0))
    return (cm.join(stats, "category")
            .where(F.col("margin") < F.col("mean_margin") - F.lit(k) * F.col("sd_margin"))
            .select("month", "category", "revenue", "cost", F.round("margin", 4).alias("margin"),
                    F.round(z, 3).alias("z_score")))


def category_share(silver: DataFrame, **cols) -> DataFrame:
    """month, category, revenue, share of the month's revenue, and growth of the
    category against the previous calendar month."""
    date_col, category_col = cols.get("date_col", "date"), cols.get("category_col", "category")
    cm = (silver.groupBy(month_of(date_col).alias("month"), F.col(category_col).alias("category"))
          .agg(rounded_total(*measure_sums(cols.get("revenue_col", "revenue"))).alias("revenue")))
    # the month's total is a window over the small aggregate (its rows are categories, not sales)
    parts = [F.sum(p("revenue")).over(Window.partitionBy("month")) for p in (exact_part, other_part)]
    cm = cm.withColumn("month_revenue", joined_total(*parts))
    prev = cm.select(_next_month("month").alias("month"), "category", F.col("revenue").alias("prev_revenue"))
    return (cm.join(prev, ["month", "category"], "left")
            .select("month", "category", "revenue",
                    F.round(F.col("revenue") / F.nullif(F.col("month_revenue"), F.lit(0.0)), 4).alias("share"),
                    "prev_revenue",
                    F.round((F.col("revenue") - F.col("prev_revenue")) / F.nullif(F.col("prev_revenue"), F.lit(0.0)),
                            4).alias("growth")))

# ------------------------------------------------------------------ sample questions

def revenue_by_category(silver: DataFrame) -> DataFrame:
    return (silver.groupBy("category")
            .agg(rounded_total(*measure_sums("revenue")).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc()))


def compare_two_months(silver: DataFrame, m1: str, m2: str) -> DataFrame:
    """Revenue per category in two months side by side (a conditional-sum pivot)."""
    m = month_of("date")
    s = silver.where(m.isin(m1, m2))
    r1, r2 = (F.coalesce(rounded_total(*measure_sums("revenue", m == x)), F.lit(0.0)) for x in (m1, m2))
    return (s.groupBy("category").agg(r1.alias("revenue_first"), r2.alias("revenue_second"))
            .withColumn("difference", F.round(F.col("revenue_second") - F.col("revenue_first"), 2)))


def low_margin_months(gold: DataFrame, threshold: float = 0.15) -> DataFrame:
    return gold.where(F.col("profit_margin") < threshold).orderBy("month")


def month_category_rows(silver: DataFrame, month: str, category: str, n: int = 5) -> DataFrame:
    """The ``n`` largest sales of one category in one month."""
    return (silver.where((month_of("date") == month) & (F.col("category") == category))
            .orderBy(F.col("revenue").desc(), F.col("cost").desc(), F.col("units_sold").desc(), "date")
            .limit(n))


def best_avg_profit_category(silver: DataFrame) -> DataFrame:
    """Category with the highest average profit per sale (exact: (Σrevenue − Σcost) / n)."""
    (re, ro), (ce, co) = measure_sums("revenue"), measure_sums("cost")
    profit = F.when(ro.isNull() & co.isNull(), (re - ce).cast("double")).otherwise(joined_total(re, ro) - joined_total(ce, co))
    avg_profit = profit / F.count(F.lit(1))
    return (silver.groupBy("category").agg(F.round(avg_profit, 4).alias("avg_profit"))
            .orderBy(F.col("avg_profit").desc(), "category").limit(1))

"""Gold: monthly metrics and profile-driven aggregates.

Measures of any size are summed as exact decimals where that loses nothing, else as DOUBLE (see
:func:`strata.functions.casts.measure_sum`), and rounded once at the end, so money totals do not
depend on how partial aggregates meet.  The top category per month comes from a second-level
aggregate over the (month, category) partials — no join and no window over
raw rows, and every aggregate runs map-side first.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import (
    EXACT_BELOW, EXACT_TYPE, joined_total, measure_sum, measure_sums, month_of, month_of_text, rounded_total,
)
from strata.operators.model import Profile

def month_category_totals(silver: DataFrame, date_col: str = "date", category_col: str = "category",
                          revenue_col: str = "revenue", cost_col: str = "cost",
                          units_col: str = "units_sold", month_from_text: bool = False) -> DataFrame:
    """Exact partial totals per (month, category); the month is ``date_format(d, 'yyyy-MM')``
    or, with ``month_from_text``, the first seven characters of the date text."""
    month = month_of_text(F.col(date_col).cast("string")) if month_from_text else month_of(date_col)
    return (silver.groupBy(month.alias("month"), F.col(category_col).alias("category"))
            .agg(*_both(revenue_col, "category_revenue"), *_both(cost_col, "category_cost"),
                 F.sum(units_col).cast("bigint").alias("category_units")))


def _both(c: str, name: str) -> list[Column]:
    exact, other = measure_sums(c)
    return [exact.alias(f"{name}_exact"), other.alias(f"{name}_other")]


def _sums(name: str) -> tuple[Column, Column]:
    return F.sum(f"{name}_exact"), F.sum(f"{name}_other")


def _best() -> Column:
    """Category with the greatest revenue: no revenue comes last, ties go to the alphabetically first."""
    total = joined_total("category_revenue_exact", "category_revenue_other")
    return F.min(F.struct(total.isNull().alias("none"), (-total).alias("neg"), (-F.col("category_revenue_exact")).alias("neg_exact"),
                          F.col("category").alias("category"),
                          rounded_total("category_revenue_exact", "category_revenue_other").alias("revenue")))


def gold_monthly(silver: DataFrame, **cols) -> DataFrame:
    """month, revenue, cost, profit_margin (fraction, 4 dp), units_sold, top_category."""
    per_cat = month_category_totals(silver, **cols)
    (re, ro), (ce, co) = _sums("category_revenue"), _sums("category_cost")
    rev, cost = joined_total(re, ro), joined_total(ce, co)
    profit = F.when(ro.isNull() & co.isNull(), (re - ce).cast("double")).otherwise(rev - cost)
    return (per_cat.groupBy("month")
            .agg(rounded_total(re, ro).alias("revenue"), rounded_total(ce, co).alias("cost"),
                 F.round(F.try_divide(profit, rev), 4).alias("profit_margin"),
                 F.sum("category_units").cast("bigint").alias("units_sold"),
                 _best()["category"].alias("top_category"))
            .orderBy("month"))


def gold_monthly_percent(silver: DataFrame, **cols) -> DataFrame:
    """Seeder-style gold: totals rounded to cents, margin in percent of the rounded totals,
    month taken from the date text."""
    per_cat = month_category_totals(silver, month_from_text=True, **cols)
    g = (per_cat.groupBy("month")
         .agg(rounded_total(*_sums("category_revenue")).alias("total_revenue"),
              rounded_total(*_sums("category_cost")).alias("total_cost"),
              F.sum("category_units").cast("bigint").alias("total_units_sold"),
              _best()["category"].alias("top_category")))
    margin = F.when(F.col("total_revenue") != 0,
                    F.round((F.col("total_revenue") - F.col("total_cost")) / F.col("total_revenue") * 100, 2)
                    ).otherwise(F.lit(0.0))
    return g.select("month", "total_revenue", "total_cost", margin.alias("margin_pct"),
                    "total_units_sold", "top_category").orderBy("month")


def top_category_per_month(silver: DataFrame, **cols) -> DataFrame:
    """month, top_category, category_revenue (the winning category's total)."""
    per_cat = month_category_totals(silver, **cols)
    return (per_cat.groupBy("month").agg(_best().alias("b"))
            .select("month", F.col("b.category").alias("top_category"), F.col("b.revenue").alias("category_revenue")))


# --------------------------------------------------------------------------
# generic aggregates (profile-driven gold)

AGG_FUNCS = ("sum", "avg", "count", "min", "max")


@dataclass(frozen=True)
class Agg:
    func: str
    column: str | None  # None → COUNT(*)
    alias: str

    def expr(self) -> Column:
        c = self.column
        if self.func == "sum":
            return measure_sum(c).alias(self.alias)
        if self.func == "avg":
            return F.try_divide(measure_sum(c), F.count(c)).alias(self.alias)
        if self.func == "count":
            return (F.count(c) if c else F.count(F.lit(1))).cast("bigint").alias(self.alias)
        if self.func == "min":
            return F.min(c).alias(self.alias)
        if self.func == "max":
            return F.max(c).alias(self.alias)
        raise ValueError(self.func)

    def sql(self) -> str:
        c = f"`{self.column}`" if self.column else "*"
        if self.func in ("sum", "avg"):
            exact = f"TRY_CAST(CASE WHEN ABS({c}) < {EXACT_BELOW:.0f} THEN {c} END AS {EXACT_TYPE})"
            is_exact = f"COALESCE(CAST({exact} AS DOUBLE) = {c}, FALSE)"
            parts = [f"CAST(SUM(CASE WHEN {is_exact} THEN {exact} END) AS DOUBLE)",
                     f"SUM(CASE WHEN NOT {is_exact} THEN CAST({c} AS DOUBLE) END)"]
            total = f"CASE WHEN COUNT({c}) > 0 THEN COALESCE({parts[0]}, 0D) + COALESCE({parts[1]}, 0D) END"
            return f"{total} AS `{self.alias}`" if self.func == "sum" else f"({total}) / NULLIF(COUNT({c}), 0) AS `{self.alias}`"
        if self.func == "count":
            return f"CAST(COUNT({c}) AS BIGINT) AS `{self.alias}`"
        return f"{self.func.upper()}({c}) AS `{self.alias}`"


@dataclass(frozen=True)
class GoldSpec:
    """GROUP BY [month(date_col)] + dims, with aggregates."""

    description: str
    dims: tuple[str, ...]
    aggs: tuple[Agg, ...]
    date_col: str | None = None
    month_alias: str = "month"

    def apply(self, silver: DataFrame) -> DataFrame:
        keys = ([month_of(self.date_col).alias(self.month_alias)] if self.date_col else []) + \
            [F.col(d) for d in self.dims]
        return silver.groupBy(*keys).agg(*[a.expr() for a in self.aggs])

    def sql(self, table: str = "silver_clean_sales") -> str:
        sel, grp = [], []
        if self.date_col:
            sel.append(f"date_format(`{self.date_col}`, 'yyyy-MM') AS `{self.month_alias}`")
            grp.append(f"date_format(`{self.date_col}`, 'yyyy-MM')")
        sel += [f"`{d}`" for d in self.dims]
        grp += [f"`{d}`" for d in self.dims]
        sel += [a.sql() for a in self.aggs]
        group = f" GROUP BY {', '.join(grp)}" if grp else ""
        return f"SELECT {', '.join(sel)} FROM {table}{group}"


def gold_agg(silver: DataFrame, dims: Sequence[str], aggs: Sequence[tuple[str, str | None, str]],
             date_col: str | None = None) -> DataFrame:
    """Group by month(date_col) (if given) and ``dims``; ``aggs`` = (func, column, alias)."""
    spec = GoldSpec("", tuple(dims), tuple(Agg(*a) for a in aggs), date_col)
    return spec.apply(silver)


def _dims_by_cardinality(profile: Profile) -> list[str]:
    dims = profile.by_role("dimension")

    def card(name):
        for c in profile.columns:
            if c.name == name:
                v = (c.stats or {}).get("cardinality")
                return v if v is not None else float("inf")
        return float("inf")

    return sorted(dims, key=lambda d: (card(d), dims.index(d)))


def gold_options(profile: Profile) -> list[GoldSpec]:
    """Three to five candidate gold aggregates, by rule (the first one is the default gold).

    With dimensions and measures: the measures' sums by the first dimension, by the second and by both (where there
    is a second), their averages by the first, and the count of the first id (or of rows) over all. Without dimensions
    their sums and averages and the count remain; without measures, counts by the dimensions; a range of the measures
    or a plain row count fills up to three. A date column adds its month to every option."""
    dates = profile.by_role("date")
    date_col = dates[0] if dates else None
    dims = _dims_by_cardinality(profile)
    measures = profile.measures
    ids = profile.by_role("id")
    sums = tuple(Agg("sum", m, m) for m in measures)
    avgs = tuple(Agg("avg", m, f"avg_{m}") for m in measures)
    ends = tuple(Agg(f, m, f"{f}_{m}") for m in measures for f in ("min", "max"))
    count = (Agg("count", ids[0] if ids else None, f"{ids[0]}_count" if ids else "row_count"),)
    what = ", ".join(measures) if measures else "rows"
    per = "Monthly" if date_col else "Total"
    option = lambda text, by, aggs: GoldSpec(f"{per} {text}" + (f" by {' and '.join(by)}" if by else ""), tuple(by), aggs, date_col)
    by = [dims[:1], dims[1:2], dims[:2]] if len(dims) > 1 else [dims[:1]] if dims else [[]]
    if measures:
        out = [option(what, d, sums) for d in by] + [option(f"average {what}", dims[:1], avgs)]
        if not dims and not date_col:
            out.append(option(f"range of {what}", [], ends))
        return [*out, option("record count", [], count)]
    out = [option("record count", d, count) for d in by]
    if dims:
        out.append(option("record count", [], count))
    filled = [c for c in profile.names if c not in ids]
    out += [option(f"filled values of {c}", [], (Agg("count", c, f"{c}_count"),)) for c in filled[:max(0, 3 - len(out))]]
    return out if len(out) >= 3 or not ids else [*out, option("row count", [], (Agg("count", None, "row_count"),))]


def gold(silver: DataFrame, profile: Profile, option: int = 0) -> DataFrame:
    """Materialise one candidate aggregate (the first by default)."""
    return gold_options(profile)[option].apply(silver)


def gold_from_sql(spark: SparkSession, silver: DataFrame, sql: str,
                  view: str = "silver_clean_sales") -> DataFrame:
    """User-supplied gold SELECT over the silver table; checked by the read-only guard first."""
    from strata.operators.guard import guarded_sql, temp_views
    with temp_views(spark, **{view: silver}):
        return guarded_sql(spark, sql)

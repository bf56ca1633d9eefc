"""Silver: typed, validated, deduplicated rows (latest copy per key wins)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.constants import SALES_DEDUP_KEYS
from strata.functions.casts import to_date, to_int, to_real
from strata.functions.predicates import all_of, non_negative, present
from strata.operators.dedup import Repeats, latest_per_key, repeats
from strata.operators.layers import DEFAULT_ROW_ID, identity_columns, run_timestamp, surrogate_id, well_formed
from strata.operators.model import Profile


def valid_row(profile: Profile, extensions: bool = False) -> Column:
    """Every required column present and every measure present and >= 0 (TRUE if none); with
    ``extensions`` every date parses, too."""
    conds = [present(c) for c in profile.required] + [non_negative(c) for c in profile.measures]
    if extensions:
        conds += [to_date(c).isNotNull() for c in profile.by_role("date")]
    return all_of(conds)


def typed_column(name: str, role: str) -> Column:
    if role == "date":
        return to_date(name).alias(name)
    if role in ("measure", "currency"):
        return to_real(name).alias(name)
    return F.col(name)


def silver(bronze: DataFrame, profile: Profile, row_id: Sequence[str] = DEFAULT_ROW_ID,
           dedup_keys: Sequence[str] | None = None, run_ts=None, extensions: bool = False,
           known: Repeats | None = None) -> DataFrame:
    """Profile-driven silver: filter valid rows first, then keep the latest per key.

    With ``extensions`` rows whose date text does not parse are not valid either
    (the matching quarantine reason is ``Unparseable Date: <col>``). ``known``:
    the already written :func:`strata.operators.quarantine.valid_repeats`."""
    valid = well_formed(bronze).where(valid_row(profile, extensions))
    survivors = latest_per_key(valid, list(dedup_keys or profile.dedup_keys()), row_id, known=known)
    id_cols = identity_columns(bronze, row_id)
    return survivors.select(
        surrogate_id(id_cols).alias("id"),
        *[typed_column(c.name, c.role) for c in profile.columns],
        run_timestamp(run_ts).alias("cleaned_at"),
    )


def dated(bronze: DataFrame) -> DataFrame:
    """The rows that the baseline sales rules look for duplicates among: with a date and a category."""
    return well_formed(bronze).where(present("date") & present("category"))


def sales_repeats(bronze: DataFrame, row_id: Sequence[str] = DEFAULT_ROW_ID, bits: DataFrame | None = None,
                  share: tuple[int, int] = (0, 1)) -> Repeats:
    """The repeated keys of the baseline sales rules."""
    return repeats(dated(bronze), SALES_DEDUP_KEYS, row_id, bits=bits, share=share)


def silver_sales(bronze: DataFrame, row_id: Sequence[str] = DEFAULT_ROW_ID, run_ts=None,
                 known: Repeats | None = None, extensions: bool = False) -> DataFrame:
    """Baseline sales silver with ``profit``.

    The dedup runs over rows with a date and a category *before* the
    numeric check, so a negative newest copy hides an older valid one.
    ``known`` is :func:`sales_repeats` when already written.  With
    ``extensions`` a survivor with an unparseable date or a malformed number
    is left out (it is quarantined with its own reason) instead of passing
    with a NULL date."""
    return typed_sales(latest_per_key(dated(bronze), SALES_DEDUP_KEYS, row_id, known=known), row_id, run_ts, extensions)


def typed_sales(survivors: DataFrame, row_id: Sequence[str] = DEFAULT_ROW_ID, run_ts=None, extensions: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """The silver rows of surviving bronze rows: typed, without those whose numbers are missing, malformed or negative.
    Columns in ``keep`` are passed on."""
    if extensions:
        from strata.operators.quarantine import sales_extension_ok
        survivors = survivors.where(sales_extension_ok())
    typed = survivors.select(
        surrogate_id([c for c in identity_columns(survivors, row_id) if c not in keep]).alias("id"), *keep,
        to_date("date").alias("date"),
        F.col("category"),
        to_real("revenue").alias("revenue"),
        to_real("cost").alias("cost"),
        to_int("units_sold").alias("units_sold"),
    )
    sound = lambda c: (F.col(c) >= 0) & ~F.isnan(c)
    return (typed.where(sound("revenue") & sound("cost") & (F.col("units_sold") >= 0))
            .withColumn("profit", F.col("revenue") - F.col("cost"))
            .withColumn("cleaned_at", run_timestamp(run_ts)))


def with_margin_pct(silver: DataFrame, revenue_col: str = "revenue", cost_col: str = "cost") -> DataFrame:
    """Adds ``margin_pct`` = round((revenue − cost) / revenue × 100, 2) per row (NULL when revenue is 0)."""
    r, c = F.col(revenue_col), F.col(cost_col)
    return silver.withColumn("margin_pct", F.round(F.try_divide(r - c, r) * 100, 2))

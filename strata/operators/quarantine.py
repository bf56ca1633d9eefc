"""Quarantine: rejected bronze rows, each with the reason it was rejected.

Two rule sets exist and differ on purpose:

* ``quarantine_sales`` — baseline sales rules, a first-match cascade so a
  row carries at most one reason: missing date, then missing category,
  then any negative number, then duplicate.  The duplicate window runs over
  all rows with a date and a category (negative ones included), and only
  non-negative non-survivors are reported as duplicates.
* ``quarantine`` — profile-driven rules, one output row per violated rule,
  so a row with two violations is quarantined twice; duplicates are looked
  for only among rows that pass every rule.

All row rules are evaluated in one pass over bronze that shuffles nothing;
duplicates are joined from the rows of repeated keys alone.  Rows that
ingestion found to have another number of fields than their header carry
that reason alone: their values may stand in the wrong columns.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.constants import (
    REASON_DUPLICATE, REASON_MALFORMED_NUMERIC, REASON_MALFORMED_ROW, REASON_MISSING_CATEGORY, REASON_MISSING_DATE,
    REASON_NEGATIVE_ANY, REASON_NEGATIVE_COL, REASON_NULL_REQUIRED, REASON_OUT_OF_RANGE, REASON_UNPARSEABLE_DATE,
    SALES_COLUMNS, SALES_DEDUP_KEYS,
)
from strata.functions.casts import to_date
from strata.functions.predicates import (
    all_non_negative, any_negative, malformed_numeric, missing, negative, out_of_int_range, present,
)
from strata.operators.dedup import Repeats, not_latest, repeats
from strata.operators.layers import DEFAULT_ROW_ID, malformed_row, run_timestamp, well_formed
from strata.operators.model import Profile
from strata.operators.silver import dated, valid_row


def _shape(rows: DataFrame, cols: Sequence[str], run_ts) -> DataFrame:
    """Quarantine layout: raw_<col>..., source_file, ingested_at (text), reason, quarantined_at."""
    return rows.select(
        *[F.col(c).alias(f"raw_{c}") for c in cols],
        F.col("source_file"),
        F.col("ingested_at").cast("string").alias("ingested_at"),
        F.col("rejection_reason"),
        run_timestamp(run_ts).alias("quarantined_at"),
    )


SALES_MEASURES = ("revenue", "cost", "units_sold")


def sales_rule_reason(extensions: bool = False):
    """First matching row rule of the baseline sales flow, NULL when none applies
    (a NULL comparison — e.g. a missing measure — matches no rule).

    ``extensions`` adds, after the category rule, an unparseable date and a
    present-but-malformed number as their own reasons (off by default)."""
    rule = (F.when(missing("date"), REASON_MISSING_DATE)
            .when(missing("category"), REASON_MISSING_CATEGORY))
    if extensions:
        rule = rule.when(to_date("date").isNull(), REASON_UNPARSEABLE_DATE.format(col="date"))
        for c in SALES_MEASURES:
            rule = rule.when(malformed_numeric(c), REASON_MALFORMED_NUMERIC.format(col=c))
    return (rule.when(any_negative(["revenue", "cost"], ["units_sold"]), REASON_NEGATIVE_ANY)
            .when(out_of_int_range("units_sold"), REASON_OUT_OF_RANGE))


def sales_extension_ok():
    """Rows the extension rules let through (parseable date, well-formed numbers)."""
    ok = to_date("date").isNotNull()
    for c in SALES_MEASURES:
        ok = ok & ~malformed_numeric(c)
    return ok


def quarantine_sales(bronze: DataFrame, row_id: Sequence[str] = DEFAULT_ROW_ID,
                     run_ts=None, known: Repeats | None = None, extensions: bool = False, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Baseline sales quarantine (cascade, one reason per row).

    Rows that break a rule, found where they are read, and the duplicates among
    the others. ``known``: the already written
    :func:`strata.operators.silver.sales_repeats`. ``extensions``: see
    :func:`sales_rule_reason`. ``share``: (k, n) for the k-th of n shares, whose union is
    the quarantine; duplicates are dealt by their key, broken rows are in the first."""
    dup = all_non_negative(["revenue", "cost"], ["units_sold"])
    if extensions:
        dup = dup & sales_extension_ok()
    copies = _sales_copies(not_latest(dated(bronze), SALES_DEDUP_KEYS, row_id, known=known, share=share).where(dup), run_ts)
    return copies if share[0] else _sales_broken(bronze, run_ts, extensions).unionByName(copies)


def _sales_copies(copies: DataFrame, run_ts) -> DataFrame:
    return _shape(copies.withColumn("rejection_reason", F.lit(REASON_DUPLICATE)), SALES_COLUMNS, run_ts)


def delivered_quarantine(delivery: DataFrame | None, rows: DataFrame, before: DataFrame, known: Repeats, row_id: Sequence[str] = DEFAULT_ROW_ID,
                         run_ts=None) -> DataFrame:
    """What a delivery adds to the baseline sales quarantine: its rows that break a rule, and the copies among its dated
    ``rows`` and the survivors ``before`` it. ``known`` holds the repeated keys of both. Of a delivery that is merged in
    shares of the months, ``rows`` are those of one share, and only one share is given the ``delivery``."""
    copies = not_latest(before.select(*rows.columns).unionByName(rows), SALES_DEDUP_KEYS, row_id, known=known)
    copies = _sales_copies(copies.where(all_non_negative(["revenue", "cost"], ["units_sold"])), run_ts)
    return copies if delivery is None else _sales_broken(delivery, run_ts).unionByName(copies)


def _sales_broken(bronze: DataFrame, run_ts, extensions: bool = False) -> DataFrame:
    reason = F.when(malformed_row(bronze), REASON_MALFORMED_ROW).otherwise(sales_rule_reason(extensions))
    return _shape(bronze.withColumn("rejection_reason", reason).where(F.col("rejection_reason").isNotNull()), SALES_COLUMNS, run_ts)


def sales_row_rules(bronze: DataFrame, run_ts=None) -> DataFrame:
    """Only the stateless row rules of :func:`quarantine_sales` (no duplicates):
    usable on a stream, where each micro-batch is checked on its own."""
    return _sales_broken(bronze, run_ts)


def row_rule_quarantine(bronze: DataFrame, profile: Profile, run_ts=None, extensions: bool = False) -> DataFrame:
    """Only the stateless row rules of :func:`quarantine` (no duplicates)."""
    reasons = F.when(malformed_row(bronze), F.array(F.lit(REASON_MALFORMED_ROW))).otherwise(rule_reasons(profile, extensions))
    rows = bronze.select("*", F.explode(reasons).alias("rejection_reason"))
    return _shape(rows, profile.names, run_ts)


def rule_reasons(profile: Profile, extensions: bool = False):
    """Array expression of every violated row rule (NULL entries compacted away)."""
    checks = [F.when(missing(c), F.lit(REASON_NULL_REQUIRED.format(col=c))) for c in profile.required]
    checks += [F.when(negative(c), F.lit(REASON_NEGATIVE_COL.format(col=c))) for c in profile.measures]
    if extensions:
        checks += [F.when(malformed_numeric(c), F.lit(REASON_MALFORMED_NUMERIC.format(col=c)))
                   for c in profile.measures]
        checks += [F.when(present(c) & to_date(c).isNull(), F.lit(REASON_UNPARSEABLE_DATE.format(col=c)))
                   for c in profile.by_role("date")]
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*checks))


def _valid(bronze: DataFrame, profile: Profile, extensions: bool) -> DataFrame:
    return well_formed(bronze).where(valid_row(profile, extensions))


def valid_repeats(bronze: DataFrame, profile: Profile, row_id: Sequence[str] = DEFAULT_ROW_ID,
                  dedup_keys: Sequence[str] | None = None, extensions: bool = False, bits: DataFrame | None = None,
                  share: tuple[int, int] = (0, 1)) -> Repeats:
    """The repeated keys of the rows that pass every rule of the profile."""
    return repeats(_valid(bronze, profile, extensions), list(dedup_keys or profile.dedup_keys()), row_id, bits=bits, share=share)


def quarantine(bronze: DataFrame, profile: Profile, row_id: Sequence[str] = DEFAULT_ROW_ID,
               dedup_keys: Sequence[str] | None = None, run_ts=None,
               extensions: bool = False, known: Repeats | None = None, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Profile-driven quarantine (one row per violated rule, plus duplicates).

    ``known``: the already written :func:`valid_repeats`. ``share``: see :func:`quarantine_sales`."""
    keys = list(dedup_keys or profile.dedup_keys())
    copies = not_latest(_valid(bronze, profile, extensions), keys, row_id, known=known, share=share)
    copies = _shape(copies.withColumn("rejection_reason", F.lit(REASON_DUPLICATE)), profile.names, run_ts)
    return copies if share[0] else row_rule_quarantine(bronze, profile, run_ts, extensions).unionByName(copies)

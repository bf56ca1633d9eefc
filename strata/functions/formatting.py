"""Display formats for metrics (JVM built-ins; no Python per row).

Rounding follows the usual printf behaviour on the exact binary value with
ties to even (``format_number`` and ``bround`` both do this), so ``0.125``
shows as ``0.12``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import COUNT_KEYWORDS, CURRENCY_KEYWORDS, PERCENT_KEYWORDS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_if_null(x: Column, text: Column) -> Column:
    return F.when(x.isNull(), F.lit("")).otherwise(text)


def currency(c) -> Column:
    """``$1,234.50``; NULL → ``""``."""
    x = _c(c).cast("double")
    return _blank_if_null(x, F.concat(F.lit("$"), F.format_number(x, 2)))


def percent(c, multiplier) -> Column:
    """``12.34%`` of ``c * multiplier``; NULL → ``""``."""
    x = _c(c).cast("double") * multiplier
    return _blank_if_null(x, F.format_string("%.2f%%", F.bround(x, 2)))


def integer(c) -> Column:
    """``1,234`` (truncated toward zero); NULL → ``""``."""
    x = _c(c).cast("double")
    return _blank_if_null(x, F.format_number(x.cast("bigint"), 0))


def column_class(name: str) -> str | None:
    """'currency' → 'percent' → 'count' by name keyword (first match), else None."""
    n = name.lower()
    if any(k in n for k in CURRENCY_KEYWORDS):
        return "currency"
    if any(k in n for k in PERCENT_KEYWORDS):
        return "percent"
    if any(k in n for k in COUNT_KEYWORDS):
        return "count"
    return None


def month_label(month) -> Column:
    """``2026-01`` → ``Jan '26``; NULL for text that is not a ``yyyy-MM`` month."""
    return F.date_format(F.try_to_date(_c(month), "yyyy-MM"), "MMM ''yy")


def markdown_row(cols) -> Column:
    """``| a | b | c |`` from the given columns (as text, NULL → empty)."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]),
                    F.lit(" |"))

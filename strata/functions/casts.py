"""Lenient typing of raw text.

ANSI ``cast`` raises on bad text, so everything goes through ``try_cast``
(bad text becomes NULL).  Integers round half away from zero first, so
``'2.7'`` becomes 3 as in the engines the behaviour comes from.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_real(c) -> Column:
    return _c(c).try_cast("double")


def to_int(c) -> Column:
    return F.round(_c(c).try_cast("double")).try_cast("int")


def to_date(c) -> Column:
    """Text (``2026-05-15`` or ``2026-05-15 14:22:11``) to DATE, NULL if unparseable."""
    return _c(c).try_cast("date")


def month_of(d) -> Column:
    """``YYYY-MM`` bucket of a DATE/TIMESTAMP column."""
    return F.date_format(_c(d), "yyyy-MM")


def month_of_text(s) -> Column:
    """Month from the first seven characters of a ``YYYY-MM-DD`` string."""
    return F.substring(_c(s), 1, 7)


#: The type of the exact share of a sum, and the size below which values may enter it: a trillion of them fit.
EXACT_TYPE, EXACT_BELOW = "decimal(38,6)", 1e14


def exact_part(c) -> Column:
    """The value as an exact decimal where that loses nothing, else NULL."""
    c = _c(c)
    d = F.when(F.abs(c) < EXACT_BELOW, c).try_cast(EXACT_TYPE)
    return F.when(d.cast("double") == c.cast("double"), d)


def other_part(c) -> Column:
    """The value as DOUBLE where :func:`exact_part` has none: huge or finer than a millionth, infinite, NaN."""
    c = _c(c)
    return F.when(exact_part(c).isNull(), c.cast("double"))


def joined_total(exact, other) -> Column:
    """DOUBLE total of the sums of both parts; NULL when both are."""
    exact, other = _c(exact).cast("double"), _c(other)
    return F.when(other.isNull(), exact).when(exact.isNull(), other).otherwise(exact + other)


def rounded_total(exact, other, digits: int = 2) -> Column:
    """The total rounded once; exact decimals are rounded as decimals."""
    return F.when(_c(other).isNull(), F.round(_c(exact), digits).cast("double")) \
        .otherwise(F.round(joined_total(exact, other), digits))


def measure_sum(c, when: Column | None = None) -> Column:
    """Sum of a DOUBLE measure of any size. Values that are exact decimals are summed as such, so the sum does
    not depend on the order in which partial aggregates meet; the others are added as DOUBLE."""
    return joined_total(*measure_sums(c, when))


def measure_sums(c, when: Column | None = None) -> tuple[Column, Column]:
    """The sums of both parts, for totals that are built in two steps."""
    parts = (exact_part(c), other_part(c))
    return tuple(F.sum(p if when is None else F.when(when, p)) for p in parts)

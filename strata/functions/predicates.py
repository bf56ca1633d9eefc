"""Row predicates over raw text columns.

Every predicate is a plain ``Column`` so Catalyst can fold, combine and
push it; none of them can evaluate to NULL unless stated, which keeps
``where`` and ``when`` chains free of three-valued surprises.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.constants import MISSING_SENTINELS
from strata.functions.casts import to_int, to_real


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing(c, sentinels: Iterable[str] = MISSING_SENTINELS) -> Column:
    """``c IS NULL OR c IN ('None', '')`` (exact case). Never NULL."""
    c = _c(c)
    return c.isNull() | c.isin(*sentinels)


def present(c, sentinels: Iterable[str] = MISSING_SENTINELS) -> Column:
    """Complement of :func:`missing`. Never NULL."""
    return ~missing(c, sentinels)


def negative(c) -> Column:
    """A present value whose numeric reading is below zero.

    Malformed text reads as NULL, so the result is NULL (treated as false)."""
    return present(c) & (to_real(c) < 0)


def non_negative(c) -> Column:
    """A present value whose numeric reading is zero or more (NULL if malformed; NaN is no number)."""
    return present(c) & (to_real(c) >= 0) & ~F.isnan(to_real(c))


def malformed_numeric(c) -> Column:
    """Extension: present, but not a plain decimal number (or NaN/Infinity)."""
    c = _c(c)
    return present(c) & ~F.coalesce(
        c.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$") & ~F.isnan(to_real(c)),
        F.lit(False))


def out_of_int_range(c) -> Column:
    """A number (NaN is none) that :func:`strata.functions.casts.to_int` cannot hold. Never NULL."""
    return F.coalesce(~F.isnan(to_real(c)) & to_int(c).isNull(), F.lit(False)) & to_real(c).isNotNull()


def any_negative(cols: Iterable, int_cols: Iterable = ()) -> Column:
    """``CAST(a AS REAL) < 0 OR ...`` with SQL three-valued logic kept."""
    conds = [to_real(c) < 0 for c in cols] + [to_int(c) < 0 for c in int_cols]
    return reduce(or_, conds)


def all_non_negative(cols: Iterable, int_cols: Iterable = ()) -> Column:
    conds = [(to_real(c) >= 0) & ~F.isnan(to_real(c)) for c in cols] + [to_int(c) >= 0 for c in int_cols]
    return reduce(and_, conds)


def all_of(conds: Iterable[Column]) -> Column:
    """AND of the conditions; ``TRUE`` when there are none (the ``1=1`` case)."""
    return reduce(and_, list(conds), F.lit(True))


def any_null(cols: Iterable) -> Column:
    """``c1 IS NULL OR c2 IS NULL ...``; FALSE when there are no columns."""
    return reduce(or_, [_c(c).isNull() for c in cols], F.lit(False))

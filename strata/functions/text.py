"""Text functions over columns of SQL/model text, all built-in regex
expressions (Java regex), so a whole table of texts is checked in parallel.

Mirrors of the driver-side checks in :mod:`strata.operators.guard`."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.constants import (
    GUARD_COMMENT, GUARD_FORBIDDEN_KEYWORDS, GUARD_MSG_FORBIDDEN, GUARD_MSG_NOT_SELECT, GUARD_QUOTED,
    GUARD_SPARK_EXTRA_KEYWORDS,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def forbidden_pattern(spark_extras: bool = True) -> str:
    words = GUARD_FORBIDDEN_KEYWORDS + (GUARD_SPARK_EXTRA_KEYWORDS if spark_extras else ())
    return r"(?i)\b(" + "|".join(words) + r")\b"


def strip_sql_comments(c) -> Column:
    """Drop ``-- line`` and ``/* block */`` comments (not inside literals and quoted names), then surrounding
    whitespace."""
    return trim_space(F.regexp_replace(_c(c), f"({GUARD_QUOTED})|{GUARD_COMMENT}", "$1"))


def trim_space(c) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), r"\A\s+|\s+\z", "")


def starts_read_only(c) -> Column:
    """Text begins with SELECT or WITH (case-insensitive, whole word)."""
    return F.coalesce(_c(c).rlike(r"(?i)^(select|with)\b"), F.lit(False))


def forbidden_keywords(c, spark_extras: bool = True) -> Column:
    """Distinct forbidden keywords (lower case) in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_c(c)), F.lit(forbidden_pattern(spark_extras)), 1))


def guard_check(c, spark_extras: bool = True) -> Column:
    """struct<is_safe: boolean, message: string> for each query text."""
    clean = strip_sql_comments(c)
    kws = forbidden_keywords(clean, spark_extras)
    prefix, _, suffix = GUARD_MSG_FORBIDDEN.partition("{kw}")
    safe = starts_read_only(clean) & (F.size(kws) == 0)
    msg = (F.when(~starts_read_only(clean), F.lit(GUARD_MSG_NOT_SELECT))
           .when(F.size(kws) > 0, F.concat(F.lit(prefix), F.array_join(kws, ", "), F.lit(suffix)))
           .otherwise(F.lit("")))
    return F.struct(safe.alias("is_safe"), msg.alias("message"))


def extract_fenced_sql(c) -> Column:
    """Body of the first fenced ```sql block, else of any ``` block, else the whole
    text; trimmed, with literal ``\\n`` / ``\\t`` turned into real newlines/tabs."""
    c = _c(c)
    tagged = F.regexp_extract(c, r"(?is)```sql(.*?)```", 1)
    plain = F.regexp_extract(c, r"(?s)```(.*?)```", 1)
    has_tagged = c.rlike(r"(?is)```sql(.*?)```")
    has_plain = c.rlike(r"(?s)```(.*?)```")
    body = F.when(has_tagged, tagged).when(has_plain, plain).otherwise(c)
    body = trim_space(body)
    body = F.replace(body, F.lit("\\n"), F.lit("\n"))
    return F.replace(body, F.lit("\\t"), F.lit("\t"))


def strip_json_fence(c) -> Column:
    """Remove a leading ```json / ``` fence line and a trailing ``` fence."""
    s = trim_space(c)
    s = F.regexp_replace(s, r"(?i)\A```(json)?[ \t]*\n?", "")
    s = F.regexp_replace(s, r"\n?```\z", "")
    return trim_space(s)


def json_valid(c, schema: StructType, required: Sequence[str] = ()) -> Column:
    """True when the text parses as JSON for ``schema`` and every required field is non-null.

    ``from_json`` turns malformed text into a struct of NULLs (not NULL), so
    validity is read from a ``_corrupt_record`` field added to the schema."""
    from pyspark.sql.types import StringType, StructField
    with_corrupt = StructType(list(schema.fields) + [StructField("_corrupt_record", StringType())])
    parsed = F.from_json(_c(c), with_corrupt, {"mode": "PERMISSIVE",
                                                "columnNameOfCorruptRecord": "_corrupt_record"})
    ok = parsed.isNotNull() & parsed.getField("_corrupt_record").isNull()
    for r in required:
        ok = ok & parsed.getField(r).isNotNull()
    return F.coalesce(ok, F.lit(False))

"""Row numbers without gaps or collisions, in two passes over stored rows and without a sort.

A hash of a row repeats in a large table sooner or later. Here every row is written once with the task that wrote it
and its place among that task's rows. The stored rows are then counted by task, the counts summed up in the order of the
tasks, and a row's number is the sum before its task plus its place. What a lost executor repeats is the writing of a
task, whose place numbers begin anew, or the reading of rows that no longer change. Which row gets which number follows
from how the input was dealt to tasks; nothing but the numbers' being 1 to n, each once, is promised.

An empty frame gives an empty frame. Rows that repeat get numbers of their own. Columns may have any names but that of
the number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.sources.files import write_layer

#: ``monotonically_increasing_id`` keeps the task in the bits above these and the place in them.
PLACE_BITS = 33


def number_rows(df: DataFrame, path: str, name: str = "row_no", start: int = 1) -> DataFrame:
    """``df`` written to ``path`` and read back with ``name`` = start, start + 1, … as its first column.

    The only thing that meets in one task is one row for each task that wrote. To number a later delivery, give the
    greatest number so far plus one as ``start``."""
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    place = "_place"
    while place in df.columns or place == name:
        place += "_"
    write_layer(df.select("*", F.monotonically_increasing_id().alias(place)), path)
    schema = StructType([*df.schema.fields, StructField(place, LongType())])
    stored = df.sparkSession.read.schema(schema).parquet(path)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (stored.groupBy(F.shiftright(place, PLACE_BITS).alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    rows = stored.alias("r").join(starts.alias("s"), F.shiftright(F.col(f"r.`{place}`"), PLACE_BITS) == F.col("s._task"))
    number = F.col("s._start") + F.col(f"r.`{place}`").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + F.lit(start)
    return rows.select(number.cast("bigint").alias(name), *[F.col(f"r.`{c}`") for c in df.columns])

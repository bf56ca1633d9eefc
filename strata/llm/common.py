"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: The white space of every word rule here: space and U+0009 to U+000D (``bytes.split()`` cuts at the same six).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: lineage ends here, and the
    files outlive any executor."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Texts have any length, so Python gets them in batches of bounded bytes, whatever the number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def stored_by(spark: SparkSession, df: DataFrame, name: str, key: str) -> DataFrame:
    """Like :func:`stored`, in buckets of ``key``: joins and groups on it read the files without another shuffle."""
    table_name = f"strata_{name}_{uuid.uuid4().hex[:12]}"
    (df.write.format("parquet").option("path", scratch_path(spark, name)).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
     .saveAsTable(table_name))
    out = spark.table(table_name)
    spark.sql(f"DROP TABLE {table_name}")  # the files stay, and the frame knows them
    return out


def text_hash(text: Column | str = "text") -> Column:
    """With the document id, the key of a document: rows that repeat both are the same document."""
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)


def same(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> Column:
    """Null-safe equality on pairs of columns (an equi-join for Spark)."""
    cond = F.lit(True)
    for a, b in keys:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


#: Words of 64 bits in a membership table: two megabytes, whatever it is made of.
BIT_WORDS = 1 << 17


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def member_bits(spark: SparkSession, refs: DataFrame) -> DataFrame:
    """``(word, bits)``: one bit for each 64-bit hash in the column ``ref`` of ``refs``, at most ``BIT_WORDS`` rows."""
    spot = F.expr("shiftleft(1L, cast(pmod(shiftright(ref, 20), 64) as int))")
    return stored(spark, refs.select(F.pmod("ref", F.lit(BIT_WORDS)).alias("word"), spot.alias("spot"))
                  .groupBy("word").agg(F.bit_or("spot").alias("bits")), "member-bits")


def parted(df: DataFrame, ref: Column, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose hash may be among the members, and the rows whose hash is not: the second part needs
    no join, so its texts are not shuffled. The broadcast table has a fixed bound; with members beyond it more and
    more rows are in the first part, and nothing is lost."""
    r, w, b = (unused(df, f"_m_{x}") for x in ("ref", "word", "bits"))
    spot = F.expr(f"shiftleft(1L, cast(pmod(shiftright({r}, 20), 64) as int))")
    table_ = F.broadcast(bits.select(F.col("word").alias(w), F.col("bits").alias(b)))
    marked = df.withColumn(r, ref)
    marked = marked.join(table_, F.pmod(marked[r], F.lit(BIT_WORDS)) == table_[w], "left")
    may = F.coalesce(F.col(b).bitwiseAND(spot) != 0, F.lit(False))
    own = [F.col(f"`{c}`") for c in df.columns]
    return marked.filter(may).select(*own), marked.filter(~may).select(*own)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """The texts of a string column; null is empty."""
    return ["" if x is None else x for x in column.to_pylist()]

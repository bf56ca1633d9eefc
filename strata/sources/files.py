"""File sources and sinks for the layers.

* landing CSV → bronze: every column read as text (no inference), audit
  columns added, appended as parquet;
* layer exports as CSV with a header (gold, which is small, as one file);
* typed re-read of exports;
* profile JSON;
* keyed upsert, row-batch append, refresh-in-place.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.layers import FIELD_COUNT, MALFORMED, run_timestamp
from strata.session import shuffles_removed


# ------------------------------------------------------------------ landing CSV → bronze

#: RFC 4180: a quote inside a quoted value is doubled.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}
#: Layers are written in row groups of this many bytes, so that a file of any size is read by as many tasks as it has groups,
#: and in files of this many rows. Spark counts 4 MB for opening a file and packs at most 128 MB into a scan task, so a task
#: reads 32 files at most: what it sorts or counts before a shuffle is bounded by rows, however well they compress.
MAX_ROWS_PER_FILE = 50_000
LAYOUT = {"parquet.block.size": str(4 << 20), "maxRecordsPerFile": str(MAX_ROWS_PER_FILE), "compression": "zstd"}
#: No field is ever this, so an empty field reads as NULL and a quoted empty one as empty text.
NO_TEXT = chr(0)


def _as_list(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The header of each file of a folder, file or glob (or a list of them): the first line of each is read,
    through Spark's own file systems, and nothing else."""
    import csv
    from concurrent.futures import ThreadPoolExecutor
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files: list[str] = []
    for p in _as_list(path):
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        for top in fs.globStatus(at) or []:
            for f in fs.listStatus(top.getPath()) if top.isDirectory() else [top]:
                if not f.isDirectory() and f.getPath().getName()[0] not in "_." and f.getLen() > 0:
                    files.append(f.getPath().toString())
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(f: str) -> tuple[str, ...]:
        at = jvm.org.apache.hadoop.fs.Path(f)
        stream, codec = at.getFileSystem(conf).open(at), codecs.getCodec(at)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return tuple(x.strip() for x in next(csv.reader([(reader.readLine() or "").lstrip(chr(0xFEFF))]), []))
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(sorted(files), pool.map(first_line, sorted(files)), strict=True))


def csv_header(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Column names from the header of the first file (no data scan, no type inference)."""
    return list(next(iter(file_headers(spark, path).values()), ()))


def all_text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def _fields(record) -> Column:
    """Fields of a CSV record: its separators outside quotes, and one more."""
    plain = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return F.length(F.regexp_replace(plain, "[^,]", "")) + 1


def read_landing_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                     run_ts=None, multi_line: bool = False, ingest_id: str | None = None) -> DataFrame:
    """Landing CSV as all-text bronze rows with ``ingested_at``, ``source_file``,
    ``_ingest_id`` (one per call) and ``_row_id`` (unique within it).

    Columns are matched by each file's own header: files whose columns stand in
    another order, or that have more of them, are read by name, and a file that
    lacks one is refused.  ``columns`` defaults to the first file's.  A record with
    fewer or more fields than its header (a missing value, a separator that is not
    quoted) is kept, with its text in ``_malformed`` and its number of fields in
    ``_field_count``; both are NULL for all other rows.  With
    ``multi_line`` quoted values may hold line breaks; each file is then read by
    one task."""
    import uuid
    headers = file_headers(spark, path)
    cols = list(columns or next(iter(headers.values()), ()))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for f, h in headers.items():
        if lacks := [c for c in cols if c not in h]:
            raise ValueError(f"{f} has no column {', '.join(lacks)}")
        by_header.setdefault(h, []).append(f)
    ingest = ingest_id or uuid.uuid4().hex
    out = None
    for k, (h, files) in enumerate(by_header.items()):
        record = "_corrupt_record"
        while record in h:
            record += "_"
        df = (spark.read.schema(all_text_schema([*h, record]))
              .options(**CSV_OPTIONS, multiLine=multi_line, mode="PERMISSIVE", nullValue=NO_TEXT, columnNameOfCorruptRecord=record).csv(files)
              .select(*[F.col(f"`{c}`") for c in cols], F.col(record).alias(MALFORMED), _fields(F.col(record)).alias(FIELD_COUNT),
                      run_timestamp(run_ts).alias("ingested_at"),
                      F.col("_metadata.file_name").alias("source_file"),
                      F.lit(f"{ingest}-{k}").alias("_ingest_id"), F.monotonically_increasing_id().alias("_row_id")))
        out = df if out is None else out.unionByName(df)
    if out is None:
        audit = f"{MALFORMED} string, {FIELD_COUNT} int, ingested_at timestamp, source_file string, _ingest_id string, _row_id bigint"
        return spark.createDataFrame([], ", ".join([f"`{c}` string" for c in cols] + [audit]))
    return out


def ingest_csv(spark: SparkSession, path: str | Sequence[str], bronze_path: str, columns: Sequence[str] | None = None,
               run_ts=None, multi_line: bool = False, refresh: bool = False, ingest_id: str | None = None) -> None:
    """Append a landing CSV (file, directory or glob) to the bronze parquet table; with ``refresh`` it
    replaces what is there."""
    rows = read_landing_csv(spark, path, columns, run_ts, multi_line, ingest_id)
    rows.write.mode("overwrite" if refresh else "append").options(**LAYOUT).parquet(bronze_path)


def rows_per_file(bronze: DataFrame) -> DataFrame:
    """(source_file, rows_loaded) for every landing file in bronze."""
    return bronze.groupBy("source_file").agg(F.count(F.lit(1)).cast("bigint").alias("rows_loaded"))


def rows_loaded(bronze: DataFrame, source_file: str) -> int:
    """Rows loaded from one file (a pushed-down filter and a count)."""
    return bronze.where(F.col("source_file") == source_file).count()


def is_loaded(df: DataFrame) -> bool:
    """True when the table already holds rows (reads at most one row)."""
    return not df.isEmpty()


# ------------------------------------------------------------------ exports

def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, quotes doubled, blanks kept; ``single_file`` puts all rows through one task, so it is
    only for layers of a bounded size, such as months."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").options(**CSV_OPTIONS, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                                         emptyValue='""', quoteAll=False).csv(path))


def read_typed_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Re-read an export with declared types (no inference)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multi_line, emptyValue="").csv(path)


# ------------------------------------------------------------------ profile JSON

def write_profile(spark: SparkSession, profile, path: str) -> None:
    """The profile as one nested JSON document, ``{column: {role, reason, stats: {…}}}``, columns in order."""
    import json
    text = json.dumps(profile.to_dict(), default=str)  # one line: a text table of one row
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_profile(spark: SparkSession, path: str):
    """Inverse of :func:`write_profile`."""
    from strata.operators.model import Profile
    return Profile.from_json(spark.read.text(path, wholetext=True).first()["value"])


# ------------------------------------------------------------------ table maintenance

def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert (insert-or-replace): target rows whose key is not updated, plus all updates.

    A shuffle anti-join on the key; the result must be written to a new
    location (or after :func:`refresh_in_place`), never over ``target`` in
    the same plan."""
    kept = target.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def append_by_name(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """``INSERT INTO t (cols) SELECT …``: append only the listed columns, by name."""
    df.select(*columns).write.mode("append").parquet(path)


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Append-concatenate frames by column name (missing columns become NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def append_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str, path: str) -> None:
    """Append a small batch of in-memory rows to a parquet table."""
    spark.createDataFrame(list(rows), schema).write.mode("append").parquet(path)


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), more: bool = False) -> None:
    """Full refresh of a layer at ``path`` (overwrite), or ``more`` rows for it. The shuffles that made the rows are
    gone from the disks when it ends."""
    w = df.write.mode("append" if more else "overwrite").options(**LAYOUT)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        w.parquet(path)


#: Rows from which on a layer that needs them shuffled is written share by share of the keys, and shares at most: each
#: reads the rows again.
ROWS_PER_SHARE, MOST_SHARES = 2_000_000, 8


def shares_of(rows: int) -> int:
    """Shares that so many rows are shuffled in, one after the other."""
    return max(1, min(MOST_SHARES, -(-rows // ROWS_PER_SHARE)))


def write_shares(share: Callable[[tuple[int, int]], DataFrame], n: int, path: str) -> None:
    """Full refresh of a layer from ``share((k, n))`` for every k, one after the other, so that the disks hold the
    shuffled rows of one share at a time."""
    for k in range(n):
        write_layer(share((k, n)), path, more=k > 0)


def run_concurrently(*writes) -> None:
    """Run independent write actions as concurrent Spark jobs (one driver thread
    each) so their stages share the executors; re-raises the first failure."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        for f in [pool.submit(w) for w in writes]:
            f.result()


def refresh_in_place(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite ``path`` with a result that was computed *from* ``path``.

    Spark refuses to overwrite a location the same plan reads, so lineage is
    cut first with a reliable checkpoint in the shared checkpoint folder."""
    from strata.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    write_layer(df.checkpoint(eager=True), path, partition_by)


# ------------------------------------------------------------------ JDBC (PostgreSQL etc.)

def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Parallel JDBC read: give a numeric ``partition_column`` and bounds so each
    task reads one range instead of one task reading the whole table."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               batch_size: int = 50000) -> None:
    """Batched JDBC write (``batchsize`` rows per round trip, one connection per task)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()

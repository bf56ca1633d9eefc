"""Keep-latest deduplication without a window.

``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ingested_at DESC ...)``
sends every row of a key to one task; one key holding a third of the data
would then be sorted by a single task.  Here the survivor per key is the
maximum of a struct whose leading fields are the ordering columns, so the
aggregate runs partially on the map side and a hot key shrinks to one row
per map task before the shuffle.

Ordering (total, deterministic): ``ingested_at DESC, source_file DESC``,
then every raw column DESC (NULLs last), then the row identity.  Identical
copies tie on everything but the row identity, and any of them yields the
same survivor content.

Only keys seen more than once need any of this.  A first aggregate counts
rows per 64-bit key hash (fixed width, so it is a hash aggregate and
shuffles 16 bytes a key); the hashes counted twice or more set bits in a
table of fixed size (a Bloom filter with one hash).  Rows whose bit is not
set are alone with their key: they survive where they were read, without a
shuffle.  Only the others, a superset of the repeated keys' rows, go through
the struct aggregate, and only they are joined with the repeated keys (and
their survivor's identity) to find the rows that did not survive
(``rn > 1``).  The rows are counted first, in one job that also gives the
table of bits.  Repeated keys that are few and hold many rows each are
broadcast whole, and no row is shuffled; else those held by ``HOT_ROWS``
rows or more are broadcast, and the others meet in a shuffle join, where no
key brings more than that and the number of tasks grows with the rows.  Key
columns compare null-safely, as grouping does; a hash collision only makes a
row a candidate that is then compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of 64 bits in the table of repeated keys: two megabytes, whatever it is made of.
BIT_WORDS = 1 << 17
#: Rows from which on a key's duplicates are found by a broadcast; n rows hold n / HOT_ROWS such keys at most.
HOT_ROWS = 100_000
#: Repeated keys are broadcast whole if they are no more than FEW_KEYS and their rows at least FEW_SHARE times as many.
FEW_KEYS, FEW_SHARE = 50_000, 100
#: Rows that one task of the shuffle join takes; from WIDE tasks on their number is set by the rows, not by the session.
ROWS_PER_TASK, WIDE = 500_000, 8


def _order_fields(df: DataFrame, order_first: Sequence[str], row_id: Sequence[str]) -> list[str]:
    rest = [c for c in df.columns if c not in order_first and c not in row_id]
    tail = [c for c in row_id if c not in order_first]
    return list(order_first) + rest + tail


def _identity(df: DataFrame, row_id: Sequence[str]) -> list[str]:
    """The identity columns that the frame has."""
    return [c for c in row_id if c in df.columns]


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _word() -> Column:
    """The word of the table of bits that a key's hash belongs to, and its bit there."""
    return F.expr(f"pmod(_kh, {BIT_WORDS}L)")


def _spot() -> Column:
    return F.expr("shiftleft(1L, cast(pmod(shiftright(_kh, 20), 64) as int))")


def in_share(df: DataFrame, keys: Sequence[str], share: tuple[int, int]) -> DataFrame:
    """The rows of the k-th of n shares of the keys, ``share`` being (k, n). All rows of a key are in one."""
    k, n = share
    return df if n == 1 else df.where(_share_of(_key_hash(keys), n) == k)


def _share_of(key_hash: Column, n: int) -> Column:
    return F.pmod(F.shiftright(key_hash, 40), F.lit(n))


def key_groups(df: DataFrame, keys: Sequence[str], row_id: Sequence[str],
               order_first: Sequence[str] = ("ingested_at", "source_file")) -> DataFrame:
    """(_kh, keys..., _w: survivor struct, _n: rows per key) — one partial/final aggregate.

    The key's 64-bit hash comes first among the grouping columns: the aggregate
    sorts, and nearly every comparison ends at those eight bytes instead of
    running through equal beginnings of the key texts.

    The struct holds the columns that are not keys: a key is constant in its
    group, so it neither orders nor needs to travel twice.  Both the survivors
    and the duplicates derive from the result."""
    fields = [c for c in _order_fields(df, order_first, _identity(df, row_id)) if c not in keys]
    return df.groupBy(_key_hash(keys).alias("_kh"), *keys).agg(F.max(F.struct(*[F.col(c) for c in fields])).alias("_w"),
                                                               F.count(F.lit(1)).alias("_n"))


def without_hash(groups: DataFrame) -> DataFrame:
    """:func:`key_groups` as they are stored: without the hash, which does not compress and is cheap to make anew."""
    return groups.drop("_kh")


def with_hash(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored groups as :func:`key_groups` gives them."""
    return groups if "_kh" in groups.columns else groups.select(_key_hash(keys).alias("_kh"), "*")


def repeated_bits(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(word, bits): a bit for the hash of every key that ``df`` holds more than once, in at most ``BIT_WORDS`` rows."""
    return group_bits(df.groupBy(_key_hash(keys).alias("_kh")).agg(F.count(F.lit(1)).alias("_n")))


def group_bits(groups: DataFrame) -> DataFrame:
    """The same of groups that are known already (``_kh``, ``_n``)."""
    return groups.where("_n > 1").groupBy(_word().alias("_word")).agg(F.bit_or(_spot()).alias("_bits"))


def _marked(df: DataFrame, keys: Sequence[str], bits: DataFrame) -> DataFrame:
    """``df`` with ``_repeated``: whether the row's key may be held more than once. The broadcast table has a fixed bound;
    with keys beyond it more and more rows are marked, and nothing is lost."""
    marked = df.withColumn("_kh", _key_hash(keys))
    marked = marked.join(F.broadcast(bits), _word() == F.col("_word"), "left")
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col("_bits").bitwiseAND(_spot()) != 0, F.lit(False)).alias("_repeated"))


@dataclass(frozen=True)
class Repeats:
    """The repeated keys of some rows: their bits, and the :func:`key_groups` of the rows whose bit is set. A flow that
    needs survivors and duplicates writes both once and passes them to each."""

    bits: DataFrame
    groups: DataFrame

    def in_share(self, share: tuple[int, int]) -> Repeats:
        """Those of a share of the keys; see :func:`in_share`."""
        k, n = share
        return self if n == 1 else Repeats(self.bits, self.groups.where(_share_of(F.col("_kh"), n) == k))


def repeats(df: DataFrame, keys: Sequence[str], row_id: Sequence[str],
            order_first: Sequence[str] = ("ingested_at", "source_file"), bits: DataFrame | None = None,
            share: tuple[int, int] = (0, 1)) -> Repeats:
    """:class:`Repeats` of ``df``; pass ``bits`` where they are already written. Groups are those of a ``share`` of the keys."""
    bits = bits if bits is not None else repeated_bits(df, keys)
    return Repeats(bits, key_groups(_marked(in_share(df, keys, share), keys, bits).where("_repeated").drop("_repeated"), keys, row_id, order_first))


def merged_groups(*groups: DataFrame) -> DataFrame:
    """The groups of all rows, from the :func:`key_groups` of parts of them."""
    every = groups[0]
    for g in groups[1:]:
        every = every.unionByName(g)
    keys = [c for c in every.columns if c not in ("_w", "_n")]
    return every.groupBy(*keys).agg(F.max("_w").alias("_w"), F.sum("_n").alias("_n"))


def survivors(groups: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The surviving row of every group, with the columns that the rows had."""
    return groups.select(*[F.col(c) if c in keys else F.col(f"_w.{c}").alias(c) for c in columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], row_id: Sequence[str],
                   order_first: Sequence[str] = ("ingested_at", "source_file"),
                   known: Repeats | None = None) -> DataFrame:
    """One row per ``keys``: the greatest by (order_first..., other columns..., row_id).

    With the repeated keys ``known``, rows that are alone with their key pass as they
    are, without a shuffle, and only the others' survivors are read from the groups.
    Without, one aggregate over all rows finds the survivors: one scan and one
    shuffle, where looking for the repeated keys first would take two scans more.
    Keys are read from the grouping columns, so a filter on one reaches the scan."""
    groups = known.groups if known else key_groups(df, keys, row_id, order_first)
    kept = survivors(groups, df.columns, keys)
    return _marked(df, keys, known.bits).where("NOT _repeated").drop("_repeated").unionByName(kept) if known else kept


@dataclass(frozen=True)
class Counted:
    """What a job has counted: rows, repeated keys and their rows, hashes of keys held by ``HOT_ROWS`` rows or more, and
    the (word, bits) pairs of :func:`repeated_bits`."""

    rows: int
    keys: int
    copies: int
    hot: list[int]
    words: list[tuple[int, int]]

    def few(self) -> bool:
        return 0 < self.keys <= FEW_KEYS and self.copies >= FEW_SHARE * self.keys

    def bits(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.words, "_word long, _bits long")


def _counted(df: DataFrame, keys: Sequence[str], known: Repeats | None) -> Counted:
    """The counts of the written groups, or else of the rows: one row for each word of the table of bits, at most
    ``BIT_WORDS``. Two hot keys of a word are told apart; a third would be joined as the others are."""
    counts = known.groups.select("_kh", "_n") if known else df.groupBy(_key_hash(keys).alias("_kh")).agg(F.count(F.lit(1)).alias("_n"))
    n, hot = F.col("_n"), F.when(F.col("_n") >= HOT_ROWS, F.col("_kh"))
    words = counts.groupBy(_word().alias("_word")).agg(
        F.sum(n).alias("rows"), F.count(F.when(n > 1, 1)).alias("keys"), F.sum(F.when(n > 1, n)).alias("copies"),
        F.min(hot).alias("low"), F.max(hot).alias("high"), F.bit_or(F.when(n > 1, _spot())).alias("bits")).collect()
    return Counted(sum(w["rows"] for w in words), sum(w["keys"] for w in words), sum(w["copies"] or 0 for w in words),
                   sorted({h for w in words for h in (w["low"], w["high"]) if h is not None}),
                   [(w["_word"], w["bits"]) for w in words if w["bits"] is not None])


def not_latest(df: DataFrame, keys: Sequence[str], row_id: Sequence[str],
               order_first: Sequence[str] = ("ingested_at", "source_file"),
               known: Repeats | None = None, share: tuple[int, int] = (0, 1)) -> DataFrame:
    """Rows of ``df`` that did not survive (``rn > 1``), those of a ``share`` of the keys.

    An inner join of the rows whose key's bit is set with the keys held more than
    once. It runs on a 64-bit hash of the key (one fixed-width column to shuffle
    and sort on instead of several strings); the exact null-safe key equality
    stays as a residual condition, so a hash collision can never pair rows of
    different keys. A job counts the rows of each key first; few keys of many rows
    are joined by a broadcast, and so are hot ones, apart from the others."""
    df, known = in_share(df, keys, share), known and known.in_share(share)
    counted = _counted(df, keys, known)
    known = known or repeats(df, keys, row_id, order_first, bits=counted.bits(df.sparkSession))
    ids = _identity(df, row_id)
    dup_keys = known.groups.where(F.col("_n") > 1).select(
        F.col("_kh").alias("_kh2"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[(F.col(c) if c in keys else F.col(f"_w.{c}")).alias(f"_s{i}") for i, c in enumerate(ids)])
    tasks = -(-counted.rows // ROWS_PER_TASK)
    wide = tasks > min(WIDE, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def copies(rows: DataFrame, dup_keys: DataFrame) -> DataFrame:
        # null-safe equality written so the planner keeps it as a residual check
        # (only _kh becomes a shuffle/sort key)
        on = [rows["_kh"] == dup_keys["_kh2"]] + \
            [F.coalesce(rows[k] == dup_keys[f"_k{i}"], rows[k].isNull() & dup_keys[f"_k{i}"].isNull())
             for i, k in enumerate(keys)]
        survivor = F.lit(True)
        for i, c in enumerate(ids):
            survivor = survivor & rows[c].eqNullSafe(dup_keys[f"_s{i}"])
        return rows.join(dup_keys, on, "inner").where(~survivor).select(*[rows[c] for c in df.columns])

    def met(rows: DataFrame, dup_keys: DataFrame) -> DataFrame:
        return copies(rows.repartition(tasks, "_kh"), dup_keys.repartition(tasks, "_kh2")) if wide else copies(rows, dup_keys)

    if counted.few():
        return copies(df.withColumn("_kh", _key_hash(keys)), F.broadcast(dup_keys))
    rows = _marked(df, keys, known.bits).where("_repeated").drop("_repeated").withColumn("_kh", _key_hash(keys))
    hot = counted.hot
    if not hot:
        return met(rows, dup_keys)
    return copies(rows.where(F.col("_kh").isin(hot)), F.broadcast(dup_keys.where(F.col("_kh2").isin(hot)))).unionByName(
        met(rows.where(~F.col("_kh").isin(hot)), dup_keys.where(~F.col("_kh2").isin(hot))))

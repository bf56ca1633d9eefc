"""Packing by best-fit decreasing.

Documents are cut into full windows and one remainder. Remainders are dealt to groups of bounded expected
size; in each, the longest first, a remainder goes to the open window it fills best, found by a segment
tree over remaining capacities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, stored, strings
from strata.llm.tokens import by_tokenizer

#: Remainders a group holds on average: enough of them that little room stays open in any group.
GROUP = 20_000
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece long"


class Capacities:
    """Segment tree over capacities 0..size: how many open windows have a capacity in each range."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that some window has."""
        at = least + self.leaves
        if self.count[at]:
            return least
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """``(window number, offset)`` of each item; ``lengths`` must not rise."""
    tree, held, out, n = Capacities(window), [[] for _ in range(window + 1)], [], 0
    for length in lengths:
        room = tree.tightest(length)
        if room is None:
            number, room, n = n, window, n + 1
        else:
            number = held[room].pop()
            tree.add(room, -1)
        out.append((number, window - room))
        if room > length:
            held[room - length].append(number)
            tree.add(room - length, 1)
    return out


def pieces(spark: SparkSession, docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1,
           with_ids: bool = False) -> DataFrame:
    """Full windows and remainders of each row of ``docs(doc_id, text)``: its ids, then ``end_id``. A null
    text has no ids of its own. ``piece`` numbers them; store the rows before using it."""
    file = spark.sparkContext.broadcast(Path(tokenizer).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, n, last = by_tokenizer(file.value), TaskContext.get().partitionId() << 40, end_id.to_bytes(4, "little")
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
                ids = encode(text) + last
                total = len(ids) // 4
                for start in range(0, total, window):
                    own = ids[4 * start:4 * (start + window)]
                    rows.append((doc_id, start, len(own) // 4, zlib.crc32(own), total, n, *([own] if with_ids else [])))
                    n += 1
            if rows:
                kinds = [pa.int64()] * 6 + [pa.binary()] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"] + ["ids"] * with_ids)

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, _PIECES + ", ids binary" * with_ids))


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1,
         with_ids: bool = False, group: int = GROUP) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` for each piece, and its
    ``ids`` (little-endian unsigned 32-bit) if asked for.

    Every id of every row is in exactly one piece; a row without text is one piece of ``end_id``. Repeated
    rows are packed each for itself; a null ``doc_id`` stays null; an empty table gives no rows; other
    columns are not read. Sequences are named by a piece in them, so names are unique without a count."""
    if window < 1:
        raise ValueError("window must be positive")
    bounded_batches(spark)
    cut = stored(spark, pieces(spark, docs, tokenizer, window, end_id, with_ids), "pieces")
    columns = [c for c in cut.columns if c != "piece"]
    rest = cut.filter(F.col("length") < window)
    groups = max(1, -(-rest.count() // group))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "piece"], ascending=[False, True], kind="stable", ignore_index=True)
        at = best_fit_decreasing(rows["length"].tolist(), window)
        first: dict[int, int] = {}
        names = [first.setdefault(k, p) for (k, _), p in zip(at, rows["piece"].tolist(), strict=True)]
        return pd.DataFrame({"piece": rows["piece"], "sequence_id": names, "offset": [o for _, o in at]})

    dealt = rest.withColumn("of", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    if with_ids:
        placed = dealt.select("of", "length", "piece").groupBy("of").applyInPandas(fit, "piece long, sequence_id long, offset long")
        packed = rest.join(placed, "piece").select(*columns, "sequence_id", "offset")
    else:
        packed = dealt.groupBy("of").applyInPandas(
            lambda r: r.drop(columns="of").merge(fit(r), on="piece")[[*columns, "sequence_id", "offset"]],
            ", ".join(f"{c} long" for c in [*columns, "sequence_id", "offset"]))
    full = cut.filter(F.col("length") == window).select(*columns, F.col("piece").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)

"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut into words (a run of white space with what follows it, which never splits a pre-token). Tasks
reduce chunks of documents to their distinct words and the places of those. The distinct words are shuffled by
hash, each is encoded once where all its chunks meet, the ids go back to the chunks, and the places put
them in order. Decoding joins ids with the table of token bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, stored_by, strings
from strata.llm.tokens import by_ranks, ranks, units

#: Characters of documents that are reduced together, and places in a row.
CHUNK, PLACES = 14 << 20, 1 << 18
#: Characters of words whose ids a task keeps while the chunks of a bucket pass.
KEPT = 1 << 22
_ROWS = "chunk long, bucket int, doc_ids array<long>, counts array<long>, data binary"


def _pack(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def _pack_words(words: list[str]) -> bytes:
    own = [w.encode() for w in words]
    sizes = np.array([len(w) for w in own], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=6).compress(len(own).to_bytes(8, "little") + sizes + b"".join(own))


def _unpack_words(data: bytes) -> list[str]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 8), dtype=np.int64) + 8 + 4 * n
    out, at = [], 8 + 4 * n
    for e in ends.tolist():
        out.append(raw[at:e].decode())
        at = e
    return out


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values of the ragged rows ``at``, one after the other."""
    n = sizes[at]
    before = np.cumsum(n) - n
    return values[np.repeat(starts[at] - before, n) + np.arange(int(n.sum()))]


def chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of words (``bucket`` set: the chunk's distinct words of that bucket) and of places (``bucket`` null:
    documents, their numbers of words, and for each word its number among the chunk's words, bucket after bucket)."""
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
    names = ["chunk", "bucket", "doc_ids", "counts", "data"]

    def rows(own: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*own, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        known: dict[str, int] = {}
        ids: list = []
        counts: list[int] = []
        places: list[np.ndarray] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            dealt: dict[int, list[str]] = {}
            for w in known:
                dealt.setdefault(zlib.crc32(w.encode()) % buckets, []).append(w)
            to, n = np.empty(len(known), np.uint32), 0
            for k in sorted(dealt):
                own = sorted(dealt.pop(k))  # sorted words pack well
                to[[known[w] for w in own]] = np.arange(n, n + len(own), dtype=np.uint32)
                n += len(own)
                yield rows([(number, k, None, None, _pack_words(own))])
            first, held = 0, 0
            for i, p in enumerate(places):
                held += len(p)
                if held >= PLACES or i == len(places) - 1:
                    yield rows([(number, None, ids[first:i + 1], counts[first:i + 1], _pack(to[np.concatenate(places[first:i + 1])]))])
                    first, held = i + 1, 0

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), strings(b.column(1)), strict=True):
                own = units(text)
                places.append(np.fromiter((known.setdefault(u, len(known)) for u in own), np.uint32, len(own)))
                ids.append(doc_id)
                counts.append(len(own))
                size += len(text)
                if size >= CHUNK:
                    yield from close()
                    known, ids, counts, places, size = {}, [], [], [], 0
                    number += 1
        if ids:
            yield from close()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _ROWS)


def encode(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` for each row of ``docs(doc_id, text)``: ids as little-endian unsigned 32-bit binary, each
    match of ``pattern`` encoded by itself by the ranks, no special tokens.

    ``pattern`` must keep white space and what follows apart as the public pattern does (see ``tokens``). Null
    and empty texts have no ids; repeated rows each get theirs; a null ``doc_id`` stays null; an empty table
    gives no rows; other columns are not read."""
    file = spark.sparkContext.broadcast(Path(rank_file).read_bytes())
    bounded_batches(spark)
    # bucketed by chunk, so the places, by far the most of it, are never shuffled
    cut = stored_by(spark, chunks(docs, int(spark.conf.get("spark.sql.shuffle.partitions"))), "bpe_chunks", "chunk")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = by_ranks(file.value, pattern)
        own.keep = KEPT
        for b in batches:
            for chunk, bucket, data in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                words = _unpack_words(data)
                if new := [w for w in words if w not in own.known]:
                    own.learn(new if own.size <= own.keep else words)
                ids = [own.known[w] for w in words]
                sizes = np.array([len(x) // 4 for x in ids], np.uint32)
                flat = np.frombuffer(b"".join(ids), "<u4")
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([bucket], pa.int32()), pa.array([_pack(sizes)]), pa.array([_pack(flat)])],
                                                 ["chunk", "bucket", "sizes", "ids"])

    coded = (cut.filter("bucket is not null").select("chunk", "bucket", "data").repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(once, "chunk long, bucket int, sizes binary, ids binary"))

    def reassemble(places: pa.Table, words: pa.Table) -> pa.Table:
        ids, texts = [], []
        order = words.sort_by("bucket")
        sizes = [_unpack(x) for x in order.column("sizes").to_pylist()]
        flat = [_unpack(x) for x in order.column("ids").to_pylist()]
        n = np.concatenate(sizes).astype(np.int64) if sizes else np.empty(0, np.int64)
        values = np.concatenate(flat) if flat else np.empty(0, "<u4")
        starts = np.cumsum(n) - n
        for doc_ids, counts, data in zip(*(places.column(c).to_pylist() for c in ("doc_ids", "counts", "data")), strict=True):
            at = _unpack(data).astype(np.int64)
            own = gather(values, starts, n, at).astype("<u4")
            ends = np.concatenate(([0], np.cumsum(n[at])))[np.cumsum(counts)]
            ids += doc_ids
            texts += [own[s:e].tobytes() for s, e in zip(np.concatenate(([0], ends[:-1])), ends, strict=True)]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "ids": pa.array(texts, pa.binary())})

    spots = cut.filter("bucket is null").select("chunk", "doc_ids", "counts", "data")
    return spots.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(reassemble, "doc_id long, ids binary")


def decode(spark: SparkSession, coded: DataFrame, rank_file: str) -> DataFrame:
    """``coded(ids, ...)`` with ``decoded``, the bytes of the ids by the token table, whose size is fixed by the
    file. Null ids decode to null; an id that the table lacks fails the job."""
    table = ranks(Path(rank_file).read_bytes())
    n = max(table.values()) + 1
    words = [b""] * n
    for w, i in table.items():
        words[i] = w
    sizes = np.array([len(w) for w in words], np.int64)
    own = spark.sparkContext.broadcast((np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, starts, sizes = own.value
        for b in batches:
            at = b.schema.get_field_index("ids")
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                out = []
                for x in part.column(at).to_pylist():
                    ids = np.frombuffer(x or b"", "<u4").astype(np.int64)
                    if len(ids) and not (sizes[ids] > 0).all():
                        raise ValueError("an id has no token")
                    out.append(None if x is None else gather(values, starts, sizes, ids).tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*part.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema) + ", decoded binary"
    return coded.mapInArrow(run, schema)

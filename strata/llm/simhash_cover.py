"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of ``radius + 1`` bits, and every non-zero vector ``v`` gives a
table whose mask keeps the positions with an odd product with ``v``. At most ``radius`` positions differ in
a linked pair, and ``radius`` vectors leave some ``v`` orthogonal to all of them: in that table the pair
has equal keys. So no linked pair is missed, by construction and not by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, member_bits, parted, stored, text_hash, utf8
from strata.llm.graph import components

SEED = 42
#: Buckets up to this size are compared in memory; larger ones are covered again over their free bits.
BUCKET = 512
_BLOCK = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """64-bit SimHash of the ``width``-word shingles of a UTF-8 text: A-Z lowered, one bit for each
    position that over half of the shingle hashes set. Fewer words make one shingle; no words make 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line, n = b" ".join(words), len(words) - width + 1
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
    stops = ends[width - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK], strict=True)],
                     dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp)`` for each row of ``docs(doc_id, text)``; a null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, width) for t in utf8(b.column(2))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], ["doc_id", "text_hash", "fp"])

    return (docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def cover_masks(bits: list[int], radius: int) -> list[int]:
    """The masks over the given bit positions: any ``radius`` of them are outside some mask."""
    n = 1 << (radius + 1)
    own = {bit: i % (n - 1) + 1 for i, bit in enumerate(bits)}
    return [sum(1 << bit for bit, p in own.items() if (p & v).bit_count() & 1) for v in range(1, n)]


def _mix(path: int, table: int, key: np.ndarray) -> np.ndarray:
    """A bucket's number. Two buckets that meet in one number are only compared together."""
    x = key ^ np.uint64((path * 0x9E3779B97F4A7C15 + table * 0xC2B2AE3D27D4EB4F + 1) % (1 << 64))
    with np.errstate(over="ignore"):
        for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(31))) * np.uint64(m)
    return x ^ (x >> np.uint64(29))


def _dealt(fps: np.ndarray, path: int, free: int, radius: int) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once in each table over the free bits of its bucket."""
    for v, mask in enumerate(cover_masks([i for i in range(64) if free >> i & 1], radius)):
        bucket = _mix(path, v, fps & np.uint64(mask))
        rest = np.full(len(fps), np.uint64(free & ~mask).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(rest), pa.array(fps.view(np.int64))],
                                         ["bucket", "free", "fp"])


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join what is linked in a bucket: a spanning forest, so no more than its members."""
    parent = list(range(len(fps)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    for i in range(len(fps) - 1):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= radius) + i + 1:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, int(j)))
    return out


def links(spark: SparkSession, prints: DataFrame, radius: int = 3) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints that join exactly those within ``radius`` bits
    (directly or over other edges). Buckets over ``BUCKET`` are dealt again by covering their free bits,
    which at most halves those each time, so the passes are few and every pair is still met."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _dealt(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), 0, (1 << 64) - 1, radius)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(a, b, bucket, free) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(bucket, pa.int64()), pa.array(free, pa.int64())],
                ["a", "b", "bucket", "free"])

        def again(fps: np.ndarray, bucket: int, free: int) -> Iterator[pa.RecordBatch]:
            for d in _dealt(fps, bucket % (1 << 64), free % (1 << 64), radius):
                yield rows(d.column(2), pa.nulls(len(fps), pa.int64()), d.column(0), d.column(1))

        def close(held: list[np.ndarray], big: bool, free: int) -> Iterator[pa.RecordBatch]:
            if not big and held:
                fps = np.unique(np.concatenate(held))
                if pairs := _forest(fps, radius):
                    at, signed = np.array(pairs), fps.view(np.int64)
                    none = pa.nulls(len(at), pa.int64())
                    yield rows(signed[at[:, 0]], signed[at[:, 1]], none, none)

        key, held, size, big, free = None, [], 0, False, 0
        for batch in batches:
            bucket, rest, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(bucket)])), strict=True):
                if e <= s:
                    continue
                if key is None or bucket[s] != key:
                    if size > 1:
                        yield from close(held, big, free)
                    key, held, size, big, free = bucket[s], [], 0, False, 0
                part, size, free = fp[s:e].view(np.uint64), size + int(e - s), free | int(rest[s:e].max()) | int(rest[s:e].min())
                if big:
                    yield from again(part, int(key), free)
                elif size > BUCKET and (free % (1 << 64)).bit_count() > BUCKET.bit_length() - 1:
                    big = True
                    for x in [*held, part]:
                        yield from again(x, int(key), free)
                    held = []
                else:
                    held.append(part)
        if size > 1:
            yield from close(held, big, free)

    dealt = prints.select("fp").distinct().mapInArrow(deal, "bucket long, free long, fp long")
    edges = None
    while True:
        found = stored(spark, dealt.repartition("bucket").sortWithinPartitions("bucket")
                       .mapInArrow(compare, "a long, b long, bucket long, free long"), "simhash-links")
        now = found.filter("bucket is null").select("a", "b").distinct()
        edges = now if edges is None else edges.unionByName(now)
        dealt = found.filter("bucket is not null").select("bucket", "free", F.col("a").alias("fp"))
        if dealt.isEmpty():
            return edges.distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp, label, component_id)`` for each row of ``docs(doc_id, text)``: documents whose
    fingerprints differ in at most ``radius`` bits are linked, over any chain of links.

    ``label`` is a fingerprint that names the component, ``component_id`` is the smallest ``doc_id`` of the component; null where all its ids are null. Null and
    empty texts have fingerprint zero and are linked like any other. Repeated rows stay, each with its
    component. Other columns are not read. An empty table gives no rows. Copies share a fingerprint and are
    one node, so a group of any size costs one row after its partial aggregate."""
    bounded_batches(spark)
    prints = stored(spark, fingerprints(docs, width), "simhash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    found = components(spark, links(spark, prints, radius))
    labelled = (nodes.join(found, nodes["fp"] == found["node"], "left")
                .select("fp", "least_id", F.coalesce("label", "fp").alias("label")))
    ids = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of = labelled.join(ids, "label").select(F.col("fp").alias("fp_of"), "label", "component_id")
    return prints.join(of, prints["fp"] == of["fp_of"]).drop("fp_of")


def first_of_groups(spark: SparkSession, docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest ``doc_id``
    stays (of several, that with the smallest text hash; rows equal in both count as one). A component
    whose ids are all null keeps its row of the smallest text hash. All columns are kept."""
    near = near_duplicates(spark, docs, width, radius)
    rows = near.groupBy("label", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = (rows.groupBy("label")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")).alias("k")))
    first = stored(spark, first.select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash"), F.col("k.n").alias("kept_n")), "simhash-kept")
    out = rows.join(first, rows["doc_id"].eqNullSafe(first["kept_id"]) & (rows["text_hash"] == first["kept_hash"]), "left_anti")
    out = stored(spark, out.select(F.col("doc_id").alias("_s_id"), F.col("text_hash").alias("_s_hash")), "simhash-out")
    many = first.filter("kept_n > 1").select(F.col("kept_id").alias("_s_id"), F.col("kept_hash").alias("_s_hash"))
    bits = member_bits(spark, out.unionByName(many).select(F.xxhash64("_s_id", "_s_hash").alias("ref")))
    may, rest = parted(docs, F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))), bits)
    on = lambda k: may["doc_id"].cast("long").eqNullSafe(k["_s_id"]) & (F.xxhash64(may["text"].cast("string")) == k["_s_hash"])
    stays = may.join(out, on(out), "left_anti")
    # of rows equal in id and text one stays
    at = lambda k: stays["doc_id"].cast("long").eqNullSafe(k["_s_id"]) & (F.xxhash64(stays["text"].cast("string")) == k["_s_hash"])
    return rest.unionByName(stays.join(many, at(many), "left_anti")).unionByName(
        stays.join(many, at(many), "left_semi").dropDuplicates(["doc_id", "text"]))

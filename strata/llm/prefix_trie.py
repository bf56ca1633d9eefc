"""Conversation prefix trie with a depth-band rollup.

Every distinct sequence of first turns is a node. Subtree totals are not summed over all ancestors, which a deep
conversation has many of, nor level by level, which takes as many rounds as it is deep: depths are cut into bands
of fixed height, and a node adds its values to its ancestors inside its band alone. The tops of the bands, now
holding their band's totals, form a trie of ``1 / band`` of the depth, which is summed in the same way; its
completed totals are then added to the nodes of the band above each top. Rounds grow with the logarithm of the
depth, and a node is exploded to at most ``band`` others in each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, stored

#: Depths of a band.
BAND = 16
#: Bytes of a node's name: the hash of its turns.
NAME = 16
ROOT = bytes(NAME)
_SPACE = r"[\x20\x09-\x0D]+"
#: Ids in one piece of a list that is hashed.
PIECE = 4096


def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn_key, n_words)`` of ``conversations(conv_id, turn, role, text)``: its turns from place 1 on,
    and each conversation once at place 0.

    Turns are ordered by ``turn``, null first, and equal ones by the SHA-256 of their content. A null role or text is
    empty; repeated rows are turns of their own; rows without ``conv_id`` belong to no conversation. Texts stay where
    they are read: only their hashes and counts are shuffled, and a conversation is sorted as a stream that may spill."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn_key"),
        F.size(F.array_remove(F.split(text, _SPACE), "")).cast("long").alias("n_words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_key")
    placed = turns.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "turn_key", "n_words")
    ids = turns.select("conv_id").distinct().select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn_key"),
                                                    F.lit(0).cast("long").alias("n_words"))
    return placed.unionByName(ids)


def rebuilt(spark: SparkSession, conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """The :func:`sequences` of conversations that share first turns: of conversation ``c`` the first
    ``crc32(c) % heads`` turns are those of ``c - c % group`` (all, if it has fewer; none, if there is no such)."""
    own = stored(spark, sequences(conversations), "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    tails = own.filter((F.col("place") == 0) | (F.col("place") > h))
    first = own.filter((F.col("place") > 0) & (F.col("place") < heads) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    takers = own.filter("place = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"))
    return tails.unionByName(takers.join(first, "base").filter(F.col("place") <= F.col("h")).select(own.columns))


def members(seqs: DataFrame, band: int = BAND) -> DataFrame:
    """``(node, parent, depth, n_words, up, conv_id, ends)`` for each conversation of :func:`sequences` and each node it
    starts with. ``up[k]`` names, one after another, the ancestors at depths divisible by ``band**k`` in the node's
    band of ``band**(k+1)`` depths (of the band before, if the node is the top of one), for each ``k`` whose power
    divides the node's depth. A task holds two bands of names at a time, however long a conversation is."""
    names = ["node", "parent", "depth", "n_words", "up", "conv_id", "ends"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last, held, node, depth, recent = None, None, ROOT, 0, []
        for b in batches:
            for conv, _, key, n in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if conv != last:
                    if held:
                        rows.append((*held, True))
                    last, node, depth, recent = conv, ROOT, 0, []
                    held = (ROOT, None, 0, 0, [], conv)
                if key is None:
                    continue
                rows.append((*held, False))
                parent, node, depth, up, step = node, hashlib.blake2b(node + key, digest_size=NAME).digest(), depth + 1, [], 1
                while depth % step == 0:
                    if len(up) == len(recent):
                        recent.append([ROOT])
                    own = recent[len(up)]
                    up.append(b"".join(own))
                    step *= band
                    if depth % step == 0:
                        own.clear()
                    own.append(node)
                held = (node, parent, depth, n, up, conv)
            if len(rows) > 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                rows = []
        if held:
            rows.append((*held, True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return (seqs.select("conv_id", "place", "turn_key", "n_words").repartition("conv_id").sortWithinPartitions("conv_id", "place")
            .mapInArrow(run, "node binary, parent binary, depth long, n_words long, up array<binary>, conv_id long, ends boolean"))


def _named(up: Column) -> Column:
    """The names in a list of :func:`members`."""
    return F.transform(F.sequence(F.lit(1), F.length(up), F.lit(NAME)), lambda i: F.substring(up, i, F.lit(NAME)))


def subtree_sums(spark: SparkSession, nodes: DataFrame, values: list[str], deepest: int, band: int = BAND) -> DataFrame:
    """``(node, values...)`` summed over each node's subtree, of ``nodes(node, depth, up, values...)``."""
    sums = [F.sum(v).alias(v) for v in values]
    partial, step, k = [], 1, 0
    level = nodes.select("node", "depth", "up", *values)
    while True:
        inside = level.filter(F.col("depth") % (step * band) != 0).select(F.explode(_named(F.get("up", k))).alias("node"), *values)
        own = level.select("node", "depth", *values).unionByName(inside.withColumn("depth", F.lit(None).cast("long")))
        partial.append(stored(spark, own.groupBy("node").agg(F.max("depth").alias("depth"), *sums), "band-sums"))
        step, k = step * band, k + 1
        if step > deepest:
            break
        tops = partial[-1].filter(F.col("depth") % step == 0).select("node", *values)
        level = nodes.filter(F.col("depth") % step == 0).select("node", "depth", "up").join(tops, "node")
    total = partial[-1].select("node", *values)
    for k in range(len(partial) - 2, -1, -1):  # the tops of the bands of this level are complete: add them to the band above
        step //= band
        tops = nodes.filter((F.col("depth") % step == 0) & (F.col("depth") > 0)).select("node", "up").join(total, "node")
        names = _named(F.get("up", k))  # the first name is a top itself
        below = tops.select(F.explode(F.slice(names, 2, F.size(names))).alias("node"), *values)
        rest = partial[k].filter(F.col("depth") % step != 0).select("node", *values)
        total = stored(spark, total.unionByName(rest.unionByName(below).groupBy("node").agg(*sums)), "subtree-sums")
    return total


def listed(ids: DataFrame) -> DataFrame:
    """``(node, digest)`` of ``ids(node, conv_id)``: the SHA-256 of each node's ids, ascending and comma-joined. Pieces of
    the lists are made in tasks of equal size; a node's pieces are then hashed one after another, as that hash needs."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, own = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([own[0]], pa.int64()), pa.array([",".join(map(str, own))])],
                                              ["node", "least", "piece"])

        for b in batches:
            for name, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if own and (name != node or len(own) == PIECE):
                    yield row()
                    own = []
                node = name
                own.append(conv)
        if own:
            yield row()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, own, done = None, None, []

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])], ["node", "digest"])

        for b in batches:
            for name, piece in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if own is not None and name == node:
                    own.update(b"," + piece.encode())
                    continue
                if own is not None:
                    done.append((node, own.hexdigest()))
                node, own = name, hashlib.sha256(piece.encode())
            if len(done) > 10_000:
                yield out(done)
                done = []
        if own is not None:
            yield out([*done, (node, own.hexdigest())])

    cut = (ids.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
           .mapInArrow(pieces, "node binary, least long, piece string"))
    return cut.repartition("node").sortWithinPartitions("node", "least").mapInArrow(digests, "node binary, digest string")


def trie(spark: SparkSession, seqs: DataFrame, band: int = BAND) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` for each node of
    the conversations in :func:`sequences`.

    A node is named by its smallest member; the root has no parent. ``saved_tokens`` sums, over the subtree, the words
    of a node's last turn for every member but one. ``ends_sha256`` is over the members that end at the node. No
    conversations give no rows, a conversation without turns is a member of the root. A conversation's turns pass one
    task as a stream; nodes with very many members or children are reduced before they are shuffled, or left to the
    split of skewed joins."""
    bounded_batches(spark)
    every = stored(spark, members(seqs, band), "trie-members")
    nodes = stored(spark, every.groupBy("node", "parent", "depth", "n_words", "up").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")),
                   "trie-nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    valued = nodes.join(children, "node", "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"))
    valued = stored(spark, valued, "trie-values")
    deepest = valued.agg(F.max("depth")).first()[0] or 0
    sums = subtree_sums(spark, valued, ["n_leaves", "saved_tokens"], deepest, band)
    ends = listed(every.filter("ends"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = (valued.drop("n_leaves", "saved_tokens", "up", "n_words").join(sums, "node").join(ends, "node", "left").join(above, "parent", "left"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"))

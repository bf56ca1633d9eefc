"""Benchmark decontamination by winnowing.

A span of ``span`` words holds ``span - gram + 1`` hashes of ``gram`` consecutive words. Of every such run of
hashes the smallest is kept as a fingerprint, so a span that a document shares with a benchmark item always
has a fingerprint that both keep, at the same word of the span. Fingerprints of the two sides are joined, and
each hit is extended to the whole span, word by word. Everything is built-in functions.

Words are runs of digits, letters a-z (A-Z lowered) and characters beyond ASCII. The spans of an item are
its windows of ``span`` consecutive words; an item of fewer words, but not none, is one span by itself and is
looked for by the hash of all its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BIT_WORDS, member_bits, stored, text_hash

#: What parts words, in a text whose A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a span that must not be missed, and words of a hashed gram.
SPAN, GRAM = 10, 5
#: Places of a document that are looked at together: what a row carries stays small, however long the text.
BLOCK = 512


def words(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), SEPARATORS), "")


def _hashed(texts: Column, gram: int) -> Column:
    """One hash for each ``gram`` consecutive words."""
    starts = F.when(F.size(texts) >= gram, F.sequence(F.lit(0), F.size(texts) - gram)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(texts, i + j) for j in range(gram)]))


def _least_of_some_run(grams: Column, at: Column, own: Column, run: int) -> Column:
    """Whether ``own``, the hash at ``at``, is the smallest of some ``run`` consecutive hashes. Equal hashes all
    count, so the choice depends on the run's words alone, wherever it stands."""
    def reach(step: int) -> Column:
        out = F
        for j in range(1, run):
            out = out.when(F.coalesce(F.get(grams, at + step * j) < own, F.lit(True)), j - 1)
        return out.otherwise(run - 1) if run > 1 else F.lit(0)

    return reach(-1) + reach(1) >= run - 1


def spans(items: DataFrame, sizes: list[int], span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The distinct spans of ``items(item_id, text)``, whose lengths are ``sizes``: ``(span_words, size, hash, offset)``, where ``hash`` is the
    span's fingerprint and ``offset`` its first word in the span."""
    of = items.select(words(F.col("text")).alias("w")).filter(F.size("w") > 0).distinct()
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - span + 1, F.lit(1)))
    cut = of.select(F.explode(F.transform(starts, lambda i: F.slice("w", i, span))).alias("span_words")).distinct()
    sized = cut.withColumn("size", F.size("span_words"))
    out = None
    for size in sizes:  # a shorter item is one span, whose only hash is its fingerprint
        of_size = sized.filter(F.col("size") == size).withColumn("g", _hashed(F.col("span_words"), gram if size == span else size))
        part = of_size.select("span_words", "size", F.array_min("g").alias("hash"),
                              (F.array_position("g", F.array_min("g")) - 1).cast("int").alias("offset"))
        out = part if out is None else out.unionByName(part)
    return out


def candidates(docs: DataFrame, bits: DataFrame, size: int, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Fingerprints of ``docs`` that may be among the spans of ``size`` words: ``(doc_id, text_hash, at, hash, before, near)``
    with the words ``near`` the fingerprint, ``before`` of which stand ahead of it. ``bits`` is a table of fixed size that
    tells the others, so only these leave their task."""
    gram, run = (gram, span - gram + 1) if size == span else (size, 1)
    own = words(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text").cast("string")).alias("text_hash"), own.alias("w"))
    # outer: an inner explode would have its array computed once more for a filter on its size
    cut = rows.select("*", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("w") - gram, F.lit(0)), F.lit(BLOCK))).alias("base"))
    ahead = F.least(F.col("base"), F.lit(run - 1))
    cut = cut.select("doc_id", "text_hash", "base", F.slice("w", F.col("base") - ahead + 1, ahead + BLOCK + run + gram - 2).alias("part"))
    gone = cut.withColumn("g", _hashed(F.col("part"), gram)).select("doc_id", "text_hash", "base", "part", "g", F.posexplode_outer("g").alias("i", "hash"))
    gone = gone.filter(F.col("hash").isNotNull() & (F.col("i") >= ahead) & (F.col("i") < ahead + BLOCK))
    if run > 1:
        gone = gone.filter(_least_of_some_run(F.col("g"), F.col("i"), F.col("hash"), run))
    spot = F.expr("shiftleft(1L, cast(pmod(shiftright(hash, 20), 64) as int))")
    met = gone.join(F.broadcast(bits), F.pmod(gone["hash"], F.lit(BIT_WORDS)) == bits["word"]).filter(F.col("bits").bitwiseAND(spot) != 0)
    before = F.least(F.col("i"), F.lit(run - 1))
    return met.select("doc_id", "text_hash", F.lit(size).alias("size"), (F.col("base") - ahead + F.col("i")).alias("at"), "hash", before.alias("before"),
                      F.slice("part", F.col("i") - before + 1, before + gram + run - 1).alias("near"))


def hits(spark: SparkSession, docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``(doc_id, text_hash, start, size, span_words)``: every place of a document where a span of an item stands,
    each once, whatever the number of items that hold the span."""
    own = F.least(F.size(words(F.col("text"))), F.lit(span))
    sizes = [r[0] for r in items.select(own.alias("size")).distinct().collect() if r[0]]  # at most ``span`` numbers
    if not sizes:
        return spark.createDataFrame([], "doc_id long, text_hash long, start int, size int, span_words array<string>")
    wanted = stored(spark, spans(items, sizes, span, gram), "spans")
    found = None
    for size in sizes:
        bits = member_bits(spark, wanted.filter(F.col("size") == size).select(F.col("hash").alias("ref")))
        part = candidates(docs, bits, size, span, gram)
        found = part if found is None else found.unionByName(part)
    near = stored(spark, found, "fingerprints").alias("f")
    join = near.join(wanted.alias("s"), (F.col("f.size") == F.col("s.size")) & (F.col("f.hash") == F.col("s.hash")))
    first = F.col("before") - F.col("offset")
    whole = join.filter(F.when(first >= 0, F.slice("near", F.greatest(first, F.lit(0)) + 1, F.col("s.size")) == F.col("span_words")))
    return whole.select("doc_id", "text_hash", (F.col("at") - F.col("offset")).alias("start"), F.col("s.size").alias("size"), "span_words").distinct()


def _covered(places: Column) -> Column:
    """Words inside any of the ``(start, size)`` places."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    step = lambda a, p: F.struct(
        (a["n"] + F.greatest(p["start"] + p["size"] - F.greatest(a["end"], p["start"].cast("long")), F.lit(0))).alias("n"),
        F.greatest(a["end"], (p["start"] + p["size"]).cast("long")).alias("end"))
    return F.aggregate(F.sort_array(places), start, step, lambda a: a["n"])


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_words, n_hit, item_ids)`` for each row of ``docs(doc_id, text)``: its words, those inside a span of
    an item, and the items with a span in it (as text, sorted).

    Null and empty texts have no words and no hits; an item without words has no span. Repeated rows each get their row;
    items with equal ids count as one; a null ``item_id`` is named by the empty text; a null ``doc_id`` is an id like any
    other. No rows in ``docs`` give none, no items give rows without hits. Other columns are not read. Documents are
    told by id and text hash. What one document's hits hold is bounded by its own words and the items it meets."""
    if not 0 < gram <= span:
        raise ValueError("a gram has at least one word and at most the span's")
    met = stored(spark, hits(spark, docs, items, span, gram), "span-hits")
    keys = ["doc_id", "text_hash"]
    covered = met.groupBy(*keys).agg(_covered(F.collect_set(F.struct("start", "size"))).alias("n_hit"))
    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    holds = own.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - span + 1, F.lit(1))),
                                                     lambda i: F.slice("w", i, span))).alias("span_words")).distinct()
    of = (met.select(*keys, "span_words").distinct().join(holds, "span_words").select(*keys, "item").distinct()
          .groupBy(*keys).agg(F.sort_array(F.collect_list("item")).alias("item_ids")))
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text").cast("string")).alias("text_hash"),
                        F.size(words(F.col("text"))).cast("long").alias("n_words")).alias("d")
    out = every
    for side, name in ((covered, "n_hit"), (of, "item_ids")):
        right = side.select(F.col("doc_id").alias("_k"), F.col("text_hash").alias("_h"), name)
        out = out.join(right, F.col("doc_id").eqNullSafe(F.col("_k")) & F.col("text_hash").eqNullSafe(F.col("_h")), "left").drop("_k", "_h")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))

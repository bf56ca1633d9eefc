"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.llm.oracle import ORACLE  # noqa: F401  SQL by query, where SQL can state it; tests hold the others against brute force

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.simhash_cover import near_duplicates
    near = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _joined(spans, kinds=None):
    own = spans if kinds is None else F.filter(spans, lambda p: p["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"])))


@query
def op1_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.secret_links import BASE, secrets
    found = secrets(spark, table(spark, sf_dir, "documents"))

    def n(kind: str):  # the lambda takes the element alone: Spark gives a second parameter the element's place
        return F.size(F.filter("spans", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(n, BASE),
                        F.sha2(_joined(F.col("spans"), BASE), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.best_fit import pack
    return pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.mcd_outliers import verdicts
    return verdicts(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query
def op2_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.compact_windows import repeats
    return repeats(spark, table(spark, sf_dir, "documents")).drop("text_hash", "of_text_hash")


@query
def op5_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.word_bpe import decode, encode
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = decode(spark, encode(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_subword_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.subword_langid import predict, train
    docs = table(spark, sf_dir, "documents")
    return predict(spark, docs, train(spark, docs))


@query
def op9_stable_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.stable_ann import nearest
    return nearest(spark, table(spark, sf_dir, "embeddings"), every=100, k=10)


@query
def op10_dom_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.dom_boost import extract, train
    pages = table(spark, sf_dir, "pages")
    return extract(spark, pages, train(spark, pages))


@query
def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document takes three edits whose places follow from its id and length: a replacement, an insertion
    and a deletion."""
    import public_tokenizers

    from strata.llm.edit_counts import apply_edits, trees
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    kept = trees(spark, table(spark, sf_dir, "documents"), path, pattern)
    n = F.length(F.coalesce("text", F.lit(""))).cast("long")
    at = lambda seed, size: F.pmod(F.xxhash64("doc_id", F.lit(seed)), size + 1)
    edit = lambda start, stop, new: F.struct(start.alias("start"), stop.alias("stop"), F.lit(new).alias("new"))
    first = at(1, n)
    after = n - F.least(n - first, F.lit(5)) + 8
    third = at(3, after + 1)
    edits = F.array(edit(first, first + 5, " edited "), edit(at(2, after), at(2, after), "x"), edit(third, third + 20, ""))
    done = apply_edits(spark, kept.withColumn("edits", edits), path, pattern)
    return done.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "rescanned", F.length("text").cast("long").alias("n_chars"))


@query
def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.winnowing import contamination
    found = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.prefix_trie import rebuilt, trie
    return trie(spark, rebuilt(spark, table(spark, sf_dir, "conversations")))


@query
def op13_blockmax_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.blockmax import build, search
    return search(spark, build(spark, table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=10)

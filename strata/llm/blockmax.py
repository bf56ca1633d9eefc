"""Ranked lexical search: block-max MaxScore over shards.

Documents are indexed in shards of bounded size. A term's postings in a shard are stored in blocks of ``BLOCK``, each
with the largest count and the smallest document length in it, which bound every score of the block. A query takes
its lists by falling bound. As long as a document that is in none of the lists so far could still enter the ten best,
lists are essential and read whole; from then on only documents seen so far count. Such a document is held against the
bounds of the blocks it would be in, and only where it can still enter are blocks decompressed. The best of all shards
are merged. Scores are integers, so no bound is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, stored, utf8

#: Fixed values of the score: k1 = 0.8 and b = 0.75 in integers.
SCALE, FLAT, SLOPE = 1_000_000_000, 25, 75
#: Postings of a block; documents and tokens of a shard (a longer document is a shard by itself); terms of a query block.
BLOCK, SHARD_DOCS, SHARD_TOKENS, QUERY_TERMS = 128, 1 << 16, 1 << 22, 1 << 16
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_HEAD = np.dtype([("first", "<u2"), ("last", "<u2"), ("at", "<u4"), ("count", "<u4"), ("length", "<u4")])
_INDEX = "shard long, term string, df long, heads binary, data binary, ids array<long>, lens array<long>"


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order: runs of digits, letters (A-Z lowered) and characters beyond ASCII."""
    return text.translate(_FOLD).split()


class _Numbers(dict):
    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _encoded(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray]:
    """Blocks of postings sorted by term and document: where each list starts, its blocks, their bytes, and where the
    bytes of each block start. A block holds, one after another, the distances from its first document and the counts:
    a byte each where they fit, else two and four."""
    starts = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(term)])))
    place = np.arange(len(term)) - np.repeat(starts, sizes)
    firsts = np.flatnonzero(place % BLOCK == 0)
    counts = np.diff(np.concatenate((firsts, [len(term)])))
    heads = np.zeros(len(firsts), _HEAD)
    heads["first"], heads["last"] = doc[firsts], doc[firsts + counts - 1]
    heads["count"], heads["length"] = np.maximum.reduceat(tf, firsts), np.minimum.reduceat(length, firsts)
    wide = (heads["last"].astype(np.int64) - heads["first"] > 255) | (heads["count"] > 255)
    at = np.concatenate(([0], np.cumsum(counts * np.where(wide, 6, 2))))
    out = np.zeros(at[-1], np.uint8)
    of = np.repeat(np.arange(len(firsts)), counts)
    i, gap = np.arange(len(term)) - firsts[of], doc - doc[firsts[of]]
    for big, width, own in ((False, 1, 1), (True, 2, 4)):
        rows = np.flatnonzero(wide[of] == big)
        base, n = at[of[rows]], counts[of[rows]]
        for k in range(width):
            out[base + i[rows] * width + k] = gap[rows] >> (8 * k) & 255
        for k in range(own):
            out[base + n * width + i[rows] * own + k] = tf[rows] >> (8 * k) & 255
    blocks = np.searchsorted(firsts, np.concatenate((starts, [len(term)])))
    heads["at"] = at[:-1] - np.repeat(at[blocks[:-1]], np.diff(blocks))
    return sizes, blocks, heads, out, at


def _block(heads: np.ndarray, data: bytes, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and counts of block ``k`` of a list of ``n`` postings."""
    h = heads[k]
    size, at, end = min(BLOCK, n - k * BLOCK), int(h["at"]), int(heads[k + 1]["at"]) if k + 1 < len(heads) else len(data)
    width, own = ("u1", "u1") if end - at == 2 * size else ("<u2", "<u4")
    gap = np.frombuffer(data, width, size, at).astype(np.int64)
    return gap + int(h["first"]), np.frombuffer(data, own, size, at + size * np.dtype(width).itemsize).astype(np.int64)


def build(spark: SparkSession, docs: DataFrame, shard_tokens: int = SHARD_TOKENS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The stored index of ``docs(doc_id, text)``: a row for each shard and term, and for each shard a row without term
    that has the ids and lengths of its documents, and in ``heads`` which ids are null. Every row of ``docs`` is in one shard; null and empty texts are
    documents without terms. Other columns are not read."""
    if not 0 < shard_docs <= 1 << 16:
        raise ValueError("a shard has 1 to 65536 documents")
    bounded_batches(spark)

    def shard(number: int, ids: list, held: list[np.ndarray], counts: list[np.ndarray], lens: list[int], vocab: dict) -> Iterator[pa.RecordBatch]:
        names, none = ["shard", "term", "df", "heads", "data", "ids", "lens"], lambda n, k: pa.nulls(n, k)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([number]), none(1, pa.string()), none(1, pa.int64()), pa.array([bytes(x is None for x in ids)]),
                                          none(1, pa.binary()), pa.array([[x or 0 for x in ids]], longs), pa.array([lens], longs)], names)
        if not vocab:
            return
        term, tf = np.concatenate(held), np.concatenate(counts)
        doc = np.repeat(np.arange(len(held)), [len(x) for x in held])
        order = np.argsort(term, kind="stable")
        sizes, blocks, heads, data, at = _encoded(term[order], doc[order], tf[order], np.array(lens)[doc[order]])
        words, raw = pa.array(list(vocab), pa.binary()).cast(pa.string()), pa.py_buffer(data)
        every = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at[blocks].astype(np.int32)), raw])
        tops = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((blocks * _HEAD.itemsize).astype(np.int32)), pa.py_buffer(heads)])
        for s in range(0, len(sizes), 4096):
            n = min(4096, len(sizes) - s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), words.slice(s, n), pa.array(sizes[s:s + n].astype(np.int64)),
                                              tops.slice(s, n), every.slice(s, n), none(n, longs), none(n, longs)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, held, counts, lens, vocab, size = TaskContext.get().partitionId() << 32, [], [], [], [], _Numbers(), 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                own = terms(text)
                if ids and (len(ids) == shard_docs or size + len(own) > shard_tokens):
                    yield from shard(number, ids, held, counts, lens, vocab)
                    number, ids, held, counts, lens, vocab, size = number + 1, [], [], [], [], _Numbers(), 0
                found, n = np.unique(np.fromiter(map(vocab.__getitem__, own), np.int64, len(own)), return_counts=True)
                ids.append(doc_id), held.append(found), counts.append(n), lens.append(len(own))
                size += len(own)
        if ids:
            yield from shard(number, ids, held, counts, lens, vocab)

    return stored(spark, docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _INDEX), "index")


def best(own: list[tuple[int, int, np.ndarray, bytes, np.ndarray]], n_docs: int, impact, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a shard that may be among the ``k`` best, with their scores: all whose score reaches the ``k``-th
    largest. ``own`` holds (weight, postings, blocks, bytes, block bounds) of each list."""
    own = sorted(own, key=lambda x: -x[0] * int(x[4].max()))
    left = np.cumsum([0, *[x[0] * int(x[4].max()) for x in own[::-1]]])[::-1]  # what the lists from here on can add
    score, seen, least = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool), 1
    for i, (w, n, heads, data, _) in enumerate(own):
        if left[i] < least:
            break
        for b in range(len(heads)):
            doc, tf = _block(heads, data, n, b)
            score[doc] += w * impact(doc, tf)
            seen[doc] = True
        if seen.sum() >= k:
            least = max(1, int(np.partition(score[seen], -k)[-k]))
    else:
        i = len(own)
    doc = np.flatnonzero(seen)
    at, bound = [], score[doc]
    for w, _, heads, _, tops in own[i:]:  # without decompressing anything: the block each document would be in, and its bound
        b = np.searchsorted(heads["last"], doc)
        inside = b < len(heads)
        inside[inside] = heads["first"][b[inside]] <= doc[inside]
        at.append(np.where(inside, b, -1))
        bound = bound + np.where(inside, w * tops[np.minimum(b, len(heads) - 1)], 0)
    for j, (w, n, heads, data, tops) in enumerate(own[i:]):
        may = bound >= least
        doc, bound, at = doc[may], bound[may], [x[may] for x in at]
        for b in np.unique(at[j][at[j] >= 0]):
            have, tf = _block(heads, data, n, int(b))
            of = np.flatnonzero(at[j] == b)
            p = np.minimum(np.searchsorted(have, doc[of]), len(have) - 1)
            met = have[p] == doc[of]
            gain = np.zeros(len(of), np.int64)
            gain[met] = w * impact(doc[of[met]], tf[p[met]])
            score[doc[of]] += gain
            bound[of] += gain - w * tops[b]
        if len(doc) >= k:
            least = max(least, int(np.partition(score[doc], -k)[-k]))
    may = score[doc] >= least
    return doc[may], score[doc][may]


def search(spark: SparkSession, index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each distinct row of ``items(item_id, text)`` the ``k`` documents of
    the index with the highest scores above 0, equal scores by ascending ``doc_id`` (null last).

    Items without terms, or with none that a document holds, have no rows, as has an empty index. Repeated documents
    are documents of their own, repeated items are one. Other columns are not read. Items are taken in blocks of
    bounded size, each against every shard; a shard's task holds its documents' lengths and the lists of the block's terms."""
    bounded_batches(spark)
    shards = index.filter("term IS NULL").select("shard", "heads", "ids", "lens")
    n_docs, n_terms = shards.select(F.explode("lens").alias("n")).filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    word = F.filter(F.split(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                            r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    asked = own.select("item_id", F.xxhash64("item_id", "text").alias("item"), F.explode(word).alias("term"))
    asked = stored(spark, asked.groupBy("item_id", "item", "term").agg(F.count("*").alias("n")), "query-terms")
    blocks = max(1, -(-asked.count() // QUERY_TERMS))
    asked = asked.withColumn("block", F.pmod("item", F.lit(blocks)))
    lists = index.filter("term IS NOT NULL").join(asked.select("term").distinct(), "term")
    lists = stored(spark, lists.select("shard", "term", "df", "heads", "data"), "query-lists")
    df = lists.groupBy("term").agg(F.sum("df").alias("all_df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("all_df") + 1))).cast("long")
    weighed = stored(spark, asked.join(df, "term").select("block", "item_id", "item", "term", "n", weight.alias("w")).filter("w > 0"), "query-weights")

    rows = "block long, shard long, kind string, name string, item long, item_id long, n long, w long, heads binary, data binary, ids array<long>, lens array<long>"
    kinds = [x.split(" ")[:2] for x in rows.split(", ")]

    def shaped(df: DataFrame, kind: str, **have) -> DataFrame:
        return df.select(*[(F.lit(kind) if c == "kind" else have[c] if c in have else F.lit(None)).cast(t).alias(c) for c, t in kinds])

    c = F.col
    at = shards.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    queries = weighed.groupBy("block", "item", "item_id").agg(F.collect_list(F.struct("term", "n", "w")).alias("terms"))
    queries = queries.groupBy("block").agg(F.to_json(F.collect_list(F.struct(c("item").cast("string").alias("item"), "item_id", "terms"))).alias("queries"))
    wanted = weighed.select("block", "term").distinct().join(lists, "term")
    union = (shaped(at.join(queries, "block"), "shard", block=c("block"), shard=c("shard"), heads=c("heads"), ids=c("ids"), lens=c("lens"), name=c("queries"))
             .unionByName(shaped(wanted, "list", block=c("block"), shard=c("shard"), name=c("term"), n=c("df"), heads=c("heads"), data=c("data"))))

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        import json
        out: list[pd.DataFrame] = []
        of = group[group["kind"] == "shard"]
        ids, lens = (np.asarray(of[x].iloc[0], np.int64) for x in ("ids", "lens"))
        no_id = np.frombuffer(of["heads"].iloc[0], bool)
        m = FLAT + SLOPE * lens * n_docs // n_terms
        impact = lambda doc, tf: SCALE * tf // (1000 * tf + 8 * m[doc])
        have = {}
        for name, n, heads, data in group.loc[group["kind"] == "list", ["name", "n", "heads", "data"]].itertuples(index=False):
            h = np.frombuffer(heads, _HEAD)
            tf, length = h["count"].astype(np.int64), h["length"].astype(np.int64)
            have[name] = (int(n), h, data, SCALE * tf // (1000 * tf + 8 * (FLAT + SLOPE * length * n_docs // n_terms)))
        for q in json.loads(of["name"].iloc[0]):
            mine = [(t["n"] * t["w"], *have[t["term"]]) for t in q["terms"] if t["term"] in have]
            if not mine:
                continue
            doc, score = best(mine, len(lens), impact, k)
            # of equal scores more than k may be left: the smallest ids stay
            name = pd.arrays.IntegerArray(ids[doc], no_id[doc])
            top = (pd.DataFrame({"item": int(q["item"]), "item_id": pd.array([q.get("item_id")] * len(doc), "Int64"), "doc_id": name, "score": score})
                   .sort_values(["score", "doc_id"], ascending=[False, True], na_position="last", kind="stable").head(k))
            out.append(top)
        none = pd.DataFrame({"item": pd.array([], "int64"), "item_id": pd.array([], "Int64"), "doc_id": pd.array([], "Int64"), "score": pd.array([], "int64")})
        return pd.concat(out, ignore_index=True) if out else none

    found = union.groupBy("block", "shard").applyInPandas(answer, "item long, item_id long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(c("score").desc(), c("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(c("rank") <= k).select("item_id", "rank", "doc_id", "score")

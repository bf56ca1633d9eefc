"""Edit-aware token counts.

A document keeps a segment tree over its pre-tokens: leaves are small blocks of pre-token lengths and token counts,
inner nodes are sums. An edit scans again from the last pre-token that could not see it, until a new boundary falls on
an old one; only those pre-tokens are encoded, and the sums on their paths to the root are updated.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, strings
from strata.llm.tokens import ranks, units

#: Pre-tokens of a new block; a block that grows to four times as many is divided with the whole tree.
BLOCK = 64
#: A pre-token of the public pattern looks at most one character past its end; this leaves room.
CONTEXT = 4


class Counter:
    """Pre-tokens and their token counts, each distinct one encoded once while it is kept."""

    def __init__(self, file: bytes, pattern: str, keep: int = 1 << 18) -> None:
        self.pattern, self.keep = regex.compile(pattern), keep
        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks(file), special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}
        self.of_unit: dict[str, tuple[bytes, bytes]] = {}

    def count(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            if len(self.known) > self.keep:
                self.known.clear()
            n = self.known[word] = len(self.encode(word))
        return n

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Length and token count of each pre-token of a text."""
        lengths, counts, known = [], [], self.of_unit
        for u in units(text):
            got = known.get(u)
            if got is None:
                if len(known) > self.keep:
                    known.clear()
                own = self.pattern.findall(u)
                got = known[u] = (np.array([len(w) for w in own], "<u4").tobytes(), np.array([self.count(w) for w in own], "<u4").tobytes())
            lengths.append(got[0])
            counts.append(got[1])
        return np.frombuffer(b"".join(lengths), "<u4"), np.frombuffer(b"".join(counts), "<u4")


class CountTree:
    """Segment tree of a text's pre-tokens."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray) -> None:
        self._build(lengths.tolist(), counts.tolist())

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.blocks = [(lengths[i:i + BLOCK], counts[i:i + BLOCK]) for i in range(0, len(lengths), BLOCK)] or [([], [])]
        self.base = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i, (x, y) in enumerate(self.blocks):
            self.chars[self.base + i], self.tokens[self.base + i] = sum(x), sum(y)
        for k in range(self.base - 1, 0, -1):
            self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def total(self) -> int:
        """Tokens of the text: the root's sum."""
        return self.tokens[1]

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([v for b in self.blocks for v in b[k]], np.uint32) for k in (0, 1))

    def _find(self, at: int) -> tuple[int, int, int]:
        """Block, place in it and start of the pre-token that holds character ``at`` (or of the end)."""
        node, start = 1, 0
        while node < self.base:
            node *= 2
            if at - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        block, place = node - self.base, 0
        lengths = self.blocks[block][0] if block < len(self.blocks) else []
        while place < len(lengths) and start + lengths[place] <= at:
            start += lengths[place]
            place += 1
        return block, place, start

    def _update(self, block: int) -> None:
        k = self.base + block
        self.chars[k], self.tokens[k] = sum(self.blocks[block][0]), sum(self.blocks[block][1])
        while k > 1:
            k //= 2
            self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]

    def edit(self, counter: Counter, text: str, start: int, stop: int, new: str) -> tuple[str, int]:
        """The text with ``[start, stop)`` replaced, and how many characters were scanned again."""
        text = text[:start] + new + text[stop:]
        shift, until = len(new) - (stop - start), start + len(new)
        block, place, at = self._find(max(0, start - CONTEXT))
        first, from_, old = (block, place), at, at + shift  # ``old``: the next old boundary, in the new text
        lengths, counts = [], []
        here, spot = block, place
        for m in counter.pattern.finditer(text, at):
            while here < len(self.blocks) and old < m.start():
                if spot < len(self.blocks[here][0]):
                    old += self.blocks[here][0][spot]
                    spot += 1
                else:
                    here, spot = here + 1, 0
            if m.start() >= until and old == m.start() and m.start() > from_:
                break
            lengths.append(m.end() - m.start())
            counts.append(counter.count(m[0]))
            at = m.end()
        else:
            here, spot = len(self.blocks) - 1, len(self.blocks[-1][0])
        (b0, p0), (b1, p1) = first, (here, spot)
        if b1 >= len(self.blocks):
            b1, p1 = len(self.blocks) - 1, len(self.blocks[-1][0])
        for k, own in ((0, lengths), (1, counts)):
            head, tail = self.blocks[b0][k][:p0], self.blocks[b1][k][p1:]
            if b0 == b1:
                self.blocks[b0][k][:] = head + own + tail
            else:
                self.blocks[b0][k][:], self.blocks[b1][k][:] = head + own, tail
                for b in range(b0 + 1, b1):
                    self.blocks[b][k].clear()
        if len(self.blocks[b0][0]) > 4 * BLOCK:
            self._build(*(x.tolist() for x in self.leaves()))
        else:
            for b in range(b0, b1 + 1):
                self._update(b)
        return text, at - from_


def pack(lengths: np.ndarray, counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(len(lengths).to_bytes(8, "little") + lengths.astype("<u4").tobytes() + counts.astype("<u4").tobytes())


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(raw, "<u4", n, 8), np.frombuffer(raw, "<u4", n, 8 + 4 * n)


def trees(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``(doc_id, text, n_tokens, tree)`` for each row of ``docs(doc_id, text)``: the leaves of its tree, packed, and
    their sum. A null text has an empty tree and stays null; other columns are not read."""
    bounded_batches(spark)
    file = spark.sparkContext.broadcast(Path(rank_file).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(file.value, pattern)
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                own = [counter.leaves(t) for t in strings(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([int(c.sum()) for _, c in own], pa.int64()),
                                                  pa.array([pack(*x) for x in own], pa.binary())], ["doc_id", "text", "n_tokens", "tree"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, text string, n_tokens long, tree binary"))


def with_edits(kept: DataFrame, edits: DataFrame) -> DataFrame:
    """``kept`` (of :func:`trees`) with the array ``edits`` of ``(start, stop, new)`` from ``edits(doc_id, seq, start,
    stop, new)``, by ``seq`` and then place; rows without edits get an empty array."""
    own = (edits.groupBy(F.col("doc_id").alias("_e_id"))
           .agg(F.sort_array(F.collect_list(F.struct("seq", "start", "stop", "new"))).alias("_e"))
           .select("_e_id", F.transform("_e", lambda e: F.struct(e["start"].cast("long").alias("start"), e["stop"].cast("long").alias("stop"), e["new"].alias("new"))).alias("edits")))
    empty = F.array().cast("array<struct<start:bigint,stop:bigint,new:string>>")
    return kept.join(own, kept["doc_id"].eqNullSafe(own["_e_id"]), "left").drop("_e_id").withColumn("edits", F.coalesce("edits", empty))


def apply_edits(spark: SparkSession, kept: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``(doc_id, text, n_tokens, tree, n_tokens_before, n_edits, rescanned)`` for each row of ``kept(doc_id, text,
    n_tokens, tree, edits)``: the state after the edits, in their order, each by the text before it.

    Places are code points, clipped to the text; a stop before the start counts as the start; nulls in an edit are 0
    or an empty text; a null array has no edits. A null text is edited as an empty one if there are edits. The tree
    is not built anew from the text: only ``rescanned`` characters are cut and counted again."""
    file = spark.sparkContext.broadcast(Path(rank_file).read_bytes())
    names = ["doc_id", "text", "n_tokens", "tree", "n_tokens_before", "n_edits", "rescanned"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(file.value, pattern)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part, rows = b.slice(k, 512), []
                for doc_id, text, n, data, edits in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                    if not edits:
                        rows.append((doc_id, text, n, data, n, 0, 0))
                        continue
                    tree, text, seen = CountTree(*unpack(data)), text or "", 0
                    for e in edits:
                        start = min(max(e["start"] or 0, 0), len(text))
                        stop = min(max(e["stop"] or 0, start), len(text))
                        text, scanned = tree.edit(counter, text, start, stop, e["new"] or "")
                        seen += scanned
                    rows.append((doc_id, text, tree.total, pack(*tree.leaves()), n, len(edits), seen))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return kept.select("doc_id", "text", "n_tokens", "tree", "edits").mapInArrow(
        run, "doc_id long, text string, n_tokens long, tree binary, n_tokens_before long, n_edits long, rescanned long")

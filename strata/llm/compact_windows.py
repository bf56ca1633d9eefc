"""Substring de-duplication by compact windows.

The tokens of a document are the hashes of its five-word shingles. For each of ``HASHES`` random orders, a
Cartesian tree over the tokens yields compact windows ``(left, centre, right)``: all subsequences between
``left`` and ``right`` that hold the centre have the centre as their min-hash. Windows that could hold
a passage of ``words`` words are grouped by min-hash (with the few tokens around it, which keeps common
short phrases apart), each member is joined to the first of its group, pairs that meet under enough orders
are verified token by token, and passages of Jaccard similarity 0.8 or more remain. Members that this leaves without a
passage are sorted with the others of their group by the tokens about the centre and held against their neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WORD, bounded_batches, member_bits, parted, stored, text_hash, unused

SHINGLE, WORDS, SIMILARITY = 5, 50, 0.8
#: Random orders, and how many of them a pair of documents must meet under.
HASHES, ENOUGH = 5, 2
#: Tokens on either side of a centre that must agree.
AROUND = 2
#: Windows that are reduced to one member a key and task before the shuffle, and words hashed at a time.
_HELD, _WORDS = 1 << 19, 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _cells(column: pa.Array) -> list[bytes]:
    """The bytes of each cell of a string or binary column without nulls."""
    if not len(column):
        return []
    _, ends, data = column.cast(pa.binary()).buffers()
    at = np.frombuffer(ends, np.int32, len(column) + 1, 4 * column.offset).tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]


def _values(column: pa.Array) -> list:
    """The values of a column of numbers, null as None."""
    return column.to_pylist() if column.null_count else column.to_numpy(zero_copy_only=False).tolist()


def _binary(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """A binary column whose cells hold so many of the values each, in turn."""
    ends = np.concatenate(([0], np.cumsum(counts * values.itemsize))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the texts, A-Z lowered, text after text, and where the words of each text begin (with the
    end). Each distinct word is hashed once; null has no words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    words, at = split.flatten(), np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy(), dtype=np.int64)))
    full = pc.greater(pc.binary_length(words), 0)  # the split gives empty words at the ends of a text
    at = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)))[at]
    coded = words.filter(full).dictionary_encode()
    known = _cells(coded.dictionary)
    return np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))[coded.indices.to_numpy()], at


def tokens(texts: pa.Array) -> list[np.ndarray]:
    """The shingle hashes of each text; empty below ``SHINGLE`` words."""
    h, at = word_hashes(texts)
    flat = shingled(h)
    return [flat[s:max(s, e - SHINGLE + 1)] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def shingled(h: np.ndarray) -> np.ndarray:
    n = len(h) - SHINGLE + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            out = out * _ODD + h[i:i + n]
    return _mixed(out)


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each ``width`` consecutive values, by doubling."""
    k = 1
    while 2 * k <= width:
        x = pick(x[:len(x) - k], x[k:])
        k *= 2
    return x if k == width else pick(x[:len(x) - width + k], x[width - k:])


def _smaller(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the place before it with the nearest that is not greater, or ``lo - 1``, and the place after it with the nearest
    that is smaller, or ``hi``. All places advance at once along the pointers of those they point to."""
    n = len(values)
    left, right = np.arange(-1, n - 1), np.arange(1, n + 1)
    on = np.arange(n)
    while len(on):
        at = left[on]
        on = on[(at >= lo[on]) & (values[at] > values[on])]
        left[on] = left[left[on]]
    on = np.arange(n)
    while len(on):
        at = right[on]
        on = on[(at < hi[on]) & (values[np.minimum(at, n - 1)] >= values[on])]
        right[on] = right[right[on]]
    return left, right


def compact_windows(order: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """``(left, centre, right)`` of all compact windows of ``width`` tokens or more.

    ``order`` holds the tokens' values, document after document; ``first`` and ``last`` (exclusive) bound the
    document of each token. Only a token that is the least of some ``width`` tokens has such a window, and so
    have its ancestors in the Cartesian tree: the tree is built over those tokens alone."""
    n = len(order)
    if n < width:
        return (np.empty(0, np.int64),) * 3
    least = _sliding(order, width, np.minimum)
    least[np.flatnonzero(np.arange(width, n + 1) > last[:n - width + 1])] = 0
    spread = np.zeros(n + width - 1, np.uint64)
    spread[width - 1:n] = least
    centre = np.flatnonzero((_sliding(spread, width, np.maximum) == order) & (last - first >= width))
    if not len(centre):
        return (centre,) * 3
    begin, end = first[centre], last[centre]
    start = np.flatnonzero(np.concatenate(([True], begin[1:] != begin[:-1])))
    sizes = np.diff(np.append(start, len(centre)))
    lo = np.repeat(start, sizes)
    hi = lo + np.repeat(sizes, sizes)
    before, after = _smaller(order[centre], lo, hi)
    left = np.where(before >= lo, centre[before] + 1, begin)
    right = np.where(after < hi, centre[np.minimum(after, len(centre) - 1)], end) - 1
    wide = right - left + 1 >= width
    return left[wide], centre[wide], right[wide]


#: A place in a document: sixteen bits of the text hash, the order, the centre. It tells documents of one id apart.
_TAG, _ORDER = 40, 36


def _tag(text_hash_: str):
    return F.col(text_hash_).bitwiseAND(F.lit(0xFFFF))


def _by_key(key: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The order by ``key``, then ``then``: only keys that repeat are sorted by both."""
    at = np.argsort(key)
    own = key[at]
    same = own[1:] == own[:-1]
    shared = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    at[shared] = at[shared][np.lexsort((then[at[shared]], own[shared]))]
    return at


def windows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``(key, doc_id, place, reach, of_id, of_place)``: the windows of each key in the task's first document that has it;
    other members of the task are links to the first of them (``of_*``). ``reach`` is how far the window extends to the left (upper
    half) and to the right of its centre."""
    width = words - SHINGLE + 1
    names = ["key", "doc_id", "place", "reach", "of_id", "of_place"]

    def found(docs_tokens: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        sizes = np.array([len(t) for t in docs_tokens])
        ends = np.cumsum(sizes)
        doc, flat = np.repeat(np.arange(len(sizes)), sizes), np.concatenate(docs_tokens)
        first, last = (ends - sizes)[doc], ends[doc]
        parts = []
        for f in range(HASHES):
            left, centre, right = compact_windows(_mixed(flat, f + 1), first, last, width)
            key = np.full(len(centre), np.uint64(f + 1))
            with np.errstate(over="ignore"):
                for k in range(-AROUND, AROUND + 1):
                    at = centre + k
                    inside = (at >= first[centre]) & (at < last[centre])
                    key = key * _ODD + np.where(inside, flat[np.clip(at, 0, len(flat) - 1)], np.uint64(k + 100))
            place = (np.int64(f) << _ORDER) + centre - first[centre]
            parts.append((_mixed(key).view(np.int64), doc[centre], place, ((centre - left) << 32) + right - centre))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def reduced(ids: list, tags: list, held: list[tuple]) -> pa.RecordBatch:
        """The windows of one document of each key stay windows; the others become links to its first."""
        key, doc, place, reach = (np.concatenate(c) for c in zip(*held, strict=True))
        rank = np.empty(len(ids), np.int64)
        rank[sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, tags[i]))] = np.arange(len(ids))
        number: dict[tuple, int] = {}
        uid = np.array([number.setdefault(x, len(number)) for x in zip(ids, tags, strict=True)])
        place = place + (np.array(tags, np.int64)[doc] << _TAG)
        at = _by_key(key, (rank[doc] << _TAG) + (place & ((1 << _TAG) - 1)))
        key, doc, place, reach = (x[at] for x in (key, doc, place, reach))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        of = np.flatnonzero(new)[np.cumsum(new) - 1]
        same = ~new & (uid[doc[of]] == uid[doc])  # further windows of the first's document: an earlier task may hold the key
        new = new | same
        ids_ = pa.array(ids, pa.int64())
        cols = [pa.array(key), ids_.take(pa.array(doc)), pa.array(place), pa.array(reach), ids_.take(pa.array(doc[of])), pa.array(place[of], mask=new)]
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        ids, tags, own = [], [], []
        size = 0

        def flush() -> None:
            nonlocal own, size, n
            if own:
                start = len(ids) - len(own)
                key, doc, *rest = found(own)
                held.append((key, doc + start, *rest))
                n, own, size = n + len(key), [], 0

        for b in batches:
            for doc_id, tag, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), tokens(b.column(2)), strict=True):
                if len(t) < width:
                    continue
                ids.append(doc_id)
                tags.append(tag)
                own.append(t)
                size += len(t)
                if size >= _WORDS:
                    flush()
                    if n >= _HELD:
                        yield reduced(ids, tags, held)
                        held, ids, tags, n = [], [], [], 0
        flush()
        if n:
            yield reduced(ids, tags, held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("h"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", _tag("h").alias("tag"), "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def links(found: DataFrame) -> DataFrame:
    """Each window with the first of its key (by document, then place): sorted partitions are read as streams,
    so a key of any size takes constant memory, and a task sent the windows of one document of it per reduction. What
    is a link already is dealt by document and passed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = None  # key, id and place of the first window of the key
        for b in batches:
            done = b.filter(b.column(5).is_valid())
            if done.num_rows:
                yield done
            b = b.filter(b.column(5).is_null())
            if not b.num_rows:
                continue
            key, ids, place = b.column(0).to_numpy(), b.column(1), b.column(2).to_numpy()
            new = np.concatenate(([lead is None or key[0] != lead[0]], key[1:] != key[:-1]))
            of = np.cumsum(new)
            at = np.flatnonzero(new)
            l_id = pa.concat_arrays([pa.array([lead[1] if lead else None], pa.int64()), ids.take(pa.array(at))])
            l_place = np.concatenate((np.array([lead[2] if lead else 0], np.int64), place[at]))
            of_id, of_place = l_id.take(pa.array(of)), l_place[of]
            same_id = pc.or_kleene(pc.and_(of_id.is_null(), ids.is_null()), pc.fill_null(pc.equal(of_id, ids), False)).to_numpy(zero_copy_only=False)
            keep = ~new & ~(same_id & (of_place >> _TAG == place >> _TAG))
            last = int(of[-1])
            lead = (int(key[-1]), l_id[last].as_py(), int(l_place[last]))
            if keep.any():
                yield pa.RecordBatch.from_arrays([*b.columns[:4], of_id, pa.array(of_place)], b.schema.names).filter(pa.array(keep))

    deal = F.when(F.col("of_place").isNull(), F.col("key")).otherwise(F.xxhash64("doc_id", F.shiftright("place", _TAG)))
    return found.repartition(deal).sortWithinPartitions("key", "doc_id", "place").mapInArrow(run, found.schema)


def _new(column: pa.Array) -> np.ndarray:
    """Whether a value of a sorted column, null first, differs from the one before it."""
    full, own = column.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(column, 0).to_numpy()
    return np.concatenate(([True], (full[1:] != full[:-1]) | (own[1:] != own[:-1])))


def paired(found: DataFrame) -> DataFrame:
    """The links of each pair of documents in one row: under how many orders they meet, where (``seeds``), and the ranges of the
    windows in either document. Sorted partitions are read as streams; the seeds of one pair are held together."""
    def made(rows: pa.Table, start: np.ndarray) -> pa.RecordBatch:
        key, place, reach, of_place = (rows.column(k).to_numpy() for k in range(4, 8))
        centre, of_centre = (x & ((1 << _ORDER) - 1) for x in (place, of_place))
        orders = np.bitwise_count(np.bitwise_or.reduceat(1 << (place >> _ORDER & ((1 << _TAG - _ORDER) - 1)), start)).astype(np.int32)
        seeds = pa.StructArray.from_arrays([pa.array(x) for x in (key, centre, of_centre)], ["key", "centre", "of_centre"])
        ends = pa.array(np.append(start, len(key)).astype(np.int32))
        ranges = (np.minimum.reduceat(centre - (reach >> 32), start), np.maximum.reduceat(centre + (reach & ((1 << 32) - 1)), start),
                  np.minimum.reduceat(of_centre, start), np.maximum.reduceat(of_centre, start))
        own = [rows.column(k).combine_chunks().take(pa.array(start)) for k in range(4)]
        return pa.RecordBatch.from_arrays([*own, pa.array(orders), pa.ListArray.from_arrays(ends, seeds), *map(pa.array, ranges)],
                                          [*by, "orders", "seeds", "a_first", "a_last", "b_first", "b_last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the links of the pair that may go on
        for b in batches:
            if not b.num_rows:
                continue
            seen = pa.concat_batches([held[-1].slice(held[-1].num_rows - 1), b]) if held else b
            start = np.flatnonzero(np.logical_or.reduce([_new(c) for c in seen.columns[:4]])[len(seen) - len(b):])
            if held and not len(start):
                held.append(b)
                continue
            last = int(start[-1])
            before = sum(h.num_rows for h in held)
            if before or last:
                start = np.concatenate(([0] if before else [], start[:-1] + before)).astype(np.int64)
                yield made(pa.Table.from_batches([*held, b.slice(0, last)]).combine_chunks(), start)
            held = [b.slice(last)]
        if held:
            yield made(pa.Table.from_batches(held).combine_chunks(), np.array([0]))

    by = ["doc_id", "tag", "of_id", "of_tag"]
    rows = found.select("doc_id", F.shiftright("place", _TAG).alias("tag"), "of_id", F.shiftright("of_place", _TAG).alias("of_tag"), "key", "place", "reach", "of_place")
    return (rows.repartition(*by).sortWithinPartitions(*by)
            .mapInArrow(run, ", ".join(f"{c} long" for c in by) + ", orders int, seeds array<struct<key: long, centre: long, of_centre: long>>, "
                        "a_first long, a_last long, b_first long, b_last long"))


def _ahead(a: np.ndarray, b: np.ndarray, i: int, j: int) -> int:
    """How many tokens agree from ``a[i] == b[j]`` on."""
    n = min(len(a) - i, len(b) - j)
    differ = a[i:i + n] != b[j:j + n]
    at = int(differ.argmax())
    return at if differ[at] else n


def _shared(a: np.ndarray, b: np.ndarray, most: int, after: int) -> Iterable[tuple[int, int]]:
    """The first places of each token that ``a`` and ``b`` share, ``most`` together and one of them ``after`` or more, the shortest gap
    first; what continues a run of such places is left out."""
    if len(a) + len(b) <= 1 << 9:  # too short for the array functions to pay
        x, y = a.tolist(), b.tolist()
        if set(x).isdisjoint(y):
            return ()
        places = dict(zip(reversed(y), range(len(y) - 1, -1, -1), strict=True))
        found, before = [], -2
        for s, token in enumerate(x):
            t = places.pop(token, -2)  # a later place of the token finds none
            if t >= 0 and before != t - 1 and s + t <= most and max(s, t) >= after:
                found.append((max(s, t), s + t, token, s, t))
            before = t
        return [f[3:] for f in sorted(found)]
    _, s, t = np.intersect1d(a, b, return_indices=True)
    of = np.full(len(a) + 1, -2)
    of[s] = t
    new = (of[s - 1] != t - 1) & (s + t <= most) & (np.maximum(s, t) >= after)  # of[-1] is no place
    s, t = s[new], t[new]
    at = np.lexsort((a[s], s + t, np.maximum(s, t)))
    return zip(s[at].tolist(), t[at].tolist(), strict=True)


def _meetings(a: np.ndarray, b: np.ndarray, most: int, near: int = 16) -> Iterator[tuple[int, int]]:
    """Where the tokens of ``a`` and ``b`` may meet again after gaps of ``most`` tokens together, the shortest gap first."""
    yield from _shared(a[:near], b[:near], most, 0)
    if max(len(a), len(b)) > near:
        yield from _shared(a, b, most, near)


def aligned(a: np.ndarray, b: np.ndarray, seeds: list[tuple[int, int]], width: int,
            similarity: float = SIMILARITY) -> list[tuple[int, int, int, int, float]]:
    """Near-equal passages ``(a_start, a_end, b_start, b_end, jaccard)`` in tokens, ends exclusive. From each seed
    the agreeing run grows over edits on both sides while the similarity holds, however long an edit is; the token
    sets decide."""
    out: list[tuple[int, int, int, int, float]] = []
    spent: dict[int, int] = {}  # how far the runs of each diagonal have been tried: seeds come in order, and those of a run are one
    spare = 1 / similarity - 1  # tokens in gaps, on both sides together, for each token that agrees

    def over(x: np.ndarray, y: np.ndarray, equal: int, gaps: int) -> tuple[int, int, int] | None:
        """Over the gap at the start of ``x`` and ``y``: the tokens passed on either side, and how many of them agree."""
        n = min(len(x), len(y))
        most = int(spare * (equal + n)) - gaps
        if n == 0 or most < 1:
            return None
        tried: dict[int, int] = {}  # how far each diagonal agrees from the places tried
        for s, t in _meetings(x[:most + 1], y[:most + 1], most):
            if s >= tried.get(s - t, 0):
                n = _ahead(x, y, s, t)
                tried[s - t] = s + n
                if s + t + gaps <= spare * (equal + n):
                    return s + n, t + n, n
        return None

    for i, j in sorted(seeds):
        if i < spent.get(i - j, 0) or i >= len(a) or j >= len(b) or a[i] != b[j]:
            continue
        if out and any(s <= i < e and s2 <= j < e2 for s, e, s2, e2, _ in out):
            continue
        back, ahead = _ahead(a[:i + 1][::-1], b[:j + 1][::-1], 0, 0) - 1, _ahead(a, b, i, j)
        spent[i - j] = i + ahead
        a0, a1, b0, b1 = i - back, i + ahead, j - back, j + ahead
        core, equal = (a0, a1, b0, b1), back + ahead
        while True:
            gaps = a1 - a0 + b1 - b0 - 2 * equal
            if grown := over(a[a1:], b[b1:], equal, gaps):
                a1, b1 = a1 + grown[0], b1 + grown[1]
            elif grown := over(a[:a0][::-1], b[:b0][::-1], equal, gaps):
                a0, b0 = a0 - grown[0], b0 - grown[1]
            else:
                break
            equal += grown[2]
        for s, e, s2, e2 in dict.fromkeys(((a0, a1, b0, b1), core)):
            if min(e - s, e2 - s2) < width:
                continue
            if (s, e, s2, e2) == core:  # equal token by token
                both = of = 1
            else:
                x, y = set(a[s:e].tolist()), set(b[s2:e2].tolist())
                both, of = len(x & y), len(x | y)
            if both >= similarity * of:
                out.append((s, e, s2, e2, both / of))
                break
    return out


def repeats(spark: SparkSession, docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Passages of at least ``words`` words of ``docs(doc_id, text)`` that near-repeat one of an earlier document:
    ``(doc_id, text_hash, start_word, end_word, of_doc_id, of_text_hash, of_start_word, of_end_word, similarity)``,
    ends exclusive, words as cut by white space.

    Earlier is by ``doc_id`` (null first), then text hash. Each passage is paired with a representative of its
    group, not with all members: with the first member of a key or, where that is no near repeat or was met under too few
    orders, with an earlier member that agrees longest to the left or right of a shared token. Repeats inside one document are not reported; rows equal in id and text are one
    document. Null, empty and shorter texts hold no passage; an empty table gives no rows; other columns are not
    read."""
    bounded_batches(spark)
    width = words - SHINGLE + 1
    met = paired(links(windows(docs, words)))
    pairs = stored(spark, met.withColumn("pair", F.xxhash64("doc_id", "tag", "of_id", "of_tag")), "window-pairs")
    near = stored(spark, verified(spark, docs, pairs.filter(F.col("orders") >= ENOUGH), width, similarity), "first-repeats")
    more = stored(spark, second_tries(spark, docs, pairs, near, width, similarity), "second-pairs")
    return near.unionByName(verified(spark, docs, more, width, similarity))


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("d"), text_hash().alias("h"), F.col("text").cast("string").alias("text")).withColumn("t", _tag("h"))


#: Tokens on either side of a centre that a second try compares, in widths.
_CONTEXT = 1.5
#: Tokens on one side of the centre, itself included, that two members must agree on to be compared.
_SIDE = 10


def rooted(context: np.ndarray, at: int) -> list[tuple[bytes, bytes]]:
    """The two ways to read a context from its centre ``at`` on: to the right and to the left, each followed by what is on the other side."""
    return [(context[at:].tobytes(), context[:at][::-1].tobytes()), (context[:at + 1][::-1].tobytes(), context[at + 1:].tobytes())]


def contexts(flat: np.ndarray, centre: np.ndarray, first: np.ndarray, last: np.ndarray, reach: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """:func:`rooted` for many centres of ``flat`` at a time, ``reach`` tokens to either side within ``first`` and ``last`` (exclusive):
    what is ahead, what is behind, and a hash of the ``_SIDE`` tokens ahead."""
    def read(start: np.ndarray, step: int, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.arange(reach + 1)
        return flat[np.clip(start[:, None] + step * k, 0, len(flat) - 1)], k < count[:, None]

    before, after = np.minimum(reach, centre - first), np.minimum(reach, last - centre - 1)
    for step, n, m in ((1, after, before), (-1, before, after)):
        ahead, inside = read(centre, step, n + 1)
        behind, inside_ = read(centre - step, -step, m)
        own = np.full(len(centre), np.uint64(2 + step))
        with np.errstate(over="ignore"):
            for k in range(min(_SIDE, reach + 1)):
                own = own * _ODD + np.where(inside[:, k], ahead[:, k], np.uint64(1 << 40))
        yield _binary(n + 1, ahead[inside]), _binary(m, behind[inside_]), _mixed(own)


class _Member:
    """A window in its sorted stream."""

    def __init__(self, order: tuple, what: tuple, ahead: bytes, behind: bytes):
        self.order, self.what, self.ahead, self.behind = order, what, ahead, behind
        self.own: np.ndarray | None = None
        self.each: list[int] = []
        self.held: frozenset = frozenset()

    def read(self) -> None:
        if self.own is None:
            ahead, behind = np.frombuffer(self.ahead, np.uint32), np.frombuffer(self.behind, np.uint32)
            self.own = np.concatenate((behind[::-1], ahead))
            self.each = self.own.tolist()
            self.held = frozenset(self.each)

    def near(self, other: _Member, width: int, similarity: float) -> bool:
        """Whether a near-equal passage of both holds the centres. Such passages share the tokens that the similarity asks for, so
        members with fewer in common (a frequent line among different texts) are told apart by their token sets."""
        self.read()
        other.read()
        if sum(map(other.held.__contains__, self.each)) < 2 * width * similarity / (1 + similarity) - 1e-9:
            return False
        return bool(aligned(self.own, other.own, [(len(self.behind) // 4, len(other.behind) // 4)], width, similarity))


def tried(members: Iterator[tuple], width: int, similarity: float) -> Iterator[tuple]:
    """``(what, what of an earlier document)`` for members ``(group, order, what, failed, ahead, behind)`` that come sorted by group,
    then by the tokens read from the centre, then by document order.

    In such a stream the neighbours of a member are those that agree with it longest. The Cartesian tree of the documents' order over
    the stream, kept as its right spine, gives the nearest member of an earlier document before and after each; a failed member
    is held against these two. Members that equal one of an earlier document add nothing to the spine, so copies take no room."""
    spine: list[tuple[_Member, list[_Member]]] = []  # per document: its latest member, and those that wait for a partner
    group = None
    for own_group, order, what, failed, ahead, behind in members:
        if own_group != group:
            group, spine = own_group, []
        m = _Member(order, what, ahead, behind)
        while spine and spine[-1][0].order > order:
            for w in spine.pop()[1]:
                if w.near(m, width, similarity):
                    yield w.what, what
        waits: list[_Member] = []
        if spine and spine[-1][0].order == order:
            waits = spine.pop()[1]
        if failed:
            if spine and m.near(spine[-1][0], width, similarity):
                yield what, spine[-1][0].what
            else:
                waits.append(m)
        if waits or not spine or (spine[-1][0].ahead, spine[-1][0].behind) != (ahead, behind):
            spine.append((m, waits))


def judge(reach: int, keys: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``(doc_id, tag, of_id, of_tag, seeds, spans)`` a row a seed: whether none of the document's ``spans`` covers it (``failed``), and
    whether it equals its first member in all that is compared, ``reach`` tokens to either side (``equal``): then it is no
    other partner. With ``keys`` the keys of the failed seeds alone."""
    more = SHINGLE - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, spans = b.column(4), b.column(5)
            row = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
            key, centre, of_centre = (own.flatten().field(k) for k in range(3))
            at = centre.to_numpy()
            counts = pc.fill_null(spans.value_lengths(), 0).to_numpy()
            begin, counts = (np.cumsum(counts) - counts)[row], counts[row]
            start, end, similarity = (spans.flatten().field(k).to_numpy() for k in range(3))
            failed, equal = np.ones(len(at), bool), np.zeros(len(at), bool)
            on, k = np.flatnonzero(counts), 0
            while len(on):  # the seeds of documents with more than k passages, each against its document's next
                c, i = at[on], begin[on] + k
                failed[on] &= (start[i] > c) | (c >= end[i] - more)
                equal[on] |= (similarity[i] == 1) & (start[i] <= np.maximum(0, c - reach)) & (c + reach < end[i] - more)
                k += 1
                on = on[counts[on] > k]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(key.to_numpy()[failed]))], ["bad"])
                continue
            some = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(some) for k in range(4)), key, centre, of_centre, pa.array(failed), pa.array(equal)],
                                             ["doc_id", "tag", "of_id", "of_tag", "key", "centre", "of_centre", "failed", "equal"])

    return run


def second_tries(spark: SparkSession, docs: DataFrame, pairs: DataFrame, near: DataFrame, width: int, similarity: float) -> DataFrame:
    """Pairs for the windows that no passage of ``near`` covers, though their key has an earlier member: these and the
    key's other members are sorted by the tokens to the right and, apart, to the left of their centres, and :func:`tried` finds partners
    in the streams. A passage of the width and similarity has a run of some twenty tokens unchanged, so that a centre in it
    agrees on ``_SIDE`` tokens on one side; members are dealt to tasks by these."""
    reach = int(_CONTEXT * width)
    spans = (near.groupBy("doc_id", _tag("text_hash").alias("tag")).agg(F.collect_list(F.struct("start_word", "end_word", "similarity")).alias("spans"))
             .toDF("s_id", "s_tag", "spans"))
    held = (pairs.join(spans, pairs["doc_id"].eqNullSafe(spans["s_id"]) & (pairs["tag"] == spans["s_tag"]), "left")
            .select("doc_id", "tag", "of_id", "of_tag", "seeds", "spans"))
    bad = stored(spark, held.mapInArrow(judge(reach, keys=True), "bad long").distinct(), "tried-keys")
    each = held.mapInArrow(judge(reach), "doc_id long, tag long, of_id long, of_tag long, key long, centre long, of_centre long, failed boolean, equal boolean")
    each, _ = parted(each, F.col("key"), member_bits(spark, bad.select(F.col("bad").alias("ref"))))
    each = each.join(bad, each["key"] == bad["bad"], "left_semi")
    both = F.explode(F.array(*[F.struct(i.alias("doc_id"), t.alias("tag"), F.col("key"), c.alias("centre"), f.alias("failed"), e.alias("equal")) for i, t, c, f, e in (
        (F.col("doc_id"), F.col("tag"), F.col("centre"), F.col("failed"), F.col("equal")),
        (F.col("of_id"), F.col("of_tag"), F.col("of_centre"), F.lit(False), F.lit(False)))]))
    refs = each.select(both.alias("r")).select("r.*").filter("failed or not equal").groupBy("doc_id", "tag", "key", "centre").agg(F.max("failed").alias("failed"))
    refs = stored(spark, refs.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "centre", "failed")).alias("refs")), "tried-refs")
    one, _ = parted(_documents(docs), F.xxhash64("d", "t"), member_bits(spark, refs.select(F.xxhash64("doc_id", "tag").alias("ref"))))
    asked = (refs.join(one, one["d"].eqNullSafe(refs["doc_id"]) & (one["t"] == refs["tag"]))
             .select("d", "h", "text", F.col("refs.key"), F.col("refs.centre"), F.col("refs.failed")))
    names = ["deal", "d", "h", "centre", "failed", "ahead", "behind"]

    def batch(rows: list, names: list, kinds: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = tokens(b.column(2))
            ends = np.cumsum([len(t) for t in own])
            flat = np.concatenate(own).astype(np.uint32)
            of = np.repeat(np.arange(len(own)), b.column(3).value_lengths().to_numpy())
            first, last = np.concatenate(([0], ends[:-1]))[of], ends[of]
            key, centre, failed = (b.column(k).flatten() for k in range(3, 6))
            inside = np.flatnonzero(first + centre.to_numpy() < last)  # another text of the same id and tag may be shorter
            for k in range(0, len(inside), 1 << 13):
                at = inside[k:k + (1 << 13)]
                some, doc = pa.array(at), pa.array(of[at])
                for ahead, behind, deal in contexts(flat, first[at] + centre.to_numpy()[at], first[at], last[at], reach):
                    with np.errstate(over="ignore"):
                        deal = _mixed(deal + key.to_numpy()[at].view(np.uint64)).view(np.int64)
                    cols = [pa.array(deal), b.column(0).take(doc), b.column(1).take(doc), centre.take(some), failed.take(some), ahead, behind]
                    yield pa.RecordBatch.from_arrays(cols, names)

    out = ["doc_id", "h", "centre", "of_id", "of_h", "of_centre"]

    def matched(b: pa.RecordBatch) -> pa.RecordBatch:
        """Without the groups that lie in this batch and have no failed member or no other one."""
        deal, failed = b.column(0).to_numpy(), b.column(4).to_numpy(zero_copy_only=False)
        if not len(deal):
            return b
        start = np.flatnonzero(np.concatenate(([True], deal[1:] != deal[:-1])))
        sizes = np.diff(np.append(start, len(deal)))
        keep = np.logical_or.reduceat(failed, start) & (sizes > 1)
        keep[[0, -1]] = True  # these may go on in another batch
        return b.filter(pa.array(np.repeat(keep, sizes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[tuple]:
            for b in map(matched, batches):
                for deal, d, h, centre, failed, ahead, behind in zip(*map(_values, b.columns[:5]), *map(_cells, b.columns[5:]), strict=True):
                    yield deal, (d is not None, d or 0, h & 0xFFFF, h), (d, h, centre), failed, ahead, behind

        rows = []
        for one, of in tried(members(), width, similarity):
            rows.append(one + of)
            if len(rows) >= 1 << 14:
                yield batch(rows, out, [pa.int64()] * 6)
                rows = []
        if rows:
            yield batch(rows, out, [pa.int64()] * 6)

    members_ = asked.mapInArrow(cut, "deal long, d long, h long, centre long, failed boolean, ahead binary, behind binary")
    found = (members_.repartition("deal").sortWithinPartitions("deal", "ahead", "behind", "d", _tag("h"), "h", "centre")
             .mapInArrow(run, ", ".join(f"{c} long" for c in out)))
    # few pairs, and passages of any length: the whole documents are asked for
    whole = F.lit(1 << 40)
    return (found.groupBy("doc_id", _tag("h").alias("tag"), "of_id", _tag("of_h").alias("of_tag"))
            .agg(F.collect_list(F.struct("centre", "of_centre")).alias("seeds"))
            .withColumns({"pair": F.xxhash64("doc_id", "tag", "of_id", "of_tag"), "a_first": F.lit(0), "a_last": whole, "b_first": F.lit(0), "b_last": whole}))


#: Rows that the pairs of one document are dealt to.
_ROWS = 8


def verified(spark: SparkSession, docs: DataFrame, pairs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The passages of ``pairs``, as :func:`repeats` gives them."""
    # each document hands every pair it is in the tokens that may matter; documents in no pair are not shuffled
    n = F.col("a_last") - F.col("a_first") + 1
    part = lambda side, lo, hi: F.struct("pair", F.lit(side).alias("side"), lo.alias("lo"), hi.alias("hi")).alias("ask")
    ask = (pairs.select("doc_id", "tag", part(0, F.greatest(F.lit(0), F.col("a_first") - width), F.col("a_last") + width))
           .unionByName(pairs.select(F.col("of_id").alias("doc_id"), F.col("of_tag").alias("tag"),
                                     part(1, F.greatest(F.lit(0), F.col("b_first") - n), F.col("b_last") + n))))
    bits = member_bits(spark, ask.select(F.xxhash64("doc_id", "tag").alias("ref")))
    one, _ = parted(_documents(docs), F.xxhash64("d", "t"), bits)
    # a text meets the asks of its document in a few rows, however many pairs it is in
    ask = ask.groupBy("doc_id", "tag", F.pmod("ask.pair", F.lit(_ROWS)).alias("row")).agg(F.collect_list("ask").alias("asks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, asks = tokens(b.column(1)), b.column(2).flatten()
            of = np.repeat(np.arange(len(own)), b.column(2).value_lengths().to_numpy())
            pair, side, lo, hi = (asks.field(k) for k in range(4))
            n = np.array([len(t) for t in own])[of]
            lo, hi = np.minimum(lo.to_numpy(), n), np.minimum(hi.to_numpy() + 1, n)
            part = np.cumsum(hi - lo) >> 20
            for at in np.split(np.arange(len(of)), np.flatnonzero(part[1:] != part[:-1]) + 1):
                cut_ = [own[d][s:e] for d, s, e in zip(of[at].tolist(), lo[at].tolist(), hi[at].tolist(), strict=True)]
                some = pa.array(at)
                cols = [pair.take(some), side.take(some), b.column(0).take(pa.array(of[at])), pa.array(lo[at]), _binary((hi - lo)[at], np.concatenate(cut_))]
                yield pa.RecordBatch.from_arrays(cols, ["pair", "side", "h", "lo", "tokens"])

    asked = ask.join(one, one["d"].eqNullSafe(ask["doc_id"]) & (one["t"] == ask["tag"])).select("h", "text", "asks")
    slices = asked.mapInArrow(cut, "pair long, side int, h long, lo long, tokens binary")
    seeds = F.transform("seeds", lambda x: F.struct(x["centre"].alias("centre"), x["of_centre"].alias("of_centre"))).alias("seeds")
    # a pair and its slices, dealt once, are read as a stream: first the pair, then either side
    stream = slices.unionByName(pairs.select("pair", F.lit(-1).alias("side"), "doc_id", "of_id", seeds), allowMissingColumns=True)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, group, sides = [], None, ([], [])

        def judged() -> Iterator[tuple]:
            more = SHINGLE - 1
            for (doc_id, of_id, own), (h, lo, x), (of_h, of_lo, y) in product(of, *sides):
                for s, e, s2, e2, j in aligned(x, y, [(i - lo, k - of_lo) for i, k in own], width, similarity):
                    yield doc_id, h, s + lo, e + lo + more, of_id, of_h, s2 + of_lo, e2 + of_lo + more, j

        def made(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64()] * 8 + [pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], out)

        for b in batches:
            rows = []
            b = dict(zip(b.schema.names, b.columns, strict=True))
            cells = _cells(pc.fill_null(b["tokens"], b""))
            starts = np.concatenate(([0], np.cumsum(pc.fill_null(b["seeds"].value_lengths(), 0).to_numpy()))).tolist()
            centre, of_centre = (b["seeds"].flatten().field(k).to_numpy().tolist() for k in range(2))
            for k, (pair, side, h, lo, doc_id, of_id) in enumerate(zip(*(b[c].to_pylist() for c in ("pair", "side", "h", "lo", "doc_id", "of_id")), strict=True)):
                if pair != group:
                    rows += judged()
                    of, group, sides = [], pair, ([], [])
                if side < 0:
                    of.append((doc_id, of_id, list(zip(centre[starts[k]:starts[k + 1]], of_centre[starts[k]:starts[k + 1]], strict=True))))
                elif not sides[side] or sides[side][-1][0] != h:  # a row may come twice
                    sides[side].append((h, lo, np.frombuffer(cells[k], np.uint64)))
            if rows:
                yield made(rows)
        if rows := list(judged()):
            yield made(rows)

    out = ["doc_id", "text_hash", "start_word", "end_word", "of_doc_id", "of_text_hash", "of_start_word", "of_end_word", "similarity"]
    return (stream.repartition("pair").sortWithinPartitions("pair", "side", "h")
            .mapInArrow(verify, ", ".join(f"{c} long" for c in out[:-1]) + ", similarity double"))


def cut_repeats(spark: SparkSession, docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the passages that :func:`repeats` finds: the earliest copy stays. Words that remain keep
    the white space before them; rows and columns stay, but ``n_chars``, where there is one, counts the new
    text of changed rows."""
    own, cut = unused(docs, "_r_spans"), unused(docs, "_r_pieces")
    spans = (repeats(spark, docs, words, similarity).groupBy("doc_id", "text_hash")
             .agg(F.array_sort(F.collect_set(F.struct("start_word", "end_word"))).alias(own))
             .select(F.col("doc_id").alias("_r_id"), F.col("text_hash").alias("_r_hash"), own))
    spans = stored(spark, spans, "repeat-spans")
    bits = member_bits(spark, spans.select(F.xxhash64("_r_id", "_r_hash").alias("ref")))
    may, rest = parted(docs, F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))), bits)
    out = may.join(spans, may["doc_id"].cast("long").eqNullSafe(spans["_r_id"])
                   & (F.xxhash64(may["text"].cast("string")) == spans["_r_hash"]), "left").select(*[may[f"`{c}`"] for c in docs.columns], spans[own])
    # words with the white space before them, and what follows the last word
    pieces = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    tail = F.regexp_extract("text", r"[\x20\x09-\x0D]*\z", 0)
    at = F.aggregate(own, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("kept")),
                     lambda a, s: F.struct(F.greatest(a["at"], s["end_word"]).alias("at"), F.when(
                         s["start_word"] > a["at"], F.concat(a["kept"], F.slice(F.col(cut), (a["at"] + 1).cast("int"), (
                             s["start_word"] - a["at"]).cast("int")))).otherwise(a["kept"]).alias("kept")),
                     lambda a: F.concat_ws("", F.concat(a["kept"], F.slice(F.col(cut), (a["at"] + 1).cast("int"), F.size(cut)))))
    out = out.withColumn(cut, F.when(F.col(own).isNotNull(), pieces))
    out = out.withColumn("text", F.when(F.col(own).isNull(), F.col("text")).otherwise(F.concat(at, tail)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(own).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return out.select(*[f"`{c}`" for c in docs.columns]).unionByName(rest)

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import blockmax as B


def own_terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
            for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=10):
    """Every score by the stated formula, all documents ranked."""
    counted = [(i, Counter(own_terms(t))) for i, t in docs]
    lens = [sum(c.values()) for _, c in counted]
    big_n, big_l = sum(n > 0 for n in lens), sum(lens)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (i, c), n in zip(counted, lens, strict=True):
            s = 0
            for t in own_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    s += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * big_n // big_l)))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, **size):
    df = spark.createDataFrame([(t, i, 1, "x") for i, t in docs], "text string, doc_id long, n int, term string")
    of = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, shard int")
    return sorted(map(tuple, B.search(spark, B.build(spark, df, **size), of).collect()), key=repr)


def made(rng, n, words):
    return [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=rng.choice([1, 5, 30])))) for i in range(n)]


def test_every_case_against_brute_force(spark):
    rng = random.Random(3)
    words = ["The", "of", "élan", "漢字", "x1", *(f"w{i}" for i in range(60))]
    docs = made(rng, 700, words)
    docs += [(None, "w50 w51"), (None, "w50"), (2**60 + 1, "w50 w50"), (2**60 + 1, "w50 w50"), (3, "rare, rare"), (4, None), (5, ""), (6, "?!"),
             (7, "The " * 3000), (8, "w3 " * 300 + "w59")]
    items = [(1, "the OF élan w7 w50"), (2, "rare"), (3, "nowhere at all"), (4, None), (5, ""), (6, " ".join(words)), (None, "w50 w50 x1"),
             (2, "rare"), (2, "w9")]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, shard_docs=37) == want
    assert run(spark, docs, items, shard_tokens=50) == want


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same text") for i in random.Random(1).sample(range(500), 500)] + [(900 + i, "other") for i in range(600)]
    got = run(spark, docs, [(1, "same")], shard_docs=64)
    assert [r[2] for r in got if r] and sorted(r[2] for r in got) == list(range(10))
    assert got == brute(docs, [(1, "same")])


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert len(run(spark, docs, items)) == 1
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame(items, "item_id long, text string")
    assert B.search(spark, B.build(spark, none), some).collect() == []
    assert B.search(spark, B.build(spark, none.unionByName(spark.createDataFrame([(1, None)], "doc_id long, text string"))), some).collect() == []
    assert B.search(spark, B.build(spark, spark.createDataFrame(docs, "doc_id long, text string")), some.limit(0)).collect() == []
    with pytest.raises(ValueError):
        B.build(spark, none, shard_docs=1 << 17)


@pytest.mark.parametrize("size", [1, 3, 128])
def test_blocks_give_back_their_postings(monkeypatch, size):
    monkeypatch.setattr(B, "BLOCK", size)
    rng = np.random.default_rng(size)
    term = np.sort(rng.integers(0, 40, 900))
    doc = np.concatenate([np.sort(rng.choice(65536 if t % 2 else 300, (term == t).sum(), replace=False)) for t in np.unique(term)])
    tf, length = rng.choice([1, 2, 300, 70000], 900, p=[.6, .3, .05, .05]), rng.integers(1, 9, 900)
    sizes, blocks, heads, data, at = B._encoded(term, doc, tf, length)
    for i, t in enumerate(np.unique(term)):
        own, raw = heads[blocks[i]:blocks[i + 1]], bytes(data[at[blocks[i]]:at[blocks[i + 1]]])
        got = [B._block(own, raw, int(sizes[i]), k) for k in range(len(own))]
        assert np.concatenate([g[0] for g in got]).tolist() == doc[term == t].tolist()
        assert np.concatenate([g[1] for g in got]).tolist() == tf[term == t].tolist()
        for h, (d, n) in zip(own, got, strict=True):
            assert (h["first"], h["last"], h["count"]) == (d[0], d[-1], n.max())


def test_blocks_that_cannot_matter_stay_compressed(monkeypatch):
    """With rare and common terms, most blocks of the common lists are never read, and the result is that of all."""
    monkeypatch.setattr(B, "BLOCK", 8)
    rng = np.random.default_rng(5)
    n_docs, lists = 4000, []
    length = rng.integers(1, 60, n_docs)
    term = np.concatenate([np.full(n, t) for t, n in enumerate((12, 40, 2500, 3800))])
    doc = np.concatenate([np.sort(rng.choice(n_docs, n, replace=False)) for n in (12, 40, 2500, 3800)])
    tf = rng.integers(1, 4, len(doc))
    sizes, blocks, heads, data, at = B._encoded(term, doc, tf, length[doc])
    impact = lambda d, n: 10**9 * n // (1000 * n + 8 * (25 + length[d]))
    score = np.zeros(n_docs, np.int64)
    for t, w in enumerate((9000, 6000, 300, 40)):
        h = heads[blocks[t]:blocks[t + 1]]
        tops = 10**9 * h["count"].astype(np.int64) // (1000 * h["count"].astype(np.int64) + 8 * (25 + h["length"].astype(np.int64)))
        lists.append((w, int(sizes[t]), h, bytes(data[at[blocks[t]]:at[blocks[t + 1]]]), tops))
        np.add.at(score, doc[term == t], w * impact(doc[term == t], tf[term == t]))
    read, block = [0], B._block
    monkeypatch.setattr(B, "_block", lambda *a: (read.__setitem__(0, read[0] + 1), block(*a))[1])
    got, s = B.best(lists, n_docs, impact, 10)
    least = np.sort(score)[-10]
    assert sorted(got.tolist()) == np.flatnonzero(score >= least).tolist() and (s == score[got]).all()
    assert read[0] < len(heads) / 4

import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash_cover as S
from strata.llm.graph import components


def brute_print(text):
    words = (text or "").encode().lower().split()
    sh = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    label = {f: f for f in fps}
    for _ in fps:
        for a, b in itertools.combinations(fps, 2):
            if (a ^ b).bit_count() <= 3:
                label[a] = label[b] = min(label[a], label[b])
    return label


def test_masks_cover_every_pair_within_the_radius():
    for bits in (list(range(64)), list(range(3, 40, 2)), [1, 7]):
        masks = S.cover_masks(bits, 3)
        for k in (1, 2, 3):
            for at in itertools.islice(itertools.combinations(bits, k), 0, 50000):
                d = sum(1 << i for i in at)
                assert any(not m & d for m in masks)


def test_components_of_planted_neighbours_with_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET", 8)
    rnd, fps = random.Random(5), set()
    for _ in range(25):
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 3, 30])):
            fps.add(x)
            for _ in range(rnd.choice([1, 2, 3, 4])):
                x ^= 1 << rnd.randrange(24)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = {r["node"]: r["label"] for r in components(spark, S.links(spark, df)).collect()}
    want = brute_components(fps)
    signed = lambda f: int(np.uint64(f).astype(np.int64))
    got = {f: found.get(signed(f), signed(f)) for f in fps}
    for a, b in itertools.combinations(fps, 2):
        assert (want[a] == want[b]) == (got[a] == got[b])


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int, `a.b` string")


def test_operator_against_brute_force_with_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [(1, base), (2, base), (2, base), (3, base.replace("w7 ", "W7\t")), (4, None), (5, ""), (None, "x"),
             (None, "x"), (7, "Éa b"), (8, "éa b"), (9, "q " * 30000), (10, base + " more")]
    df = docs(spark, [(i, t, "clash", 1, "z") for i, t in texts])
    got = [tuple(r) for r in S.near_duplicates(spark, df).select("doc_id", "fp", "component_id").collect()]
    assert len(got) == len(texts)
    fps = {t: brute_print(t) for _, t in texts}
    label = brute_components(sorted(set(fps.values())))
    ids = {}
    for i, t in texts:
        if i is not None:
            ids[label[fps[t]]] = min(ids.get(label[fps[t]], i), i)
    want = [(i, int(np.uint64(fps[t]).astype(np.int64)), ids.get(label[fps[t]])) for i, t in texts]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = S.first_of_groups(spark, df)
    assert kept.columns == df.columns
    assert kept.count() == len({label[f] for f in fps.values()})
    assert S.near_duplicates(spark, df.limit(0)).count() == 0
    assert S.first_of_groups(spark, df.limit(0)).count() == 0


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (None, 4), (200, 201)]
    got = {r["node"]: r["label"] for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 200, 201: 200}
    assert components(spark, spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0

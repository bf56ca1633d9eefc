import numpy as np
import pytest

from strata.llm import stable_ann as A


def brute(rows, every, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    queries, out = {}, {}
    for i, v in ok:
        if i % every == 0:
            queries[i] = min(queries.get(i, v.tolist()), v.tolist())
    for i, v in queries.items():
        v = np.array(v)
        near = sorted((float(np.sqrt(((x - v) ** 2).sum())), j) for j, x in ok if j != i and len(x) == len(v))[:k]
        out[i] = near
    return out


@pytest.mark.parametrize("block", [A.BLOCK, 50])
def test_recall_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    monkeypatch.setattr(A, "QUERIES", 7)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 24)) * 0.3
    x[100:160] = x[100]
    rows = [(i, [float(t) for t in np.float32(v)]) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, []), (1010, [0.0] * 24), (1020, [float("nan")] + [1.0] * 23), (1030, [None] + [1.0] * 23), (None, [1.0] * 24),
             (1040, [float("inf")] * 24), (1050, [1.0, 2.0]), (1051, [1.0, 2.5]), (1060, [1.0, 2.0, 3.0]), (5, rows[5][1]), (20, rows[21][1])]
    df = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, score double, cell int")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {}
    for r in A.nearest(spark, df, every=10, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"], r["rank"]))
    want = brute(rows, 10, 10)
    assert set(got) == {q for q, near in want.items() if near}
    hits = total = 0
    for q, near in want.items():
        mine = got.get(q, [])
        assert [r for _, _, r in mine] == list(range(1, len(near) + 1))
        assert [m[:2] for m in mine] == sorted(m[:2] for m in mine)
        hits += len({(round(d, 9), i) for d, i, _ in mine} & {(round(d, 9), i) for d, i in near})
        total += len(near)
    assert hits >= 0.95 * total
    assert [m[1] for m in got[1050]] == [1051] and 1060 not in got
    assert A.nearest(spark, df.limit(0)).count() == 0


def test_tree_finds_what_the_test_does_not_rule_out():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 8))
    x[:300] = x[0]
    p = x @ A.projection(8)
    tree = A.Tree(np.arange(900), x, p)
    lo, hi = A.boxes(nodes := A.kd_split(p, 40))
    cell = A.cells_of(nodes, p)
    assert (p >= lo[cell]).all() and (p <= hi[cell]).all()
    for q in range(0, 900, 90):
        want = sorted((float(np.sqrt(((v - x[q]) ** 2).sum())), i) for i, v in enumerate(x) if i != q)[:10]
        got = tree.search(q, x[q], p[q], 10, np.inf)
        assert len(set(got) & set(want)) >= 8

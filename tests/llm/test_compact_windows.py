import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import compact_windows as C


def brute_windows(order, width):
    out = set()
    for c in range(len(order)):
        left = c
        while left > 0 and order[left - 1] > order[c]:
            left -= 1
        right = c
        while right + 1 < len(order) and order[right + 1] >= order[c]:
            right += 1
        if right - left + 1 >= width:
            out.add((left, c, right))
    return out


def test_compact_windows_against_brute_force():
    rnd = random.Random(1)
    for _ in range(150):
        width, docs = rnd.choice([1, 2, 5, 9]), [[rnd.randrange(1, 40) for _ in range(rnd.randint(0, 40))] for _ in range(4)]
        flat = np.array([x for d in docs for x in d], np.uint64)
        sizes = np.array([len(d) for d in docs])
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(4), sizes)
        got = set(zip(*(x.tolist() for x in C.compact_windows(flat, (ends - sizes)[doc], ends[doc], width)), strict=True))
        want = {(a + s, b + s, c + s) for d, s in zip(docs, (ends - sizes).tolist(), strict=True) for a, b, c in brute_windows(d, width)}
        assert got == want


def prose(rnd, n):
    return [f"w{rnd.randrange(5000)}" for _ in range(n)]


def planted(rnd):
    passage, near, hot = prose(rnd, 60), prose(rnd, 200), prose(rnd, 13)
    rows = []
    for i in range(60):
        words = prose(rnd, rnd.randint(60, 300))
        if i % 3 == 0:  # a frequent line is no passage
            words[10:10] = hot
        if i in (5, 20, 40):
            at = rnd.randint(0, len(words))
            words[at:at] = passage
        if i in (7, 33):
            own = near[:]
            if i == 33:
                own[50], own[120:121] = "edited", []
            words[20:20] = own
        rows.append((i, " ".join(words)))
    return rows + [(70, rows[3][1]), (71, rows[3][1].upper()), (71, rows[3][1].upper()), (72, None), (73, ""), (None, rows[3][1]),
                   (74, "x " * 40000)], passage


def shingles(words):
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_repeats_against_brute_force(spark):
    rows, passage = planted(random.Random(2))
    df = spark.createDataFrame([(i, t, 1.0, "k") for i, t in rows], "doc_id long, text string, similarity double, key string")
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for i, t in rows}
    got = {}
    for r in C.repeats(spark, df).collect():
        a = words[r["doc_id"]][r["start_word"]:r["end_word"]]
        b = words[r["of_doc_id"]][r["of_start_word"]:r["of_end_word"]]
        x, y = shingles(a), shingles(b)
        assert min(len(a), len(b)) >= 50 and abs(len(x & y) / len(x | y) - r["similarity"]) < 1e-9 and r["similarity"] >= 0.8
        assert (r["of_doc_id"] is None) or r["of_doc_id"] < r["doc_id"]
        got.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
    # every 50-word window that an earlier document holds is inside a reported passage
    seen, holders = {}, {}
    for i in sorted(words, key=lambda x: (x is not None, x or 0)):
        for k in range(len(words[i]) - 49):
            w = tuple(words[i][k:k + 50])
            if seen.setdefault(w, i) != i:
                holders.setdefault(i, []).append(k)
    for i, at in holders.items():
        for k in at:
            assert any(s <= k and k + 50 <= e for s, e in got[i]), (i, k)
    assert set(got) == set(holders)
    near = [e - s for s, e in got[33]]
    assert sum(near) >= 190
    cut = {}
    out = C.cut_repeats(spark, df)
    assert out.columns == df.columns
    for r in out.collect():
        cut.setdefault(r["doc_id"], []).append(r["text"])
    assert sum(map(len, cut.values())) == len(rows)
    p = " ".join(passage)
    assert [i for i, t in cut.items() if t[0] and p in t[0]] == [5]
    assert cut[72] == [None] and cut[73] == [""] and cut[74][0] == rows[-1][1]
    assert cut[70] == [""] and cut[71] == ["", ""]
    for i, t in rows:  # clean documents stay as they are
        if i not in got:
            assert cut[i][0] == t
    assert C.repeats(spark, df.limit(0)).count() == 0
    assert C.cut_repeats(spark, df.limit(0)).agg(F.count("*")).first()[0] == 0


def found(spark, texts, partitions=1):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartitionByRange(partitions, "doc_id")
    got = {}
    for r in C.repeats(spark, df).collect():
        got.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"], r["of_doc_id"]))
    return got


def test_members_that_fail_against_the_first_meet_the_others(spark):
    """A and D are edited copies of B: each is near to B, but they are not near to each other."""
    rnd = random.Random(11)
    texts, groups = [[], [], []], 20
    for _ in range(groups):
        p = prose(rnd, 50)
        for k, at in enumerate((12, None, 37)):
            own = p[:]
            if at:
                own[at] = f"edit{rnd.random()}"
            texts[k].append(" ".join(prose(rnd, 30) + own + prose(rnd, 30)))
    for partitions in (1, 3):
        got = found(spark, sum(texts, []), partitions)
        d = [i for i in range(2 * groups, 3 * groups) if any(s <= 30 and e >= 80 and of == i - groups for s, e, of in got.get(i, []))]
        assert len(d) >= 0.9 * groups, d


def second(rows, failed, width=46):
    """The pairs of one group, whose members have their centre at 68."""
    out = set()
    for side in range(2):
        members = [(0, (i,), i, f, *C.rooted(x, 68)[side]) for i, (x, f) in enumerate(zip(rows, failed, strict=True))]
        out |= set(C.tried(iter(sorted(members, key=lambda m: (m[4], m[5], m[1]))), width, 0.8))
    return out


def test_second_tries_set_a_frequent_line_aside():
    rnd = np.random.default_rng(5)
    line = rnd.integers(0, 1 << 32, 16, dtype=np.uint32)
    rows = [np.concatenate([rnd.integers(0, 1 << 32, 60, dtype=np.uint32), line, rnd.integers(0, 1 << 32, 60, dtype=np.uint32)]) for _ in range(300)]
    rows[200] = rows[120].copy()
    rows[200][100] = 1
    assert second(rows, [i > 0 for i in range(len(rows))]) == {(200, 120)}


def test_second_tries_meet_the_nearest_earlier_member():
    """Copies with an edit on either side, in any order of documents: whatever is near to an earlier member gets a partner."""
    rnd = np.random.default_rng(6)
    for _ in range(30):
        line = rnd.integers(0, 1 << 32, 16, dtype=np.uint32)
        rows, of = [], []
        for c in range(6):
            base = np.concatenate([rnd.integers(0, 1 << 32, 60, dtype=np.uint32), line, rnd.integers(0, 1 << 32, 60, dtype=np.uint32)])
            for k in range(4):
                own = base.copy()
                if k:
                    own[[0, 40, 90, 100][k]] = k
                rows.append(own)
                of.append(c)
        at = rnd.permutation(len(rows))
        rows, of = [rows[i] for i in at], [of[i] for i in at]
        got = second(rows, [True] * len(rows))
        assert all(of[i] == of[j] and j < i for i, j in got)
        assert {i for i, _ in got} == {i for i in range(len(rows)) if of[i] in of[:i]}
        copies = second([rows[0]] * 500, [True] * 500)
        assert copies == {(i, 0) for i in range(1, 500)}


def test_long_edits_are_bridged(spark):
    rnd = random.Random(12)
    n, texts, more = 20, [], []
    for _ in range(n):
        p = prose(rnd, 80)
        texts.append(" ".join(prose(rnd, 30) + p + prose(rnd, 30)))
        more.append(" ".join(prose(rnd, 30) + p[:40] + prose(rnd, 9) + p[40:] + prose(rnd, 30)))
    got = found(spark, texts + more)
    assert sum(any(s <= 30 and e >= 119 for s, e, _ in got.get(n + i, [])) for i in range(n)) >= 0.9 * n
    a = np.arange(1, 2001, dtype=np.uint64)
    b = np.concatenate([a[:1000], np.arange(5000, 5300, dtype=np.uint64), a[1030:]])
    assert [x[:4] for x in C.aligned(a, b, [(990, 990)], 46)] == [(0, 2000, 0, 2270)]


def test_repeats_are_found_whatever_the_tasks(spark):
    """The second document holds the passage twice; the first, in the same task or another, holds it once."""
    rnd = random.Random(13)
    p = prose(rnd, 60)
    texts = [" ".join(prose(rnd, 40) + p + prose(rnd, 40)), " ".join(prose(rnd, 40) + p + prose(rnd, 70) + p + prose(rnd, 40))]
    for partitions in (1, 2):
        spans = found(spark, texts, partitions)[1]
        assert any(s <= 40 and e >= 100 for s, e, _ in spans) and any(s <= 170 and e >= 230 for s, e, _ in spans)


def test_the_texts_of_pairs_are_cut_once(spark):
    """Both sides of the pairs come from one pass over the texts, and no slice is sent twice."""
    df = spark.createDataFrame([(i, " ".join(prose(random.Random(i % 2), 80))) for i in range(4)], "doc_id long, text string")
    plan = C.repeats(spark, df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow cut") == 1 and plan.count("MapInArrow verify") == 1, plan


def test_tokens_are_those_of_each_text():
    texts = ["  A b\tC\x0bd\x0ce\rf\n g ", None, "", " \n", "\u00c9 \u00e9 x\x1cy z\u0085q \u00a0 w", "a b c d", "q w e r t y " * 30]
    import xxhash
    for column in (pa.array(texts), pa.array(["x " * 9, *texts])[1:], pa.array(texts, pa.large_string()), pa.array([None], pa.string()), pa.array([], pa.string())):
        got = C.tokens(column)
        want = [C.shingled(np.array([xxhash.xxh64_intdigest(w) for w in (t or "").encode().lower().split()], np.uint64)) for t in column.to_pylist()]
        assert len(got) == len(want) and all(map(np.array_equal, got, want))


def test_contexts_of_many_centres():
    rnd = np.random.default_rng(7)
    docs = [rnd.integers(0, 1 << 32, n, dtype=np.uint32) for n in (3, 1, 200, 40)]
    ends = np.cumsum([len(d) for d in docs])
    of = np.repeat(np.arange(4), [len(d) for d in docs])
    at = np.concatenate([np.arange(len(d)) for d in docs])
    first, reach = (ends - [len(d) for d in docs])[of], 69
    deals = {}
    for side, (ahead, behind, deal) in enumerate(C.contexts(np.concatenate(docs), first + at, first, ends[of], reach)):
        want = [C.rooted(docs[d][max(0, c - reach):c + reach + 1], c - max(0, c - reach))[side] for d, c in zip(of, at, strict=True)]
        assert list(zip(ahead.to_pylist(), behind.to_pylist(), strict=True)) == want
        for (a, _), x in zip(want, deal.tolist(), strict=True):
            assert deals.setdefault((side, a[:4 * C._SIDE]), x) == x
    assert len(set(deals.values())) == len(deals)


def test_links_of_a_pair_are_one_row(spark):
    """Whatever the batches: a pair may fill many, and ids may be null."""
    rnd = random.Random(21)
    rows = []
    for _ in range(400):
        doc, of = (rnd.choice([None, 0, 5, -3]), rnd.randrange(2)), (rnd.choice([None, 0, 7]), rnd.randrange(2))
        rows.append((rnd.randrange(9), doc[0], doc[1] << C._TAG | rnd.randrange(5) << C._ORDER | rnd.randrange(100, 200), rnd.randrange(50) << 32 | rnd.randrange(50),
                     of[0], of[1] << C._TAG | rnd.randrange(5) << C._ORDER | rnd.randrange(100)))
    want = {}
    for key, doc, place, reach, of, of_place in rows:
        tag, centre = place >> C._TAG, place & (1 << C._ORDER) - 1
        w = want.setdefault((doc, tag, of, of_place >> C._TAG), (set(), [], [], [], []))
        w[0].add(place >> C._ORDER & 15)
        for held, x in zip(w[1:], ((key, centre, of_place & (1 << C._ORDER) - 1), centre - (reach >> 32), centre + (reach & (1 << 32) - 1), of_place & (1 << C._ORDER) - 1), strict=True):
            held.append(x)
    df = spark.createDataFrame(rows, "key long, doc_id long, place long, reach long, of_id long, of_place long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("3", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = C.paired(df).collect()
            assert len(got) == len(want)
            for r in got:
                orders, seeds, first, last, of = want[r["doc_id"], r["tag"], r["of_id"], r["of_tag"]]
                assert r["orders"] == len(orders) and sorted(map(tuple, r["seeds"])) == sorted(seeds)
                assert (r["a_first"], r["a_last"], r["b_first"], r["b_last"]) == (min(first), max(last), min(of), max(of))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert C.paired(df.limit(0)).count() == 0
    plan = C.paired(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan, plan


def test_seeds_are_judged_by_the_passages_of_their_document():
    rnd = random.Random(22)
    spans = [None, [], *[[(s, s + rnd.randrange(50, 200), rnd.choice([1.0, 0.9])) for s in rnd.choices(range(300), k=k)] for k in (1, 2, 5)]]
    seeds = [[(rnd.randrange(1 << 40), rnd.randrange(400), rnd.randrange(400)) for _ in range(n)] for n in (4, 3, 40, 60, 80)]
    names = (("key", "centre", "of_centre"), ("start_word", "end_word", "similarity"))
    cell = lambda rows, names: None if rows is None else [dict(zip(names, x, strict=True)) for x in rows]
    whole = {"similarity": pa.float64()}
    kinds = [pa.list_(pa.struct([(n, whole.get(n, pa.int64())) for n in own])) for own in names]
    b = pa.RecordBatch.from_arrays([pa.array([3, None, 5, 6, 7], pa.int64()), *[pa.array(range(5), pa.int64())] * 3,
                                    pa.array([cell(x, names[0]) for x in seeds], kinds[0]), pa.array([cell(x, names[1]) for x in spans], kinds[1])],
                                   ["doc_id", "tag", "of_id", "of_tag", "seeds", "spans"])
    want, reach = [], 20
    for d, k, own, held in zip((3, None, 5, 6, 7), range(5), seeds, spans, strict=True):
        for key, c, of in own:
            failed = not any(s <= c < e - C.SHINGLE + 1 for s, e, _ in held or [])
            equal = any(j == 1 and s <= max(0, c - reach) and c + reach < e - C.SHINGLE + 1 for s, e, j in held or [])
            want.append((d, k, k, k, key, c, of, failed, equal))
    for part in ([b], [b.slice(0, 1), b.slice(1, 2), b.slice(3)]):
        got = [tuple(r.values()) for x in C.judge(reach)(iter(part)) for r in x.to_pylist()]
        assert got == want and len({w[7:] for w in want}) >= 3
        keys = [r["bad"] for x in C.judge(reach, keys=True)(iter(part)) for r in x.to_pylist()]
        assert set(keys) == {w[4] for w in want if w[7]}


def test_shared_places_of_short_and_long_texts():
    rnd = np.random.default_rng(23)

    def plain(a, b, most, after):
        a, b = a.tolist(), b.tolist()
        at = {a.index(x): b.index(x) for x in set(a) & set(b)}
        new = [(s, t) for s, t in at.items() if at.get(s - 1, -2) != t - 1 and s + t <= most and max(s, t) >= after]
        return sorted(new, key=lambda p: (max(p), sum(p), a[p[0]]))

    for n, tokens in ((1, 2), (16, 20), (16, 1 << 30), (250, 300), (600, 500), (600, 1 << 30)):
        for _ in range(5):
            a, b = rnd.integers(0, tokens, n, dtype=np.uint64), rnd.integers(0, tokens, n + 3, dtype=np.uint64)
            b[n // 2:] = a[:n + 3 - n // 2][:n + 3] if n > 3 else b[n // 2:]
            for most, after in ((n, 0), (2 * n, 16), (4, 0)):
                assert list(C._shared(a, b, most, after)) == plain(a, b, most, after)

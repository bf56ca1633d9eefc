import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import winnowing as W



def own_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, span=10):
    """Words hit and items met, by looking at every place of every span."""
    w, hit, met = own_words(text), set(), set()
    for item, other in items:
        v = own_words(other)
        size = min(span, len(v))
        for s in range(len(v) - size + 1) if size else ():
            for p in range(len(w) - size + 1):
                if w[p:p + size] == v[s:s + size]:
                    hit |= set(range(p, p + size))
                    met.add("" if item is None else str(item))
    return len(w), len(hit), sorted(met)


def check(spark, docs, items):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, hash int, word string")
    of = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, bits int")
    got = sorted((repr(r[0]), r[1], r[2], list(r[3])) for r in W.contamination(spark, df, of).collect())
    assert got == sorted((repr(i), *brute(t, items)) for i, t in docs)


def test_every_case_against_brute_force(spark):
    rng = random.Random(7)
    line = [rng.choice(["ant", "bee", "Cat", "dog", "élan", "x1"]) + rng.choice("abcdefgh") for _ in range(1400)]
    passage = " ".join(line[:30])
    items = [(1, passage), (2, "one two three"), (3, "Solo"), (4, None), (5, ""), (6, "?!"), (7, passage), (None, " ".join(line[40:52])),
             (10, "la " * 14), (11, "one two three"), (12, " ".join(line[600:611]))]
    docs = [(1, None), (2, ""), (3, "..."), (None, passage), (None, passage), (4, passage.upper().replace(" ", "--")), (4, "other text"),
            (5, " ".join(line)), (6, "one, two; THREE one two three"), (7, "solo"), (8, "la " * 40), (9, " ".join(line[:9])),
            (10, " ".join(line[3:13]) + " gap " + " ".join(line[8:20])), (11, "é " * 3 + " ".join(line[40:52]) + "\x00" + "one two"),
            # a span that lies across the edge of two blocks
            *[(20 + k, "w " * (W.BLOCK - 12 + k) + " ".join(line[5:15])) for k in range(24)]]
    check(spark, docs, items)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("abc D", max_size=70), max_size=4), st.lists(st.text("abc D", max_size=60), max_size=3))
def test_few_words_repeat_much(spark, texts, items):
    check(spark, list(enumerate(texts)), list(enumerate(items)))


def test_empty_tables_and_long_text(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted(map(tuple, W.contamination(spark, docs, none).collect())) == [(1, 11, 0, []), (2, 0, 0, [])]
    item = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    assert W.contamination(spark, docs.limit(0), item).count() == 0
    long_ = spark.createDataFrame([(1, "a b c d e f g h i j k " * 20_000)], "doc_id long, text string")
    assert W.contamination(spark, long_, item).first()[:3] == (1, 220_000, 220_000)
    with pytest.raises(ValueError):
        W.contamination(spark, docs, item, span=4, gram=5)


def test_documents_stay_on_the_jvm_and_in_their_tasks(spark):
    """No Python worker in the plan, and only fingerprints that may be wanted leave a scan of the texts."""
    item = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    wanted = W.spans(item, [10])
    bits = W.member_bits(spark, wanted.selectExpr("hash AS ref"))
    plan = W.candidates(docs, bits, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "hashpartitioning" not in plan

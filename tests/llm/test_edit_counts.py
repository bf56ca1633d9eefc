import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from strata.llm import edit_counts as E

PATH = P.path("byte_bpe_multi_50k.tiktoken")
PIECES = [*"ab's  \n\t,!-12", "'ll", "'re", "  ", "\r\n", "the ", chr(0xE9), chr(0x6F22), chr(0x1F600), chr(0xA0), chr(0x2003), "'"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=50).map("".join)


@pytest.fixture(scope="module")
def whole():
    return tiktoken.Encoding("m", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))})


@pytest.fixture(scope="module")
def counter():
    return E.Counter(open(PATH, "rb").read(), P.PATTERN)


def check(tree, counter, text, whole):
    assert tree.total == len(whole.encode_ordinary(text))
    assert tree.leaves()[0].tolist() == [len(w) for w in counter.pattern.findall(text)]


@settings(max_examples=500, deadline=None)
@given(text=TEXT, edits=st.lists(st.tuples(st.integers(0, 90), st.integers(0, 12), TEXT), max_size=6))
def test_edits_against_counting_anew(whole, counter, text, edits):
    tree = E.CountTree(*counter.leaves(text))
    check(tree, counter, text, whole)
    for start, size, new in edits:
        start = min(start, len(text))
        stop = min(start + size, len(text))
        want = text[:start] + new + text[stop:]
        text, _ = tree.edit(counter, text, start, stop, new)
        assert text == want
        check(tree, counter, text, whole)


def test_long_documents_scan_only_what_is_near(whole, counter):
    rnd = random.Random(8)
    text = " ".join(rnd.choice(["alpha", "beta,", "12", "don't\n", "  x"]) for _ in range(6000))
    tree = E.CountTree(*counter.leaves(text))
    for _ in range(120):
        start = rnd.randint(0, len(text))
        new = rnd.choice(["", "x", " ", "a b c " * rnd.choice([1, 80])])
        text, seen = tree.edit(counter, text, start, min(len(text), start + rnd.choice([0, 1, 30, 400])), new)
        assert seen <= len(new) + 60
        check(tree, counter, text, whole)


def test_operator_with_odd_rows(spark, whole):
    docs = [(1, "hello wor ld"), (2, None), (3, ""), (None, "a b"), (None, "a b"), (5, "x " * 50000), (6, "same"), (6, "same")]
    df = spark.createDataFrame([(i, t, 1, b"") for i, t in docs], "doc_id long, text string, n_tokens int, tree binary")
    edits = spark.createDataFrame([(1, 2, 5, 6, ""), (1, 1, 9, 10, ""), (2, 0, 0, 0, "new"), (None, 0, 0, 1, "zz"), (5, 0, 10**6, 0, "end"),
                                   (6, 0, None, None, None), (99, 0, 0, 0, "no")], "doc_id long, seq int, start long, stop long, new string")
    kept = E.trees(spark, df, PATH, P.PATTERN)
    out = E.apply_edits(spark, E.with_edits(kept, edits), PATH, P.PATTERN).collect()
    want = {1: "hellowor ld"[:8] + "ld", 2: "new", 3: "", None: "zz b", 5: "x " * 50000 + "end", 6: "same"}
    assert len(out) == len(docs)
    for r in out:
        assert (r["text"] or "") == want[r["doc_id"]]
        assert r["n_tokens"] == len(whole.encode_ordinary(r["text"] or ""))
        assert E.unpack(bytes(r["tree"]))[1].sum() == r["n_tokens"]
    assert E.apply_edits(spark, E.with_edits(E.trees(spark, df.limit(0), PATH, P.PATTERN), edits), PATH, P.PATTERN).count() == 0

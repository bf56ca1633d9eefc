import html as entities
import random
import re

import numpy as np
import pytest

from strata.llm import dom_boost as D

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return D.train(spark, spark.read.parquet(f"{SF}/pages.parquet").filter("page_id % 2 = 0"))


def brute(page):
    """The article by its tags, which the trees are not bound to."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in blocks if x)


def test_held_out_pages_exactly(spark, model):
    pages = spark.read.parquet(f"{SF}/pages.parquet").filter("page_id % 2 = 1")
    want = {r["page_id"]: brute(r["html"]) for r in pages.collect()}
    got = D.extract(spark, pages, model).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_held_out_variants(spark, model):
    rows = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").filter("page_id % 2 = 1").limit(60).collect()]
    right = total = 0
    for k, page in enumerate(rows):
        for own, plain in D.variants(page, random.Random(1000 + k)):
            want = brute(page).split("\n")
            tree = D.parse(D._plain(own, random.Random(k)) if plain else own)
            got = D.decode(tree, model(D.features(tree)))
            right += 2 * len(set(want) & set(got))
            total += len(set(want)) + len(set(got))
    assert right / total > 0.97


ODD = {None: "", "": "", "plain text": "plain text", "<p>a<p>b": "a\nb", "a < b &lt; c": "a < b < c",
       "<div><p>x &amp; y&nbsp;z\n\t w</p><script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --></div>": "x & y z w",
       "<textarea><p>no</textarea><p>yes": "yes", "<p>cut <b": "cut", "<!-- open <p>no": "", '<p title="a > b">t</p>': "t", "<p a='x>y": "y",
       "<ul><li>one<li>two</ul>": "one\ntwo", "<SCRIPT>no</SCRIPT >go": "go",
       "<p>a <math><mi>x</mi></math> b <noscript>c</noscript> <button>d</button></p>": "a x b c d", "<p>a <button>b</p><p>c": "a b\nc",
       "<p>a <svg><text>no</p><p>yes</p>": "a\nyes", "<div>a <select><option>no</div><p>yes": "a\nyes",
       "<div>a <svg><div>no</div></svg> b</div>": "a b", "<svg><text>no": "", "<p>a <textarea></p><p>no": "a"}


def test_parse_of_odd_pages():
    for page, want in ODD.items():
        assert "\n".join(t for t in D.parse(page or "").text if t) == want, page


def test_decoding_is_the_best_consistent_labelling():
    rnd = random.Random(4)
    for _ in range(200):
        page = D.Page()
        page.add(-1, "#root", frozenset(), None)
        for _ in range(rnd.randint(1, 7)):
            up = rnd.choice([i for i, t in enumerate(page.text) if t is None])
            page.add(up, "div", frozenset(), rnd.choice([None, "t"]))
        n = len(page.tag)
        odds = np.array([rnd.uniform(-3, 3) for _ in range(n)])
        kids = [[i for i in range(n) if page.parent[i] == k] for k in range(n)]
        whole = lambda k: odds[k] + sum(whole(c) for c in kids[k])

        def best(k):
            keep = [(abs(whole(k)), whole(k) >= 0)]
            if page.text[k] is None:
                keep.append((sum(best(c)[0] for c in kids[k]) - D.DIVIDE, None))
            return max(keep, key=lambda x: x[0])

        def leaves(k, bound=None):
            state = bound if bound is not None else best(k)[1]
            if page.text[k] is not None:
                return [k] if state else []
            return [x for c in kids[k] for x in leaves(c, state)]

        for i in range(n):
            if page.text[i] is not None:
                page.text[i] = str(i)
        assert D.decode(page, odds) == [str(k) for k in sorted(leaves(0))]


def test_rows_of_every_kind(spark, model):
    rows = [(i, None if i % 2 else "u", h, 1, "c") for i, h in enumerate([*ODD, "<div>" * 3000 + "deep", "<p>" + "w " * 200000, "x", "x", '<a "' * 20000])]
    rows += [(None, "u", "x", 1, "c")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = D.extract(spark, df, model).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert D.extract(spark, df.limit(0), model).count() == 0
    none = D.train(spark, df.limit(0))
    assert {r["page_id"]: r["text"] for r in D.extract(spark, df.filter("page_id = 3"), none).collect()} == {3: "a\nb"}

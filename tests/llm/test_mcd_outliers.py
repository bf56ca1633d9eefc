import collections
import random
import re

import numpy as np
import pytest

from strata.llm import mcd_outliers as M

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words, lines = W.findall(text), [x for x in text.split("\n") if W.search(x)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = collections.Counter(tri)
    covered = {i + k for i, t in enumerate(tri) if n[t] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


ODD = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "x x x x x", "\x0bä\x1c\U0001f600 b\r\nc\n\nc\n c\nc", "a # b|c <d> **",
       "same line here\nsame line here\nother\nsame line here", "long " * 30000, " ".join(str(i % 977) for i in range(20000)),
       " ".join(map(str, range(60))), "a b c"]


def test_statistics_against_brute_force(spark):
    rnd = random.Random(7)
    texts = ODD + ["".join(rnd.choice(["a ", "b ", "c ", "d\n", "#", "\t"]) for _ in range(rnd.randint(0, 200))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, "en", None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in M.statistics(df).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == brute(texts[r["doc_id"]]), r["doc_id"]


def corpus(rnd, n):
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(60, 400))]
        junk = i % 10 == 3
        rows.append((i, " ".join(w + rnd.choice(["###", "%%%", "|"]) for w in words) if junk else " ".join(words), ["en", "de", None][i % 3 and i % 2], ["a", "b"][i % 5 == 0], junk))
    return rows


@pytest.mark.parametrize("n", [600])
def test_planted_outliers_go_and_clean_documents_stay(spark, n):
    rows = corpus(random.Random(9), n) + [(None, "tiny", "xx", "only", True), (None, "tiny", "xx", "only", True)]
    df = spark.createDataFrame([(i, t, g, s, "x", 1) for i, t, g, s, _ in rows], "doc_id long, text string, lang string, source string, cell string, n_words int")
    v = M.verdicts(spark, df)
    plan = v._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = {r["doc_id"]: r["kept"] for r in v.collect()}
    assert got == {i: not junk for i, _, _, _, junk in rows}
    kept = M.passing(spark, df)
    assert kept.columns == df.columns and kept.count() == sum(not r[4] for r in rows)
    assert M.verdicts(spark, df.limit(0)).count() == 0 and M.passing(spark, df.limit(0)).count() == 0


def test_estimate_against_numpy(spark):
    """Concentration steps give the covariance that numpy's give from the same start."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 5)) @ np.tril(rng.normal(size=(5, 5))) + 5
    x[:120] += 60
    df = spark.createDataFrame([("g", i % M.SALTS, *map(float, r)) for i, r in enumerate(x)], "cell string, salt int, " + ", ".join(f"{z} double" for z in M.Z))
    found = M.estimates(spark, df).first()
    floors = np.array([M.FLOORS[z] for z in M.Z])
    rank = lambda d: np.sort(d)[int(np.ceil(len(d) * M.H)) - 1]
    med = np.sort(x, axis=0)[len(x) // 2 - 1]
    mad = np.maximum(np.sort(np.abs(x - med), axis=0)[len(x) // 2 - 1] * 1.4826, floors)
    d = (((x - med) / mad) ** 2).sum(axis=1)
    for _ in range(M.STEPS):
        near = x[d <= rank(d)]
        cov = np.cov(near.T, bias=True) * M.CONSISTENCY + np.diag(floors ** 2)
        d = np.einsum("ij,jk,ik->i", x - near.mean(axis=0), np.linalg.inv(cov), x - near.mean(axis=0))
    factor = np.array([[found[f"c_{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    assert np.allclose(factor @ factor.T, cov, rtol=0.02, atol=0.05)
    assert all(d[:120] > M.CUTOFF)


def test_duplicate_lines_and_repeated_words_reject_alone(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(3, 8)))
    rows = [(i, "\n".join(" ".join(word() for _ in range(10)) for _ in range(rnd.randint(6, 30)))) for i in range(300)]
    dishes = [f"dish{k}" for k in range(12)]
    for i in range(300, 304):  # a menu: short lines in changing order
        rows.append((i, "\n".join(rnd.choice(dishes) for _ in range(60))))
    for i in range(304, 308):  # half of the words stand in repeated windows
        block = " ".join(word() for _ in range(50))
        rows.append((i, " ".join([block, *(word() for _ in range(50)), block, *(word() for _ in range(50))])))
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    v = M.verdicts(spark, df).collect()
    assert not any(r["base_failed"] for r in v)
    assert {r["doc_id"] for r in v if not r["kept"]} == set(range(300, 308))

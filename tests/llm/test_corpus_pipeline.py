"""The stages one by one and together, against plain Python on a small table."""
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_secret_links import brute as brute_secrets
from test_simhash_cover import brute_components, brute_print

import corpus_pipeline as C

RNG = random.Random(11)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(n):
    return ["".join(RNG.choices("abcdefghijklmnopqrstuvwxyz", k=RNG.randint(3, 9))) for _ in range(n)]


PASSAGE = _prose(70)
LONG = _prose(900)
DOCS = [(i, " ".join(_prose(90))) for i in range(12)]
DOCS += [(20, " ".join(_prose(60) + PASSAGE + _prose(40))), (21, "\n".join(_prose(55)) + " " + " ".join(PASSAGE) + "  " + " ".join(_prose(65)) + "\n"),
         (30, " ".join(LONG)), (31, " ".join(LONG)), (32, " ".join([*LONG[:400], "other", *LONG[401:]])), (40, None), (41, ""), (42, "too short"), (None, "short, too"),
         (50, " ".join(_prose(60)) + " password = hunter2hunter2 user=alice zX9wV7uT5sR3qP1oN2 " + " ".join(_prose(30))),
         (60, " ".join(["same"] * 80)), (61, " ".join(_prose(120))), (61, " ".join(_prose(120)))]


def frame(spark, rows=DOCS):
    return spark.createDataFrame([(i, t, "en", "web", len(t) if t is not None else None) for i, t in rows], COLUMNS)


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def passing(rows):
    """The base rules; the table is too small for an estimate, so nothing else rejects."""
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        many = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        if len(w) >= 50 and 100 * len(many) <= 50 * len(w):
            out.append((i, t))
    return out


def first_of_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(sorted(set(prints)))
    first = {}
    for (i, t), f in zip(rows, prints, strict=True):
        first[label[f]] = min(first.get(label[f], (i, t)), (i, t), key=lambda x: (x[0] is None, x[0]))
    return sorted(first.values(), key=repr)


def without_passage(rows):
    """The planted passage goes where a later document repeats it; words keep the white space before them. Document 32,
    if it came this far, is the long text with one word replaced: one passage from its first word to its last."""
    out, seen = [], False
    for i, t in sorted(rows):
        own = re.search(r"\s*" + r"\s+".join(PASSAGE), t)
        out.append((i, "" if i == 32 else t[:own.start()] + t[own.end():] if own and seen else t))
        seen = seen or own is not None
    return sorted(out, key=repr)


def masked(rows):
    out = []
    for i, t in rows:
        new, at = "", 0
        for _, s, e in brute_secrets(t)[1]:
            if s >= at:
                new += t[at:s] + "[SECRET]"
            at = max(at, e)
        out.append((i, new + t[at:]))
    return sorted(out, key=repr)


def check_packing(pieces, rows):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    want = sorted((i, np.array([*own.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows)
    got, room = {}, {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["doc_tokens"], p["start"])):
        ids = next(w for i, w in want if i == p["doc_id"] and len(w) == 4 * p["doc_tokens"]
                   and zlib.crc32(w[4 * p["start"]:4 * (p["start"] + p["length"])]) == p["ids_crc32"])
        got[(p["doc_id"], ids)] = got.get((p["doc_id"], ids), 0) + p["length"]
        room.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert got == {(i, w): len(w) // 4 for i, w in want}
    for own in room.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_and_run_against_plain_python(spark, tmp_dir):
    rows, docs = DOCS, frame(spark)
    for (name, stage), brute in zip(C.STAGES[:-1], (passing, first_of_groups, without_passage, masked), strict=True):
        out = stage(spark, docs, tmp_dir)
        assert sorted(out.columns) == sorted(docs.columns), name
        want = sorted(brute(rows), key=repr)
        assert kept(out) == want, name
        assert len(want) < len(rows) or want != sorted(rows, key=repr), name  # every stage has something to do
        for r in out.collect():
            assert r["n_chars"] == len(r["text"])
        rows, docs = want, frame(spark, want)
    check_packing(C.STAGES[-1][1](spark, docs, tmp_dir).collect(), rows)
    frame(spark).write.parquet(f"{tmp_dir}/documents.parquet")
    check_packing(C.run(spark, tmp_dir).collect(), rows)


@pytest.mark.parametrize("name", [name for name, _ in C.STAGES])
def test_empty_table_and_clashing_columns(spark, tmp_dir, name):
    stage = dict(C.STAGES)[name]
    extra = ["_m_ref", "_m_word", "_m_bits", "_r_pieces", "_r_spans", "_r_id", "_s_spans", "_s_id", "_s_hash", "_q_id", "_q_hash", "_q_lang", "spans", "key", "h", "text_hash", "label"]
    df = frame(spark, DOCS[:3]).selectExpr("*", *[f"doc_id AS {c}" for c in extra])
    assert stage(spark, frame(spark, []), tmp_dir).collect() == []
    out = stage(spark, df, tmp_dir)
    assert out.count() >= 3
    if name != "packing":
        assert sorted(out.columns) == sorted(df.columns) and all(r[c] == r["doc_id"] for r in out.collect() for c in extra)

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.errors import PythonException

from strata.llm import word_bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("chunk,places", [(B.CHUNK, B.PLACES), (400, 30)])
def test_ids_and_round_trip(spark, monkeypatch, chunk, places):
    monkeypatch.setattr(B, "CHUNK", chunk)
    monkeypatch.setattr(B, "PLACES", places)
    own = tiktoken.Encoding("m", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))})
    rnd = random.Random(2)
    bits = ["the ", "né", "\n", "  ", "don't", "漢字", "\U0001f600", "12", "<|endoftext|>", "\x00", " x", "\t"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 80))) for _ in range(200)] + [None, "", "a", "a", "word " * 60000, " "]
    rows = [(i if i != 3 else None, t, 5, b"x") for i, t in enumerate(texts)] + [(7, texts[7], 5, b"x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk int, ids binary")
    got = [tuple(r) for r in B.decode(spark, B.encode(spark, df, PATH, P.PATTERN), PATH).collect()]
    want = [(i, np.array(own.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((a, bytes(b), bytes(c)) for a, b, c in got), key=key) == sorted(want, key=key)
    assert B.encode(spark, df.limit(0), PATH, P.PATTERN).count() == 0
    bad = spark.createDataFrame([(1, np.array([50300], "<u4").tobytes()), (2, None)], "doc_id long, ids binary")
    with pytest.raises(PythonException):
        B.decode(spark, bad, PATH).collect()
    assert B.decode(spark, bad.filter("doc_id = 2"), PATH).first()["decoded"] is None


def test_small_chunks_and_packing():
    x = np.array([0, 1, 255, 256, 2**32 - 1, 70000], np.uint32)
    assert B._unpack(B._pack(x)).tolist() == x.tolist() and len(B._unpack(B._pack(x[:0]))) == 0
    words = ["", "a\x00b", "é漢", " " * 500]
    assert B._unpack_words(B._pack_words(words)) == words
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st

from strata.llm.tokens import by_ranks, by_tokenizer, parts, units

ODD = st.lists(st.sampled_from([*"ab'st  \n\t\r.,!-_12", *map(chr, (0x0B, 0x1C, 0x85, 0xA0, 0x2003, 0x3000, 0xB2, 0xE9, 0x2167, 0x6F22, 0x1F600)),
                               "'ll", "<|endoftext|>", "  "]), max_size=60).map("".join)


@pytest.fixture(scope="module")
def whole():
    import tiktoken
    from tokenizers import Tokenizer
    multi = tiktoken.Encoding("m", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))})
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    enc = (by_ranks(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read(), P.PATTERN),
           by_tokenizer(open(P.path("byte_bpe_50k.json"), "rb").read()))
    return multi, own, enc


def check(whole, text):
    multi, own, (a, b) = whole
    assert "".join(units(text)) == text
    assert np.frombuffer(a(text), "<u4").tolist() == multi.encode_ordinary(text)
    assert np.frombuffer(b(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(text=ODD)
def test_units_encode_like_the_whole_text(whole, text):
    check(whole, text)


def test_every_pair_of_white_space(whole):
    spaces = [chr(i) for i in range(0x3001) if chr(i).isspace() or i in (0x180E, 0x200B, 0x2060)] + [chr(0xFEFF)]
    for a in spaces:
        for b in spaces:
            check(whole, f"x{a}{b}y {a}z{b} {a}")


def test_cache_that_overflows(whole):
    enc, rnd = whole[2][0], random.Random(1)
    enc.keep, keep = 300, enc.keep
    for _ in range(50):
        text = " ".join(str(rnd.randrange(10**6)) for _ in range(60))
        assert np.frombuffer(enc(text), "<u4").tolist() == whole[0].encode_ordinary(text)
    enc.keep = keep


def test_parts_of_a_text_encode_like_the_whole(whole):
    rnd, file = random.Random(2), open(P.path("byte_bpe_50k.json"), "rb").read()
    assert parts("") == [""] and parts("abc def", 3) == ["abc", " def"] and parts("abcdef", 2) == ["abcdef"]
    for size in (1, 7, 60):
        enc = by_tokenizer(file, size)
        for _ in range(60):
            text = "".join(rnd.choice(["ab", " ", "  ", "\n", "\u00a0", "9", "'ll", "\u00e9", "<|endoftext|>", ".", "\u6f22"]) for _ in range(50))
            assert "".join(parts(text, size)) == text
            assert np.frombuffer(enc(text), "<u4").tolist() == whole[1].encode(text, add_special_tokens=False).ids
    assert parts("x" * 50 + " y", 10) == ["x" * 50, " y"]

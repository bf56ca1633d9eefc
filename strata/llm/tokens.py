"""Exact byte-pair encoding by units.

A unit is a run of white space and the run of other characters after it. The pre-token pattern never
matches across the start of a unit nor looks past its end, so a text's ids are those of its units, one after
another: units are encoded one by one and known ones looked up, or long texts are cut where a unit begins.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable

import numpy as np

#: White space of the pre-token pattern (the Unicode property), without the plain space.
_WS = "".join(map(chr, (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_UNITS = re.compile(f"[ {_WS}]*[^ {_WS}]+|[ {_WS}]+")
#: Where a plain split at spaces would cut a run of white space, or leave one at an end.
_UNEVEN = re.compile(rf" [ {_WS}]|[{_WS}] |\A[ {_WS}]|[ {_WS}]\Z")


def units(text: str) -> list[str]:
    """The units of a text, in order; they join to the text."""
    if not text:
        return []
    if _UNEVEN.search(text):
        return _UNITS.findall(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes. ``many`` encodes a list of units; ``keep``
    bounds the cached characters."""

    def __init__(self, many: Callable[[list[str]], Iterable[list[int]]], keep: int = 1 << 23) -> None:
        self.many, self.keep, self.size = many, keep, 0
        self.known: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        if self.size > self.keep:
            self.known.clear()
            self.size = 0
        for u, ids in zip(new, self.many(new), strict=True):
            self.known[u] = np.array(ids, "<u4").tobytes()
        self.size += sum(map(len, new))

    def __call__(self, text: str) -> bytes:
        own, known = units(text), self.known
        try:
            return b"".join([known[u] for u in own])
        except KeyError:
            self.learn([u for u in set(own) if u not in known] if self.size <= self.keep else list(set(own)))
            return b"".join([known[u] for u in own])


def ranks(file: bytes) -> dict[bytes, int]:
    """The token bytes of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}


def by_ranks(file: bytes, pattern: str) -> Encoder:
    """Encoder of a rank file: each match of ``pattern`` by itself, no special tokens."""
    import tiktoken
    own = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(file), special_tokens={})
    return Encoder(lambda new: map(own.encode_ordinary, new))


#: Fixed value: the pre-token pattern of byte-level tokenizer files.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Encoders of this process by file, so that tasks which follow each other read the file once.
_OWN: dict[int, Callable[[str], bytes]] = {}
#: Characters of a text that are encoded at a time; where a unit begins next, the text is cut.
PART = 1 << 20
_BEGIN = re.compile(f"(?<=[^ {_WS}])(?=[ {_WS}])")


def parts(text: str, size: int = PART) -> list[str]:
    """The text in parts of about ``size`` characters that begin with a unit, so that their ids are the text's."""
    out, at = [], 0
    while len(text) - at > size and (cut := _BEGIN.search(text, at + size)):
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]] if out else [text]


def _bytes_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 is itself, the other bytes
    take the letters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """The ranks that a byte-level BPE tokenizer's merges give, or None if ids do not follow the merges."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) \
            or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
        return None
    vocab, letters = model["vocab"], _bytes_of()
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocab.get(w) for w in merged]
    if ids != sorted(set(ids)) or len(vocab) != len(ids) + 256 or ids and ids[0] < 256:
        return None
    return {bytes(letters[c] for c in w): i for w, i in vocab.items()}


def by_tokenizer(file: bytes, size: int = PART) -> Callable[[str], bytes]:
    """Encoder of a tokenizer file, without added special tokens: a text gives its ids as little-endian unsigned 32-bit
    bytes. They are the file's own ids; where the text holds no special string they come from the ranks of its merges,
    which are the same ids sooner."""
    import json
    import os
    import zlib
    key = zlib.crc32(file)
    if size == PART and key in _OWN:
        return _OWN[key]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    own, spec = Tokenizer.from_buffer(file), json.loads(file)
    found = merge_ranks(spec)
    special = [t["content"] for t in spec.get("added_tokens", [])]

    def whole(part: str) -> list[int]:
        return own.encode(part, add_special_tokens=False).ids

    if found is None or any(not s or any(c in f" {_WS}" for c in s) for s in special):
        ids = whole
    else:
        import tiktoken
        by_rank = tiktoken.Encoding("merges", pat_str=BYTE_LEVEL, mergeable_ranks=found, special_tokens={}).encode_ordinary

        def ids(part: str) -> list[int]:
            return whole(part) if any(s in part for s in special) else by_rank(part)

    def encode(text: str) -> bytes:
        return b"".join([np.array(ids(part), "<u4").tobytes() for part in parts(text, size)])

    if size == PART:
        _OWN[key] = encode
    return encode

import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import prefix_trie as T


def ordered(rows):
    """The turns of each conversation by the stated order."""
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out.setdefault(c, []).append(((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()), (role, text)))
    return {c: [x for _, x in sorted(t)] for c, t in out.items()}


def shared(own):
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        out[c] = base[:h] + turns[h:]
    return out


def brute(own):
    nodes = {}
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((c, len(turns) == d))
    out = []
    for path, who in nodes.items():
        under = [p for p in nodes if p[:len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in under if p)
        leaves = sum(not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in under) for p in under)
        ends = ",".join(map(str, sorted(c for c, end in who if end)))
        out.append((min(c for c, _ in who), len(path), min(c for c, _ in nodes[path[:-1]]) if path else None, len(who), len(children), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, node string")


def check(spark, rows, band=T.BAND):
    df, own = frame(spark, rows), ordered(rows)
    got = T.trie(spark, T.rebuilt(spark, df), band).collect()
    assert sorted(map(tuple, got), key=repr) == brute(shared(own))
    return own


def test_every_case_against_brute_force(spark):
    rows = [(0, i, "user", f"turn {i}") for i in range(5)] + [(c, i, "user", f"turn {i} of {c % 3}") for c in range(1, 45) for i in range(c % 6)]
    rows += [(61, None, None, None), (61, None, "a", "b c"), (61, 1, "", ""), (61, 1, "", ""), (62, 2, "a", None), (62, 1, None, "x  y\n"),
             (None, 0, "user", "lost"), (-3, 0, "user", "turn 0"), (-20, 0, "user", "turn 9"), (-25, 1, "u", "z"), (-25, 0, "u", "z")]
    own = check(spark, rows + [(80, 0, "user", "turn 0")] * 2, band=2)
    assert any(not t for t in shared(own).values())  # a conversation without turns


def test_deep_conversations_in_narrow_bands(spark):
    line = [("u" if i % 2 else "a", f"word {i}") for i in range(75)]
    rows = [(c, i, *t) for c, n in ((100, 75), (200, 75), (300, 64), (400, 9), (500, 70)) for i, t in enumerate(line[:n])]
    rows += [(600, i, *t) for i, t in enumerate(line[:40])] + [(600, 40 + i, "b", f"off {i}") for i in range(30)]
    for band in (2, 3, 16):
        check(spark, rows, band)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 24), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from([None, "a"]), st.sampled_from(["x", "y z", None])), max_size=30))
def test_any_rows(spark, rows):
    check(spark, rows, 2)


def test_long_lists_of_ids_are_hashed_in_order(spark):
    n = 3 * T.PIECE + 5
    ids = spark.range(n).selectExpr("cast('k' as binary) AS node", "id - 7 AS conv_id")
    (row,) = T.listed(ids).collect()
    assert row["digest"] == hashlib.sha256(",".join(str(i - 7) for i in range(n)).encode()).hexdigest()


def test_empty_table_and_plain_sequences(spark):
    assert T.trie(spark, T.rebuilt(spark, frame(spark, []))).count() == 0
    rows = [(1, 0, "u", "a"), (2, 0, "u", "a"), (2, 1, "u", "b")]
    got = T.trie(spark, T.sequences(frame(spark, rows))).collect()
    assert sorted(map(tuple, got), key=repr) == brute(ordered(rows))

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from strata.llm.best_fit import best_fit_decreasing, pack

PATH = P.path("byte_bpe_50k.json")


def test_best_fit_against_brute_force():
    rnd = random.Random(3)
    for _ in range(60):
        window = rnd.choice([1, 7, 16, 100])
        items = sorted((rnd.randint(1, window) for _ in range(rnd.randint(0, 120))), reverse=True)
        rooms, fits = [], []
        for x in items:
            open_ = [r for r in rooms if r >= x]
            if open_:
                fits.append(min(open_))
                rooms.remove(min(open_))
                rooms.append(fits[-1] - x)
            else:
                fits.append(window)
                rooms.append(window - x)
        assert [window - o for _, o in best_fit_decreasing(items, window)] == fits


def test_pack_holds_every_id_once(spark):
    own, rnd = Tokenizer.from_file(PATH), random.Random(4)
    texts = [(i, " ".join(rnd.choice(["a", "Bé", "the\n", "<|endoftext|>", "12"]) for _ in range(rnd.randint(0, 300)))) for i in range(150)]
    texts += [(150, None), (151, ""), (None, "x y"), (152, "same"), (152, "same"), (153, "w " * 9000)]
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in texts], "doc_id long, text string, length int, sequence_id string")
    for with_ids in (False, True):
        rows = [r.asDict() for r in pack(spark, df, PATH, window=256, with_ids=with_ids, group=60).collect()]
        left = defaultdict(list)
        for i, t in texts:
            left[i].append(own.encode(t or "", add_special_tokens=False).ids + [1])
        seqs = defaultdict(list)
        for r in rows:
            assert any(len(ids) == r["doc_tokens"] and zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
                       for ids in left[r["doc_id"]])
            seqs[r["sequence_id"]].append((r["offset"], r["length"]))
            if with_ids:
                assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        assert sum(r["length"] for r in rows) == sum(len(x) for v in left.values() for x in v)
        for parts in seqs.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= 256
        total = sum(r["length"] for r in rows)
        assert len(seqs) * 256 <= 1.1 * total + 512
    assert pack(spark, df.limit(0), PATH).count() == 0

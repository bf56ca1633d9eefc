import zlib

import numpy as np

from strata.llm import subword_langid as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_folds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in L.predict(spark, docs, L.train(spark, docs)).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r["held_out"]]
    right = np.mean([got[i]["lang_pred"] == truth[i] for i in held])
    assert right > 0.97
    sure = [i for i in held if not got[i]["rejected"]]
    assert len(sure) > 0.9 * len(held) and np.mean([got[i]["lang_pred"] == truth[i] for i in sure]) >= right - 0.005


def test_predictions_do_not_see_labels_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = L.train(spark, docs)
    rows = [(1, None), (2, ""), (3, "123 !?"), (None, "the and of"), (None, "the and of"), (5, "the " * 400000), (6, chr(0x1F600)), (7, chr(0x10FFFF) + "a")]
    df = spark.createDataFrame([(i, t, "xx", 1.0) for i, t in rows], "doc_id long, text string, lang string, score double")
    got = L.predict(spark, df, model).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"]): r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (1, 2, 3, 6))
    assert by[5]["lang_pred"] == by[None]["lang_pred"] == "en" and not by[None]["held_out"]
    assert L.train(spark, df.limit(0)).languages == [] and L.predict(spark, df.limit(0), model).count() == 0
    none = L.train(spark, df.filter("doc_id is null"))
    assert none.languages == [] and L.predict(spark, df, none).filter("lang_pred != 'und'").count() == 0


def test_counts_are_those_of_the_text():
    text = "Über die Straße. " * 50
    assert L.counts(text).tolist() == np.bincount(L.subwords(text), minlength=L.BUCKETS).tolist()

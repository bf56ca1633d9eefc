"""The registered queries of the training-data operators: every column is read; those with SQL are held against it."""
import hashlib

import pytest
from test_registered_queries import SF, _bag, duck, pytestmark  # noqa: F401
from test_secret_links import CASES, brute

from strata.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, name):  # noqa: F811
    df, rel = QUERIES[name](spark, SF), duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op1_secret_links"}))
def test_query_gives_rows_that_can_be_read(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows and not any(all(r[c] is None for r in rows) for c in rows[0].__fields__)


def test_secret_query_against_brute_force(spark, tmp_dir):
    """The query's rows over the given texts and planted ones, among them parts that are only reported together."""
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts = dict(given + [(10**6 + i, t) for i, t in CASES if i is not None])
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    rows = QUERIES["op1_secret_links"](spark, tmp_dir).collect()
    assert len(rows) == len(texts) and all(any(r[f"n_{k}"] for r in rows) for k in ("assign", "access", "hex"))
    assert all(any(f"{k}:" in r["spans"] for r in rows) for k in ("account", "opaque", "address"))
    joined = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    for r in rows:
        base, every = brute(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest() and r["spans"] == joined(every)

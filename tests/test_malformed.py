"""Records whose fields do not match their header, numbers that do not fit, and the shapes of the duplicate search."""
import os

import pytest
from helpers import reasons, sales_bronze, text_bronze

from strata.constants import REASON_DUPLICATE, REASON_MALFORMED_ROW, REASON_MISSING_CATEGORY, REASON_OUT_OF_RANGE
from strata.operators.dedup import Repeats, key_groups, latest_per_key, not_latest, repeated_bits, repeats
from strata.operators.guard import GuardError, guarded_sql
from strata.operators.layers import FIELD_COUNT, MALFORMED
from strata.operators.model import Profile
from strata.operators.quarantine import quarantine, quarantine_sales, sales_row_rules
from strata.operators.silver import silver, silver_sales
from strata.plans.medallion import run_medallion
from strata.sources import files as IO

LINES = ["2031-02-03,Lamps, big,9.00,4.00,2", "2031-02-03,Lamps,9.00,4.00", "2031-02-04,Lamps,9.00,4.00,2,extra", "2031-02-05,Lamps,9.00,4.00,3000000000",
         "2031-02-06,Lamps,9.00,4.00,2", "2031-02-06,Lamps,9.00,4.00,2", '2031-02-07,"Lamps, ""big""",9.00,4.00,2', "2031-02-08,,9.00,4.00,2"]


def _landing(tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write("\n".join(["date,category,revenue,cost,units_sold", *LINES]) + "\n")
    return f"{tmp_dir}/in"


@pytest.mark.parametrize("multi_line", [False, True])
def test_records_of_other_lengths_are_kept_and_named(spark, tmp_dir, multi_line):
    b = IO.read_landing_csv(spark, _landing(tmp_dir), multi_line=multi_line, run_ts="2031-01-01 00:00:00")
    got = {(r["date"], r[FIELD_COUNT], r[MALFORMED]) for r in b.collect() if r[MALFORMED] is not None}
    assert got == {("2031-02-03", 6, LINES[0]), ("2031-02-03", 4, LINES[1]), ("2031-02-04", 6, LINES[2])}
    assert b.select("date").count() == b.count() == len(LINES)  # also where only some columns are read
    s, q = silver_sales(b), quarantine_sales(b)
    assert {str(r["date"]) for r in s.collect()} == {"2031-02-06", "2031-02-07"}
    assert reasons(q) == sorted([REASON_MALFORMED_ROW] * 3 + [REASON_OUT_OF_RANGE, REASON_DUPLICATE, REASON_MISSING_CATEGORY])
    assert reasons(sales_row_rules(b)) == sorted([REASON_MALFORMED_ROW] * 3 + [REASON_OUT_OF_RANGE, REASON_MISSING_CATEGORY])


def test_profile_rules_name_them_once(spark, tmp_dir):
    b = IO.read_landing_csv(spark, _landing(tmp_dir), run_ts="2031-01-01 00:00:00")
    p = Profile.of({"date": "date", "category": "dimension", "revenue": "measure", "cost": "measure", "units_sold": "measure"})
    q, s = quarantine(b, p), silver(b, p)
    assert reasons(q).count(REASON_MALFORMED_ROW) == 3 and reasons(q).count(REASON_DUPLICATE) == 1
    assert s.count() + q.count() == len(LINES)


def test_whole_flow_accounts_for_every_record(spark, tmp_dir):
    layers = run_medallion(spark, _landing(tmp_dir), f"{tmp_dir}/lake", export=False)
    audit = {r["check"]: r["value"] for r in layers.audit.collect()}
    assert audit["unaccounted_rows"] == 0 and audit[f"rejections: {REASON_MALFORMED_ROW}"] == 3
    found = run_medallion(spark, f"{tmp_dir}/in", f"{tmp_dir}/other", profile_from_data=True, export=False)
    assert MALFORMED not in found.profile.names and FIELD_COUNT not in found.profile.names


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _written(spark, tmp_dir, n=400):
    rows = [(f"2031-01-{1 + i % 28:02d}", f"C{i // 2 if i < 40 else i}", "5.00", "1.00", "2", f"2031-03-01 00:00:{i % 60:02d}") for i in range(n)]
    sales_bronze(spark, rows).write.parquet(f"{tmp_dir}/b")
    return spark.read.parquet(f"{tmp_dir}/b")


KEYS, ROW_ID = ["category"], ["_row_id"]


def test_only_rows_of_repeated_keys_are_shuffled(spark, tmp_dir):
    b = _written(spark, tmp_dir)
    known = Repeats(*(x.checkpoint() for x in (lambda r: (r.bits, r.groups))(repeats(b, KEYS, ROW_ID))))
    assert known.groups.count() < 40  # the twenty repeated keys, and few others
    p = _plan(latest_per_key(b, KEYS, ROW_ID, known=known))
    assert "SortAggregate" not in p and "hashpartitioning" not in p  # rows alone with their key stay where they are read
    q = _plan(not_latest(b, KEYS, ROW_ID, known=known))
    assert "LeftOuter, BuildRight" in q and "Inner" in q and q.count("FileScan") == 1


def test_bronze_is_joined_with_nothing_but_bits(spark, tmp_dir):
    outer = [ln for ln in _plan(quarantine_sales(_written(spark, tmp_dir))).splitlines() if "Join" in ln and "LeftOuter" in ln]
    assert outer and all("BroadcastHashJoin [pmod(" in ln for ln in outer)


def test_bits_may_collide_without_loss(spark, tmp_dir):
    """With every bit set, all rows are candidates and the result is the same."""
    b = _written(spark, tmp_dir)
    full = spark.range(1 << 17).selectExpr("id AS _word", "-1L AS _bits")
    every = Repeats(full, key_groups(b, KEYS, ROW_ID))
    one = repeats(b, KEYS, ROW_ID)
    for f in (latest_per_key, not_latest):
        assert sorted(map(tuple, f(b, KEYS, ROW_ID, known=every).collect())) == sorted(map(tuple, f(b, KEYS, ROW_ID, known=one).collect()))
    assert repeated_bits(b.limit(0), KEYS).count() == 0


def test_null_keys_are_equal(spark):
    b = text_bronze(spark, ["k", "v"], [(None, "a"), (None, "b"), ("x", "c"), ("", "d")])
    kept, gone = latest_per_key(b, ["k"], ROW_ID), not_latest(b, ["k"], ROW_ID)
    assert sorted(r["v"] for r in kept.collect()) == ["b", "c", "d"] and [r["v"] for r in gone.collect()] == ["a"]


@pytest.mark.parametrize("sql", ["SELECT * FROM IDENTIFIER('other.t')", "SELECT * FROM parquet.`/x`", "SELECT input_file_name() FROM guard_m",
                                 "SELECT (SELECT max(x) FROM other.t) AS n", "WITH t AS (SELECT * FROM other.t) SELECT * FROM t",
                                 "SELECT java_method('a', 'b')", "SELECT * FROM guard_m WHERE x IN (SELECT x FROM other.t)", "SELECT own_udf(x) FROM guard_m",
                                 "SELECT TRANSFORM(x) USING 'cat' FROM guard_m"])
def test_plan_walk_refuses(spark, sql):
    spark.range(3).selectExpr("id AS x").createOrReplaceTempView("guard_m")
    spark.udf.register("own_udf", lambda x: x)
    with pytest.raises(GuardError):
        guarded_sql(spark, sql)


@pytest.mark.parametrize("sql", [
    "SELECT a.x, row_number() OVER (ORDER BY a.x) AS n FROM guard_m a JOIN guard_m b ON a.x = b.x WHERE a.x IN (SELECT x FROM guard_m) ORDER BY 1 LIMIT 5",
    "WITH t AS (SELECT x, upper(concat('a', x)) AS y FROM guard_m), u AS (SELECT * FROM t) SELECT y, count(*) AS n, sum(x), avg(x) FROM u GROUP BY y HAVING count(*) > 0",
    "SELECT * FROM (VALUES (1, 'a')) v(x, y) UNION ALL SELECT x, 'b' FROM guard_m", "SELECT e FROM guard_m LATERAL VIEW explode(array(x, 2)) t AS e",
    "SELECT x, coalesce(x, 0), CASE WHEN x > 1 THEN round(x / 2, 1) END, date_format(date'2031-01-01', 'yyyy'), nullif(x, 1), cast(x AS string) FROM guard_m",
    "SELECT DISTINCT x FROM guard_m EXCEPT SELECT 1", "SELECT id FROM range(3)", "SELECT * FROM guard_m PIVOT (count(*) FOR x IN (1, 2))"])
def test_plan_walk_lets_queries_pass(spark, sql):
    spark.range(3).selectExpr("id AS x").createOrReplaceTempView("guard_m")
    guarded_sql(spark, sql).collect()

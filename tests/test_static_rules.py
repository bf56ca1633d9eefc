"""Baseline sales rules against a plain statement of them, over every combination of a few field values."""
import datetime as dt
import itertools
from collections import Counter

from helpers import reasons, sales_bronze

from strata.constants import (
    REASON_DUPLICATE, REASON_MALFORMED_NUMERIC, REASON_MISSING_CATEGORY, REASON_MISSING_DATE, REASON_NEGATIVE_ANY, REASON_NEGATIVE_COL,
    REASON_NULL_REQUIRED, REASON_UNPARSEABLE_DATE,
)
from strata.operators.audit import dq_audit
from strata.operators.gold import gold_monthly
from strata.operators.model import Profile
from strata.operators.quarantine import quarantine, quarantine_sales
from strata.operators.silver import silver, silver_sales

T = "2033-11-30 06:00:0{}"
GRID = list(itertools.product([None, "", "None", "2033-11-02", "2033-11-03 19:20:21"], [None, "", "None", "none", "Rope"],
                              ["16.5", "0", "-0.01", None], ["3.25", "-4", ""], ["6", "-1", "1.6"]))


def number(text):
    return float(text) if text else None


def judged(row):
    """The reason of a row that is alone with its key; None for silver, 'neither' where a measure is missing."""
    date, category, *measures = row
    if date in (None, "", "None"):
        return REASON_MISSING_DATE
    if category in (None, "", "None"):
        return REASON_MISSING_CATEGORY
    values = [number(m) for m in measures]
    if any(v is not None and v < 0 for v in values):
        return REASON_NEGATIVE_ANY
    return "neither" if None in values else None


def one_of_each(spark):
    """The grid without rows that share a key, so that no row is a copy."""
    first = {}
    for r in GRID:
        first.setdefault((r[0], r[1], r[4], r[2]) if judged(r) not in (REASON_MISSING_DATE, REASON_MISSING_CATEGORY) else r, r)
    rows = list(first.values())
    return rows, sales_bronze(spark, [(*r, T.format(0)) for r in rows])


def test_every_combination_of_values(spark):
    rows, b = one_of_each(spark)
    want = Counter(map(judged, rows))
    assert Counter(reasons(quarantine_sales(b))) == {k: n for k, n in want.items() if k not in (None, "neither")}
    got = {(str(r["date"]), r["category"], r["revenue"], r["cost"], r["units_sold"], r["profit"]) for r in silver_sales(b).collect()}
    assert got == {(d[:10], c, float(r), float(k), {"6": 6, "1.6": 2}[u], float(r) - float(k)) for d, c, r, k, u in rows if judged((d, c, r, k, u)) is None}


def test_audit_accounts_for_the_grid(spark):
    rows, b = one_of_each(spark)
    s, q = silver_sales(b), quarantine_sales(b)
    audit = {r["check"]: r["value"] for r in dq_audit(b, s, q, gold_monthly(s)).collect()}
    assert audit["unaccounted_rows"] == sum(judged(r) == "neither" for r in rows) > 0
    assert audit["null_violations_in_silver"] == 0 and audit["financial_discrepancy"] == 0


def test_the_newest_copy_stays_and_may_be_a_bad_one(spark):
    key = ("2033-11-04", "Sail")
    b = sales_bronze(spark, [(*key, "8", "1", "2", T.format(1)), (*key, "8", "5", "2", T.format(3)), (*key, "8", "9", "2", T.format(2)),
                             (*key, "7", "1", "2", T.format(1)), (*key, "7", "-1", "2", T.format(2))])
    assert [(r["date"], r["cost"]) for r in silver_sales(b).collect()] == [(dt.date(2033, 11, 4), 5.0)]
    q = sorted((r["raw_revenue"], r["raw_cost"], r["rejection_reason"]) for r in quarantine_sales(b).collect())
    assert q == [("7", "-1", REASON_NEGATIVE_ANY), ("7", "1", REASON_DUPLICATE), ("8", "1", REASON_DUPLICATE), ("8", "9", REASON_DUPLICATE)]


def test_gold_of_two_months(spark):
    rows = [("2033-11-05", "Oar", "30", "12", "3"), ("2033-11-06", "Keel", "30", "18", "1"), ("2033-12-01", "Oar", "5", "9", "2"), ("2033-12-02", "Keel", "4", "1", "2")]
    g = [tuple(r) for r in gold_monthly(silver_sales(sales_bronze(spark, [(*r, T.format(0)) for r in rows]))).collect()]
    assert g == [("2033-11", 60.0, 30.0, 0.5, 4, "Keel"), ("2033-12", 9.0, 10.0, -0.1111, 4, "Oar")]  # of equal revenues the first name


def test_both_rule_sets_on_rows_with_one_fault(spark):
    sound = ["2033-11-08", "Mast", "11", "2", "3"]
    faults = [(0, "", REASON_MISSING_DATE, REASON_NULL_REQUIRED.format(col="date")), (1, "None", REASON_MISSING_CATEGORY, REASON_NULL_REQUIRED.format(col="category")),
              (2, "-6", REASON_NEGATIVE_ANY, REASON_NEGATIVE_COL.format(col="revenue")), (4, "-6", REASON_NEGATIVE_ANY, REASON_NEGATIVE_COL.format(col="units_sold"))]
    rows = [tuple(sound[:i] + [v] + sound[i + 1:]) for i, v, _, _ in faults] + [tuple(sound)]
    b = sales_bronze(spark, [(*r, T.format(0)) for r in rows])
    p = Profile.of({"date": "date", "category": "dimension", "revenue": "measure", "cost": "measure", "units_sold": "measure"})
    assert reasons(quarantine_sales(b)) == sorted(f[2] for f in faults) and reasons(quarantine(b, p)) == sorted(f[3] for f in faults)
    assert silver_sales(b).count() == silver(b, p).count() == 1


def test_extensions_name_what_the_base_rules_pass_over(spark):
    b = sales_bronze(spark, [("33/11/9", "Rope", "1", "1", "1", T.format(0)), ("2033-11-09", "Rope", "1,5", "1", "1", T.format(0)), ("2033-11-10", "Rope", "1", "1", "1", T.format(0))])
    assert reasons(quarantine_sales(b)) == [] and silver_sales(b).where("date IS NULL").count() == 1
    assert reasons(quarantine_sales(b, extensions=True)) == sorted([REASON_UNPARSEABLE_DATE.format(col="date"), REASON_MALFORMED_NUMERIC.format(col="revenue")])
    assert [str(r["date"]) for r in silver_sales(b, extensions=True).collect()] == ["2033-11-10"]

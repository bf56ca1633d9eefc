"""Profile-driven rules on three small domains: 5 rows → 2 silver, 3 quarantined."""
import pytest
from helpers import reasons, text_bronze

from strata.operators.gold import gold_agg, gold_options
from strata.operators.model import Profile
from strata.operators.profile import build_profile
from strata.operators.quarantine import quarantine
from strata.operators.silver import silver

SHOP = (["date", "category", "revenue", "cost", "units_sold"],
        [("2026-01-07", "Garden", "800.00", "500.00", "4"),
         ("2026-01-07", "Garden", "800.00", "500.00", "4"),
         ("2026-02-11", None, "20.00", "12.00", "1"),
         ("2026-03-02", "Toys", "-15.00", "6.00", "3"),
         ("2026-04-18", "Kitchen", "410.00", "205.00", "2")],
        {"date": "date", "category": "dimension", "revenue": "measure", "cost": "measure", "units_sold": "measure"})
STAFF = (["employee_id", "name", "department", "salary", "hire_date"],
         [("E7", "Ann Lee", "Finance", "71000.00", "2026-01-03"),
          ("E7", "Ann Lee", "Finance", "71000.00", "2026-01-03"),
          ("E8", "Raj Patel", "", "64000.00", "2026-01-20"),
          ("E9", "Mo", "Legal", "-1.00", "2026-02-09"),
          ("E10", "Kim Park", "Support", "52000.00", "2026-03-30")],
         {"employee_id": "id", "name": "text", "department": "dimension", "salary": "measure", "hire_date": "date"})
CLAIMS = (["patient_id", "claim_id", "claim_date", "diagnosis_code", "claim_amount", "copay"],
          [("P10", "C1", "2026-05-01", "K21.0", "310.00", "25.00"),
           ("P10", "C1", "2026-05-01", "K21.0", "310.00", "25.00"),
           ("P11", "C2", "2026-05-02", "None", "95.00", "10.00"),
           ("P12", "C3", "2026-05-03", "M54.5", "-40.00", "5.00"),
           ("P13", "C4", "2026-05-04", "R51", "600.00", "0.00")],
          {"patient_id": "id", "claim_id": "id", "claim_date": "date", "diagnosis_code": "dimension",
           "claim_amount": "measure", "copay": "measure"})


@pytest.mark.parametrize("domain", [SHOP, STAFF, CLAIMS], ids=["shop", "staff", "claims"])
def test_five_rows_two_silver_three_quarantined(spark, domain):
    cols, rows, roles = domain
    b = text_bronze(spark, cols, rows)
    p = Profile.of(roles)
    assert silver(b, p).count() == 2
    q = reasons(quarantine(b, p))
    assert len(q) == 3 and "Duplicate Transaction" in q


@pytest.mark.parametrize("domain", [SHOP, STAFF, CLAIMS], ids=["shop", "staff", "claims"])
def test_rules_reproduce_declared_roles(spark, domain):
    cols, rows, roles = domain
    prof = build_profile(text_bronze(spark, cols, rows), cols)
    assert {c.name: c.role for c in prof.columns} == roles


def test_double_violation_is_quarantined_twice(spark):
    cols, _, roles = SHOP
    b = text_bronze(spark, cols, [("", None, "-1.00", "-2.00", "1")])
    q = reasons(quarantine(b, Profile.of(roles)))
    assert q == ["Negative Numeric Metric: cost", "Negative Numeric Metric: revenue",
                 "Null value in required column: category", "Null value in required column: date"]


def test_dynamic_keeps_older_copy_when_newest_is_negative(spark):
    cols, _, roles = SHOP
    b = spark.createDataFrame(
        [("2026-01-07", "Garden", "800.00", "500.00", "4", __import__("datetime").datetime(2026, 1, 8), "a.csv", 0),
         ("2026-01-07", "Garden", "800.00", "-5.00", "4", __import__("datetime").datetime(2026, 1, 9), "b.csv", 1)],
        "date string, category string, revenue string, cost string, units_sold string, ingested_at timestamp, "
        "source_file string, _row_id bigint")
    s = silver(b, Profile.of(roles)).collect()
    assert len(s) == 1 and s[0]["cost"] == 500.0


def test_gold_aggregates_and_names(spark):
    cols, rows, roles = STAFF
    s = silver(text_bronze(spark, cols, rows), Profile.of(roles))
    g = gold_agg(s, ["department"], [("avg", "salary", "salary"), ("count", "employee_id", "employee_count")],
                 date_col="hire_date")
    assert g.columns == ["month", "department", "salary", "employee_count"]
    got = sorted((r["month"], r["department"], r["salary"], r["employee_count"]) for r in g.collect())
    assert got == [("2026-01", "Finance", 71000.0, 1), ("2026-03", "Support", 52000.0, 1)]


def test_gold_options_shape():
    p = Profile.of(SHOP[2])
    opts = gold_options(p)
    assert 3 <= len(opts) <= 5
    assert all(o.date_col == "date" for o in opts)
    assert opts[0].dims == ("category",) and {a.func for a in opts[0].aggs} == {"sum"}
    assert "GROUP BY" in opts[0].sql()


def test_dynamic_extensions_keep_layers_disjoint(spark):
    cols, _, roles = SHOP
    b = text_bronze(spark, cols, [("2026-13-40", "Garden", "1.00", "1.00", "1"),
                                  ("2026-01-07", "Garden", "x1", "1.00", "1"),
                                  ("2026-01-08", "Toys", "2.00", "1.00", "1")])
    p = Profile.of(roles)
    assert reasons(quarantine(b, p, extensions=True)) == ["Malformed Numeric Metric: revenue",
                                                          "Unparseable Date: date"]
    assert [r["category"] for r in silver(b, p, extensions=True).collect()] == ["Toys"]
    assert silver(b, p).count() == 2          # default: the unparseable date passes with a NULL date


def test_gold_options_shapes_by_profile():
    two_dims = Profile.of({"d": "date", "a": "dimension", "b": "dimension", "m": "measure", "k": "id"})
    opts = gold_options(two_dims)
    assert len(opts) == 5
    assert [o.dims for o in opts[:3]] == [("a",), ("b",), ("a", "b")]
    assert {a.func for a in opts[3].aggs} == {"avg"} and opts[4].aggs[0].func == "count"
    no_dim = gold_options(Profile.of({"d": "date", "m": "measure"}))
    assert 3 <= len(no_dim) <= 5 and all(o.dims == () and o.date_col == "d" for o in no_dim)
    no_date = gold_options(Profile.of({"a": "dimension", "m": "measure"}))
    assert all(o.date_col is None for o in no_date) and no_date[0].dims == ("a",)
    assert "GROUP BY `a`" in no_date[0].sql() and "date_format" not in no_date[0].sql()


def test_gold_options_order_dimensions_by_cardinality(spark):
    cols = ["day", "wide", "narrow", "amt"]
    rows = [("2026-01-0%d" % (1 + i % 3), f"w{i}", "n%d" % (i % 2), f"{i}.0") for i in range(12)]
    prof = build_profile(text_bronze(spark, cols, rows), cols)
    assert gold_options(prof)[0].dims == ("narrow",)
    s = silver(text_bronze(spark, cols, rows), prof)
    assert gold_options(prof)[0].apply(s).count() == 2           # one month × two narrow values

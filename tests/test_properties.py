"""Property tests: the window-free dedup equals a brute-force ROW_NUMBER over random bronze."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.quarantine import quarantine_sales
from strata.operators.silver import silver_sales

SCHEMA = ("date string, category string, revenue string, cost string, units_sold string, "
          "ingested_at timestamp, source_file string, _row_id bigint")

row = st.tuples(st.sampled_from([None, "", "None", "2026-01-01", "2026-01-02"]),
                st.sampled_from([None, "", "A", "B"]),
                st.sampled_from(["10.00", "-1.00", "20.00"]),
                st.sampled_from(["5.00", "-2.00", "7.50"]),
                st.sampled_from(["1", "2", "-1"]),
                st.integers(0, 2), st.sampled_from(["f1.csv", "f2.csv"]))


def _missing(v):
    return v is None or v in ("None", "")


def brute_force(rows):
    """Reference semantics written out: cascade of row rules, then
    ROW_NUMBER() OVER (PARTITION BY date, category, units_sold, revenue
    ORDER BY ingested_at DESC, source_file DESC, raw columns DESC)."""
    silver, quarantine = [], []
    dated = [r for r in rows if not _missing(r[0]) and not _missing(r[1])]
    groups = {}
    for r in dated:
        groups.setdefault((r[0], r[1], r[4], r[2]), []).append(r)
    rank = {}
    for g in groups.values():
        g.sort(key=lambda r: (r[5], r[6], r[0], r[1], r[2], r[3], r[4]), reverse=True)
        for i, r in enumerate(g):
            rank[r[7]] = i + 1
    for r in rows:
        neg = float(r[2]) < 0 or float(r[3]) < 0 or int(r[4]) < 0
        if _missing(r[0]):
            quarantine.append("Missing/Invalid Date")
        elif _missing(r[1]):
            quarantine.append("Missing/Invalid Category")
        elif neg:
            quarantine.append("Negative Numeric Metric(s)")
        elif rank[r[7]] > 1:
            quarantine.append("Duplicate Transaction")
        if not _missing(r[0]) and not _missing(r[1]) and rank[r[7]] == 1 and not neg:
            silver.append((r[0], r[1], float(r[2]), float(r[3]), int(r[4])))
    return sorted(silver), sorted(quarantine)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=14))
def test_static_rules_match_brute_force(spark, rows):
    base = dt.datetime(2026, 1, 1)
    data = [(d, c, r, co, u, base + dt.timedelta(hours=h), f, i) for i, (d, c, r, co, u, h, f) in enumerate(rows)]
    b = spark.createDataFrame(data, SCHEMA)
    s = sorted((str(x["date"]), x["category"], x["revenue"], x["cost"], x["units_sold"]) for x in silver_sales(b).collect())
    q = sorted(x["rejection_reason"] for x in quarantine_sales(b).collect())
    plain = [(d, c, r, co, u, base + dt.timedelta(hours=h), f, i) for i, (d, c, r, co, u, h, f) in enumerate(rows)]
    es, eq = brute_force(plain)
    assert s == es
    assert q == eq
    # every bronze row is in silver, quarantine, or neither — never both
    assert len(s) + len(q) <= len(rows)


DYN_SCHEMA = ("k string, dim string, day string, amt string, ingested_at timestamp, source_file string, "
              "_row_id bigint")
dyn_row = st.tuples(st.sampled_from([None, "", "k1", "k2"]),
                    st.sampled_from([None, "None", "x", "y"]),
                    st.sampled_from([None, "", "2026-01-01", "2026-01-02"]),
                    st.sampled_from([None, "", "3.5", "-1", "0"]),
                    st.integers(0, 2), st.sampled_from(["a.csv", "b.csv"]))


def dyn_brute_force(rows, roles):
    """One quarantine row per violated rule; duplicates among fully valid rows only,
    keyed by the id columns, else dimensions + dates; latest copy first."""
    names = ["k", "dim", "day", "amt"]
    idx = {n: i for i, n in enumerate(names)}
    required = [n for n in names if roles[n] in ("date", "id", "dimension")]
    measures = [n for n in names if roles[n] == "measure"]
    ids = [n for n in names if roles[n] == "id"]
    keys = ids or ([n for n in names if roles[n] == "dimension"] + [n for n in names if roles[n] == "date"])
    reasons, valid = [], []
    for r in rows:
        for n in required:
            if _missing(r[idx[n]]):
                reasons.append(f"Null value in required column: {n}")
        for n in measures:
            if not _missing(r[idx[n]]) and float(r[idx[n]]) < 0:
                reasons.append(f"Negative Numeric Metric: {n}")
        if all(not _missing(r[idx[n]]) for n in required) and \
                all(not _missing(r[idx[n]]) and float(r[idx[n]]) >= 0 for n in measures):
            valid.append(r)
    groups = {}
    for r in valid:
        groups.setdefault(tuple(r[idx[k]] for k in keys), []).append(r)
    silver = []
    for g in groups.values():
        # NULL sorts below every string (NULLs last under DESC)
        g.sort(key=lambda r: (r[4], r[5]) + tuple((0, "") if v is None else (1, v) for v in r[:4]), reverse=True)
        silver.append(g[0][:4])
        reasons += ["Duplicate Transaction"] * (len(g) - 1)
    return sorted(silver, key=str), sorted(reasons)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(dyn_row, min_size=1, max_size=12), st.booleans())
def test_profile_rules_match_brute_force(spark, rows, with_id):
    from strata.operators.model import Profile
    from strata.operators.quarantine import quarantine
    from strata.operators.silver import silver
    roles = {"k": "id" if with_id else "text", "dim": "dimension", "day": "date", "amt": "measure"}
    base = dt.datetime(2026, 1, 1)
    data = [(k, d, day, a, base + dt.timedelta(hours=h), f, i) for i, (k, d, day, a, h, f) in enumerate(rows)]
    b = spark.createDataFrame(data, DYN_SCHEMA)
    p = Profile.of(roles)
    got_q = sorted(r["rejection_reason"] for r in quarantine(b, p).collect())
    got_s = sorted(((r["k"], r["dim"], None if r["day"] is None else str(r["day"]), r["amt"])
                    for r in silver(b, p).collect()), key=str)
    es, eq = dyn_brute_force(data, roles)
    exp_s = sorted(((k, d, day, float(a)) for k, d, day, a in es), key=str)
    assert got_q == eq
    assert got_s == exp_s

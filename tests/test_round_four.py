"""What a run leaves on the disks: shuffles that go with their statement, shares of the keys and months, vacuumed streams,
bronze that is only lent, compressed layers and landing files."""
import glob
import os
import random
import time

import pyarrow.parquet as pq
import pytest
from helpers import sales_bronze
from pyspark.sql import functions as F

from strata.operators.dedup import not_latest
from strata.operators.quarantine import quarantine, quarantine_sales, valid_repeats
from strata.operators.model import Profile
from strata.operators.silver import sales_repeats
from strata.plans import fixtures
from strata.plans.incremental import Lake
from strata.plans.medallion import run_medallion
from strata.plans.queries_io import _write_landing
from strata.session import checkpoint_dir, shuffles_removed
from strata.sources import files as IO
from strata.streaming.deliveries import stream_deliveries

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffles(spark):
    """Shuffle files in the folders of the session's block manager."""
    own = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    assert own
    return {f for d in own for f in glob.glob(f"{d}/*/shuffle_*.data")}


def _file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join(["date,category,revenue,cost,units_sold", *rows]) + "\n")
    return folder


def _rows(seed, n, months=(1, 2, 3, 4)):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    return [f"{pick(f'2031-{rng.choice(months):02d}-0{rng.randint(1, 4)}', '', 'None', 'soon')},{pick('A', 'B', '')},{pick('5.00', '7.25', '-1', 'x', '')},"
            f"{pick('1.00', '2.50')},{pick('1', '2')}" for _ in range(n)]


def _content(v):
    return (sorted(map(tuple, v.silver.drop("id", "cleaned_at").collect()), key=repr), sorted(map(tuple, v.quarantine.drop("quarantined_at").collect()), key=repr),
            sorted(map(tuple, v.gold.collect()), key=repr))


def test_a_layer_leaves_no_shuffle_behind(spark, tmp_dir):
    before = _shuffles(spark)
    df = spark.range(20000).selectExpr("id", "uuid() AS u").repartition(4, "id")
    IO.write_layer(df, f"{tmp_dir}/t")
    for _ in range(50):  # files are deleted soon after the statement
        if left := _shuffles(spark) - before:
            time.sleep(0.1)
    assert not left
    assert spark.conf.get(CLEANUP) == "false" and df.count() == 20000  # the frame can be read again


def test_writes_at_the_same_time_restore_the_setting(spark):
    old = spark.conf.get(CLEANUP)
    with shuffles_removed(spark):
        with pytest.raises(RuntimeError), shuffles_removed(spark):
            raise RuntimeError("lost")
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == old


def test_layers_are_compressed_by_zstd(spark, tmp_dir):
    IO.write_layer(spark.range(10), f"{tmp_dir}/t")
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in glob.glob(f"{tmp_dir}/t/*.parquet")} == {"ZSTD"}


def test_shares_of_the_keys_are_the_whole(spark, tmp_dir):
    rows = [(f"2031-01-{1 + i % 9:02d}", None if i % 17 == 0 else f"C{i % 4}", "-1" if i % 13 == 0 else "5.00", f"{i}.00", None if i % 11 == 0 else "1",
             f"2031-03-{1 + i % 28:02d} 00:00:00") for i in range(400)]
    b, prof = sales_bronze(spark, rows), Profile.of({"date": "date", "category": "dimension", "revenue": "measure"})
    text = lambda *q: sorted(str(r) for x in q for r in x.collect())
    for known in (None, sales_repeats(b)):
        parts = [quarantine_sales(b, run_ts="2031-05-01", known=known, share=(k, 3)) for k in range(3)]
        assert text(*parts) == text(quarantine_sales(b, run_ts="2031-05-01", known=known)) and all(text(p) for p in parts)
    for known in (None, valid_repeats(b, prof)):
        parts = [quarantine(b, prof, run_ts="2031-05-01", known=known, share=(k, 3)) for k in range(3)]
        assert text(*parts) == text(quarantine(b, prof, run_ts="2031-05-01", known=known))
    keys = ["category", "units_sold"]  # null in places
    assert text(*[not_latest(b, keys, ("_row_id",), share=(k, 4)) for k in range(4)]) == text(not_latest(b, keys, ("_row_id",)))


@pytest.mark.parametrize("profile", [None, {"date": "date", "category": "dimension", "revenue": "measure", "cost": "measure", "units_sold": "measure"}])
def test_a_run_in_shares_gives_the_same_layers(spark, tmp_dir, monkeypatch, profile):
    _file(f"{tmp_dir}/in", "a", _rows(1, 150))
    _file(f"{tmp_dir}/in", "b", _rows(2, 150))
    whole = _content(run_medallion(spark, f"{tmp_dir}/in", f"{tmp_dir}/whole", profile, run_ts="2031-09-01 00:00:00", export=False))
    monkeypatch.setattr(IO, "ROWS_PER_SHARE", 120)
    written, write = [], IO.write_layer
    monkeypatch.setattr(IO, "write_layer", lambda df, path, *a, **b: (written.append(path.rsplit("/", 1)[1]), write(df, path, *a, **b)))
    got = run_medallion(spark, f"{tmp_dir}/in", f"{tmp_dir}/whole", profile, run_ts="2031-09-01 00:00:00", export=False)  # replaces the first
    assert _content(got) == whole
    assert written.count("quarantine") == written.count("groups") == 3


def test_deliveries_in_shares_of_the_months_give_the_same_layers(spark, tmp_dir, monkeypatch):
    def delivered(name):
        lake = Lake(spark, f"{tmp_dir}/{name}")
        for i, months in enumerate(((1, 2, 3), (2, 4))):
            lake.deliver(_file(f"{tmp_dir}/d{i}", f"f{i}", _rows(i, 90, months)), run_ts=f"2031-09-0{i + 1} 00:00:00")
        return _content(lake.layers()), {layer: set(lake.manifest()[layer]) for layer in ("state", "silver", "gold")}

    whole = delivered("whole")
    monkeypatch.setattr(IO, "ROWS_PER_SHARE", 30)
    shares, of = [], Lake._shares
    monkeypatch.setattr(Lake, "_shares", lambda *a: shares.append(of(*a)) or shares[-1])
    assert delivered("shares") == whole
    assert len(shares[0]) > 1 and all(p and sorted({*p}) == sorted(p) for s in shares for p in s)


def test_a_stream_that_keeps_one_version_has_only_its_files(spark, tmp_dir):
    for i in range(3):
        _file(f"{tmp_dir}/in", f"f{i}", _rows(i, 40, (1, 2, 3) if i < 2 else (3,)))
    content = []
    for name, keep in (("all", None), ("one", 1)):
        lake = Lake(spark, f"{tmp_dir}/{name}")
        stream_deliveries(lake, f"{tmp_dir}/in", f"{tmp_dir}/c-{name}", "sales", max_files_per_trigger=1, run_ts="2031-09-01 00:00:00", keep=keep).awaitTermination()
        content.append(_content(lake.layers()))
        m = lake.manifest()
        there = {f"{tmp_dir}/{name}/{os.path.relpath(d, f'{tmp_dir}/{name}')}" for layer in ("state", "silver") for d, _, fs in os.walk(f"{tmp_dir}/{name}/{layer}")
                 if any(f.endswith(".parquet") for f in fs)}
        assert (there == {f for layer in ("state", "silver") for f in m[layer].values()}) == bool(keep)
        assert lake.version() == 3 and m["streams"] == {"sales": 2}
    assert content[0] == content[1]


def test_stored_groups_have_no_hash(spark, tmp_dir):
    lake = Lake(spark, f"{tmp_dir}/lake")
    lake.deliver(_file(f"{tmp_dir}/d", "f", _rows(5, 30)))
    assert "_kh" not in lake.read("state", lake.manifest()).columns


def test_bronze_for_a_landing_is_lent(spark, tmp_dir, monkeypatch):
    (spark.range(300).selectExpr("id AS l_orderkey", "id % 20 AS l_partkey", "id % 9 AS l_suppkey", "double(id % 5) AS l_quantity", "double(id) + 0.5 AS l_extendedprice",
                                 "0.05D AS l_discount", "if(id % 3 = 0, 'R', 'N') AS l_returnflag",
                                 "cast(date_add(date'2031-01-01', cast(id % 60 AS int)) AS timestamp) AS l_shipdate").write.parquet(f"{tmp_dir}/t/lineitem.parquet"))
    spark.range(20).selectExpr("id AS p_partkey", "concat('T', id % 3) AS p_type").write.parquet(f"{tmp_dir}/t/part.parquet")
    a, b = _write_landing(spark, f"{tmp_dir}/t")
    root = f"{checkpoint_dir(spark).removeprefix('file:')}/strata-scratch"
    assert not [n for n in os.listdir(root) if n.startswith("lent-")]
    assert all(f.endswith(".csv.gz") for p in (a, b) for f in os.listdir(p.removeprefix('file:')) if f.startswith("part-"))
    landed = IO.read_landing_csv(spark, [a, b], multi_line=True)
    stored = fixtures.stored_bronze(spark, f"{tmp_dir}/t", "sales")
    assert landed.count() == stored.count() == 400
    assert landed.agg(F.sum("revenue")).first() == stored.agg(F.sum("revenue")).first()
    with fixtures.lent_bronze(spark, f"{tmp_dir}/t", "sales") as rows:  # stored already: it stays
        assert rows.count() == 400
    assert fixtures.stored_bronze(spark, f"{tmp_dir}/t", "sales").count() == 400

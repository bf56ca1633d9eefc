"""End-to-end medallion run: landing CSV → bronze → silver + quarantine → gold,
exports and the data-quality audit.

Every layer is written before the next one reads it, so a lost executor
only recomputes from the last written layer and no stage carries the whole
lineage back to the landing files.  Silver and quarantine are computed
from the written bronze; gold from the written silver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.operators.audit import dq_audit
from strata.operators.gold import gold, gold_from_sql, gold_monthly
from strata.operators.model import Profile
from strata.operators.profile import build_profile
from strata.constants import BRONZE_TABLE, GOLD_TABLE, QUARANTINE_TABLE, SILVER_TABLE
from strata.operators.dedup import Repeats, with_hash, without_hash
from strata.operators.layers import raw_columns
from strata.operators.quarantine import quarantine, quarantine_sales, valid_repeats
from strata.operators.silver import sales_repeats, silver, silver_sales
from strata.session import discard, scratch_path
from strata.sources import files as IO
from strata.sources.catalog import attach_table, create_workspace


@dataclass
class Layers:
    bronze: DataFrame
    silver: DataFrame
    quarantine: DataFrame
    gold: DataFrame
    audit: DataFrame
    profile: Profile | None


def write_repeats(spark: SparkSession, find: Callable[[DataFrame | None, tuple[int, int]], Repeats], path: str, shares: int = 1) -> Repeats:
    """The repeated keys that ``find`` gives (for bits that are already written, or for None, and a share of the keys),
    written once: first their bits, then the groups of the rows they mark."""
    IO.write_layer(find(None, (0, 1)).bits, f"{path}/bits")
    bits = spark.read.parquet(f"{path}/bits")
    IO.write_shares(lambda share: without_hash(find(bits, share).groups), shares, f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")
    return Repeats(bits, with_hash(groups, [c for c in groups.columns if c not in ("_w", "_n")]))


def run_medallion(spark: SparkSession, landing: str, root: str, profile: Profile | dict | None = None,
                  profile_from_data: bool = False, gold_sql: str | None = None,
                  dedup_keys=None, run_ts=None, export: bool = True, extensions: bool = False,
                  workspace: str | None = None, refresh: bool = True, approx_profile: bool = False,
                  multi_line: bool = False) -> Layers:
    """Run every layer for the files under ``landing`` into folders under ``root``.

    Without a profile the baseline sales rules apply; with one (or with
    ``profile_from_data``) the profile-driven rules.  ``gold_sql`` (a read-only
    SELECT over ``silver_clean_sales``) replaces the default gold.  The repeated
    keys are written once, read by silver and quarantine, and deleted.
    ``refresh`` replaces bronze, so a second run over the same files gives the same
    layers; without it the files are appended to what bronze holds.  With
    ``workspace`` the layers are registered as tables of that tenant.
    ``extensions`` turns on the opt-in rejection reasons (unparseable dates,
    malformed numbers); ``approx_profile`` profiles in one pass with sketches."""
    IO.ingest_csv(spark, landing, f"{root}/bronze", run_ts=run_ts, refresh=refresh, multi_line=multi_line)
    bronze = spark.read.parquet(f"{root}/bronze")

    if isinstance(profile, dict):
        profile = Profile.from_dict(profile) if all(isinstance(v, dict) for v in profile.values()) \
            else Profile.of(profile)
    if profile is None and profile_from_data:
        profile = build_profile(bronze, raw_columns(bronze), approx=approx_profile)
        IO.write_profile(spark, profile, f"{root}/profile")

    scratch, shares = scratch_path(spark, "repeats"), IO.shares_of(bronze.count())
    find = (lambda bits, share: sales_repeats(bronze, bits=bits, share=share)) if profile is None else \
        (lambda bits, share: valid_repeats(bronze, profile, dedup_keys=dedup_keys, extensions=extensions, bits=bits, share=share))
    shared = {"known": write_repeats(spark, find, scratch, shares), "run_ts": run_ts, "extensions": extensions}
    if profile is None:
        s, q = silver_sales(bronze, **shared), lambda share: quarantine_sales(bronze, share=share, **shared)
    else:
        s = silver(bronze, profile, dedup_keys=dedup_keys, **shared)
        q = lambda share: quarantine(bronze, profile, dedup_keys=dedup_keys, share=share, **shared)
    IO.run_concurrently(lambda: IO.write_layer(s, f"{root}/silver"),
                        lambda: IO.write_shares(q, shares, f"{root}/quarantine"))
    discard(spark, scratch)
    s, q = spark.read.parquet(f"{root}/silver"), spark.read.parquet(f"{root}/quarantine")

    if gold_sql:
        g = gold_from_sql(spark, s, gold_sql)
    elif profile is None:
        g = gold_monthly(s)
    else:
        g = gold(s, profile)
    IO.write_layer(g, f"{root}/gold")
    g = spark.read.parquet(f"{root}/gold")

    if export:
        IO.export_csv(s, f"{root}/export/silver_clean_sales")
        # one file only where the rows are months; any other gold has as many rows as its keys
        IO.export_csv(g, f"{root}/export/gold_monthly_metrics", single_file=not gold_sql and profile is None)
    if workspace is not None:
        create_workspace(spark, workspace)
        for table, layer in ((BRONZE_TABLE, "bronze"), (SILVER_TABLE, "silver"), (QUARANTINE_TABLE, "quarantine"), (GOLD_TABLE, "gold")):
            attach_table(spark, workspace, table, f"{root}/{layer}")
    audit = dq_audit(bronze, s, q, g, profile)
    return Layers(bronze, s, q, g, audit, profile)

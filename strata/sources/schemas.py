"""Layer schemas: fixed for the baseline sales flow, derived from a profile otherwise."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from strata.constants import SALES_COLUMNS
from strata.operators.model import Profile

_ROLE_TYPE = {"date": DateType(), "measure": DoubleType(), "currency": DoubleType()}


def bronze_schema(profile: Profile | None = None) -> StructType:
    """Every raw column as text, then ``_ingest_id``, ``ingested_at``, ``source_file``, ``_row_id``."""
    cols = profile.names if profile else list(SALES_COLUMNS)
    return StructType([StructField(c, StringType()) for c in cols] + [
        StructField("_ingest_id", StringType()), StructField("ingested_at", TimestampType()),
        StructField("source_file", StringType()), StructField("_row_id", LongType())])


def silver_schema(profile: Profile | None = None) -> StructType:
    """``id``, each column typed by its role, ``cleaned_at``; the sales flow adds ``profit``."""
    if profile is None:
        return StructType([
            StructField("id", LongType()), StructField("date", DateType()), StructField("category", StringType()),
            StructField("revenue", DoubleType()), StructField("cost", DoubleType()),
            StructField("units_sold", IntegerType()), StructField("profit", DoubleType()),
            StructField("cleaned_at", TimestampType())])
    return StructType([StructField("id", LongType())] +
                      [StructField(c.name, _ROLE_TYPE.get(c.role, StringType())) for c in profile.columns] +
                      [StructField("cleaned_at", TimestampType())])


def quarantine_schema(profile: Profile | None = None) -> StructType:
    """``raw_<col>`` text columns, ``source_file``, ``ingested_at`` (text), reason, ``quarantined_at``."""
    cols = profile.names if profile else list(SALES_COLUMNS)
    return StructType([StructField(f"raw_{c}", StringType()) for c in cols] + [
        StructField("source_file", StringType()), StructField("ingested_at", StringType()),
        StructField("rejection_reason", StringType()), StructField("quarantined_at", TimestampType())])


GOLD_SALES_SCHEMA = StructType([
    StructField("month", StringType()), StructField("revenue", DoubleType()), StructField("cost", DoubleType()),
    StructField("profit_margin", DoubleType()), StructField("units_sold", LongType()),
    StructField("top_category", StringType())])

GOLD_SALES_PERCENT_SCHEMA = StructType([
    StructField("month", StringType()), StructField("total_revenue", DoubleType()),
    StructField("total_cost", DoubleType()), StructField("margin_pct", DoubleType()),
    StructField("total_units_sold", LongType()), StructField("top_category", StringType())])

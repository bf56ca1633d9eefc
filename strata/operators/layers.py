"""Bronze conventions shared by the silver and quarantine operators.

A bronze frame holds the raw columns as text plus the audit columns
``ingested_at`` (TIMESTAMP) and ``source_file`` (STRING) and a row
identity (default ``_ingest_id, ingested_at, source_file, _row_id``, as far as
the frame has them; any columns that together are unique per bronze row).  The identity only
has to be unique per bronze row; it is never shown in silver or quarantine.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ("ingested_at", "source_file")
#: What ingestion notes of a record whose fields do not match its header: its text, and how many fields it has.
MALFORMED, FIELD_COUNT = "_malformed", "_field_count"
# bronze written by strata.sources.files.ingest_csv: every ingest has an id of its
# own (two may share ingested_at), and _row_id is unique within an ingest
DEFAULT_ROW_ID = ("ingested_at", "source_file", "_ingest_id", "_row_id")


def raw_columns(bronze: DataFrame, row_id: Sequence[str] = DEFAULT_ROW_ID) -> list[str]:
    return [c for c in bronze.columns if c not in AUDIT_COLUMNS and c not in row_id and c not in (MALFORMED, FIELD_COUNT)]


def malformed_row(bronze: DataFrame) -> Column:
    """Whether ingestion noted a wrong number of fields (never, where bronze has no such note). Never NULL."""
    return F.col(MALFORMED).isNotNull() if MALFORMED in bronze.columns else F.lit(False)


def well_formed(bronze: DataFrame) -> DataFrame:
    """The rows with as many fields as their header, without the notes."""
    return bronze.where(~malformed_row(bronze)).drop(MALFORMED, FIELD_COUNT) if MALFORMED in bronze.columns else bronze


def identity_columns(bronze: DataFrame, row_id: Sequence[str] = DEFAULT_ROW_ID) -> list[str]:
    """Columns hashed into the silver surrogate id (raw, audit, identity; no repeats)."""
    cols = raw_columns(bronze, row_id) + list(AUDIT_COLUMNS)
    return cols + [c for c in row_id if c not in cols and c in bronze.columns]


def run_timestamp(run_ts=None) -> Column:
    """Audit timestamp: a fixed value when given (tests, reruns), else now."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts).cast("timestamp")


def surrogate_id(cols: Sequence[str]) -> Column:
    """Deterministic 64-bit row key (no global sort, stable across reruns)."""
    return F.xxhash64(*[F.col(c) for c in cols])

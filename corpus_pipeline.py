"""The corpus pipeline: quality rules, near-duplicate documents, repeated passages, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame: all but the last the columns of
``documents``, with the stage's decisions carried out. :func:`run` writes each result to the shared folder
and reads it again, so a stage that is lost with an executor starts from stored rows.

In every stage an empty table gives an empty result, further columns are passed on whatever they are called (packing
does not read them), a null ``doc_id`` is an id like any other, and rows that repeat id and text are treated alike.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm.best_fit import pack
from strata.llm.common import stored, table
from strata.llm.compact_windows import cut_repeats
from strata.llm.mcd_outliers import passing
from strata.llm.secret_links import mask
from strata.llm.simhash_cover import first_of_groups

#: No stage can be stated in SQL; tests/llm/test_corpus_pipeline.py holds each, and the run, against plain Python.
ORACLE_SQL = None
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go: null, empty and short ones, such as repeat themselves, and outliers of their
    language and source (null ones are groups of their own). Ties in distance are judged alike."""
    return passing(spark, docs)


def near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: 3-word shingles, at most 3 differing bits. It is the one with the
    smallest id, of several the one with the smallest text hash, of equal rows one. Texts without words are one group."""
    return first_of_groups(spark, docs, width=3, radius=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that near-repeat one of an earlier document (by id, null first) are cut out; a document
    that is such a passage stays with an empty text. Null, empty and shorter texts stay as they are."""
    return cut_repeats(spark, docs)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and what is linked to them are masked, overlapping spans as one. No row goes; null and empty texts stay."""
    return mask(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left, in sequences of 2048; a null or empty text is its end token alone."""
    return pack(spark, docs, TOKENIZER)


STAGES = [("quality_rules", quality_rules), ("near_documents", near_documents), ("repeated_passages", repeated_passages),
          ("secret_spans", secret_spans), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return docs

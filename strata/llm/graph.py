"""Connected components as Spark joins (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every neighbour of a node is hung on the smallest node around it."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    if large:
        out = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select("a", F.col("m").alias("b"))))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Label each node of ``edges(a, b)`` (two longs) with the smallest node of its component.

    Returns ``(node, label)``, one row for each node that has an edge to another node. Null ends and
    loops are ignored; no edges give no rows. Each round is two equi-joins, whose hot keys adaptive
    execution splits, and is written to the shared folder, so an executor can be lost at any time. The
    driver sees one count and one checksum a round."""
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna().filter("a != b")
    edges = stored(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "edges")
    seen = None
    while True:
        edges = stored(spark, _star(_star(edges, large=True), large=False), "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("a")).distinct().select("a", F.col("a").alias("b"))
    return edges.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("label"))

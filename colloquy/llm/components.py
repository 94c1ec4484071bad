"""Connected components by alternating large-star and small-star steps, written to the shared folder after each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them: the larger ones, or the smaller ones and the node itself."""
    if large:
        near = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.min("b").alias("m"))
        out = near.join(least, "a").select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the least node that links reach."""
    scratch = scratch or Scratch(edges.sparkSession)
    edges = scratch.written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        after = scratch.written(_star(_star(edges, large=True), large=False), "edges")
        scratch.drop(edges)
        edges = after
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select("b", "b").distinct().toDF("node", "component"))

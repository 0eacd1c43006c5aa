"""Connected components of a link table, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.cluster import discard, materialize


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none: its label."""
    ends = edges.select("u", F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.filter("out > 1 OR out + into > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); the label is the least node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each points all
    neighbours of a node at the least of them, until every node points at its label. The
    number of steps grows with the logarithm of the longest chain. Null or equal ends and
    repeated links do not matter; no links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(before, large)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` of ``components`` after more links: only classes are joined up, not nodes."""
    to_label = lambda links, end: (
        links.join(labels.select(F.col("node").alias(end), F.col("label").alias("_label")), end, "left")
        .withColumn(end, F.coalesce("_label", end))
        .drop("_label")
    )
    between = materialize(to_label(to_label(links.select("a", "b"), "a"), "b"), "between")
    higher = components(between)
    # A linked node without a label so far is a class of its own.
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    higher = higher.select(F.col("node").alias("label"), F.col("label").alias("_above"))
    return known.join(higher, "label", "left").select("node", F.coalesce("_above", "label").alias("label"))

"""Stored feed documents, one folder per country: ``<root>/<country>/*.xml``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.schemas import FEED_ITEM


def read_feeds(spark: SparkSession, feeds: dict[str, list[str]]) -> DataFrame:
    """Items of all feeds, one scan over all paths, tagged with the country of their path."""
    paths = [path.rstrip("/") for paths in feeds.values() for path in paths]
    items = spark.read.format("xml").option("rowTag", "item").schema(FEED_ITEM).load(paths)
    file = F.col("_metadata.file_path")
    # A path is a folder or a file; longer paths first, as one may lie within another.
    owners = sorted(((p.rstrip("/"), c) for c, ps in feeds.items() for p in ps), key=lambda x: -len(x[0]))
    bare = lambda path: F.lit(path.partition(":")[2].lstrip("/") if ":/" in path else path.lstrip("/"))
    country = F.coalesce(
        *[
            F.when(file.contains(F.concat(F.lit("/"), bare(p), F.lit("/"))) | file.endswith(F.concat(F.lit("/"), bare(p))), F.lit(c))
            for p, c in owners
        ]
    )
    return items.select(
        F.col("link").alias("url"),
        "title",
        F.col("pubDate").alias("published"),
        "summary",
        "description",
        country.alias("source_country"),
    )


def read_feed(spark: SparkSession, path: str, country: str) -> DataFrame:
    """Items of the feed documents below ``path``, tagged with the country."""
    return read_feeds(spark, {country: [path]})

"""Continuous layers: topic -> bronze -> silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.operators.silver import PARTITIONS, to_silver
from presswork.schemas import BRONZE
from presswork.sources.tables import append_stream, stream_table
from presswork.sources.topic import from_topic

POLL = "300 seconds"


def topic_to_bronze(messages: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """Append topic messages to the bronze table; started query."""
    return append_stream(from_topic(messages), path, checkpoint, every=every)


def bronze_to_silver(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    partition_by: tuple[str, ...] = PARTITIONS,
):
    """Append cleaned articles to the silver table; started query.

    ``processed_date`` is available for tables kept by day of processing.
    """
    silver = to_silver(bronze)
    if "processed_date" in partition_by:
        silver = silver.withColumn("processed_date", F.to_date("silver_processed_at"))
    return append_stream(silver, path, checkpoint, partition_by, every=every)


def bronze_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    return stream_table(spark, path, BRONZE, **options)

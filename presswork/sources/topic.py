"""Keyed message topic: JSON values, the key is the source country."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.schemas import ARTICLE_EVENT, BRONZE

TOPIC = "news.raw"


def to_topic(events: DataFrame) -> DataFrame:
    """``key`` and ``value`` of every validated event; nulls stay in the JSON."""
    fields = [F.col(f.name) for f in ARTICLE_EVENT.fields]
    return events.select(
        F.col("source_country").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def from_topic(messages: DataFrame) -> DataFrame:
    """Bronze rows out of topic messages.

    Old and new field names are read. A value that is no JSON object gives a row
    without ``id``, which the next layer drops.
    """
    event = F.from_json(F.col("value").cast("string"), BRONZE, {"mode": "PERMISSIVE"})
    bronze = messages.select(event.alias("event")).select("event.*")
    return bronze.withColumns(
        {
            "published_at": F.coalesce("published_at", "published"),
            "processed_timestamp": F.current_timestamp(),
        }
    )


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def write_topic(events: DataFrame, servers: str, topic: str = TOPIC) -> None:
    (
        to_topic(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )

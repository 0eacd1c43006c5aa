"""The batch jobs of a lake, from stored silver to the searchable collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.operators import collection, enrich, gold
from presswork.schemas import COLLECTION
from presswork.sources.buckets import clear_buckets, read_buckets, upsert_buckets
from presswork.sources.jsonl import newest_run, save_run
from presswork.sources.tables import overwrite_table, read_table

NLP_INPUT = "nlp_input_articles"
SEARCH_FEATURES = "search_recommender_features"
PUBLISHER_METRICS = "daily_publisher_metrics"
ENRICHED_TABLE = "nlp_enriched_articles"
FAILURES = "failed"


def build_gold(spark: SparkSession, silver_path: str, gold_root: str) -> dict[str, int]:
    """The three gold tables; each reads only its own columns of silver."""
    silver = read_table(spark, silver_path)
    tables = {
        NLP_INPUT: (gold.nlp_input_articles(silver), ["source_country", "published_date"]),
        SEARCH_FEATURES: (gold.search_recommender_features(silver), ["published_date"]),
        PUBLISHER_METRICS: (gold.daily_publisher_metrics(silver), ["published_date"]),
    }
    return {
        name: overwrite_table(df, f"{gold_root}/{name}", keys)
        for name, (df, keys) in tables.items()
    }


def build_documents(spark: SparkSession, gold_root: str, runs: str, **options) -> str:
    """Enrich the gold articles and save them as a new run."""
    return save_run(enrich.enrich(read_table(spark, f"{gold_root}/{NLP_INPUT}"), **options), runs)


def build_enriched(
    spark: SparkSession, runs: str, gold_root: str, partition_by: tuple[str, ...] = (), with_keywords: bool = False
) -> int:
    """Flatten the newest run into the enriched gold table."""
    flat = enrich.flatten(newest_run(spark, runs), with_keywords)
    return overwrite_table(flat, f"{gold_root}/{ENRICHED_TABLE}", partition_by)


def build_portal(documents: DataFrame, path: str) -> int:
    """Portal rows of enriched documents as a table of their own, kept by country.

    The portal's queries read its columns; nothing is enriched when they run.
    """
    return overwrite_table(enrich.portal_rows(documents), path, ["source_country"])


def read_collection(spark: SparkSession, folder: str) -> DataFrame:
    """The newest state of a collection; empty before the first index run."""
    return read_buckets(spark, folder, COLLECTION)


def index_newest_run(spark: SparkSession, runs: str, folder: str, embedder=None) -> int:
    """Upsert the newest run into the collection; number of articles indexed.

    The points are embedded once, into a table of their own. Of repeated articles the
    last in the run counts, and only the buckets that get any are written anew. Articles
    that could not be embedded are listed, with the reason, in the folder's ``failed`` table.
    """
    documents = newest_run(spark, runs, missing_ok=True, place="_place")
    tried = materialize(collection.points(documents, embedder, carry=["_place"], failed="_failed"), "points")
    points = tried.filter("_failed IS NULL").drop("_failed")
    upsert_buckets(points, folder, "point_id", "_place")
    failures = tried.filter("_failed IS NOT NULL").select("point_id", F.col("_failed").alias("reason"))
    overwrite_table(failures, f"{folder}/{FAILURES}")
    return points.select("point_id").distinct().count()


def clear_collection(spark: SparkSession, folder: str) -> None:
    clear_buckets(spark, folder)


def searchable(points: DataFrame) -> DataFrame:
    """Stored points as the flat frame the search operators take."""
    return points.select("point_id", "vector", "payload.*")

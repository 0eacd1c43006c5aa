"""Silver -> gold tables and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 30
SEARCH_SOURCE = (
    "id", "clean_title", "url", "domain", "word_count", "est_read_time_mins", "published_at_ts", "published_date",
)


def _mean(column: str, places: int = 2) -> Column:
    """Mean of an integer column, rounded as an exact decimal quotient."""
    total = F.sum(column).cast("decimal(28,0)")
    return F.round(total / F.count(column).cast("decimal(20,0)"), places).cast("double")


def long_enough(silver: DataFrame, min_words: int | None) -> DataFrame:
    """The length rule of stored silver, pushed into its scan.

    None skips it, for rows that come straight out of the silver job: there it
    has been applied, and a second test would clean every text once more.
    """
    return silver if min_words is None else silver.filter(F.col("word_count") >= min_words)


def nlp_input_articles(silver: DataFrame, min_words: int | None = MIN_WORDS) -> DataFrame:
    return long_enough(silver, min_words).select(
        F.col("id").alias("article_id"),
        "clean_title",
        "clean_content",
        F.concat_ws("\n\n", "clean_title", "clean_content").alias("full_text_payload"),
        "domain",
        "source_country",
        "published_at_ts",
        "published_date",
        F.current_timestamp().alias("created_at"),
    )


def search_recommender_features(silver: DataFrame, min_words: int | None = MIN_WORDS) -> DataFrame:
    """Articles as the search reads them; of silver it takes the columns in ``SEARCH_SOURCE``."""
    return long_enough(silver, min_words).select(
        F.col("id").alias("doc_id"),
        F.col("clean_title").alias("title"),
        "url",
        "domain",
        "word_count",
        "est_read_time_mins",
        "published_at_ts",
        "published_date",
        F.current_timestamp().alias("gold_indexed_at"),
    )


def daily_publisher_metrics(silver: DataFrame) -> DataFrame:
    """Articles, words and reading time by day, country and domain."""
    return (
        silver.groupBy("published_date", "source_country", "domain")
        .agg(
            F.count("id").alias("total_articles"),
            F.sum("word_count").alias("total_word_count"),
            _mean("word_count").alias("avg_word_count"),
            _mean("est_read_time_mins").alias("avg_read_time_mins"),
            F.max("published_at_ts").alias("latest_article_ts"),
            F.min("published_at_ts").alias("earliest_article_ts"),
        )
        .withColumn("gold_processed_at", F.current_timestamp())
    )


def quality_report(cleaned: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Kept and rejected rows, publishers, average words and breaking news.

    Rows are first reduced to one per country and domain, so the distinct
    counts run over publishers, not over articles.
    """
    kept = F.col("word_count") >= min_words
    publishers = cleaned.groupBy("source_country", "domain").agg(
        F.count("*").alias("seen"),
        F.count_if(kept).alias("kept"),
        F.sum(F.when(kept, F.col("word_count"))).alias("words"),
        F.count_if(kept & F.col("is_breaking_news")).alias("breaking"),
    )
    live = F.col("kept") > 0
    total = F.sum("words").cast("decimal(28,0)")
    return publishers.agg(
        F.coalesce(F.sum("kept"), F.lit(0)).alias("kept_rows"),
        F.coalesce(F.sum(F.col("seen") - F.col("kept")), F.lit(0)).alias("rejected_rows"),
        F.countDistinct(F.when(live, F.col("source_country"))).alias("countries"),
        F.countDistinct(F.when(live, F.col("domain"))).alias("domains"),
        F.round(total / F.nullif(F.sum("kept"), F.lit(0)).cast("decimal(20,0)"), 2)
        .cast("double")
        .alias("avg_word_count"),
        F.coalesce(F.sum("breaking"), F.lit(0)).alias("breaking_rows"),
    )


def country_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("source_country").agg(
        F.count("*").alias("total_articles"),
        F.count_if(F.col("is_breaking_news")).alias("breaking_articles"),
        _mean("word_count").alias("avg_word_count"),
    )

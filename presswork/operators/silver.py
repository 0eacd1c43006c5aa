"""Bronze -> silver: cleaned articles. One function for batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.binding import keep_where
from presswork.functions.dates import parse_published
from presswork.functions.text import domain_of, replace_tags

# --- Fixed values: order of the text columns, length rule, reading speed, layout.
TEXT_COLUMNS = ("full_content", "content", "summary_snippet", "extracted_text")
MIN_WORDS = 30
WORDS_PER_MINUTE = 200
PARTITIONS = ("source_country", "published_date")


def raw_text(columns: list[str], skip_empty: bool = False) -> Column:
    """First non-null text column that exists; ``skip_empty`` also passes over ''."""
    present = [F.col(c) for c in TEXT_COLUMNS if c in columns]
    if skip_empty:
        present = [F.nullif(c, F.lit("")) for c in present]
    return F.coalesce(*present, F.lit(""))


def space_count_words(text: Column) -> Column:
    """Size of a split on single spaces; 0 for null or empty text."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(
        F.size(F.split(text, " "))
    )


def read_minutes(word_count: Column) -> Column:
    return F.ceil(word_count / F.lit(WORDS_PER_MINUTE)).cast("int")


def clean_articles(
    bronze: DataFrame, skip_empty: bool = False, iso_dates: bool = False
) -> DataFrame:
    """Silver columns of every row with ``id`` and ``title``, before the length rule."""
    published_at = (
        F.coalesce("published_at", "published")
        if "published" in bronze.columns
        else F.col("published_at")
    )
    spaced = replace_tags(raw_text(bronze.columns, skip_empty), " ")
    timed = bronze.filter(F.col("id").isNotNull() & F.col("title").isNotNull()).withColumns(
        {
            "published_at": published_at,
            "published_at_ts": parse_published(published_at, iso_dates),
            "clean_title": F.trim(replace_tags(F.col("title"), " ")),
            "clean_content_raw": F.regexp_replace(spaced, r"\s+", " "),
            "domain": domain_of(F.col("url")),
        }
    )
    trimmed = timed.withColumns(
        {
            "published_date": F.to_date("published_at_ts"),
            "clean_content": F.trim("clean_content_raw"),
        }
    )
    counted = trimmed.withColumn("word_count", space_count_words(F.col("clean_content")))
    return counted.withColumns(
        {
            "est_read_time_mins": read_minutes(F.col("word_count")),
            "full_text_payload": F.concat_ws("\n\n", "clean_title", "clean_content"),
            "silver_processed_at": F.current_timestamp(),
        }
    )


def to_silver(
    bronze: DataFrame, skip_empty: bool = False, iso_dates: bool = False
) -> DataFrame:
    cleaned = clean_articles(bronze, skip_empty, iso_dates)
    return keep_where(cleaned, F.col("word_count") >= MIN_WORDS)


def documented_silver(bronze: DataFrame) -> DataFrame:
    """The documented variant: lower-cased text, floored reading time, more than
    five words, ISO dates also read, counts and flags cast."""
    lowered = {
        target: F.trim(F.lower(replace_tags(F.col(source), "")))
        for target, source in (("clean_title", "title"), ("clean_content", "content"))
    }
    present = F.col("id").isNotNull() & F.col("title").isNotNull()
    present = present & F.col("content").isNotNull() & F.col("url").isNotNull()
    word_count = F.expr("try_cast(word_count AS int)")
    return bronze.filter(present & (word_count > 5)).withColumns(
        lowered
        | {
            "published_at_ts": parse_published(F.col("published_at"), iso=True),
            "word_count": word_count,
            "is_breaking_news": F.expr("try_cast(is_breaking_news AS boolean)"),
            "est_read_time_mins": F.floor(word_count / F.lit(WORDS_PER_MINUTE)).cast("int"),
            "domain": domain_of(F.col("url")),
        }
    )

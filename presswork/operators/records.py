"""Feed entries -> validated article records.

An entry has ``url, title, published, summary, description, source_country`` and
the ``extracted_text`` of its page (empty or null when extraction failed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.binding import first_truthy, keep_where, let
from presswork.functions.text import count_words, strip, url_id
from presswork.schemas import ARTICLE_EVENT, REQUIRED_EVENT_FIELDS

# --- Fixed values: shortest text kept, length of a snippet.
MIN_WORDS = 30
SNIPPET_CHARS = 500

NO_LINK = "no link"
NO_TEXT = "insufficient text"


def _has_link() -> Column:
    return F.nullif(F.col("url"), F.lit("")).isNotNull()


def _title() -> Column:
    return F.coalesce(F.col("title"), F.lit("No Title"))


def feed_summary() -> Column:
    """Summary of an entry, else its description, else the empty string."""
    return F.coalesce(first_truthy(F.col("summary"), F.col("description")), F.lit(""))


def triage_entries(entries: DataFrame) -> DataFrame:
    """Every entry as a record, with the reason it is rejected for (null = kept).

    The page text is used when it has enough words, else the feed summary.
    """
    summary = feed_summary()

    def with_count(text: Column) -> Column:
        return F.struct(text.alias("content"), count_words(text).alias("word_count"))

    # Each text is stripped and counted once, the summary's only where it is used.
    page = let(
        let(strip(F.coalesce(F.col("extracted_text"), F.lit(""))), with_count),
        lambda p: F.when(p["word_count"] >= MIN_WORDS, p),
    )
    chosen = F.coalesce(page, let(strip(summary), with_count))
    staged = entries.select(
        "url",
        "source_country",
        _title().alias("title"),
        F.coalesce("published", F.lit("")).alias("published_at"),
        summary.alias("summary"),
        chosen.alias("chosen"),
    )
    return staged.select("*", "chosen.*").select(
        url_id(F.col("url")).alias("id"),
        "title",
        "url",
        "source_country",
        "content",
        "published_at",
        "word_count",
        F.lower("title").contains("breaking").alias("is_breaking_news"),
        F.substring("summary", 1, SNIPPET_CHARS).alias("summary_snippet"),
        F.when(~_has_link(), F.lit(NO_LINK))
        .when(F.col("word_count") < MIN_WORDS, F.lit(NO_TEXT))
        .alias("reject_reason"),
    )


def fetched_records(entries: DataFrame) -> DataFrame:
    """Records of the feed fetcher: kept entries only."""
    triaged = triage_entries(entries.filter(_has_link()))
    kept = keep_where(triaged, F.col("reject_reason").isNull())
    return kept.drop("reject_reason").withColumns(
        {"full_content": F.col("content"), "_ingested_at": _iso_now()}
    )


def rejected_entries(entries: DataFrame) -> DataFrame:
    return keep_where(triage_entries(entries), F.col("reject_reason").isNotNull())


def scraped_events(entries: DataFrame) -> DataFrame:
    """Events of the page scraper: entries with a link and a non-empty text."""
    text = F.col("extracted_text")
    kept = entries.filter(_has_link() & F.nullif(text, F.lit("")).isNotNull())
    events = kept.select(
        url_id(F.col("url")).alias("id"),
        _title().alias("title"),
        "url",
        "source_country",
        text.alias("content"),
        F.coalesce("published", F.lit("")).alias("published_at"),
        count_words(text).alias("word_count"),
        F.lower(_title()).contains("breaking").alias("is_breaking_news"),
        F.substring(text, 1, SNIPPET_CHARS).alias("summary_snippet"),
        text.alias("full_content"),
        url_id(F.col("url")).alias("article_id"),
        text.alias("extracted_text"),
        F.lit(None).cast("string").alias("ingest_timestamp"),
    )
    return events.select(*[F.col(f.name).cast(f.dataType) for f in ARTICLE_EVENT.fields])


def _iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def violations() -> Column:
    """Rules an event breaks, one text each."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(f"{name} is missing"))
        for name in REQUIRED_EVENT_FIELDS
    ]
    typed = [
        F.when(
            F.col(name).isNotNull() & F.expr(f"try_cast({name} AS {kind})").isNull(),
            F.lit(f"{name} is not {kind}"),
        )
        for name, kind in (("word_count", "int"), ("is_breaking_news", "boolean"))
    ]
    return F.array_compact(F.array(*missing, *typed))


def validate(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events, typed and with defaults, and rejects with their reasons."""
    checked = events.withColumn("violations", violations())
    defaults = {"is_breaking_news": F.lit(False), "summary_snippet": F.lit(""), "full_content": F.lit("")}
    valid = checked.filter(F.size("violations") == 0).select(
        *[
            F.coalesce(F.col(f.name).cast(f.dataType), defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in ARTICLE_EVENT.fields
        ]
    )
    return valid, checked.filter(F.size("violations") > 0)

"""Bronze articles derived from a ``documents`` table (doc_id, text, lang, source)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.binding import lookup
from presswork.functions.text import url_id

COUNTRY_OF_LANGUAGE = {"en": "US", "fr": "FR", "de": "DE", "es": "ES"}


def article_url() -> Column:
    return F.concat(
        F.lit("https://www."), "source", F.lit(".example.com/"), "lang", F.lit("/"), "doc_id"
    )


def article_title() -> Column:
    opening = F.when(F.col("doc_id") % 10 == 0, F.lit("Breaking: ")).otherwise(F.lit(""))
    return F.concat(opening, F.lit("<b>"), F.substring("text", 1, 60), F.lit("</b>"))


def published_at() -> Column:
    hours = F.make_interval(hours=F.col("doc_id").cast("int"))
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp") + hours
    return F.concat(F.date_format(moment, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def bronze_articles(documents: DataFrame) -> DataFrame:
    """One bronze record per document, as a fetcher would have stored it."""
    return documents.select(
        "doc_id",
        "lang",
        url_id(article_url()).alias("id"),
        article_url().alias("url"),
        article_title().alias("title"),
        F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("content"),
        lookup(COUNTRY_OF_LANGUAGE, F.col("lang"), "Global").alias("source_country"),
        published_at().alias("published_at"),
        F.lower(article_title()).contains("breaking").alias("is_breaking_news"),
    )


def dirty_articles(documents: DataFrame) -> DataFrame:
    """Bronze records as they come from several fetchers, with holes.

    By the id's remainder a record lacks its id or title, has its text in another column
    (with another text in a column that counts less, or an empty one in one that counts
    more), or has no date, one in another column, with an offset, or in no known form.
    """

    def where(divisor: int, rest: int, value: Column) -> Column:
        return F.when(F.col("doc_id") % divisor == rest, value)

    text, other = F.concat(F.lit("<p>"), "text", F.lit("</p>")), F.lit("some other text")
    date = published_at()
    iso = F.lit("2024-01-01T00:00:00Z")
    dated = (
        where(11, 5, F.lit("yesterday")).when(F.col("doc_id") % 11 == 7, F.replace(date, F.lit("GMT"), F.lit("+0200")))
        .when(F.col("doc_id") % 11 == 8, iso).when(F.col("doc_id") % 11 != 6, date)
    )
    return documents.select(
        F.when(F.col("doc_id") % 23 != 3, url_id(article_url())).alias("id"),
        F.when(F.col("doc_id") % 29 != 4, article_title()).alias("title"),
        article_url().alias("url"),
        F.coalesce(where(4, 0, text), where(12, 9, F.lit(""))).alias("full_content"),
        F.coalesce(where(4, 1, text), where(4, 0, other)).alias("content"),
        F.coalesce(where(4, 2, text), where(4, 1, other)).alias("summary_snippet"),
        F.coalesce(where(4, 3, text), where(4, 2, other)).alias("extracted_text"),
        lookup(COUNTRY_OF_LANGUAGE, F.col("lang"), "Global").alias("source_country"),
        dated.alias("published_at"),
        where(11, 6, date).alias("published"),
    )


def feed_entries(documents: DataFrame) -> DataFrame:
    """The same documents as feed entries, some of them with holes as real feeds have.

    By the id's remainder an entry lacks its link, title, date or page text, or has
    its text as description instead of summary.
    """

    def unless(divisor: int, rest: int, value: Column) -> Column:
        return F.when(F.col("doc_id") % divisor != rest, value)

    return documents.select(
        "doc_id",
        unless(19, 7, article_url()).alias("url"),
        unless(13, 5, article_title()).alias("title"),
        unless(17, 6, published_at()).alias("published"),
        unless(11, 4, F.col("text")).alias("summary"),
        F.when(F.col("doc_id") % 11 == 4, F.col("text")).alias("description"),
        lookup(COUNTRY_OF_LANGUAGE, F.col("lang"), "Global").alias("source_country"),
        unless(5, 2, F.col("text")).alias("extracted_text"),
    )

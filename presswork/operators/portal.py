"""Portal queries over portal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.dictionaries import CATEGORY_COLORS, SENTIMENT_MARKERS
from presswork.functions.binding import first_truthy, lookup
from presswork.functions.text import percentage, preview
from presswork.operators.ranking import number_rows
from presswork.operators.search import query_vector, related, scored
from presswork.operators.sentiment import polarity_band
from presswork.operators.topics import query_category
from presswork.schemas import VECTOR_SIZE

# --- Fixed values: filter columns and display sizes.
FACETS = ("predicted_category", "sentiment_label", "source_country")
CARDS_PER_ROW = 3
SNIPPET_CHARS, TEXT_CHARS, ENTITY_LIMIT = 120, 300, 15


def facets(rows: DataFrame) -> DataFrame:
    """Distinct values of the filter columns: ``facet, value, articles``.

    One pass; every row becomes a value per facet, counted before the shuffle.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in FACETS]
    )
    return (
        rows.select(F.inline(pairs))
        .groupBy("facet", "value")
        .agg(F.count("*").alias("articles"))
        .orderBy("facet", "value")
    )


def selected(
    categories: Sequence[str] | None = None,
    sentiments: Sequence[str] | None = None,
    countries: Sequence[str] | None = None,
) -> Column:
    """Condition of the three facet filters; None stands for every value."""
    condition = F.lit(True)
    for column, values in zip(FACETS, (categories, sentiments, countries)):
        if values is not None:
            condition = condition & F.col(column).isin(*values)
    return condition


def filter_articles(rows: DataFrame, **facet_values) -> DataFrame:
    return rows.filter(selected(**facet_values))


def kpis(rows: DataFrame, condition: Column) -> DataFrame:
    """Total, filtered total, topics and mean polarity of the filtered rows."""
    by_topic = rows.groupBy("predicted_category").agg(
        F.count("*").alias("n"),
        F.count_if(condition).alias("shown"),
        F.sum(F.when(condition, F.col("sentiment_polarity").cast("decimal(20,6)"))).alias("polarity"),
    )
    mean = F.sum("polarity") / F.nullif(F.sum("shown"), F.lit(0))
    return by_topic.agg(
        F.sum("n").alias("total_articles"),
        F.sum("shown").alias("filtered_articles"),
        F.count("predicted_category").alias("topics"),
        F.round(mean, 2).cast("double").alias("avg_sentiment"),
    )


def ranked_articles(
    rows: DataFrame, collection: DataFrame, query: Column, category: str | None = None
) -> DataFrame:
    """Portal rows found by a search, with their rank over the whole collection.

    ``category`` is the one the query names; it restricts the rows, not the ranks.
    """
    hits = scored(collection.select("article_id", "vector"), query)
    ranks = number_rows(hits, F.desc("similarity_score"), F.col("article_id"))
    if category is not None:
        rows = rows.filter(F.col("predicted_category") == category)
    return rows.join(ranks, "article_id")


def search_articles(rows: DataFrame, collection: DataFrame, text: str) -> DataFrame:
    """Portal rows in the order of a text search; a category the text names
    restricts them."""
    named = query_category(F.lit(text))
    wanted = rows.filter(named.isNull() | (F.col("predicted_category") == named))
    size = collection.select(F.size("vector")).first()
    query = query_vector(rows.sparkSession, text, size[0] if size else VECTOR_SIZE)
    return ranked_articles(wanted, collection, query)


def cards(rows: DataFrame) -> DataFrame:
    """Display columns of an article card."""
    return rows.withColumns(
        {
            "color": lookup(CATEGORY_COLORS, F.col("predicted_category"), "gray"),
            "marker": lookup(SENTIMENT_MARKERS, F.col("sentiment_label"), ""),
            "snippet": preview(F.col("extractive_summary"), SNIPPET_CHARS),
            "band": polarity_band(F.col("sentiment_polarity")),
        }
    )


def grid(
    rows: DataFrame,
    order: str | None = None,
    descending: bool = True,
    key: str = "article_id",
    per_row: int = CARDS_PER_ROW,
) -> DataFrame:
    """Row and column of every article on the page, by ``order`` and then key.

    Only key and order take part in the numbering; texts move once, in the join.
    """
    slim = rows.select(key) if order is None else rows.select(key, order)
    by = [] if order is None else [F.desc(order) if descending else F.asc(order)]
    at = number_rows(slim, *by, F.col(key), name="_at").select(key, "_at")
    return (
        rows.join(at, key)
        .withColumns({"grid_row": F.floor(F.col("_at") / per_row), "grid_col": F.col("_at") % per_row})
        .drop("_at")
    )


def detail(rows: DataFrame, article_id: str) -> DataFrame:
    """One article as the report shows it; empty when it does not exist."""
    return cards(rows.filter(F.col("article_id") == article_id)).withColumns(
        {
            "language": F.upper("detected_language"),
            "text_preview": preview(F.col("preprocessed_text"), TEXT_CHARS),
            "shown_entities": F.slice("ner_entities", 1, ENTITY_LIMIT),
        }
    )


def keyword_search(rows: DataFrame, words: str) -> DataFrame:
    """Articles with the words in title or text, case ignored."""
    needle = words.lower()
    return rows.filter(
        F.lower("title").contains(needle) | F.lower("full_news_text").contains(needle)
    )


def related_panel(
    collection: DataFrame, article_id: str, category: str, limit: int = 3
) -> DataFrame:
    """Related articles of the same category, with display defaults."""
    hits = related(collection, article_id, limit, category_bias=category)
    shown = F.coalesce(first_truthy(F.col("category")), F.lit(category))
    return hits.select(
        "article_id",
        F.coalesce("title", F.lit("Untitled article")).alias("title"),
        shown.alias("category"),
        lookup(CATEGORY_COLORS, shown, "gray").alias("color"),
        F.coalesce(first_truthy(F.col("sentiment_label")), F.lit("Neutral")).alias("sentiment"),
        F.coalesce("source_country", F.lit("N/A")).alias("country"),
        percentage(F.col("similarity_score")).alias("match"),
        "similarity_score",
    )

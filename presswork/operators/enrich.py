"""The nine text tasks over a table of articles, and the shapes built from them."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork import dictionaries as d
from presswork.functions.binding import first_truthy, hold, non_empty
from presswork.functions.models import Loader
from presswork.functions.text import clean_text, count_words
from presswork.operators.entities import extract_entities, extract_locations, with_known_places
from presswork.operators.language import FALLBACK, detect_language, translate, try_detect_with
from presswork.operators.sentiment import get_sentiment
from presswork.operators.summary import try_summarize
from presswork.operators.topics import best_category, category_scores, extract_keywords
from presswork.schemas import ENTITIES, LOCATIONS, NLP


def repair_text(text: Column) -> Column:
    """Undo UTF-8 read as Windows-1252; other texts stay as they are."""

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        import unicodedata

        def one(t):
            if t is None:
                return None
            try:
                t = t.encode("cp1252").decode("utf-8")
            except UnicodeError:
                pass
            return unicodedata.normalize("NFC", t)

        return pa.array([one(t.as_py()) for t in texts], pa.string())

    suspect = text.rlike(r"[ÃÂâ€]")
    return F.when(suspect, run(F.when(suspect, text))).otherwise(text)


def run_tasks(
    df: DataFrame,
    text: str = "full_text_payload",
    detector: Loader | None = None,
    translators: dict[str, Loader] | None = None,
    gazetteer: Sequence[str] | DataFrame = d.GAZETTEER,
    valences: dict[str, float] = d.VALENCES,
    repair: bool = True,
) -> DataFrame:
    """Add the results of all tasks as flat columns. Tasks 4 to 9 see English text.

    ``gazetteer`` is a short list of lower-cased names, or a table of any size (``name``).

    ``task_errors`` lists the tasks that failed on a row, ``error_reasons`` says why; the row
    goes on with English as its language, its text as it was, or the head of it as summary.
    """
    source = repair_text(F.col(text)) if repair else F.col(text)
    cleaned = hold(df.drop("cleaned_text"), cleaned_text=clean_text(source)).withColumns(
        {
            "_detected": (
                F.struct(detect_language(F.col("cleaned_text")).alias("value"), F.lit(None).cast("string").alias("error"))
                if detector is None
                else try_detect_with(F.col("cleaned_text"), detector)
            ),
            "cleaned_word_count": count_words(F.col("cleaned_text")),
        }
    )
    undetected = F.col("_detected.value").isNull() & F.col("cleaned_text").isNotNull()
    cleaned = cleaned.withColumns(
        {"detected_language": F.coalesce("_detected.value", F.lit(FALLBACK)), "_undetected": undetected, "_language_error": F.col("_detected.error")}
    ).drop("_detected")
    routed = translate(cleaned, "cleaned_text", "detected_language", translators)
    english, places = F.col("translated_text"), gazetteer
    if isinstance(gazetteer, DataFrame):
        routed = with_known_places(routed, "translated_text", gazetteer, "_places")
        places = F.col("_places")
    tagged = routed.withColumns(
        {
            "ner_entities": extract_entities(english, places),
            "category_scores": category_scores(english),
            "sentiment": get_sentiment(english, valences),
            "_summary": try_summarize(english),
        }
    )
    located = tagged.withColumns(
        {
            "extracted_locations": extract_locations(F.col("ner_entities"), places),
            "category": best_category(F.col("category_scores")),
        }
    )
    failed = (
        ("language", F.col("_undetected"), F.col("_language_error")),
        ("translation", F.col("translation_failed"), F.col("translation_error")),
        ("summary", F.col("_summary.error").isNotNull(), F.col("_summary.error")),
    )
    return located.withColumns(
        {
            "summary_text": F.col("_summary.summary"),
            "keywords": extract_keywords(english, F.col("category")),
            "task_errors": F.array_compact(F.array(*[F.when(flag, F.lit(task)) for task, flag, _ in failed])),
            "error_reasons": F.array_compact(F.array(*[F.when(flag, F.coalesce(reason, F.lit("no result"))) for _, flag, reason in failed])),
        }
    ).drop("_places", "_undetected", "_language_error", "_summary", "translation_failed", "translation_error")


def nest(tasks: DataFrame) -> DataFrame:
    """Enriched documents out of the flat task columns, with one batch stamp."""
    lang, english = F.col("detected_language"), F.col("translated_text")
    nlp = F.struct(
        F.struct(
            F.col("cleaned_text"), F.col("cleaned_word_count").alias("word_count")
        ).alias("preprocessing"),
        F.struct(lang.alias("detected_language"), lang.alias("original_language")).alias(
            "language_detection"
        ),
        F.struct(
            lang.alias("source_language"),
            english.alias("translated_text"),
            F.col("translation_applied").alias("applied"),
            F.col("cleaned_text").alias("translated_from_original"),
        ).alias("translation"),
        F.struct(F.col("ner_entities").alias("entities")).alias("ner"),
        F.struct(F.col("extracted_locations").alias("locations")).alias("location_extraction"),
        F.struct("category", "category_scores").alias("category_classification"),
        F.struct("keywords").alias("keyword_extraction"),
        F.struct("summary_text").alias("summary"),
        F.col("sentiment"),
    )
    return tasks.select(
        "article_id",
        F.col("clean_title").alias("title"),
        F.col("domain").alias("url_domain"),
        "source_country",
        F.col("published_date").cast("string").alias("published_date"),
        "full_text_payload",
        english.alias("processed_text"),
        nlp.alias("nlp"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"),
        "task_errors",
        "error_reasons",
    )


def enrich(articles: DataFrame, **options) -> DataFrame:
    """Gold articles -> enriched documents, entirely inside the tasks."""
    return nest(run_tasks(articles, **options))


def enrichment_report(documents: DataFrame) -> DataFrame:
    """Documents seen, and those in which no task failed.

    A task that fails on a text leaves its name in ``task_errors``; documents of older
    runs have no such field and count as enriched when they have results.
    """
    failed = F.size("task_errors") > 0 if "task_errors" in documents.columns else F.lit(False)
    whole = F.col("nlp").isNotNull() & ~F.coalesce(failed, F.lit(False))
    return documents.agg(F.count("*").alias("total"), F.count_if(whole).alias("enriched"))


def error_report(documents: DataFrame) -> DataFrame:
    """``task, reason, articles`` of all failures."""
    failures = F.explode(non_empty(F.arrays_zip(F.col("task_errors").alias("task"), F.col("error_reasons").alias("reason"))))
    return documents.select(failures.alias("failure")).groupBy("failure.task", "failure.reason").agg(F.count("*").alias("articles"))


def with_optional_fields(documents: DataFrame) -> DataFrame:
    """Documents whose ``nlp`` has every declared field, absent ones null."""
    present = set(documents.schema["nlp"].dataType.names)

    def field(f: T.StructField) -> Column:
        if f.name not in present:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, T.StructType):
            inner = set(documents.schema["nlp"].dataType[f.name].dataType.names)
            value = F.struct(
                *[
                    (F.col(f"nlp.{f.name}.{g.name}") if g.name in inner else F.lit(None).cast(g.dataType)).alias(g.name)
                    for g in f.dataType.fields
                ]
            )
            return F.when(F.col(f"nlp.{f.name}").isNotNull(), value).alias(f.name)
        return F.col(f"nlp.{f.name}").alias(f.name)

    full = documents.withColumn("nlp", F.struct(*[field(f) for f in NLP.fields]))
    missing = {
        c: F.lit(None).cast("string")
        for c in ("predicted_category", "category", "processed_at")
        if c not in documents.columns
    }
    return full.withColumns(missing) if missing else full


def flatten(documents: DataFrame, with_keywords: bool = False) -> DataFrame:
    """Enriched documents -> the flat gold table; older paths are read as fallback."""
    full = with_optional_fields(documents)
    columns = [
        F.col("article_id"),
        F.col("title"),
        F.col("url_domain").alias("domain"),
        F.col("source_country"),
        F.col("published_date"),
        F.coalesce("nlp.language_detection.detected_language", "nlp.language").alias("detected_language"),
        F.coalesce("nlp.category_classification.category", "nlp.category").alias("predicted_category"),
        F.col("nlp.sentiment.label").alias("sentiment_label"),
        F.col("nlp.sentiment.polarity_score").alias("sentiment_polarity"),
        F.col("nlp.summary.summary_text").alias("summary"),
        F.coalesce("nlp.ner.entities", "nlp.entities").alias("ner_entities"),
        F.coalesce("nlp.location_extraction.locations", "nlp.locations").alias("extracted_locations"),
    ]
    if with_keywords:
        columns.append(F.coalesce("nlp.keyword_extraction.keywords", "nlp.keywords").alias("keywords"))
    return full.select(
        *columns,
        F.col("processed_at").alias("nlp_processed_at"),
        F.current_timestamp().alias("ingested_to_gold_at"),
    )


def portal_rows(documents: DataFrame) -> DataFrame:
    """Enriched documents as portal rows, with a default for whatever is missing."""
    full = with_optional_fields(documents)

    def either(default, *paths: str) -> Column:
        return F.coalesce(*paths, F.lit(default))

    no_words = F.array().cast("array<string>")
    return full.select(
        either("N/A", "article_id").alias("article_id"),
        either("Untitled Article", "title").alias("title"),
        either("unknown.com", "url_domain").alias("domain"),
        either("Global", "source_country").alias("source_country"),
        either("No full text payload available.", "processed_text", "full_text_payload").alias("full_news_text"),
        either("", "nlp.preprocessing.cleaned_text", "processed_text").alias("preprocessed_text"),
        either("en", "nlp.language_detection.detected_language", "nlp.language").alias("detected_language"),
        either("", "nlp.translation.translated_text", "processed_text").alias("translated_text"),
        either(False, "nlp.translation.applied", "nlp.translation_applied").alias("translation_applied"),
        either("General", "nlp.category_classification.category", "nlp.category").alias("predicted_category"),
        F.coalesce("nlp.keyword_extraction.keywords", "nlp.keywords", no_words).alias("keywords_extracted"),
        either("Neutral", "nlp.sentiment.label").alias("sentiment_label"),
        either(0.0, "nlp.sentiment.polarity_score").alias("sentiment_polarity"),
        either("No summary generated for this article.", "nlp.summary.summary_text").alias("extractive_summary"),
        F.coalesce("nlp.ner.entities", "nlp.entities", F.array().cast(ENTITIES)).alias("ner_entities"),
        F.coalesce("nlp.location_extraction.locations", "nlp.locations", F.array().cast(LOCATIONS)).alias("extracted_locations"),
    )


def document_category() -> Column:
    """First non-empty category of the four places documents keep it in."""
    return F.coalesce(
        first_truthy(
            F.col("nlp.category"),
            F.col("nlp.category_classification.category"),
            F.col("predicted_category"),
            F.col("category"),
        ),
        F.lit(""),
    )

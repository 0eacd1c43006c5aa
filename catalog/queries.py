"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each runs library operators over the whole of the given tables. Arrays, structs
and timestamps are spelled as text so that two engines can compare them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import dictionaries as d
from presswork.cluster import materialize, shared_path
from presswork.functions.binding import non_empty
from presswork.functions.text import (
    clean_text,
    count_words,
    domain_of,
    main_text,
)
from presswork.operators import (
    collection as vectors,
    dedup,
    enrich,
    gold,
    language,
    portal,
    records,
    search,
    silver,
    topics,
    vector_index,
)
from presswork.operators.entities import (
    extract_entities,
    extract_locations,
    verify_locations,
    with_known_places,
)
from presswork.operators.ranking import number_rows
from presswork.operators.sentiment import get_sentiment, sentiment_label, sentiment_scores
from presswork.operators.summary import summarize
from presswork.plans import articles as fixture
from presswork.plans import lake
from presswork.sources.feeds import read_feeds
from presswork.sources.jsonl import newest_run, save_run
from presswork.sources.tables import entry_names, overwrite_table, prepare, read_table, stream_table
from presswork.sources.topic import from_topic, to_topic
from presswork.streaming.layers import bronze_to_silver, topic_to_bronze
from presswork.streaming.ttl import admit_stream, first_seen_stream, rocksdb_state

SEARCHED_LABEL = "Technology"
WEEK = 604_800


# ---------------------------------------------------------------- inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze_articles(documents(spark, sf_dir))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.feed_entries(documents(spark, sf_dir))


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.to_silver(bronze(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(gold.nlp_input_articles(silver_table(spark, sf_dir), min_words=None))


def labelled_category(label: Column) -> Column:
    """Category of an embedding: its label, spread over the known categories."""
    names = [*d.CATEGORY_KEYWORDS, topics.GENERAL]
    return F.element_at(F.array(*[F.lit(n) for n in names]), label % len(names) + 1)


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have an embedding, as a flat collection with their text.

    The first vector component stands in for the polarity, which gives all
    three labels.
    """
    docs = table(spark, sf_dir, "documents")
    vecs = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    polarity = F.round(F.get("embedding", F.lit(0)).cast("double"), 4)
    return docs.join(vecs, "doc_id").select(
        "doc_id",
        F.md5(fixture.article_url()).alias("article_id"),
        F.col("embedding").alias("vector"),
        fixture.article_title().alias("title"),
        domain_of(fixture.article_url()).alias("domain"),
        fixture.lookup(fixture.COUNTRY_OF_LANGUAGE, F.col("lang"), "Global").alias("source_country"),
        labelled_category(F.col("label")).alias("category"),
        polarity.alias("sentiment_score"),
        sentiment_label(polarity).alias("sentiment_label"),
        F.col("lang").alias("language"),
        "text",
    )


def collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library(spark, sf_dir).drop("text", "doc_id")


#: Tables that this application has built, by what they are and the folder they are made from.
BUILT: dict[tuple[str, str, str], str] = {}


def built_once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a table that queries share; the first one to ask for it has it built."""
    wanted = (spark.sparkContext.applicationId, sf_dir, name)
    if wanted not in BUILT or not entry_names(spark, BUILT[wanted]):
        path = shared_path(spark, name)
        build(path)
        BUILT[wanted] = path
    return BUILT[wanted]


def portal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Portal rows of all documents, from one stored run, as a portal keeps it."""
    prepare(spark)
    path = built_once(spark, sf_dir, "portal", lambda path: lake.build_portal(enriched(spark, sf_dir), path))
    return read_table(spark, path)


def stored_index(spark: SparkSession, sf_dir: str) -> vector_index.Index:
    """The collection, stored for search."""
    prepare(spark)
    path = built_once(spark, sf_dir, "index", lambda path: vector_index.build_index(collection(spark, sf_dir), path))
    return vector_index.Index.open(spark, path)


def given_vector(spark: SparkSession, sf_dir: str, vec_id: int) -> list[float]:
    """Stored vector as numbers."""
    rows = table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == vec_id)
    return rows.select("embedding").first()[0]


def article_vector(spark: SparkSession, sf_dir: str, vec_id: int) -> Column:
    """Stored vector as a query."""
    rows = table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == vec_id)
    return rows.select("embedding").limit(1).scalar()


def article_key(spark: SparkSession, sf_dir: str, doc_id: int) -> str:
    """Key of one article, as a portal user would pass it on."""
    docs = table(spark, sf_dir, "documents").filter(F.col("doc_id") == doc_id)
    return docs.select(F.md5(fixture.article_url())).first()[0]


def joined(words: str | Column) -> Column:
    return F.array_join(words, "|")


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def day(column: str) -> Column:
    return F.col(column).cast("string")


def score() -> Column:
    return F.round("similarity_score", 6).alias("similarity_score")


# ---------------------------------------------------------------- ingestion


def ingest_records(spark, sf_dir):
    return records.fetched_records(entries(spark, sf_dir)).select(
        "id", "title", "url", "source_country", "published_at", "word_count",
        "is_breaking_news", "summary_snippet", F.md5("full_content").alias("content_md5"),
    )


def ingest_rejects(spark, sf_dir):
    return records.rejected_entries(entries(spark, sf_dir)).select(
        "id", "url", "word_count", "reject_reason"
    )


def ingest_events(spark, sf_dir):
    valid, _ = records.validate(records.scraped_events(entries(spark, sf_dir)))
    return valid.select(
        "id", "title", "source_country", "word_count", "is_breaking_news",
        "summary_snippet", "article_id", F.md5("extracted_text").alias("text_md5"),
    )


def feed_items(spark, sf_dir):
    """Documents written as one feed folder per country, read back as entries."""
    root = shared_path(spark, "feeds")
    items = entries(spark, sf_dir).select(
        F.col("url").alias("link"), "title", F.col("published").alias("pubDate"),
        F.coalesce("summary", "description").alias("description"), "source_country",
    )
    feeds = items.write.format("xml").option("rootTag", "channel").option("rowTag", "item")
    feeds.partitionBy("source_country").save(root)
    folders = [name for name in entry_names(spark, root) if "=" in name]
    return read_feeds(spark, {name.partition("=")[2]: [f"{root}/{name}"] for name in folders}).select(
        "url", "title", "published", "source_country"
    )


def ingest_invalid(spark, sf_dir):
    """Events with holes in them: what validation rejects, and why."""
    events = records.scraped_events(entries(spark, sf_dir))
    holed = events.withColumns(
        {
            "title": F.when(~F.col("id").startswith("a"), F.col("title")),
            "published_at": F.when(~F.col("id").startswith("b"), F.col("published_at")),
            "word_count": F.when(~F.col("id").rlike("^[bc]"), F.col("word_count")),
        }
    )
    _, rejects = records.validate(holed)
    return rejects.select("id", F.array_join("violations", "|").alias("reasons"))


def html_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    extracted = pages.select("page_id", main_text(F.col("html")).alias("text"))
    return extracted.select("page_id", "text", count_words(F.col("text")).alias("words"))


def html_blocks_text(spark, sf_dir):
    """Pages that mark no article: menus and lists of links go, the text stays."""
    pages = table(spark, sf_dir, "pages")
    unmarked = F.regexp_replace("html", r"(?i)</?article\b[^>]*>", " ")
    extracted = pages.select("page_id", main_text(unmarked).alias("text"))
    return extracted.select("page_id", "text", count_words(F.col("text")).alias("words"))


def page_domains(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", domain_of(F.col("url")).alias("domain"))


def topic_records(spark, sf_dir):
    return to_topic(records.scraped_events(entries(spark, sf_dir)))


def _document_stream(spark, sf_dir):
    prepare(spark)
    path = f"{sf_dir}/documents.parquet"
    return stream_table(spark, path, read_table(spark, path).schema)


def topic_to_bronze_stream(spark, sf_dir):
    stream = fixture.feed_entries(_document_stream(spark, sf_dir))
    messages = to_topic(records.scraped_events(stream))
    path = shared_path(spark, "bronze")
    topic_to_bronze(messages, path, shared_path(spark, "bronze-checkpoint")).awaitTermination()
    return read_table(spark, path).select(
        "id", "title", "source_country", "published_at", "word_count",
        "is_breaking_news", F.md5("content").alias("content_md5"),
    )


def topic_to_bronze_batch(spark, sf_dir):
    bronze_rows = from_topic(to_topic(records.scraped_events(entries(spark, sf_dir))))
    return bronze_rows.groupBy("source_country").agg(
        F.count("*").alias("articles"),
        F.sum("word_count").alias("words"),
        F.count_if("is_breaking_news").alias("breaking"),
    )


# ---------------------------------------------------------------- silver


def _silver_columns(rows):
    return rows.select(
        "id", "clean_title", F.md5("clean_content").alias("content_md5"), "word_count",
        "est_read_time_mins", "domain", F.md5("full_text_payload").alias("payload_md5"),
        "source_country", stamp("published_at_ts").alias("published_at_ts"),
        day("published_date").alias("published_date"),
    )


def silver_articles(spark, sf_dir):
    return _silver_columns(silver_table(spark, sf_dir))


def silver_dirty(spark, sf_dir):
    """Records without id or title, with their text elsewhere, with odd or no dates."""
    return _silver_columns(silver.to_silver(fixture.dirty_articles(documents(spark, sf_dir))))


def silver_stream(spark, sf_dir):
    path = shared_path(spark, "silver")
    stream = fixture.bronze_articles(_document_stream(spark, sf_dir))
    bronze_to_silver(stream, path, shared_path(spark, "silver-checkpoint")).awaitTermination()
    return _silver_columns(
        read_table(spark, path, schema=silver.to_silver(stream).schema, partition_by=silver.PARTITIONS)
    )


def silver_doc_variant(spark, sf_dir):
    rows = bronze(spark, sf_dir).withColumn("word_count", count_words(F.col("content")).cast("string"))
    return silver.documented_silver(rows).select(
        "id", "clean_title", F.md5("clean_content").alias("content_md5"), "word_count",
        "is_breaking_news", "est_read_time_mins", "domain",
        stamp("published_at_ts").alias("published_at_ts"),
    )


def _admitted(rows):
    return rows.select(
        "user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us")
    )


def dedup_ttl(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return _admitted(dedup.admissions(events, "user_id", "ts", "event_id", WEEK))


def dedup_ttl_crowded(spark, sf_dir):
    """Few keys with very many rows each, which fill many ranges."""
    events = table(spark, sf_dir, "events")
    admitted = dedup.admissions(events, "event_type", "ts", "event_id", WEEK)
    return admitted.select(
        "event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us")
    )


def dedup_ttl_stream(spark, sf_dir):
    prepare(spark)
    path = f"{sf_dir}/events.parquet"
    out = shared_path(spark, "admitted")
    stream = stream_table(spark, path, read_table(spark, path).schema)
    with rocksdb_state(spark):
        (
            admit_stream(stream, "user_id", "ts", "event_id", WEEK)
            .writeStream.format("parquet")
            .option("checkpointLocation", shared_path(spark, "admitted-checkpoint"))
            .trigger(availableNow=True)
            .start(out)
            .awaitTermination()
        )
    return _admitted(read_table(spark, out))


def dedup_ttl_late(spark, sf_dir):
    """Events that come late: half of them only after all others, then the end of the stream.

    A watermark holds from the micro-batch after, so one more row follows the end.
    """
    prepare(spark)
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    first, last = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    span = (last - first) // 1_000_000 + 1
    end = spark.range(1).select(
        F.lit(-1).cast("long").alias("user_id"),
        F.timestamp_micros(F.lit(last + 1_000_000 * (2 * span + WEEK))).alias("ts"),
        F.lit(-1).cast("long").alias("event_id"),
    )
    late = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    source, out, log = (shared_path(spark, name) for name in ("late-events", "admitted", "admitted-checkpoint"))
    for arriving in (events.filter(~late), events.filter(late).unionByName(end), end):
        arriving.write.mode("append").parquet(source)
        stream = stream_table(spark, source, events.schema)
        with rocksdb_state(spark):
            admitted = admit_stream(stream, "user_id", "ts", "event_id", WEEK, late_seconds=span, wait=True)
            sink = admitted.writeStream.format("parquet").option("checkpointLocation", log)
            sink.trigger(availableNow=True).start(out).awaitTermination()
    return _admitted(read_table(spark, out)).filter("user_id <> -1")


def dedup_ttl_rows(spark, sf_dir):
    """Admitted events with all their columns."""
    events = table(spark, sf_dir, "events")
    rows = dedup.admit_within_ttl(events, "user_id", "ts", "event_id", WEEK)
    return rows.select("event_id", "user_id", "event_type", "value", "props")


def dedup_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return _admitted(dedup.first_seen(events, "user_id", "ts", "event_id"))


def dedup_first_stream(spark, sf_dir):
    """The stored events, which are in time order, as a stream."""
    prepare(spark)
    path = f"{sf_dir}/events.parquet"
    out = shared_path(spark, "first")
    stream = stream_table(spark, path, read_table(spark, path).schema).select("user_id", "ts", "event_id")
    sink = first_seen_stream(stream, "user_id", "ts", 520 * WEEK).writeStream.format("parquet")
    sink = sink.option("checkpointLocation", shared_path(spark, "first-checkpoint"))
    sink.trigger(availableNow=True).start(out).awaitTermination()
    return _admitted(read_table(spark, out))


def dedup_unseen(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return dedup.unseen(docs, table(spark, sf_dir, "labels"), "doc_id")


# ---------------------------------------------------------------- gold


def gold_nlp_input(spark, sf_dir):
    return gold.nlp_input_articles(silver_table(spark, sf_dir), min_words=None).select(
        "article_id", "clean_title", F.md5("clean_content").alias("content_md5"),
        F.md5("full_text_payload").alias("payload_md5"), "domain", "source_country",
        stamp("published_at_ts").alias("published_at_ts"),
        day("published_date").alias("published_date"),
    )


def gold_search_features(spark, sf_dir):
    return gold.search_recommender_features(silver_table(spark, sf_dir), min_words=None).select(
        "doc_id", "title", "url", "domain", "word_count", "est_read_time_mins",
        stamp("published_at_ts").alias("published_at_ts"),
        day("published_date").alias("published_date"),
    )


def gold_daily_publisher_metrics(spark, sf_dir):
    return gold.daily_publisher_metrics(silver_table(spark, sf_dir)).select(
        day("published_date").alias("published_date"), "source_country", "domain",
        "total_articles", "total_word_count", "avg_word_count", "avg_read_time_mins",
        stamp("latest_article_ts").alias("latest_article_ts"),
        stamp("earliest_article_ts").alias("earliest_article_ts"),
    )


def gold_tables_written(spark, sf_dir):
    """Silver and the search table written partitioned, then read back."""
    silver_path, gold_path = shared_path(spark, "silver"), shared_path(spark, "gold")
    cleaned = silver_table(spark, sf_dir)
    overwrite_table(cleaned, silver_path, silver.PARTITIONS)
    needed = cleaned.select(*gold.SEARCH_SOURCE).schema
    stored = read_table(spark, silver_path, schema=needed, partition_by=silver.PARTITIONS)
    features = gold.search_recommender_features(stored)
    overwrite_table(features, gold_path, ["published_date"])
    counted = features.select("published_date", "word_count", "published_at_ts").schema
    return (
        read_table(spark, gold_path, schema=counted, partition_by=["published_date"])
        .groupBy(day("published_date").alias("published_date"))
        .agg(
            F.count("*").alias("articles"),
            F.sum("word_count").alias("words"),
            F.max(stamp("published_at_ts")).alias("latest"),
        )
    )


def quality_report(spark, sf_dir):
    return gold.quality_report(silver.clean_articles(bronze(spark, sf_dir)))


def country_summary(spark, sf_dir):
    return gold.country_summary(silver_table(spark, sf_dir))


# ---------------------------------------------------------------- text tasks


def nlp_clean(spark, sf_dir):
    cleaned = bronze(spark, sf_dir).select("doc_id", clean_text(F.col("content")).alias("cleaned_text"))
    return cleaned.withColumn("word_count", count_words(F.col("cleaned_text")))


def nlp_language(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", language.detect_language(F.col("text")).alias("detected_language")
    )


def nlp_translation_route(spark, sf_dir):
    """Routing with a model for French that marks what it was given."""
    detected = documents(spark, sf_dir).select(
        "doc_id", "text", language.detect_language(F.col("text")).alias("detected_language")
    )
    routed = language.translate(
        detected, "text", "detected_language", {"fr": lambda: lambda texts: [f"[fr] {t}" for t in texts]}
    )
    return routed.select(
        "doc_id", "detected_language", "translation_applied",
        F.md5("translated_text").alias("translated_md5"),
    )


def _tagged(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", extract_entities(F.col("text")).alias("entities"))


def nlp_entities(spark, sf_dir):
    return _tagged(spark, sf_dir).select("doc_id", F.posexplode(non_empty(F.col("entities"))).alias("position", "e")).select(
        "doc_id", "position", F.col("e.text").alias("entity"), F.col("e.label").alias("label")
    )


def nlp_entities_table(spark, sf_dir):
    """Entities by a gazetteer table: all words of four letters or more."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,}"), F.lit(0))
    names = docs.select(F.explode(words).alias("name"))
    known = with_known_places(docs, "text", names, "places")
    entities = extract_entities(F.col("text"), F.col("places"))
    return known.select("doc_id", F.posexplode(non_empty(entities)).alias("position", "e")).select(
        "doc_id", "position", F.col("e.text").alias("entity"), F.col("e.label").alias("label")
    )


def nlp_locations(spark, sf_dir):
    """Every entity of a person or place label taken as a place, flagged by a table."""
    places = F.transform("entities", lambda e: F.struct(e["text"].alias("text"), F.lit("LOC").alias("label")))
    tagged = _tagged(spark, sf_dir).select("doc_id", places.alias("entities"))
    names = table(spark, sf_dir, "documents").select(
        F.lower(F.concat_ws(" ", F.lit("src"), "source")).alias("name")
    ).unionByName(spark.createDataFrame([(g,) for g in d.GAZETTEER], "name string"))
    return verify_locations(tagged, "doc_id", "entities", names).select(
        "doc_id", F.posexplode(non_empty(F.col("locations"))).alias("position", "l")
    ).select("doc_id", "position", F.col("l.text").alias("location"), F.col("l.verified_location").alias("verified"))


def nlp_category_scores(spark, sf_dir):
    scores = documents(spark, sf_dir).select("doc_id", topics.category_scores(F.col("text")).alias("s"))
    return scores.select("doc_id", *[F.col("s")[c].alias(c.lower()) for c in d.CATEGORY_KEYWORDS])


def nlp_category(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", topics.best_category(topics.category_scores(F.col("text"))).alias("category")
    )


def _with_category(spark, sf_dir, keywords=d.CATEGORY_KEYWORDS):
    return documents(spark, sf_dir).withColumn(
        "category", topics.best_category(topics.category_scores(F.col("text"), keywords), keywords)
    )


def nlp_keywords(spark, sf_dir):
    return _with_category(spark, sf_dir).select(
        "doc_id", "category", joined(topics.extract_keywords(F.col("text"), F.col("category"))).alias("keywords")
    )


def nlp_keywords_doc(spark, sf_dir):
    """The documented word lists, ties by first appearance."""
    found = topics.extract_keywords(
        F.col("text"), F.col("category"), keywords=d.CATEGORY_KEYWORDS_LONG,
        stop_words=d.STOP_WORDS_LONG, first_seen=True,
    )
    return _with_category(spark, sf_dir, d.CATEGORY_KEYWORDS_LONG).select(
        "doc_id", "category", joined(found).alias("keywords")
    )


def nlp_frequent_words(spark, sf_dir):
    """Most frequent words of every document, whatever its category."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(topics.WORD), F.lit(0))
    return documents(spark, sf_dir).select(
        "doc_id", joined(topics.frequent_words(words, topics.TOP_WORDS, d.STOP_WORDS, False)).alias("keywords")
    )


def nlp_term_frequency(spark, sf_dir):
    """Occurrences of every word over all documents, stop words left out."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(topics.WORD), F.lit(0))
    words = documents(spark, sf_dir).select(F.explode(found).alias("word"))
    return words.filter(~F.col("word").isin(*d.STOP_WORDS)).groupBy("word").agg(F.count("*").alias("n"))


def nlp_sentiment(spark, sf_dir):
    scored = documents(spark, sf_dir).select("doc_id", get_sentiment(F.col("text")).alias("s"))
    return scored.select("doc_id", F.col("s.polarity_score").alias("polarity_score"), F.col("s.label").alias("label"))


def nlp_sentiment_shares(spark, sf_dir):
    scored = documents(spark, sf_dir).select("doc_id", sentiment_scores(F.col("text")).alias("s"))
    return scored.select("doc_id", "s.positive", "s.neutral", "s.negative")


def nlp_summary(spark, sf_dir):
    cleaned = documents(spark, sf_dir).select("doc_id", clean_text(F.col("text")).alias("text"))
    return cleaned.select("doc_id", summarize(F.col("text")).alias("summary"))


def nlp_flattened(spark, sf_dir):
    flat = enrich.flatten(enriched(spark, sf_dir), with_keywords=True)
    return flat.select(
        "article_id", "title", "domain", "source_country", "published_date",
        "detected_language", "predicted_category", "sentiment_label", "sentiment_polarity",
        joined("keywords").alias("keywords"),
        joined(F.transform("ner_entities", lambda e: e["text"])).alias("entities"),
        F.size("extracted_locations").alias("locations"),
    )


def nlp_documents(spark, sf_dir):
    """Nested documents with all nine results."""
    return enriched(spark, sf_dir).drop("processed_at")


def nlp_saved_run(spark, sf_dir):
    """Documents written as a run of JSON lines; the newest run read and flattened."""
    folder = shared_path(spark, "runs")
    save_run(enriched(spark, sf_dir), folder)
    flat = enrich.flatten(newest_run(spark, folder))
    return flat.groupBy("predicted_category", "detected_language").agg(F.count("*").alias("articles"))


def nlp_report(spark, sf_dir):
    """Report over a run whose model for French fails on texts of odd length."""
    articles = gold.nlp_input_articles(silver_table(spark, sf_dir), min_words=None)
    return enrich.enrichment_report(enrich.enrich(articles, translators={"fr": _even_texts_only}))


def nlp_errors(spark, sf_dir):
    """Tasks that failed in that run, and why."""
    articles = gold.nlp_input_articles(silver_table(spark, sf_dir), min_words=None)
    return enrich.error_report(enrich.enrich(articles, translators={"fr": _even_texts_only}))


def _even_texts_only():
    def translated(texts):
        if any(len(t) % 2 for t in texts):
            raise ValueError("odd length")
        return [f"[fr] {t}" for t in texts]

    return translated


def portal_articles(spark, sf_dir):
    rows = enrich.portal_rows(enriched(spark, sf_dir))
    return rows.select(
        "article_id", "title", "domain", "source_country",
        F.md5("full_news_text").alias("text_md5"), "detected_language", "translation_applied",
        "predicted_category", joined("keywords_extracted").alias("keywords"),
        "sentiment_label", "sentiment_polarity",
    )


# ---------------------------------------------------------------- vectors


def vec_embed(spark, sf_dir):
    embedded = vectors.embed_hashed(documents(spark, sf_dir).select("doc_id", "text"), "text")
    return embedded.select("doc_id", "vector")


def vec_payload(spark, sf_dir):
    rows = vectors.payloads(enriched(spark, sf_dir))
    return rows.select(
        "article_id", "title", "domain", "source_country", "published_date", "category",
        "sentiment_score", "sentiment_label", "language", joined("entities").alias("entities"),
        joined("locations").alias("locations"), joined("keywords").alias("keywords"),
        F.md5("embedding_input").alias("input_md5"),
    )


def vec_points(spark, sf_dir):
    """Points of the enriched documents, ready to be upserted."""
    return vectors.points(enriched(spark, sf_dir)).select(
        "point_id", "payload.article_id", F.size("vector").alias("size"),
        F.round(vectors.norm(F.col("vector")), 4).alias("length"),
    )


def vec_indexed(spark, sf_dir):
    """A saved run indexed into a new collection, as stored payloads."""
    runs, folder = shared_path(spark, "runs"), shared_path(spark, "collection")
    save_run(enriched(spark, sf_dir), runs)
    lake.index_newest_run(spark, runs, folder)
    return lake.searchable(lake.read_collection(spark, folder)).select(
        "article_id", "title", "category", "sentiment_label", "language",
        joined("entities").alias("entities"), joined("keywords").alias("keywords"),
        F.size("vector").alias("vector_size"),
    )


def vec_upsert(spark, sf_dir):
    """Labels of the embeddings, replaced where the labels table rates the document."""
    stored = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("article_id"), "label")
    batch = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("article_id"), (100 + F.col("quality")).cast("int").alias("label")
    )
    return vectors.upsert(stored, batch, "article_id")


def vec_stats(spark, sf_dir):
    return vectors.collection_stats(collection(spark, sf_dir), "news_articles")


def vec_search(spark, sf_dir):
    hits = search.hybrid_search(collection(spark, sf_dir), article_vector(spark, sf_dir, 0), limit=10)
    return hits.select("article_id", "title", "category", "source_country", score())


def vec_search_stored(spark, sf_dir):
    """The same search over the stored index, which opens only folders that can hold a hit."""
    hits = stored_index(spark, sf_dir).search(given_vector(spark, sf_dir, 0), limit=10)
    return hits.select("article_id", "title", "category", "source_country", score())


def vec_search_filtered(spark, sf_dir):
    hits = search.hybrid_search(
        collection(spark, sf_dir), article_vector(spark, sf_dir, 1),
        category=SEARCHED_LABEL, country="US", sentiment="Positive", limit=5,
    )
    return hits.select("article_id", "title", "sentiment_label", score())


def vec_advanced(spark, sf_dir):
    filters = {"countries": ["FR", "DE"], "sentiment": "Negative", "min_score": 0.05}
    hits = search.advanced_search(
        collection(spark, sf_dir), article_vector(spark, sf_dir, 2), filters, limit=10
    )
    return hits.select("article_id", "category", "source_country", score())


def vec_related(spark, sf_dir):
    hits = search.related(
        collection(spark, sf_dir), article_key(spark, sf_dir, 3), limit=5, category_bias="Sports"
    )
    return hits.select("article_id", "title", "category", score())


def vec_related_stored(spark, sf_dir):
    hits = stored_index(spark, sf_dir).related(article_key(spark, sf_dir, 3), limit=5, category_bias="Sports")
    return hits.select("article_id", "title", "category", score())


def vec_advanced_stored(spark, sf_dir):
    hits = stored_index(spark, sf_dir).search(
        given_vector(spark, sf_dir, 2), country=["FR", "DE"], sentiment="Negative", min_score=0.05, limit=10
    )
    return hits.select("article_id", "category", "source_country", score())


def vec_related_fallback(spark, sf_dir):
    hits = search.related(
        collection(spark, sf_dir), article_key(spark, sf_dir, 3), limit=5, category_bias="Weather"
    )
    return hits.select("article_id", "title", "category", score())


def vec_related_batch(spark, sf_dir):
    """Related articles of every hit on the first page of a search."""
    rows = collection(spark, sf_dir)
    page = search.hybrid_search(rows, article_vector(spark, sf_dir, 0), limit=12)
    targets = rows.join(F.broadcast(page.select("article_id")), "article_id")
    return search.related_batch(rows, targets, limit=3).select("target_id", "article_id", "rank", score())


def vec_browse(spark, sf_dir):
    rows = search.browse(collection(spark, sf_dir), category="Business", country="US", limit=10)
    return rows.select("payload.article_id", "payload.title", "payload.category", "payload.source_country")


def vec_trending(spark, sf_dir):
    """Most frequent entities over all mentions of all documents."""
    entities = F.transform(extract_entities(F.col("text")), lambda e: e["text"])
    rows = documents(spark, sf_dir).select(entities.alias("entities"))
    return search.trending(rows, limit=10).select("entity", F.col("count").alias("n"))


def vec_trending_sketch(spark, sf_dir):
    """The same from one stored sketch per language, merged."""
    entities = F.transform(extract_entities(F.col("text")), lambda e: e["text"])
    rows = documents(spark, sf_dir).select("lang", entities.alias("entities"))
    sketches = materialize(search.entity_sketches(rows, "lang"), "sketches")
    return search.trending_of_sketches(sketches, limit=10).select("entity", F.col("count").alias("n"))


def query_category(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return turns.select("conv_id", "turn", topics.query_category(F.col("text")).alias("category"))


# ---------------------------------------------------------------- portal


def portal_facets(spark, sf_dir):
    return portal.facets(portal_table(spark, sf_dir))


def portal_filtered(spark, sf_dir):
    rows = portal.filter_articles(
        portal_table(spark, sf_dir),
        categories=["Technology", "Sports"], sentiments=["Positive", "Neutral"], countries=["US", "FR"],
    )
    return rows.select("article_id", "predicted_category", "sentiment_label", "source_country")


def portal_kpis(spark, sf_dir):
    rows = portal_table(spark, sf_dir)
    return portal.kpis(rows, portal.selected(categories=["Technology", "Business"], sentiments=["Positive"]))


def portal_ranked(spark, sf_dir):
    rows = portal.ranked_articles(
        portal_table(spark, sf_dir), collection(spark, sf_dir),
        article_vector(spark, sf_dir, 0), category=SEARCHED_LABEL,
    )
    return rows.select("article_id", "title", F.col("rank").cast("bigint").alias("rank"), score())


def portal_pages(spark, sf_dir):
    rows = portal.grid(portal_table(spark, sf_dir), "sentiment_polarity")
    return rows.select(
        "article_id", F.col("grid_row").cast("bigint").alias("grid_row"),
        F.col("grid_col").cast("bigint").alias("grid_col"),
    )


def portal_cards(spark, sf_dir):
    # The summary has no SQL, so the cards show the text itself.
    rows = portal_table(spark, sf_dir).withColumn("extractive_summary", F.col("preprocessed_text"))
    return portal.cards(rows).select(
        "article_id", "predicted_category", "color", "marker", "snippet", "band",
        F.upper("detected_language").alias("language"),
    )


def portal_detail(spark, sf_dir):
    return portal.detail(portal_table(spark, sf_dir), article_key(spark, sf_dir, 3)).select(
        "article_id", "title", "predicted_category", "color", "language", "text_preview", "band"
    )


def portal_keyword(spark, sf_dir):
    rows = portal.keyword_search(portal_table(spark, sf_dir), "Tion the")
    return rows.select("article_id", "title")


def portal_related(spark, sf_dir):
    return portal.related_panel(collection(spark, sf_dir), article_key(spark, sf_dir, 3), "Sports").select(
        "article_id", "title", "category", "color", "sentiment", "country", "match"
    )


def portal_search(spark, sf_dir):
    """Text search over all documents: embedded, ranked, cut to the named category."""
    docs = documents(spark, sf_dir).select(
        F.md5(fixture.article_url()).alias("article_id"), "text",
        topics.best_category(topics.category_scores(F.col("text"))).alias("predicted_category"),
    )
    points = vectors.embed_hashed(docs.select("article_id", "text"), "text").drop("text")
    rows = docs.select("article_id", "predicted_category")
    return portal.search_articles(rows, points, "the latest technology").select(
        "article_id", "predicted_category", F.col("rank").cast("bigint").alias("rank"), score()
    )


def portal_collection_ranks(spark, sf_dir):
    """Rank of every article of the collection for a query."""
    hits = search.scored(collection(spark, sf_dir), article_vector(spark, sf_dir, 4))
    return number_rows(hits, F.desc("similarity_score"), F.col("article_id")).select(
        "article_id", F.col("rank").cast("bigint").alias("rank")
    )


QUERIES = {
    f.__name__: f
    for f in (
        ingest_records, ingest_rejects, ingest_events, ingest_invalid, feed_items, html_main_text, html_blocks_text, page_domains,
        topic_records, topic_to_bronze_stream, topic_to_bronze_batch,
        silver_articles, silver_dirty, silver_stream, silver_doc_variant,
        dedup_ttl, dedup_ttl_rows, dedup_ttl_crowded, dedup_ttl_stream, dedup_ttl_late, dedup_first, dedup_first_stream, dedup_unseen,
        gold_nlp_input, gold_search_features, gold_daily_publisher_metrics,
        gold_tables_written, quality_report, country_summary,
        nlp_clean, nlp_language, nlp_translation_route, nlp_entities, nlp_entities_table, nlp_locations,
        nlp_category, nlp_category_scores, nlp_keywords, nlp_keywords_doc,
        nlp_frequent_words, nlp_term_frequency, nlp_sentiment, nlp_sentiment_shares,
        nlp_summary, nlp_documents, nlp_flattened, nlp_saved_run, nlp_report, nlp_errors, portal_articles,
        vec_embed, vec_payload, vec_points, vec_indexed, vec_upsert, vec_stats,
        vec_search, vec_search_stored, vec_search_filtered, vec_advanced, vec_advanced_stored,
        vec_related, vec_related_stored, vec_related_fallback,
        vec_related_batch, vec_browse, vec_trending, vec_trending_sketch, query_category,
        portal_facets, portal_filtered, portal_kpis, portal_ranked, portal_pages,
        portal_cards, portal_detail, portal_keyword, portal_related, portal_search, portal_collection_ranks,
    )
}

"""Vector collection: embedding, payloads, upsert, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.functions.binding import keep_where, let
from presswork.functions.models import Loader, try_model
from presswork.operators.enrich import document_category, with_optional_fields
from presswork.schemas import COLLECTION, VECTOR_SIZE

# --- Fixed values: input of the original model, lists of a payload.
EMBEDDED_CHARS = 2000
ENTITY_LIMIT, LOCATION_LIMIT, KEYWORD_LIMIT = 10, 5, 10
DISTANCE_METRIC = "COSINE"


def embedding_input(title: Column, payload: Column, max_chars: int | None = None) -> Column:
    """Title and text; ``max_chars`` is for models that read no more."""
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(payload, F.lit("")))
    return text if max_chars is None else F.substring(text, 1, max_chars)


def norm(vector: Column) -> Column:
    squares = F.transform(vector, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))


def _unit(vector: Column) -> Column:
    def scale(length: Column) -> Column:
        return F.transform(
            vector, lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0)).cast("float")
        )

    return let(norm(vector), scale)


def embed_hashed(df: DataFrame, text: str, size: int = VECTOR_SIZE, output: str = "vector") -> DataFrame:
    """Signed feature hashing of the words, on the unit sphere.

    Words are hashed into twice ``size`` counters; the upper half is subtracted
    from the lower, which gives every word a position and a sign.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0))
    tokens = df.withColumn("_words", F.coalesce(words, F.array().cast("array<string>")))
    hashed = HashingTF(numFeatures=2 * size, inputCol="_words", outputCol="_counts").transform(tokens)

    def sign(counts: Column) -> Column:
        lower, upper = F.slice(counts, 1, size), F.slice(counts, size + 1, size)
        return F.zip_with(lower, upper, lambda a, b: a - b)

    vector = let(let(vector_to_array("_counts"), sign), _unit)
    return hashed.withColumn(output, vector).drop("_words", "_counts")


def embed_with(
    df: DataFrame, text: str, load: Loader, batch: int = 256, output: str = "vector", error: str | None = None
) -> DataFrame:
    """Vectors of a plugged-in model; null where it fails on a text, and then ``error`` says why."""

    def embedder():
        model = load()
        return lambda texts: [[float(x) for x in v] for v in model(texts)]

    whole = F.coalesce(F.col(text), F.lit(""))
    tried = df.withColumn("_tried", try_model(whole, embedder, T.ArrayType(T.FloatType()), batch))
    results = {output: F.col("_tried.value")} | ({} if error is None else {error: F.col("_tried.error")})
    return tried.withColumns(results).drop("_tried")


def payloads(documents: DataFrame, max_chars: int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Payload columns of enriched documents, lists cut to what search shows, and
    the text to embed; columns to ``carry`` along stay as they are."""
    full = with_optional_fields(documents)
    anonymous = F.concat(F.lit("art_"), F.hex(F.xxhash64("title", "full_text_payload")))

    def texts(items: Column, limit: int) -> Column:
        return F.coalesce(
            F.slice(F.transform(items, lambda e: e["text"]), 1, limit),
            F.array().cast("array<string>"),
        )

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return full.select(
        F.coalesce("article_id", anonymous).alias("article_id"),
        text("title").alias("title"),
        text("url_domain").alias("domain"),
        text("source_country").alias("source_country"),
        text("published_date").alias("published_date"),
        document_category().alias("category"),
        F.coalesce("nlp.sentiment.compound", "nlp.sentiment.polarity_score", F.lit(0.0)).alias("sentiment_score"),
        text("nlp.sentiment.label").alias("sentiment_label"),
        F.coalesce(
            F.nullif("nlp.language_detection.detected_language", F.lit("")), "nlp.language", F.lit("")
        ).alias("language"),
        texts(F.coalesce("nlp.ner.entities", "nlp.entities"), ENTITY_LIMIT).alias("entities"),
        texts(F.coalesce("nlp.location_extraction.locations", "nlp.locations"), LOCATION_LIMIT).alias("locations"),
        F.coalesce(
            F.slice(F.coalesce("nlp.keyword_extraction.keywords", "nlp.keywords"), 1, KEYWORD_LIMIT),
            F.array().cast("array<string>"),
        ).alias("keywords"),
        embedding_input(F.col("title"), F.col("full_text_payload"), max_chars).alias("embedding_input"),
        *carry,
    )


def points(
    documents: DataFrame,
    embedder: Loader | None = None,
    size: int = VECTOR_SIZE,
    max_chars: int | None = None,
    carry: Sequence[str] = (),
    failed: str | None = None,
) -> DataFrame:
    """Enriched documents -> rows of a collection, keyed by article.

    Articles whose embedding fails or has another size are left out, unless a column for
    the reason is named: then they stay, without a vector. Columns to ``carry`` along follow.
    """
    prepared = payloads(documents, max_chars, carry)
    embedded = (
        embed_hashed(prepared, "embedding_input", size)
        if embedder is None
        else embed_with(prepared, "embedding_input", embedder, error="_error")
    )
    fields = [F.col(f.name) for f in COLLECTION["payload"].dataType.fields]
    rows = embedded.select(
        F.col("article_id").alias("point_id"), "vector", F.struct(*fields).alias("payload"), *carry,
        *([] if embedder is None else ["_error"]),
    )
    if embedder is None:
        return rows if failed is None else rows.withColumn(failed, F.lit(None).cast("string"))
    fits = F.coalesce(F.size("vector") == size, F.lit(False))
    if failed is None:
        return keep_where(rows, fits).drop("_error")
    other_size = F.concat(F.size("vector").cast("string"), F.lit(" components"))
    reason = F.when(fits, None).otherwise(F.coalesce("_error", other_size, F.lit("no result")))
    return rows.withColumns({failed: reason, "vector": F.when(fits, F.col("vector"))}).drop(*({"_error"} - {failed}))


def empty_collection(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COLLECTION)


def upsert(stored: DataFrame, batch: DataFrame, key: str, sequence: str | None = None) -> DataFrame:
    """``stored`` with the rows of ``batch`` put in place of those with their key.

    When a key comes twice in the batch the row with the highest ``sequence``
    stays (without one, the batch is taken to have unique keys). The batch is
    read twice: pass a stored one when it is dear to compute.
    """
    if sequence is not None:
        latest = Window.partitionBy(key).orderBy(F.col(sequence).desc())
        batch = batch.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")
    kept = stored.join(batch.select(key), key, "left_anti").select(*stored.columns)
    return kept.unionByName(batch.select(*stored.columns))


def collection_stats(collection: DataFrame, name: str, vector: str = "vector") -> DataFrame:
    return collection.agg(
        F.lit(name).alias("collection_name"),
        F.count("*").alias("vectors_count"),
        F.max(F.size(vector)).alias("vector_size"),
        F.lit(DISTANCE_METRIC).alias("distance_metric"),
    )

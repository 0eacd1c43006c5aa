"""Declared schema of every layer. JSON is always read with one of these."""

from pyspark.sql import types as T


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_S, _I, _L, _D, _B = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
)
_STRINGS = T.ArrayType(_S)

# Validated article event: the value of a topic message.
ARTICLE_EVENT = _struct(
    id=_S,
    title=_S,
    url=_S,
    source_country=_S,
    content=_S,
    published_at=_S,
    word_count=_I,
    is_breaking_news=_B,
    summary_snippet=_S,
    full_content=_S,
    article_id=_S,
    extracted_text=_S,
    ingest_timestamp=_S,
)

REQUIRED_EVENT_FIELDS = (
    "id",
    "title",
    "url",
    "source_country",
    "content",
    "published_at",
    "word_count",
)

# Bronze accepts the current event and the fields of older fetchers.
BRONZE = T.StructType(
    ARTICLE_EVENT.fields
    + _struct(
        published=_S, _ingested_at=_S, processed_timestamp=T.TimestampType()
    ).fields
)

# Items of a stored feed document.
FEED_ITEM = _struct(link=_S, title=_S, pubDate=_S, summary=_S, description=_S)

ENTITY = _struct(text=_S, label=_S)
LOCATION = _struct(text=_S, verified_location=_B)
ENTITIES = T.ArrayType(ENTITY)
LOCATIONS = T.ArrayType(LOCATION)

# Results of the nine text tasks, as nested in an enriched document. The last
# six fields are older spellings that readers still accept.
NLP = _struct(
    preprocessing=_struct(cleaned_text=_S, word_count=_I),
    language_detection=_struct(detected_language=_S, original_language=_S),
    translation=_struct(
        source_language=_S,
        translated_text=_S,
        applied=_B,
        translated_from_original=_S,
    ),
    ner=_struct(entities=ENTITIES),
    location_extraction=_struct(locations=LOCATIONS),
    category_classification=_struct(
        category=_S, category_scores=T.MapType(_S, _I)
    ),
    keyword_extraction=_struct(keywords=_STRINGS),
    summary=_struct(summary_text=_S),
    sentiment=_struct(polarity_score=_D, label=_S, compound=_D),
    language=_S,
    category=_S,
    keywords=_STRINGS,
    entities=ENTITIES,
    locations=LOCATIONS,
    translation_applied=_B,
)

ENRICHED = _struct(
    article_id=_S,
    title=_S,
    url_domain=_S,
    source_country=_S,
    published_date=_S,
    full_text_payload=_S,
    processed_text=_S,
    nlp=NLP,
    processed_at=_S,
    predicted_category=_S,
    category=_S,
    task_errors=_STRINGS,
    error_reasons=_STRINGS,
)

PAYLOAD = _struct(
    article_id=_S,
    title=_S,
    domain=_S,
    source_country=_S,
    published_date=_S,
    category=_S,
    sentiment_score=_D,
    sentiment_label=_S,
    language=_S,
    entities=_STRINGS,
    locations=_STRINGS,
    keywords=_STRINGS,
)

# A vector collection: one row per point, keyed by the article.
COLLECTION = T.StructType(
    [
        T.StructField("point_id", _S, True),
        T.StructField("vector", T.ArrayType(T.FloatType()), True),
        T.StructField("payload", PAYLOAD, True),
    ]
)
VECTOR_SIZE = 384

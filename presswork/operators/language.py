"""Language detection and translation routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.dictionaries import FUNCTION_WORDS
from presswork.functions.binding import let
from presswork.functions.models import Loader, try_model, try_models

FALLBACK = "en"

def detect_language(text: Column, profiles: dict[str, tuple[str, ...]] = FUNCTION_WORDS) -> Column:
    """Language whose function words are most frequent; ``en`` when none occurs.

    Ties go to the language listed first.
    """

    def hits_of(tokens: Column, words: tuple[str, ...]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(*words)))

    def choose(tokens: Column) -> Column:
        scores = [
            F.struct(
                hits_of(tokens, ws).alias("hits"),
                F.lit(-rank).alias("rank"),
                F.lit(code).alias("code"),
            )
            for rank, (code, ws) in enumerate(profiles.items())
        ]
        return let(
            F.array_max(F.array(*scores)),
            lambda best: F.when(best["hits"] > 0, best["code"]).otherwise(F.lit(FALLBACK)),
        )

    known = sorted({w for ws in profiles.values() for w in ws})
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    hits = F.filter(tokens, lambda t: t.isin(*known))
    return F.coalesce(let(hits, choose), F.lit(FALLBACK))


def try_detect_with(text: Column, load: Loader) -> Column:
    """Struct of the language by a plugged-in model, lower case, and why there is none."""
    return let(try_model(text, load, "string"), lambda r: F.struct(F.lower(r["value"]).alias("value"), r["error"].alias("error")))


def detect_with(text: Column, load: Loader) -> Column:
    """Language by a plugged-in model, lower case; ``en`` where it fails."""
    return F.coalesce(try_detect_with(text, load)["value"], F.lit(FALLBACK))


def translate(
    df: DataFrame, text: str, lang: str, translators: dict[str, Loader] | None = None
) -> DataFrame:
    """Add ``translated_text``, ``translation_applied``, ``translation_failed`` and ``translation_error``.

    ``translators`` holds a model per source language; a text passes once, to the model
    of its own. English, unknown and unserved languages keep their text, and so does a
    text the model fails on.
    """
    source = F.col(text)
    served = {code: load for code, load in (translators or {}).items() if code != FALLBACK}
    if not served:
        return df.withColumns(
            {
                "translated_text": source,
                "translation_applied": F.lit(False),
                "translation_failed": F.lit(False),
                "translation_error": F.lit(None).cast("string"),
            }
        )
    mine = F.col(lang).isin(*served) & source.isNotNull()
    routed = try_models(F.when(mine, source), F.when(mine, F.col(lang)), served, "string")
    translated = df.withColumn("_routed", routed).withColumns(
        {
            "translated_text": F.coalesce("_routed.value", source),
            "translation_failed": F.coalesce(mine, F.lit(False)) & F.col("_routed.value").isNull(),
            "translation_error": F.col("_routed.error"),
        }
    ).drop("_routed")
    applied = (F.col(lang) != FALLBACK) & (F.col("translated_text") != source)
    return translated.withColumn("translation_applied", F.coalesce(applied, F.lit(False)))

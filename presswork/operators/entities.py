"""Named entities and locations by rule."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork import dictionaries as d
from presswork.cluster import materialize
from presswork.functions.binding import non_empty
from presswork.schemas import ENTITIES

_MONTH = "(?:" + "|".join(d.MONTHS) + ")"
DATE = (
    rf"{_MONTH} [0-9]{{1,2}}(?:, [0-9]{{4}})?|[0-9]{{1,2}} {_MONTH}(?: [0-9]{{4}})?"
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}|(?:" + "|".join(d.WEEKDAYS) + ")"
)
PERCENT = r"[0-9]+(?:[.,][0-9]+)*(?:%| percent)"
MONEY = r"[$€£¥][0-9]+(?:[.,][0-9]+)*(?: (?:million|billion|trillion))?"
_NAME_WORD = r"\p{Lu}\p{L}*(?:[-'’]\p{L}+)*"
NAME = rf"{_NAME_WORD}(?: {_NAME_WORD})*"
# A capitalised function word and its space: matched on its own, so that it
# neither opens a name nor hides a date.
LEAD = "(?:" + "|".join(d.LEADING_WORDS) + ") "
# A mention starts where no word is under way; an amount may follow a word. The
# look-ahead rules out most positions before anything else is tried.
MENTION = rf"(?=[\p{{Lu}}0-9])(?<![\p{{L}}\p{{Nd}}])(?:{DATE}|{PERCENT}|{LEAD}|{NAME})|{MONEY}"

CURRENCIES = ("$", "€", "£", "¥")
SALT = 16
Known = Callable[[Column], Column]


def _label(name: Column, is_place: Known) -> Column:
    known = F.lower(name)
    several = name.contains(" ")
    head = F.substring_index(name, " ", -1)
    return (
        F.when(is_place(known), "GPE")
        .when(several & head.isin(*d.LOCATION_HEADS), "LOC")
        .when((several & head.isin(*d.EVENT_HEADS)) | (name == "Olympics"), "EVENT")
        .when((several & head.isin(*d.ORGANIZATION_HEADS)) | known.isin(*d.ORGANIZATIONS), "ORG")
        .when(several, "PERSON")
        .when(name.rlike("^[A-Z]{2,6}$"), "ORG")
    )


def _entity(mention: Column, is_place: Known) -> Column:
    def named(name: Column) -> Column:
        return F.struct(name.alias("text"), _label(name, is_place).alias("label"))

    def fixed(label: str) -> Column:
        return F.struct(mention.alias("text"), F.lit(label).alias("label"))

    # Only dates and amounts have digits, and only amounts these marks.
    return (
        F.when(F.substring(mention, 1, 1).isin(*CURRENCIES), fixed("MONEY"))
        .when(mention.endswith("%") | mention.endswith(" percent"), fixed("PERCENT"))
        .when(mention.isin(*d.WEEKDAYS) | mention.rlike("[0-9]"), fixed("DATE"))
        .otherwise(named(mention))
    )


def _among(gazetteer: Sequence[str] | Column) -> Known:
    """Test for lower-cased names: a short list, or an array column of a row's known names."""
    if isinstance(gazetteer, Column):
        return lambda name: F.coalesce(F.array_contains(gazetteer, name), F.lit(False))
    return lambda name: name.isin(*gazetteer)


def mentions(text: Column) -> Column:
    """Dates, amounts and capitalised runs in text order."""
    matches = F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))
    return F.filter(matches, lambda m: ~m.endswith(" "))


def extract_entities(text: Column, gazetteer: Sequence[str] | Column = d.GAZETTEER) -> Column:
    """Entities in text order: dates, percentages, money, places and names.

    A run of capitalised words after any function words is a name; a single
    capitalised word counts only when a list knows it or it is an acronym. ``gazetteer``
    is a short list, or the column that ``with_known_places`` makes of a table.
    """
    is_place = _among(gazetteer)
    found = F.transform(mentions(text), lambda m: _entity(m, is_place))
    kept = F.filter(found, lambda e: e["label"].isNotNull())
    return F.coalesce(kept, F.array().cast(ENTITIES))


def extract_locations(entities: Column, gazetteer: Sequence[str] | Column = d.GAZETTEER) -> Column:
    """GPE and LOC entities with a flag for names the gazetteer knows."""
    is_place = _among(gazetteer)
    places = F.filter(entities, lambda e: e["label"].isin("GPE", "LOC"))
    return F.transform(
        places,
        lambda e: F.struct(
            e["text"].alias("text"),
            is_place(F.lower(e["text"])).alias("verified_location"),
        ),
    )


def with_known_places(df: DataFrame, text: str, gazetteer: DataFrame, output: str) -> DataFrame:
    """``df`` with the names of a gazetteer table (``name``, lower case) that each text mentions.

    The rows are stored once with a number. Each row's distinct mentions meet the table in a
    join that is salted by row, so neither the table's size nor a name that fills many
    texts matters; what comes back is a short array per row.
    """
    stored = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "mentioning")
    lowered = F.array_distinct(F.transform(mentions(F.col(text)), F.lower))
    mentioned = stored.select("_row", F.explode(non_empty(lowered)).alias("name"))
    mentioned = mentioned.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALT)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    names = gazetteer.select("name").filter("name IS NOT NULL").distinct().withColumn("_salt", salts)
    found = mentioned.join(names, ["name", "_salt"]).groupBy("_row").agg(F.collect_set("name").alias(output))
    return stored.join(found, "_row", "left").drop("_row")


def verify_locations(df: DataFrame, key: str, entities: str, gazetteer: DataFrame) -> DataFrame:
    """``key, locations`` against a gazetteer table (``name``, lower case).

    A table too large to travel is joined by name; a name that fills many
    articles is then split by the adaptive join. Positions keep the text order.
    """
    names = gazetteer.select("name").distinct().withColumn("known", F.lit(True))
    mentions = (
        df.select(key, F.posexplode(non_empty(F.col(entities))).alias("position", "entity"))
        .filter(F.col("entity.label").isin("GPE", "LOC"))
        .select(key, "position", F.col("entity.text").alias("text"))
        .withColumn("name", F.lower("text"))
    )
    flagged = mentions.join(names, "name", "left").select(
        key,
        F.struct(
            "position",
            "text",
            F.coalesce("known", F.lit(False)).alias("verified_location"),
        ).alias("place"),
    )
    per_article = flagged.groupBy(key).agg(F.array_sort(F.collect_list("place")).alias("places"))
    located = per_article.select(
        key,
        F.transform(
            "places", lambda p: F.struct(p["text"].alias("text"), p["verified_location"].alias("verified_location"))
        ).alias("locations"),
    )
    return df.select(key).join(located, key, "left").withColumn(
        "locations",
        F.coalesce("locations", F.array().cast("array<struct<text:string,verified_location:boolean>>")),
    )

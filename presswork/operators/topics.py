"""Category, keywords and the category a query names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.dictionaries import CATEGORY_KEYWORDS, QUERY_TERMS, STOP_WORDS
from presswork.functions.binding import let

# --- Fixed values: category without hits, pattern of a word, keywords reported.
GENERAL = "General"
WORD = r"[a-zA-Z][a-zA-Z0-9\-]{2,}"
TOP_WORDS = 8

Keywords = dict[str, Sequence[str]]
_NO_WORDS = "array<string>"


def category_scores(text: Column, keywords: Keywords = CATEGORY_KEYWORDS) -> Column:
    """Map of category to the number of its keywords contained in the text."""

    def scores(lowered: Column) -> Column:
        cells = []
        for category, terms in keywords.items():
            hits = [lowered.contains(t).cast("int") for t in terms]
            cells += [F.lit(category), sum(hits[1:], hits[0])]
        return F.create_map(*cells)

    return let(F.lower(F.coalesce(text, F.lit(""))), scores)


def best_category(scores: Column, keywords: Keywords = CATEGORY_KEYWORDS) -> Column:
    """Highest score, ties in dictionary order; ``General`` when all are zero."""

    def choose(found: Column) -> Column:
        names = list(keywords)
        top = F.greatest(*[found[n] for n in names])
        chain = F.when(top == 0, F.lit(GENERAL))
        for name in names:
            chain = chain.when(found[name] == top, F.lit(name))
        return chain

    return let(scores, choose)


def frequent_words(words: Column, n: int, stop_words: Sequence[str], first_seen: bool) -> Column:
    """The ``n`` most frequent words of an array, without leaving the row.

    Words are sorted with their positions, equal ones lie together, and the
    length of each run is its count. Ties go alphabetically or, with
    ``first_seen``, to the earlier word.
    """
    kept = F.filter(words, lambda w: ~w.isin(*stop_words))
    if first_seen:
        placed = F.transform(kept, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    else:
        placed = kept

    def word(run: Column, i: Column) -> Column:
        return F.get(run, i)["word"] if first_seen else F.get(run, i)

    def rank(run: Column) -> Column:
        size = F.size(run)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0) | (word(run, i) != word(run, i - 1)),
        )

        def count(begin: Column) -> Column:
            ranked = F.transform(
                begin,
                lambda p, j: F.struct(
                    (p - F.coalesce(F.get(begin, j + 1), size)).alias("minus_count"),
                    (F.get(run, p)["at"] if first_seen else F.lit(0)).alias("at"),
                    word(run, p).alias("word"),
                ),
            )
            return F.transform(F.slice(F.sort_array(ranked), 1, n), lambda r: r["word"])

        return F.when(size > 0, let(starts, count)).otherwise(F.array().cast(_NO_WORDS))

    return let(F.sort_array(placed), rank)


def extract_keywords(
    text: Column,
    category: Column,
    n: int = TOP_WORDS,
    keywords: Keywords = CATEGORY_KEYWORDS,
    stop_words: Sequence[str] = STOP_WORDS,
    first_seen: bool = False,
) -> Column:
    """Keywords of the category found in the text, else its most frequent words."""

    def choose(lowered: Column) -> Column:
        listed = F.lit(None).cast(_NO_WORDS)
        for name, terms in keywords.items():
            listed = F.when(category == name, F.array(*[F.lit(t) for t in terms])).otherwise(listed)
        found = F.coalesce(
            F.filter(listed, lambda t: lowered.contains(t)), F.array().cast(_NO_WORDS)
        )
        words = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
        return let(
            found,
            lambda hits: F.when(~lowered.rlike(WORD), F.array().cast(_NO_WORDS))
            .when(F.size(hits) > 0, F.slice(hits, 1, n))
            .otherwise(frequent_words(words, n, stop_words, first_seen)),
        )

    return let(F.lower(F.coalesce(text, F.lit(""))), choose)


def query_category(query: Column, terms: Keywords = QUERY_TERMS) -> Column:
    """Category named by whole words of a query; first listed wins, else null."""
    lowered = F.lower(query)
    chain = None
    for category, names in terms.items():
        pattern = r"(?U)\b(?:" + "|".join(re.escape(n).replace(r"\ ", " ") for n in names) + r")\b"
        hit = lowered.rlike(pattern)
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return chain

"""Lexicon sentiment after Hutto & Gilbert (2014)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork import dictionaries as d
from presswork.functions.binding import let

# --- Fixed values of the published method.
STEP = 0.293
CAPITALS = 0.733
NEGATION = -0.74
DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, QUESTIONS = 0.18, 0.96
ALPHA = 15.0
THRESHOLD = 0.05

SLICE_BYTES = 1 << 20  # of texts whose words are in memory together

TOKEN = r"[\p{L}\p{N}_]+(?:['’-][\p{L}\p{N}_]+)*"


def sentiment_label(compound: Column) -> Column:
    return (
        F.when(compound >= THRESHOLD, "Positive")
        .when(compound <= -THRESHOLD, "Negative")
        .otherwise("Neutral")
    )


SUMS = "struct<words:int,hits:int,total:double,up:double,down:double,flat:int>"


def text_slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Parts of a text column that begin within ``size`` bytes of each other."""
    import numpy as np
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // size
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist()
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        yield texts.slice(start, stop - start)


def _sums(text: Column, valences: dict[str, float]) -> Column:
    """Weighted valences of a text's words: counts, total, and sums by sign.

    The words of a slice of texts are numbered, and only distinct ones are looked up, so the
    cost does not depend on the size of the lexicon. What follows are array operations over
    all lexicon words of the slice and the words before them. Only a slice's words are in memory.
    """
    degrees = {w: STEP for w in d.STRENGTHENERS} | {w: -STEP for w in d.WEAKENERS}
    negations, pattern = frozenset(d.NEGATIONS), TOKEN
    dropped = str.maketrans("", "", "'’")

    def sums(texts: pa.Array) -> pa.Array:
        import numpy as np
        import regex

        find = regex.compile(pattern).findall
        listed = [find(t) for t in texts.to_pylist()]
        sizes = np.array([len(x) for x in listed], np.int64)
        found = pa.array([t for tokens in listed for t in tokens], pa.string()).dictionary_encode()
        distinct = found.dictionary.to_pylist()
        words = [t.lower().translate(dropped) for t in distinct]

        def each(values, kind=float):
            return np.array(values, kind)[number] if len(number) else np.zeros(0, kind)

        number = found.indices.to_numpy()
        valence = each([valences.get(w, np.nan) for w in words])
        step = each([degrees.get(w, np.nan) for w in words])
        negation = each([w in negations for w in words], bool)
        shouted = each([len(t) > 1 and t == t.upper() != t.lower() for t in distinct], bool)
        is_but = each([w == "but" for w in words], bool)

        n = len(sizes)
        owner, first = np.repeat(np.arange(n), sizes), np.cumsum(sizes) - sizes
        loud = np.bincount(owner[shouted], minlength=n)
        emphatic = (loud > 0) & (loud < sizes)
        turn = np.full(n, len(number))
        turns = np.flatnonzero(is_but)[::-1]
        turn[owner[turns]] = turns  # the first of a text is written last

        hit = np.flatnonzero(~np.isnan(valence) & np.isnan(step))
        of_text, own = owner[hit], valence[hit]
        sign = np.where(own > 0, 1.0, -1.0)
        out = own + np.where(emphatic[of_text] & shouted[hit], sign * CAPITALS, 0.0)
        for distance, damping in enumerate(DAMPING, 1):
            inside = hit - distance >= first[of_text]
            before = np.where(inside, hit - distance, 0)
            degree = inside & np.isnan(valence[before]) & ~np.isnan(step[before])
            out = out + np.where(degree, sign * np.nan_to_num(step[before]) * damping, 0.0)
        # One factor after another, as the method multiplies.
        for distance in range(1, len(DAMPING) + 1):
            inside = hit - distance >= first[of_text]
            before = np.where(inside, hit - distance, 0)
            out = np.where(inside & negation[before], out * NEGATION, out)
        turned = turn[of_text] < len(number)
        out = out * np.where(~turned, 1.0, np.where(hit < turn[of_text], BEFORE_BUT, AFTER_BUT))

        def add(rows, values):
            return np.bincount(of_text[rows], values[rows], minlength=n)

        columns = {
            "words": sizes.astype(np.int32),
            "hits": np.bincount(of_text, minlength=n).astype(np.int32),
            "total": np.bincount(of_text, out, minlength=n),
            "up": add(out > 0, out + 1),
            "down": add(out < 0, out - 1),
            "flat": (sizes - np.bincount(of_text[out != 0], minlength=n)).astype(np.int32),
        }
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32())
        return pa.StructArray.from_arrays([pa.array(x).cast(t) for x, t in zip(columns.values(), kinds, strict=True)], names=list(columns))

    @F.arrow_udf(SUMS)
    def of(texts: pa.Array) -> pa.Array:
        parts = [sums(part) for part in text_slices(texts, SLICE_BYTES)]
        return pa.concat_arrays(parts) if parts else sums(texts)

    return of(text)


def sentiment_scores(text: Column, valences: dict[str, float] = d.VALENCES) -> Column:
    """Struct of compound score in [-1, 1] and the three shares."""

    def count(mark: str) -> Column:
        return F.length(whole) - F.length(F.replace(whole, F.lit(mark), F.lit("")))

    whole = F.coalesce(text, F.lit(""))
    asked = count("?")
    marks = F.least(count("!"), F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION + F.when(
        asked > 3, QUESTIONS
    ).when(asked > 1, asked * QUESTION).otherwise(0.0)

    def scores(bound: Column) -> Column:
        s, marks = bound["sums"], bound["marks"]
        total = s["total"] + F.signum(s["total"]) * marks
        up = s["up"] + F.when(s["up"] > -s["down"], marks).otherwise(0.0)
        down = s["down"] - F.when(s["up"] < -s["down"], marks).otherwise(0.0)
        parts = up - down + s["flat"]
        found = F.struct(
            F.round(total / F.sqrt(total * total + ALPHA), 4).alias("compound"),
            F.round(F.try_divide(up, parts), 3).alias("positive"),
            F.round(F.try_divide(s["flat"], parts), 3).alias("neutral"),
            F.round(F.try_divide(F.abs(down), parts), 3).alias("negative"),
        )
        none = F.struct(
            F.lit(0.0).alias("compound"),
            F.lit(0.0).alias("positive"),
            F.when(s["words"] > 0, 1.0).otherwise(0.0).alias("neutral"),
            F.lit(0.0).alias("negative"),
        )
        return F.when(s["hits"] > 0, found).otherwise(none)

    return let(F.struct(_sums(whole, valences).alias("sums"), marks.alias("marks")), scores)


def get_sentiment(text: Column, valences: dict[str, float] = d.VALENCES) -> Column:
    """Struct of ``polarity_score`` and ``label``."""
    return let(
        sentiment_scores(text, valences)["compound"],
        lambda c: F.struct(c.alias("polarity_score"), sentiment_label(c).alias("label")),
    )


def polarity_band(polarity: Column) -> Column:
    """Display band; unlike the label, the threshold itself is neutral."""
    return (
        F.when(polarity > THRESHOLD, "positive")
        .when(polarity < -THRESHOLD, "negative")
        .otherwise("neutral")
    )

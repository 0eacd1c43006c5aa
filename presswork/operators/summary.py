"""Extractive summary: the most central sentences (Erkan & Radev 2004)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.binding import let
from presswork.functions.text import count_words

# --- Fixed values: texts kept whole, similarity that links, accuracy, fallback.
SHORT_WORDS = 40
THRESHOLD = 0.1
EPSILON = 0.1
FALLBACK_CHARS = 200

BLOCK_CELLS = 1_000_000  # sentence pairs, and products of terms, that are worked on together
MAX_STEPS = 1000

SENTENCE_END = r"(?<=[.!?])\s+(?=[\"“'(]?[\p{Lu}\p{Nd}])"


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, SENTENCE_END), lambda s: F.trim(s) != "")


def _summarizer(count: int):
    import re

    import numpy as np

    token = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")

    def weights(bags, copies):
        """Normalised tf-idf of the distinct sentences as (sentence, term, value)."""
        terms = {}
        flat = np.array([terms.setdefault(w, len(terms)) for bag in bags for w in bag], dtype=np.int64)
        width = max(len(terms), 1)
        owner = np.repeat(np.arange(len(bags)), [len(bag) for bag in bags])
        cells, counts = np.unique(owner * width + flat, return_counts=True)
        row, term = cells // width, cells % width
        largest = np.zeros(len(bags))
        np.maximum.at(largest, row, counts)
        spread = np.bincount(term, copies[row], minlength=width)
        value = counts / largest[row] * np.log(copies.sum() / (1.0 + spread))[term]
        norm = np.sqrt(np.bincount(row, value * value, minlength=len(bags)))[row]
        return row, term, np.divide(value, norm, out=np.zeros_like(value), where=norm > 0), width

    def link_blocks(row, term, value, nodes, width):
        """Blocks of sentences ``a..b`` and which sentences each is more similar to than the threshold.

        A block is as large as its cells and products allow; every sum is taken in
        the order of the terms, so blocks do not change results.
        """
        order = np.argsort(term, kind="stable")
        owner, weight = row[order], value[order]
        begin = np.searchsorted(term[order], np.arange(width + 1))
        first = np.searchsorted(row, np.arange(nodes + 1))
        met = begin[term + 1] - begin[term]
        work = np.append(0, np.cumsum(met))[first]
        a = 0
        while a < nodes:
            b = min(a + max(1, BLOCK_CELLS // nodes), int(np.searchsorted(work, work[a] + BLOCK_CELLS, side="right")) - 1)
            b = max(a + 1, b)
            e = slice(first[a], first[b])
            counts = met[e]
            at = np.arange(counts.sum()) + np.repeat(begin[term[e]] - (np.cumsum(counts) - counts), counts)
            cells = np.repeat(row[e] - a, counts) * nodes + owner[at]
            likeness = np.bincount(cells, np.repeat(value[e], counts) * weight[at], minlength=(b - a) * nodes)
            yield a, b, (likeness > THRESHOLD).reshape(b - a, nodes)
            a = b

    def central(parts):
        """Stationary weight of every sentence on the graph of similar ones.

        Equal sentences are one node with a number of copies. Links are found anew
        in each step, block by block: memory grows with the text, not with the
        pairs of its sentences.
        """
        nodes = {}
        owner = [nodes.setdefault(tuple(sorted(token.findall(p.lower()))), len(nodes)) for p in parts]
        copies = np.bincount(owner).astype(float)
        n = len(nodes)
        row, term, value, width = weights(list(nodes), copies)
        rank = np.full(n, 1.0 / len(parts))
        for _ in range(MAX_STEPS):
            new = np.zeros(n)
            for a, b, linked in link_blocks(row, term, value, n, width):
                new += (copies[a:b] * rank[a:b] / np.maximum(linked @ copies, 1.0)) @ linked
            moved = np.sqrt(copies @ (new - rank) ** 2)
            rank = new
            if moved <= EPSILON:
                return rank[owner]
        raise ValueError("the ranks of the sentences do not settle")

    def summarize(parts) -> str:
        if len(parts) > count:
            best = np.argsort(-np.round(central(parts), 12), kind="stable")[:count]
            parts = [parts[i] for i in sorted(best)]
        return " ".join(p.strip() for p in parts)

    return summarize


def try_summarize(text: Column, sentence_count: int = 2) -> Column:
    """Struct of the ``summary`` and, where the sentences could not be ranked, the ``error``.

    Such a text is cut after 200 characters. Sentences are split on the JVM; Python only
    ranks those of one article at a time.
    """

    @F.arrow_udf("struct<summary:string,error:string>")
    def run(texts: pa.Array) -> pa.Array:
        summarizer = _summarizer(sentence_count)

        def one(parts):
            if parts is None:
                return None, None
            try:
                return summarizer(parts), None
            except (ValueError, FloatingPointError) as error:
                return None, f"{type(error).__name__}: {error}"

        # The sentences of one article at a time are Python strings.
        found = [one(p.as_py()) for p in texts]
        columns = zip(*found, strict=True) if found else ((), ())
        return pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in columns], names=["summary", "error"])

    short = count_words(text) < SHORT_WORDS
    cut = F.concat(F.substring(text, 1, FALLBACK_CHARS), F.lit("..."))

    def chosen(ranked: Column) -> Column:
        summary = F.when(short, text).otherwise(F.coalesce(ranked["summary"], cut))
        return F.struct(summary.alias("summary"), ranked["error"].alias("error"))

    return let(run(F.when(~short, sentences(text))), chosen)


def summarize(text: Column, sentence_count: int = 2) -> Column:
    """The most central sentences in text order; short texts are their own summary."""
    return try_summarize(text, sentence_count)["summary"]

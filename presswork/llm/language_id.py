"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities of the pieces of one fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, which a forward
pass over the piece lattice computes; a text's score is the sum over its words. The
probabilities are learned by expectation maximisation: the corpus is reduced to word
counts per language once, and each step adds up expected piece counts over distinct
words. Only piece counts, at most vocabulary times languages, reach the driver.

Words are maximal runs of letters, lower-cased, with the vocabulary's mark for a word's
begin. Words that a worker has met keep their scores, so a step costs once per new word.

Defined cases: a null text and one without any letter get ``und`` and score 0, as does
every text if nothing could be learned; equal scores go to the first language by name;
characters outside the vocabulary count as one rare piece; rows with a null language are
not learned from; other columns pass through, those with the names of results go.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm import lattice
from presswork.llm.common import TOKENIZERS, fold, kept, strings, table

UNKNOWN = "und"
VOCABULARY = f"{TOKENIZERS}/piece_bpe_32k.model"
STEPS = 2
SMOOTHING = 0.1  # added to every piece's expected count
KNOWN_WORDS = 1_000_000
HELD_COUNTS = 300_000  # distinct words a task gathers before it hands them on
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, word, n`` of ``lang, text`` rows; words are counted in the task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def handed_on() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items() if any(x.isalpha() for x in w)]
            held.clear()
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                held.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, held.values())) > HELD_COUNTS:
                    yield handed_on()
        yield handed_on()

    counts = texts.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Log-probabilities ``[piece, language]``; the last row is for unknown characters."""

    languages: list[str]
    log_p: np.ndarray
    vocabulary: str
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def marked(words: list[str]) -> list[str]:
    return [lattice.SPACE + w for w in words]


def _expected(counts: DataFrame, model, languages: list[str]) -> DataFrame:
    """``lang, piece, n``: expected counts of pieces under the given model."""
    index = {x: i for i, x in enumerate(languages)}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p, size = model.value.log_p, len(model.value.log_p)
        vocabulary = lattice.load_vocabulary(model.value.vocabulary)
        total = np.zeros(len(languages) * size)
        for batch in batches:
            names = batch.column(1).to_pylist()
            order = np.argsort(np.array([len(w) for w in names], dtype=np.int64), kind="stable")
            words = marked([names[i] for i in order])
            of = np.array([index[x] for x in batch.column(0).to_pylist()], dtype=np.int64)[order]
            n = batch.column(2).to_numpy()[order]
            for a, b in lattice.batches(words):
                net = lattice.build(words[a:b], vocabulary)
                own = of[a:b][net.word]
                weight = log_p[net.piece, own][:, None]
                alpha, beta = lattice.forward(net, weight), lattice.backward(net, weight)
                whole = lattice.totals(net, alpha)[net.word, 0]
                share = np.exp(alpha[net.word, net.start, 0] + weight[:, 0] + beta[net.word, net.end, 0] - whole)
                piece = np.where(net.piece < 0, size - 1, net.piece)
                total += np.bincount(own * size + piece, weights=share * n[a:b][net.word], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((some // size).astype(np.int32)), pa.array((some % size).astype(np.int32)), pa.array(total[some])], names=["lang", "piece", "n"])

    sums = counts.mapInArrow(add_up, "lang int, piece int, n double")
    return sums.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, steps: int = STEPS, vocabulary: str = VOCABULARY, smoothing: float = SMOOTHING, text: str = "text", lang: str = "lang") -> Model:
    """Piece probabilities of every language in ``docs``."""
    spark = docs.sparkSession
    chosen = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = materialize(word_counts(chosen), "words")
    languages = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    size = lattice.load_vocabulary(vocabulary).size + 1
    model = Model(languages, np.full((size, len(languages)), -np.log(size)), vocabulary)
    for _ in range(steps if languages else 0):
        rows = _expected(counts, spark.sparkContext.broadcast(model), languages).toPandas()
        found = np.full((size, len(languages)), smoothing)
        found[rows["piece"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy()
        found[-1] = smoothing  # what the vocabulary lacks says nothing of a language
        model = Model(languages, np.log(found / found.sum(axis=0)), vocabulary)
    return model


class Scorer:
    """Scores of texts, with those of known words remembered."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, lattice.load_vocabulary(model.vocabulary)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))

    def _learn(self, words: list[str]) -> None:
        words.sort(key=len)
        lettered = [w for w in words if any(x.isalpha() for x in w)]
        # The last row is that of "words" without letters, which do not count.
        fresh = np.zeros((len(words), len(self.model.languages)))
        for a, b in lattice.batches(lettered):
            net = lattice.build(marked(lettered[a:b]), self.vocabulary)
            fresh[a:b] = lattice.totals(net, lattice.forward(net, self.model.log_p[net.piece]))
        others = [w for w in words if not any(x.isalpha() for x in w)] if len(lettered) < len(words) else []
        base = len(self.scores)
        self.known.update({w: base + i for i, w in enumerate([*lettered, *others])})
        self.scores = np.concatenate([self.scores, fresh])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        split = [words_of(t) for t in texts]
        missing = set().union(*split).difference(self.known)
        if missing:
            self._learn(list(missing))
        get = self.known.__getitem__
        counts = np.array([len(x) for x in split])
        at = np.fromiter((i for words in split for i in map(get, words)), np.int64, int(counts.sum()))
        total = np.zeros((len(texts), max(1, len(self.model.languages))))
        some = np.flatnonzero(counts)
        if len(some) and self.model.languages:
            starts = (np.cumsum(counts) - counts)[some]
            total[some] = np.add.reduceat(self.scores[at], starts, axis=0)
        best = total.argmax(axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        share = share.max(axis=1) / share.sum(axis=1)
        none = np.array([not any(x.isalpha() for x in t) for t in texts]) if texts else np.zeros(0, bool)
        none |= not self.model.languages
        share[none] = 0.0
        return [UNKNOWN if n else self.model.languages[b] for n, b in zip(none, best, strict=True)], share


def scorer(model: Model) -> Scorer:
    """The worker's scorer of this model, kept from task to task."""
    return kept(("language", model.key), lambda: Scorer(model))


def predicted(spark: SparkSession, text: Column, model: Model) -> Column:
    """Struct of ``lang`` and ``score`` for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def of(texts: pa.Array) -> pa.Array:
        own, langs, scores = scorer(shared.value), [], []
        for a in range(0, len(texts), 256):
            some, share = own.predict(strings(texts.slice(a, 256)))
            langs += some
            scores.append(share)
        values = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(values)], names=["lang", "score"])

    return of(text)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    out = docs.drop("lang_pred", "score").withColumn("_language", predicted(docs.sparkSession, F.col(text), model))
    return out.withColumns({"lang_pred": F.col("_language.lang"), "score": F.col("_language.score")}).drop("_language")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = learn(docs.filter(~held_out))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_language_id": op5_language_id}
ORACLES: dict[str, str] = {}

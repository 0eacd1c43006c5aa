import itertools
import math
import random

import numpy as np
import pytest

from presswork.llm import language_id as li
from presswork.llm import lattice

VOCABULARY = lattice.load_vocabulary(li.VOCABULARY)
PIECES = dict(zip(VOCABULARY.pieces, VOCABULARY.ids.tolist(), strict=True))


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        yield [word[a:b] for a, b in itertools.pairwise(at)]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    log_p = np.log(rng.dirichlet(np.ones(VOCABULARY.size + 1), 2).T)
    words = sorted(["▁the", "▁ation", "▁漢x", "▁été", "▁", "▁\U0001f600ab", "▁worthless"], key=len)
    net = lattice.build(words, VOCABULARY)
    alpha = lattice.forward(net, log_p[net.piece])
    beta = lattice.backward(net, log_p[net.piece])
    for i, word in enumerate(words):
        sums = np.zeros(2)
        for parts in segmentations(word):
            ids = [PIECES.get(p, -1 if len(p) == 1 else None) for p in parts]
            if None not in ids:
                sums += np.exp(log_p[ids].sum(axis=0))
        assert np.allclose(lattice.totals(net, alpha)[i], np.log(sums))
        assert np.allclose(beta[i, 0], np.log(sums))


def test_ranges_of_words_are_bounded():
    words = sorted(["a" * n for n in [1] * 50 + [7] * 20 + [1000, 5000]], key=len)
    ranges = list(lattice.batches(words, 100))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(len(words)))
    assert all(b - a == 1 or (b - a) * (len(words[b - 1]) + 1) <= 100 for a, b in ranges)


def test_expected_counts_by_enumeration(spark):
    counts = spark.createDataFrame([("a", "the", 3), ("b", "the", 1), ("a", "ab", 2)], "lang string, word string, n long")
    size = VOCABULARY.size + 1
    model = li.Model(["a", "b"], np.full((size, 2), -math.log(size)), li.VOCABULARY)
    got = {(r["lang"], r["piece"]): r["n"] for r in li._expected(counts, spark.sparkContext.broadcast(model), ["a", "b"]).collect()}
    want = {}
    for lang, word, n in ((0, "▁the", 3), (1, "▁the", 1), (0, "▁ab", 2)):
        paths = [p for p in segmentations(word) if all(x in PIECES for x in p)]
        mass = [size ** -len(p) for p in paths]
        for p, m in zip(paths, mass, strict=True):
            for x in p:
                want[lang, PIECES[x]] = want.get((lang, PIECES[x]), 0) + n * m / sum(mass)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = li.op5_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(out) == docs.count() and out["score"].between(0, 1).all()
    held = out[out["held_out"]]
    assert len(held) > 250 and (held["lang"] == held["lang_pred"]).mean() > 0.98


@pytest.fixture
def model(spark):
    rng = random.Random(1)
    rows = [(lang, " ".join(rng.choices(words, k=30))) for lang, words in (("x", ["the", "nation", "was"]), ("y", ["der", "über", "nicht"])) for _ in range(20)]
    rows += [(None, "the the the"), ("x", None)]
    return li.learn(spark.createDataFrame(rows, "lang string, text string"))


def test_defined_cases(spark, model):
    texts = ["The nation.", "NICHT über", None, "", "12 ½ ² _ !", "漢字", "the " * 50_000 + "der", "a" * 3000, "the\x00nation"]
    docs = spark.createDataFrame([(i, t, "old", 7.0) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, score double")
    out = {r["doc_id"]: r for r in li.identify(docs, model).collect()}
    got = [out[i]["lang_pred"] for i in range(len(texts))]
    assert got[:7] == ["x", "y", "und", "und", "und", "x", "x"] and got[8] == "x"
    assert [out[i]["score"] for i in (2, 3, 4)] == [0, 0, 0] and out[5]["score"] == pytest.approx(0.5)
    assert li.identify(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([(None, "text")], "lang string, text string")
    out = li.identify(empty, li.learn(empty)).first()
    assert (out["lang_pred"], out["score"]) == ("und", 0.0)


def test_score_does_not_depend_on_company(spark, model):
    alone = li.Scorer(model)
    texts = ["the nation was über", "der", "unseen words of the nation"]
    together = li.Scorer(model).predict(texts * 3)
    for i, t in enumerate(texts * 3):
        langs, score = alone.predict([t])
        assert langs[0] == together[0][i] and score[0] == pytest.approx(together[1][i])

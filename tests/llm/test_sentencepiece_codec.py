import itertools
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import lattice
from presswork.llm import sentencepiece_codec as sc

VOCABULARY = lattice.load_vocabulary(sc.VOCABULARY)
PIECES = dict(zip(VOCABULARY.pieces, VOCABULARY.ids.tolist(), strict=True))
own = sc.sampler(sc.VOCABULARY, sc.ALPHA, sc.SEED)


@given(st.lists(st.text(max_size=40) | st.text(alphabet=" ab▁\n漢\U0001f600", max_size=30), max_size=5))
@settings(max_examples=200, deadline=None)
def test_decoding_restores_every_text(texts):
    ids = own.encode(np.arange(len(texts)), texts)
    assert [sc.decode_ids(x, VOCABULARY) for x in ids] == texts


def paths(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in itertools.pairwise(at)]
        if all(p in PIECES for p in parts):
            yield tuple(PIECES[p] for p in parts)


@pytest.mark.parametrize("word", [" there", "   a", "tions"])
def test_samples_follow_the_weights_of_all_paths(word):
    mass = {p: np.exp(own.log_weight[list(p)].sum()) for p in paths(word.replace(" ", "▁"))}
    total, n = sum(mass.values()), 20_000
    got = Counter(tuple(x.tolist()) for x in own.encode(np.arange(n), [word] * n))
    assert set(got) <= set(mass) and len(mass) > 1
    for p, m in mass.items():
        share = m / total
        assert abs(got[p] / n - share) < 5 * np.sqrt(share * (1 - share) / n) + 1e-4


def test_a_sample_depends_on_key_and_text_only():
    texts = ["the nation was there for the nation " * 9, "other words", "the nation was there for the nation " * 9]
    keys = np.array([5, 6, 7])
    together = own.encode(keys, texts)
    for k, t, ids in zip(keys, texts, together, strict=True):
        assert np.array_equal(own.encode(np.array([k]), [t])[0], ids)
    assert not np.array_equal(together[0], together[2])
    other = sc.Sampler(sc.VOCABULARY, sc.ALPHA, sc.SEED + 1).encode(keys, texts)
    assert not np.array_equal(other[0], together[0])


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"the nation number {i} was there" for i in range(50)]
    want = own.encode(np.arange(50), texts)
    monkeypatch.setattr(sc, "KNOWN_EDGES", 10)
    forgetful = sc.Sampler(sc.VOCABULARY, sc.ALPHA, sc.SEED)
    for i in range(50):
        assert np.array_equal(forgetful.encode(np.array([i]), texts[i : i + 1])[0], want[i])


def test_operator_and_defined_cases(spark, small_batches):
    texts = [None, "", " ", "a  b", "é\t漢\x00", "word " * 5000, "x" * 5000]
    rows = [(i if i else None, t, "old") for i, t in enumerate(texts)] + [(1, "a  b", "old")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    out = sc.decode(sc.encode(docs)).collect()
    assert all(r["decoded"] == r["text"] for r in out) and [r["ids"] for r in out if r["text"] is None] == [None]
    assert len({tuple(r["ids"]) for r in out if r["doc_id"] == 1 and r["text"]}) == 1
    assert sc.decode(sc.encode(docs.limit(0))).count() == 0


def test_query_over_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    out = sc.op2_sentencepiece(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.count() == docs.count() and out.filter("NOT lossless").count() == 0
    ids = sc.encode(docs).select("doc_id", sc.F.size("ids").cast("long").alias("n_ids"))
    assert out.select("doc_id", "n_ids").exceptAll(ids).count() == 0

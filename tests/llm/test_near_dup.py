import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from presswork.llm import near_dup as nd
from presswork.llm.components import components


def words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", text.lower())


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def weighted(texts):
    """Plain weights of the whole corpus."""
    counts = [shingles(t or "") for t in texts]
    df = Counter(s for c in counts for s in c)
    idf = lambda s: 1 + nd.IDF_GAIN * np.log(min(1.0, max(df[s] / len(texts), nd.RARE))) / np.log(nd.RARE)
    return [{s: n * idf(s) for s, n in c.items()} for c in counts]


def jaccard(a, b):
    low = sum(min(w, b[s]) for s, w in a.items() if s in b)
    return low / (sum(a.values()) + sum(b.values()) - low) if a and b else 0.0


def classes(texts, pairs):
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    return [find(i) for i in range(len(texts))]


def brute(texts):
    w = weighted(texts)
    pairs = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if (texts[i] or "") == (texts[j] or "") or jaccard(w[i], w[j]) >= nd.THRESHOLD
    ]
    return classes(texts, pairs)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    fresh = lambda n: rng.choices(vocabulary, k=n)
    passage = fresh(60)
    texts = [" ".join(fresh(rng.randrange(1, 200))) for _ in range(60)]
    texts += [" ".join(fresh(100) + passage + fresh(100)) for _ in range(40)]
    for _ in range(12):
        base = fresh(rng.randrange(60, 300))
        for _ in range(rng.randrange(2, 12)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy) + rng.choice(["", ".", "!"]))
    texts += texts[:30] + [None, "", "", "...", "!!", "one", "One", "one two three four", "one two three", "é", "É"]
    rng.shuffle(texts)
    return texts


def test_classes_are_those_of_all_pairs(documents, stored, spark, small_batches):
    texts = corpus()
    got = {r["doc_id"]: r["class_id"] for r in nd.op10_near_dup(spark, stored(documents=documents(texts).repartition(3))).collect()}
    want = brute(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    by_id = {r["doc_id"]: r["text"] for r in rows.collect()}
    ids = sorted(by_id)
    want = brute([by_id[i] for i in ids])
    found, _ = nd.near_duplicates(rows)
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == {i: ids[c] for i, c in zip(ids, want, strict=True)}


def test_shingles_of_a_slice_are_those_of_each_text():
    texts = ["a b c d e f", "", None, "A  b, c\nD e F", "a b", "b a", "ä ö", "a b c d e f a b c d e f", "x" * 5000]
    keys, counts, offsets = nd.shingle_counts(pa.array(texts))
    own = [dict(zip(keys[a:b].tolist(), counts[a:b].tolist(), strict=True)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    for i, t in enumerate(texts):
        assert sorted(own[i].values()) == sorted(shingles(t or "").values())
        alone = nd.shingle_counts(pa.array([t], pa.string()))
        assert dict(zip(alone[0].tolist(), alone[1].tolist(), strict=True)) == own[i]
    assert own[0] == own[3] and own[4] != own[5]


@pytest.mark.parametrize("overlap", [0.5, 0.8, 0.95])
def test_samples_agree_as_often_as_the_similarity(overlap):
    rng = np.random.default_rng(1)
    keys = np.sort(rng.choice(1 << nd.KEY_BITS, 3000, replace=False).astype(np.uint64))
    weights = np.where(rng.random(3000) < 0.3, rng.uniform(0.5, 4, 3000), 1.5)
    cut = int(3000 * overlap)
    a, b = (keys[:cut], weights[:cut]), (keys, weights)
    sampler = nd.Sampler(600, 1.5)
    sa, sb = (sampler.signatures(k, w, np.array([0, len(k)]))[0] for k, w in (a, b))
    true = weights[:cut].sum() / weights.sum()
    assert abs(np.mean(sa == sb) - true) < 0.06


def test_a_crowded_band_over_partitions(documents, spark, small_batches):
    """Near copies of one text, in a class that no single task holds."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(200)] = f"other{i}"
        texts.append(" ".join(copy))
    found, _ = nd.near_duplicates(documents(texts).repartition(8))
    assert {r["class_id"] for r in found.collect()} == {0}


def test_one_of_each_class_stays(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(None, long, 1), (3, long, 1), (3, long, 1), (5, long + " more", 1), (7, "other text here", 1), (7, "yet another one", 1), (None, None, 1), (None, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int")
    out = sorted((r["doc_id"] or -1, r["text"] or "") for r in nd.keep_one(docs).collect())
    assert out == [(-1, ""), (3, long), (7, "other text here"), (7, "yet another one")]
    assert nd.keep_one(docs).columns == docs.columns
    assert nd.keep_one(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 50)] + [(100, i) for i in range(101, 140)] + [(139, 200), (7, 7), (3, 4)]
    out = components(spark.createDataFrame(links, "a long, b long"))
    got = {r["node"]: r["label"] for r in out.collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def drifting_classes():
    """Classes of hundreds of edited copies, all of one template; single texts link some of them."""
    rng = random.Random(11)
    template = [f"t{i}" for i in range(150)]
    texts, heads = [], []
    for c in range(4):
        head = template + [f"c{c}x{i}" for i in range(28)]
        heads.append(head)
        for _ in range(170):
            copy = list(head)
            for _ in range(rng.randrange(1, 5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    for a, b in ((0, 1), (2, 3)):
        texts += [" ".join(template + heads[a][150 : 150 + k] + heads[b][150 : 178 - k]) for k in range(6, 24, 2)]
    rng.shuffle(texts)
    return texts


def templated():
    """Texts of one template, pairwise just below the threshold, some pairs above it."""
    rng = random.Random(12)
    template = [f"t{i}" for i in range(180)]
    texts = [" ".join(template + [f"u{i}x{k}" for k in range(20)]) for i in range(300)]
    for i in range(150):
        own = [f"p{i}x{k}" for k in range(20)]
        texts += [" ".join(template + own), " ".join(template + own[:10] + [f"q{i}x{k}" for k in range(10)])]
    rng.shuffle(texts)
    return texts


def links_found(found, texts):
    """Share of the pairs above the threshold that are in one class, and whether each class is one of all pairs."""
    w = weighted(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(w[i], w[j]) >= nd.THRESHOLD]
    got = {r["doc_id"]: r["class_id"] for r in found.collect()}
    return sum(got[i] == got[j] for i, j in pairs) / len(pairs), [got[i] for i in range(len(texts))] == classes(texts, pairs)


def test_drifting_classes_of_one_crowded_band(documents, spark, small_batches):
    texts = drifting_classes()
    found, _ = nd.near_duplicates(documents(texts).repartition(6))
    assert links_found(found, texts) == (1.0, True)


def test_pairs_far_apart_in_a_crowded_band(documents, spark, small_batches):
    """Every text is a class of its own at first, so nothing stands for another."""
    texts = templated()
    found, _ = nd.near_duplicates(documents(texts).repartition(6))
    assert links_found(found, texts) == (1.0, True)


@pytest.mark.parametrize("seed", [1, 2])
def test_overlaps_of_a_block_are_those_of_each_pair(seed, monkeypatch):
    monkeypatch.setattr(nd, "FEATURES", 16)
    rng = np.random.default_rng(seed)
    keys = [np.sort(rng.choice(60, rng.integers(1, 40), replace=False)).astype(np.uint64) for _ in range(30)]
    counts = [rng.integers(1, 6, len(k)).astype(np.uint32) for k in keys]
    idf = lambda k: 1 + k.astype(float) / 100
    a, b = np.arange(0, 30, 2), np.arange(5, 30)
    got = nd.overlaps(keys, counts, idf, a, b)
    plain = [dict(zip(k.tolist(), n.tolist(), strict=True)) for k, n in zip(keys, counts, strict=True)]
    want = [[sum(min(n, plain[j].get(k, 0)) * (1 + k / 100) for k, n in plain[i].items()) for j in b] for i in a]
    assert np.allclose(got, want)


@pytest.mark.parametrize("chunk", [nd.CHUNK, 300])
def test_document_frequencies_are_exact(spark, monkeypatch, chunk):
    # A shingle that few texts of one task hold counts there too; so does one just at the least share.
    monkeypatch.setattr(nd, "CHUNK", chunk)
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(6))
    first = [own(i) + (" one two three four five" if i < 4 else "") for i in range(200)]
    second = [own(i) + (" one two three four five" if i < 260 else "") + (" a b c d e" if i >= 360 else "") for i in range(200, 400)]
    halves = spark.createDataFrame(spark.sparkContext.parallelize([(t,) for t in first + second], 2), "text string")
    df = Counter(s for t in first + second for s in shingles(t))
    for texts in (halves, halves.repartition(7)):
        keys, counts, docs = nd.frequent_shingles(texts, 0.1)
        assert docs == 400
        assert sorted(counts.tolist()) == sorted(n for n in df.values() if n >= 40) == [40, 64]
        assert len(set(keys.tolist())) == len(keys)


def test_rest_of_a_task_is_not_a_small_chunk(monkeypatch):
    # A chunk of few texts would report every shingle it has.
    monkeypatch.setattr(nd, "CHUNK", 50)
    monkeypatch.setattr(nd, "SLICE", 1)
    batch = pa.record_batch([pa.array([" ".join(f"w{i}x{k}" for k in range(14)) for i in range(23)])], names=["text"])
    chunks = list(nd._gathered(iter([batch])))
    assert [n for _, n in chunks] == [5, 5, 5, 8] and all(len(keys) == 10 * n for keys, n in chunks)
    assert list(nd._gathered(iter([]))) == []

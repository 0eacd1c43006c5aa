import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import importance as im

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = {c: c + 32 for c in range(65, 91)}


def runs(text):
    words = re.findall(WORD, (text or "").translate(UPPER))
    return [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target, percent=5, least=20):
    """``(id, n_features, weight, score, rank)`` of every document, in plain Python."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for _, x in docs for f in runs(x))
    t = Counter(bucket(f) for x in target for f in runs(x))
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    rows = []
    for doc_id, text in docs:
        found = runs(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(re.findall(WORD, (text or "").translate(UPPER)))])
    enough = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0]))
    for i, r in enumerate(enough[: percent * len(enough) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=repr)


@given(st.lists(st.binary(max_size=40), max_size=30))
def test_crcs_are_zlibs(parts):
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts) + b"?", np.uint8)
    assert im.crcs(data, np.cumsum(sizes) - sizes, sizes).tolist() == [zlib.crc32(p) for p in parts]


@given(st.lists(st.text(alphabet="aAbZ09 .\n\x7f\x00é日[", max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_features_of_each_text(texts):
    words, found = im.features([t.encode() for t in texts])
    got = Counter((int(o), int(b)) for owner, bucket in found for o, b in zip(owner, bucket, strict=True))
    assert got == Counter((i, zlib.crc32(f.encode()) % 10_000) for i, t in enumerate(texts) for f in runs(t))
    assert words.tolist() == [len(re.findall(WORD, t.translate(UPPER))) for t in texts]


def test_long_texts_and_words():
    texts = ["x" * 300_000, "ab " * 200_000, "é" * 700 + " y " + "z" * 1023 + " z"]
    _, found = im.features([t.encode() for t in texts])
    got = Counter((int(o), int(b)) for owner, bucket in found for o, b in zip(owner, bucket, strict=True))
    assert got == Counter((i, zlib.crc32(f.encode()) % 10_000) for i, t in enumerate(texts) for f in runs(t))


@pytest.fixture
def rows():
    texts = [f"Word{i % 7} of text {i % 11}, " * (i % 13) + "the end" * (i % 2) for i in range(400)]
    return [*enumerate(texts), (400, None), (401, ""), (402, "-- !!"), (403, "Naïve ÉTÉ 日本 " * 30), *[(500, "copy of it all " * 9)] * 3]


def test_against_brute_force(spark, stored, rows, small_batches):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rank", "'x' AS place", "2 AS bucket", "3 AS n").repartition(5)
    target = spark.createDataFrame([(1, "the end of text 3"), (2, None), (3, "Word2 of it")], "item_id long, text string")
    out = im.op13_importance(spark, stored(documents=docs, benchmark=target)).collect()
    want = brute(rows, ["the end of text 3", None, "Word2 of it"])
    assert sorted((tuple(r) for r in out), key=repr) == want and any(r[4] for r in want)


def test_empty_tables_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(None, "a b c " * 10)] * 40, none.schema)
    assert im.resample(none, some).count() == 0
    out = im.resample(some, none)
    assert sorted(r["rank"] for r in out.collect() if r["rank"]) == [1, 2]


def test_target_words_are_drawn_more_often(spark):
    docs = spark.createDataFrame([(i, ("wanted words here " if i % 10 == 0 else "other stuff there ") * 10) for i in range(300)], "doc_id long, text string")
    target = spark.createDataFrame([(0, "wanted words here " * 50)], "item_id long, text string")
    drawn = im.resample(docs, target).filter("rank IS NOT NULL").collect()
    assert len(drawn) == 15 and all(r["doc_id"] % 10 == 0 for r in drawn)

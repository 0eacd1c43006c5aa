import hashlib
import random
from collections import defaultdict

import pytest

from presswork.llm import line_dedup as ld


def brute(texts, min_docs, keep_first=False):
    seen = defaultdict(set)
    split = [(t or "").split("\n") for t in texts]
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower()
    for i, lines in enumerate(split):
        for x in lines:
            seen[key(x)].add(i)
    out, met = [], set()
    for lines in split:
        kept = []
        for x in lines:
            drop = key(x) and len(seen[key(x)]) >= min_docs
            if drop and keep_first and key(x) not in met:
                drop = False
                met.add(key(x))
            if not drop:
                kept.append(x)
        out.append("\n".join(kept))
    return out


def texts_with_common_lines():
    rng = random.Random(3)
    common = ["Common LINE ", "\tÉtat commun", "x", ""]
    texts = [None, "", "\n\n", "common line", "  COMMON line\r\nother\x0b"]
    for i in range(300):
        lines = [f"own {i} {j}" for j in range(rng.randrange(4))]
        lines += rng.choices(common, k=rng.randrange(4))
        lines += [f"rare {rng.randrange(60)}"]
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    return texts + ["common line\n" * 500]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [3, 10])
def test_same_as_brute_force(documents, small_batches, min_docs, keep_first):
    texts = texts_with_common_lines()
    out = ld.dedup_lines(documents(texts).repartition(5), min_docs, keep_first=keep_first)
    got = {r["doc_id"]: r["text"] or "" for r in out.collect()}
    assert got == dict(enumerate(brute(texts, min_docs, keep_first)))


def test_one_line_in_all_documents(documents, spark, small_batches):
    """A run over all partitions and batches; a document on a border counts once."""
    texts = ["same\n" * 7 + f"own {i}" for i in range(200)]
    for min_docs, kept in ((200, False), (201, True)):
        out = ld.dedup_lines(documents(texts).repartition(4), min_docs).collect()
        assert {("same" in r["text"]) for r in out} == {kept}


def test_counts_and_digest(documents, stored, spark):
    texts = texts_with_common_lines()
    rows = ld.op6_line_dedup(spark, stored(documents=documents(texts))).collect()
    want = brute(texts, 10)
    for r in rows:
        i = r["doc_id"]
        assert r["kept_sha256"] == hashlib.sha256(want[i].encode()).hexdigest()
        assert r["n_lines"] == (texts[i] or "").count("\n") + 1


def test_null_ids_repeated_rows_clashing_columns_and_empty_table(spark):
    rows = [(None, "a\nb", 1, 2)] * 2 + [(i, "a", 0, 0) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_dropped int, keep_bits int")
    out = ld.dedup_lines(docs, min_docs=4)
    assert sorted(r["text"] for r in out.collect()) == ["", "", "", "b", "b"]
    assert out.columns == ["doc_id", "text", "keep_bits", "n_lines", "n_dropped"]
    assert ld.dedup_lines(docs.limit(0)).count() == 0


def test_bitmaps_are_small(documents):
    lines = ld.line_keys(documents(["a\n" * 10000, "a"]))
    (row,) = ld.keep_bitmaps(ld.dropped_lines(lines, 2)).filter("doc = 0").collect()
    assert row["n_dropped"] == 10000 and len(row["keep_bits"]) < 100

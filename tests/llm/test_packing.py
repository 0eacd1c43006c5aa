import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import packing as pk

PATH = f"{pk.TOKENIZERS}/word_bpe_49k.json"


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
@settings(max_examples=80, deadline=None)
def test_patterns_hold_every_length(histogram):
    patterns = pk.pack_lengths(histogram, 64)
    held = Counter()
    for lengths, count in patterns:
        assert sum(lengths) <= 64 and count > 0
        for x in lengths:
            held[x] += count
    assert held == Counter(histogram)


def test_many_documents_few_patterns():
    patterns = pk.pack_lengths({x: 10**9 for x in range(1, 2049)})
    assert len(patterns) < 10_000
    filled = sum(sum(x) * n for x, n in patterns)
    assert filled / (2048 * sum(n for _, n in patterns)) > 0.98


TEXTS = [
    None, "", " ", "Hello, World.", "it's I'LL don't.", "x" * 5000, "Ünïcode ÉTÉ, o.k. 12,5.", "a b c\x1cd\x85e",
    "<|endoftext|> <|ENDOFTEXT|>", "Σίσυφος ΟΔΟΣ. İstanbul", "é Å K", "...,, ., é. 5. 7,", "word " * 9000, "日本語 テキスト。", "\U0001f600!",
]


def test_ids_are_the_tokenizers_own():
    plain = pk.encoder(PATH).tokenizer
    got = pk.WordEncoder(PATH).encode([(t or "").encode() for t in TEXTS])
    for text, ids in zip(TEXTS, got, strict=True):
        assert list(np.frombuffer(ids, "<u4")) == plain.encode(text or "", add_special_tokens=False).ids


def test_merges_are_the_tokenizers_own():
    """Every word of the vocabulary, and made ones of many merges."""
    plain = pk.encoder(PATH).tokenizer
    stems = [p.removesuffix("</w>") for p in plain.get_vocab()]
    words = [w for w in stems if w.isalpha() and w.isascii()]
    words += [a + b for a, b in zip(words, words[::-1], strict=True)] + ["über" + w + "ñé" for w in words[:3000]] + ["a" * n for n in range(1, 40)]
    words = [w.lower() for w in words]
    got = pk.WordMerges(PATH).encode(words)
    for word, ids, want in zip(words, got, plain.encode_batch(words, add_special_tokens=False), strict=True):
        assert list(np.frombuffer(ids, "<u4")) == want.ids, word


def test_pieces_cover_all_ids_once(documents, stored, spark, small_batches):
    texts = TEXTS + [f"text {i} " * (i % 40) for i in range(300)]
    rows = pk.op9_packing(spark, stored(documents=documents(texts).repartition(4))).collect()
    tokenizer = pk.encoder(PATH).tokenizer
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_empty_table_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b", 1)] * 3 + [(1, None, 2)] * 2, "doc_id long, text string, rank int")
    out = pk.pack_documents(docs)
    assert out.count() == 5 and out.select("sequence_id", "offset").distinct().count() == 5
    assert pk.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("max_length", [1, 7])
def test_other_lengths(documents, max_length):
    out = pk.pack_documents(documents(["one two three four five six seven eight nine", ""]), max_length=max_length)
    assert out.agg({"length": "max"}).first()[0] == max_length and out.filter(f"offset + length > {max_length}").count() == 0


def test_worker_keeps_only_what_its_stage_needs():
    # The words of an earlier stage must not stay in memory beside those of the next.
    from presswork.llm import common, language_id, lattice, near_dup

    model = language_id.Model(["en"], np.full((lattice.load_vocabulary(language_id.VOCABULARY).size + 1, 1), -1.0), language_id.VOCABULARY)
    first = language_id.scorer(model)
    assert language_id.scorer(model) is first
    own = pk.encoder(PATH)
    assert pk.encoder(PATH) is own and language_id.scorer(model) is not first
    assert len(common._kept) == 1
    common.forget()
    assert not common._kept and near_dup.forget is common.forget

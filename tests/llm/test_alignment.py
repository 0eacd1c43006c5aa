import bisect
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from presswork.llm import alignment as al
from presswork.llm.common import byte_of_letter

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
KNOWN, NAMES = al.memory(A, B)
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
LETTERS = byte_of_letter()


def tokens(text):
    """Ids and bytes of both tokenizers over a whole text."""
    a = TOKENIZER.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    bytes_a = [bytes(LETTERS[c] for c in TOKENIZER.id_to_token(i)) for i in a]
    named = [PIECES.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, named, strict=True)]
    return a, b, bytes_a, bytes_b


def ranges(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def brute(text):
    """Numbers of tokens, spelled groups and linked pairs, from byte ranges alone."""
    if not text:
        return 0, 0, "", []
    a, b, bytes_a, bytes_b = tokens(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return 0, 0, "", []
    at_a, at_b = ranges(bytes_a), ranges(bytes_b)
    cuts = sorted({e for _, e in at_a} & {e for _, e in at_b})
    sides = [[[] for _ in cuts] for _ in "ab"]
    for side, ids, at in zip(sides, (a, b), (at_a, at_b), strict=True):
        for i, (_, e) in zip(ids, at, strict=True):
            side[bisect.bisect_left(cuts, e)].append(str(i))
    groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True)]
    links, j = [], 0
    for i, (s, e) in zip(a, at_a, strict=True):
        while j and at_b[j - 1][1] > s:
            j -= 1
        while j < len(b) and at_b[j][0] < e:
            if at_b[j][1] > s:
                links.append((i, b[j]))
            j += 1
    return len(a), len(b), ";".join(groups), links


TEXTS = [
    None, "", " ", "  ", "\n", "a", "Hello, World.", " it's  I'LL don't. ", "x" * 3000, "Ünïcode ÉTÉ, o.k. 12,5.", "a b c\x1cd\x85e", "a\n b\n  c\n\t d \t\n", "日本語 テキスト。 混ぜる",
    "<|endoftext|> <s></s> <unk> <0x41>", "▁ a▁b", "a　 b  c\xa0 d", "\U0001f600! é é", "word " * 3000, "0123456789 " * 50 + "=" * 200, "tab\tand\x00null", "end with space ", "ﬁ ① ǅ ſ İ",
]


def check(texts):
    counts, owner, pair, groups = al.align_texts([t or "" for t in texts], KNOWN, NAMES)
    links = Counter(zip(owner.tolist(), (pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist(), strict=True))
    for i, t in enumerate(texts):
        n_a, n_b, spelled, linked = brute(t)
        assert groups[i].decode() == spelled, repr(t)[:80]
        assert [int(counts[c][i]) for c in al.RESULT] == [n_a, n_b, spelled.count("|"), len(linked)]
        assert Counter({k[1:]: n for k, n in links.items() if k[0] == i}) == Counter(linked)


def test_hard_texts():
    check(TEXTS)
    assert brute("▁ a")[:2] == (0, 0) and brute("a  b ")[0] > 0


@given(st.lists(st.text(alphabet="aeThin .,'\n\t\xa0é日1 -", max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_any_texts(texts):
    check(texts)


@given(st.lists(st.integers(1, 4), min_size=1, max_size=20), st.randoms(use_true_random=False))
def test_lockstep_of_lanes(sizes, random):
    """Lanes of different length, each with two sets of ends that share the last one."""
    end_a, end_b, first_a, first_b, stop, want = [], [], [], [], [], []
    base = 0
    for n in sizes:
        a, b = (sorted({*random.sample(range(1, n + 3), random.randint(0, n)), n + 3}) for _ in range(2))
        first_a.append(len(end_a))
        first_b.append(len(end_b))
        for i, (s, e) in enumerate(zip([0, *a[:-1]], a, strict=True)):
            want += [(len(end_a) + i, len(end_b) + j) for j, (x, y) in enumerate(zip([0, *b[:-1]], b, strict=True)) if s < y and x < e]
        end_a += [base + x for x in a]
        end_b += [base + x for x in b]
        stop.append(len(end_a))
        base += n + 3
    link_a, link_b, cut_a, cut_b = al.lockstep(*map(np.array, (end_a, end_b, first_a, first_b, stop)))
    assert sorted(zip(link_a.tolist(), link_b.tolist(), strict=True)) == sorted(want)
    shared = set(end_a) & set(end_b)
    assert cut_a.tolist() == [e in shared for e in end_a] and cut_b.tolist() == [e in shared for e in end_b]


def test_memory_starts_afresh(monkeypatch):
    monkeypatch.setattr(al, "KNOWN_CHUNKS", 20)
    for _ in range(3):
        check(TEXTS)
        check(["some other words than before", "and more more words than that"])
    KNOWN.split(["x"])
    assert len(KNOWN.known) <= 20


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_packed_numbers(numbers):
    assert al.unpacked(al.packed(np.array(numbers, np.int64))).tolist() == numbers


def test_against_brute_force(spark, stored, small_batches):
    rows = [*enumerate(TEXTS), *[(900, "copied text here")] * 30, (None, "no id"), *((100 + i, f"the {i} words of the text, {i * 7919}") for i in range(120))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS slice", "2 AS pair", "'x' AS links", "3 AS n_a").repartition(6)
    want = [(i, *brute(t)) for i, t in rows]
    counts = Counter(p for r in want for p in r[4])
    best = {b: max(n for (_, y), n in counts.items() if y == b) for _, b in counts}
    expected = [
        (i, a, b, g.count("|"), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for i, a, b, g, links in want
    ]
    got = al.op11_alignment(spark, stored(documents=docs)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_groups_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "Hello there"), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["groups"] for r in al.align_corpus(docs, A, B, with_groups=True).collect()}
    assert out == {1: brute("Hello there")[2], 2: ""}
    assert al.align_corpus(docs.limit(0), A, B).count() == 0


@pytest.mark.parametrize("text", [" " * 100_000 + "x", "é" * 50_000, "z" * 200_000, "ab\n" * 50_000], ids=str.__len__)
def test_long_texts(text):
    check([text])

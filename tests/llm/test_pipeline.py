import random

import test_line_dedup
import test_near_dup
import test_pii
from tokenizers import Tokenizer

import corpus_pipeline
from presswork.llm import packing

STAGES = dict(corpus_pipeline.STAGES)


def texts():
    rng = random.Random(8)
    words = {"x": [f"the{a}ing" for a in "abcdefgh"] + ["nation", "worth"], "y": [f"über{a}ung" for a in "abcdefgh"] + ["nicht", "schon"]}
    out = []
    for i in range(60):
        own = words["xy"[i % 2]]
        text = " ".join(rng.choice(own) + rng.choice("klmnop") for _ in range(rng.randrange(20, 120)))
        out.append((text + ("\nCommon line here" if i % 3 == 0 else "") + (f"\nmail a{i}@b.cd or 4111 1111 1111 1111" if i % 5 == 0 else ""), "xy"[i % 2]))
    out += [(out[4][0], "x")] * 3 + [(out[6][0] + " more", "x"), (None, None), ("", None), ("12 34!", "x")]
    return out


def test_every_stage_against_plain_python(spark):
    rows = texts()
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(rows)], kind)
    got, names = docs, docs.columns
    by_id = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    kept = STAGES["language_id"](spark, got, "").persist()
    assert kept.columns == names
    want = {i: t for i, (t, _) in enumerate(rows) if t and any(c.isalpha() for c in t)}
    assert by_id(kept) == want

    ids = sorted(want)
    lines = STAGES["line_dedup"](spark, kept, "").persist()
    want = dict(zip(ids, test_line_dedup.brute([want[i] for i in ids], 10), strict=True))
    assert lines.columns == names and by_id(lines) == want
    assert "Common line here" not in [x for t in want.values() for x in t.split("\n")]

    one = STAGES["near_dup"](spark, lines, "").persist()
    classes = test_near_dup.brute([want[i] for i in ids])
    want = {ids[i]: want[ids[i]] for i in set(classes)}
    assert one.columns == names and by_id(one) == want and len(want) < len(ids)

    private = STAGES["pii"](spark, one, "").persist()
    for i, t in list(want.items()):
        for span in reversed(test_pii.brute(t)):
            t = t[: span[1]] + f"<{span[0].upper()}>" + t[span[2] :]
        want[i] = t
    assert private.columns == names and by_id(private) == want

    pieces = STAGES["packing"](spark, private, "").collect()
    tokenizer = Tokenizer.from_file(f"{packing.TOKENIZERS}/word_bpe_49k.json")
    lengths = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}
    assert sorted((r["doc_id"], r["length"]) for r in pieces) == sorted(lengths.items())
    assert sum(r["length"] for r in pieces) == sum(lengths.values())


def test_run_over_given_documents(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    places = out.select("sequence_id", "offset").distinct().count()
    assert places == out.count() > 150


def test_empty_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_columns_of_the_caller_stay(spark):
    """No stage stumbles over a column of its own making, or replaces it."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts())]
    names = ["_id", "_doc", "_node", "_language", "n_lines", "n_dropped", "spans", "part", "row", "doc", "content", "gone", "bits", "node", "language", "key", "salt"]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    docs = plain.select("*", *[(plain.doc_id * (k + 2)).alias(n) for k, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[n] == r["doc_id"] * (k + 2) for r in got for k, n in enumerate(names)), name
        assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((r["doc_id"], r["text"]) for r in stage(spark, plain, "").collect())
        docs, plain = out.persist(), out.select(plain.columns).persist()
    assert packing.pack_documents(docs).count() == packing.pack_documents(plain).count()

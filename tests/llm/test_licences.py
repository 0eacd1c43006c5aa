import pytest

from presswork.llm import licences as lc
from presswork.llm.licence_texts import NOTICES, SPELLINGS, TEXTS

MIT = TEXTS[0][1]


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["licence"], r["notices"]) for r in lc.scan(docs).collect()}


def test_variants_of_a_whole_text(spark):
    variants = [
        MIT,
        MIT.upper(),
        "Copyright (c) 2020 Somebody\n" + MIT + "\n  (C) 2021, others\n© 2022",
        MIT.replace(". ", ".\n\n   ").replace("License", "Licence").replace("sublicense", "sub-license"),
        MIT.replace(" ", "\t"),
        MIT + " And more.",
        MIT.replace("free of charge", "for money"),
    ]
    got = found(spark, variants)
    assert [got[i][0] for i in range(len(variants))] == ["MIT"] * 5 + [None, None]


@pytest.mark.parametrize("rows", [TEXTS, NOTICES])
def test_every_known_text_finds_itself(spark, rows):
    got = found(spark, [t for _, t in rows])
    assert [got[i][0] for i in range(len(rows))] == [n for n, _ in rows]


def test_notices_in_lines(spark):
    text = "Some words.\n  released under the mit licence!\nmore\nALL RIGHTS RESERVED\nnot released under the MIT License."
    assert found(spark, [text, "x"]) == {0: (None, "MIT,Proprietary"), 1: (None, "")}


def test_neighbouring_spellings(spark):
    docs = spark.createDataFrame([("licence licence sub licence v2 v3",)], "x string")
    assert docs.select(lc.spelled(lc.F.col("x"))).first()[0] == "license license sublicense version 2 version 3"
    assert not {good for _, good in SPELLINGS} & {seen for seen, _ in SPELLINGS}


def test_defined_cases(spark):
    got = found(spark, [None, "", " .,! \n", "© all"])
    assert set(got.values()) == {(None, "")}
    docs = spark.createDataFrame([(None, MIT, 1)] * 2, "doc_id long, text string, licence int")
    assert [r["licence"] for r in lc.scan(docs).collect()] == ["MIT", "MIT"]
    assert lc.scan(docs.limit(0)).count() == 0
    own = spark.createDataFrame([("B", "same", False), ("A", "SAME!", True), ("C", None, True)], "licence string, text string, notice boolean")
    (row,) = lc.scan(spark.createDataFrame([(1, "Same\nother")], "doc_id long, text string"), own).collect()
    assert (row["licence"], row["notices"]) == (None, "A")

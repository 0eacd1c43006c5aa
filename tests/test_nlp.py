import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presswork import dictionaries as d
from presswork.operators import collection, enrich, language, sentiment, summary, topics
from presswork.operators.entities import extract_entities, extract_locations, verify_locations
from presswork.operators.sentiment import get_sentiment, polarity_band, sentiment_label, sentiment_scores


def words(n):
    return " ".join(f"w{i}" for i in range(n))


def category(x):
    return topics.best_category(topics.category_scores(x))


def test_category(one):
    assert one(category, "Apple released new AI chip for iPhone") == "Technology"
    assert one(lambda x: topics.category_scores(x)["Technology"], "Apple released new AI chip for iPhone") == 4
    assert one(category, "Market drops 2% on new policy", "he said", "zzz", "", None) == [
        "Business", "Technology", "General", "General", "General",
    ]


def keywords(x, **options):
    return topics.extract_keywords(x, category(x), **options)


def test_keywords(one):
    assert one(keywords, "Apple released new AI chip for iPhone") == ["ai", "apple", "app", "chip"]
    assert one(keywords, "storm storm river and river storm") == ["storm", "river"]
    assert one(keywords, "", "a b c", None, "?!") == [[], [], [], []]
    # The words are too short to count, so the category keyword is not given either.
    assert one(keywords, "ai") == []


def test_keyword_ties(one):
    text = "pear fig fig kiwi pear plum"
    assert one(lambda x: topics.frequent_words(F.split(x, " "), 3, ("kiwi",), False), text) == ["fig", "pear", "plum"]
    assert one(lambda x: topics.frequent_words(F.split(x, " "), 3, ("kiwi",), True), text) == ["pear", "fig", "plum"]


def test_many_keywords_are_cut(one):
    text = " ".join(d.CATEGORY_KEYWORDS["Technology"])
    assert one(keywords, text) == list(d.CATEGORY_KEYWORDS["Technology"][:8])


def test_keywords_against_brute_force(spark):
    import random
    import re
    from collections import Counter

    rng = random.Random(5)
    texts = [" ".join(rng.choice(["zig", "zag", "Zug", "zig-zag", "x1y", "no", "the"]) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = {r["i"]: r["k"] for r in df.select("i", topics.extract_keywords(F.col("x"), F.lit("General")).alias("k")).collect()}
    for i, t in enumerate(texts):
        counts = Counter(w for w in re.findall(r"[a-zA-Z][a-zA-Z0-9\-]{2,}", t.lower()) if w not in d.STOP_WORDS)
        assert got[i] == [w for w, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:8]]


def test_query_category(one):
    queries = ("AI breakthroughs", "election market", "he said", "Artificial  intelligence", "artificial intelligence!", "aide", "économie aié", None)
    assert one(topics.query_category, *queries) == ["Technology", "Politics", None, None, "Technology", None, None, None]


def test_language(one):
    texts = ("the cat is on the mat", "le chat est sur la table", "der Hund und die Katze", "el perro y los gatos", "zzz", "", None)
    assert one(language.detect_language, *texts) == ["en", "fr", "de", "es", "en", "en", "en"]


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right = docs.filter(language.detect_language(F.col("text")) == F.col("lang")).count()
    assert right >= 0.99 * docs.count()


def test_translation_routes(spark):
    rows = [("1", "bonjour", "fr"), ("2", "hello", "en"), ("3", "hallo", "de"), ("4", "x", None), ("5", "bad", "fr"), ("6", "salut", "fr")]
    df = spark.createDataFrame(rows, "id string, x string, lang string").coalesce(1)
    none = language.translate(df, "x", "lang")
    assert not any(r["translation_applied"] for r in none.collect())

    def french():
        def run(texts):
            if "bad" in texts:
                raise RuntimeError("bad text")
            return [t.upper() for t in texts]

        return run

    def broken():
        def run(texts):
            raise RuntimeError("no model")

        return run

    out = {r["id"]: r for r in language.translate(df, "x", "lang", {"fr": french, "de": broken, "en": french}).collect()}
    assert [out[i]["translated_text"] for i in "123456"] == ["BONJOUR", "hello", "hallo", "x", "bad", "SALUT"]
    assert [out[i]["translation_applied"] for i in "123456"] == [True, False, False, False, False, True]


def test_plugged_detector(spark):
    df = spark.createDataFrame([("a",), ("boom",), ("c",)], "x string")

    def load():
        return lambda texts: [{"a": "FR"}[t] if t != "c" else "de" for t in texts]

    out = {r["x"]: r["y"] for r in df.select("x", language.detect_with(F.col("x"), load).alias("y")).collect()}
    assert out == {"a": "fr", "boom": "en", "c": "de"}


def test_entities(one):
    text = "On August 31, Elon Musk visited the Hudson River in New York with $2.5 million, 25% of Apple and US$3. iPhone. NATO met on Monday."
    assert [(e["text"], e["label"]) for e in one(extract_entities, text)] == [
        ("August 31", "DATE"), ("Elon Musk", "PERSON"), ("Hudson River", "LOC"), ("New York", "GPE"),
        ("$2.5 million", "MONEY"), ("25%", "PERCENT"), ("Apple", "ORG"), ("US", "ORG"), ("$3", "MONEY"),
        ("NATO", "ORG"), ("Monday", "DATE"),
    ]
    assert one(extract_entities, "", None, "nothing here 2024") == [[], [], []]
    names = "The World Bank Group. In Paris. The. Olympics 2024-05-06 and World Cup"
    assert [(e["text"], e["label"]) for e in one(extract_entities, names)] == [
        ("World Bank Group", "ORG"), ("Paris", "GPE"), ("Olympics", "EVENT"), ("2024-05-06", "DATE"), ("World Cup", "EVENT"),
    ]


PLACES = [("New York", "GPE"), ("Silicon Valley", "LOC"), ("Canada", "GPE"), ("Elon Musk", "PERSON")]


def test_locations(spark):
    df = spark.createDataFrame([(1, PLACES), (2, [])], "id int, e array<struct<text:string,label:string>>")
    rows = df.select("id", extract_locations(F.col("e"), ["new york", "canada"]).alias("l")).orderBy("id").collect()
    flags = [("New York", True), ("Silicon Valley", False), ("Canada", True)]
    assert [tuple(x) for x in rows[0]["l"]] == flags and rows[1]["l"] == []
    gazetteer = spark.createDataFrame([("new york",), ("canada",), ("canada",)], "name string")
    out = {r["id"]: [tuple(x) for x in r["locations"]] for r in verify_locations(df, "id", "e", gazetteer).collect()}
    assert out == {1: flags, 2: []}


def test_sentiment_labels(spark):
    df = spark.createDataFrame([(0.05,), (0.049,), (-0.05,), (0.051,)], "c double")
    assert [r[0] for r in df.select(sentiment_label(F.col("c"))).collect()] == ["Positive", "Neutral", "Negative", "Positive"]
    assert [r[0] for r in df.select(polarity_band(F.col("c"))).collect()] == ["neutral", "neutral", "neutral", "positive"]


def compound(total):
    return round(total / (total * total + 15) ** 0.5, 4)


def test_sentiment_rules(one):
    cases = {
        "a good day": 1.9,
        "a very good day": 1.9 + 0.293,
        "very really good": 1.9 + 0.293 + 0.293 * 0.95,
        "not good": 1.9 * -0.74,
        "slightly bad": -2.5 + 0.293,
        "good but bad": 1.9 * 0.5 - 2.5 * 1.5,
        "a GOOD day": 1.9 + 0.733,
        "good!!": 1.9 + 2 * 0.292,
        "good!!!!!!": 1.9 + 4 * 0.292,
        "bad??": -2.5 - 0.36,
    }
    got = one(lambda x: get_sentiment(x)["polarity_score"], *cases)
    assert got == pytest.approx([compound(v) for v in cases.values()], abs=1e-4)
    assert one(lambda x: get_sentiment(x)["label"], "good", "bad", "table", "", None) == [
        "Positive", "Negative", "Neutral", "Neutral", "Neutral",
    ]


def test_sentiment_is_bounded(one):
    scores = one(sentiment_scores, "great " * 500, "murder " * 500 + "!!!!", "", "good bad table")
    for s in scores:
        assert -1 <= s["compound"] <= 1
    assert sum(scores[3][k] for k in ("positive", "neutral", "negative")) == pytest.approx(1, abs=0.002)


def test_custom_lexicon(one):
    assert one(lambda x: get_sentiment(x, {"zig": 2.0})["polarity_score"], "zig good") == compound(2.0)


def test_summary(one):
    assert one(summary.summarize, words(39), "", None) == [words(39), "", None]
    centre = "The river flooded the old town after heavy rain. "
    text = centre + "A cat slept. " + "Heavy rain made the river flood the old town again. " + "Nobody saw blue paint anywhere near there. " * 4
    out = one(summary.summarize, text)
    parts = [s.strip() for s in text.split(". ")]
    assert len(out.split(". ")) == 2
    assert all(s.rstrip(".") in " ".join(parts) for s in out.split(". "))


def test_summary_keeps_text_order_and_ties(one):
    same = " ".join(["Alpha beta gamma delta."] * 12)
    assert one(summary.summarize, same) == "Alpha beta gamma delta. Alpha beta gamma delta."


def test_summary_does_not_depend_on_blocks(monkeypatch):
    import random

    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "bcdfg" for b in ("ame", "ilo", "unt", "ek")]
    parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 9))) + "." for _ in range(60)]
    whole = summary._summarizer(2)(parts)
    for cells in (1, 7, 500):
        monkeypatch.setattr(summary, "BLOCK_CELLS", cells)
        assert summary._summarizer(2)(parts) == whole


def test_failing_models_are_counted(spark):
    def odd(texts):
        if any(len(t) % 2 for t in texts if t):
            raise ValueError("odd")
        return ["FR" for _ in texts]

    rows = [(str(n), "t", "d", "US", None, "x" * n) for n in range(1, 7)]
    gold = spark.createDataFrame(rows, "article_id string, clean_title string, domain string, source_country string, published_date date, full_text_payload string")
    docs = enrich.enrich(gold, detector=lambda: odd)
    errors = {r["article_id"]: r["task_errors"] for r in docs.collect()}
    assert errors == {str(n): ["language"] if n % 2 else [] for n in range(1, 7)}
    assert tuple(enrich.enrichment_report(docs).first()) == (6, 3)
    assert [tuple(r) for r in enrich.error_report(docs).collect()] == [("language", "ValueError: odd", 3)]


def test_enrichment_of_edge_rows(spark, small_batches):
    rows = [("1", "t", "d", "US", None, "Apple is good. " * 30), ("2", "t", "d", "US", None, ""), ("3", "t", "d", "US", None, None), ("4", "t", "d", "US", None, "<p></p>")]
    gold = spark.createDataFrame(rows, "article_id string, clean_title string, domain string, source_country string, published_date date, full_text_payload string")
    docs = {r["article_id"]: r for r in enrich.enrich(gold).collect()}
    assert len(docs) == 4
    first = docs["1"]["nlp"]
    assert first["category_classification"]["category"] == "Technology" and first["sentiment"]["label"] == "Positive"
    assert first["preprocessing"]["word_count"] == 90 and first["ner"]["entities"][0]["text"] == "Apple"
    for i in "234":
        assert docs[i]["nlp"]["preprocessing"]["cleaned_text"] == "" and docs[i]["nlp"]["summary"]["summary_text"] == ""
        assert docs[i]["nlp"]["language_detection"]["detected_language"] == "en"


def test_flatten_reads_old_paths(spark):
    old = '{"article_id":"1","nlp":{"language":"fr","category":"Sports","keywords":["k"],"entities":[{"text":"A","label":"ORG"}]}}'
    new = '{"article_id":"2","title":"t","nlp":{"language_detection":{"detected_language":"de"},"category_classification":{"category":"Business"},"sentiment":{"label":"Positive","polarity_score":0.5}}}'
    from presswork.schemas import ENRICHED

    docs = spark.createDataFrame([(old,), (new,), ('{"article_id":"3"}',)], "v string").select(F.from_json("v", ENRICHED).alias("d")).select("d.*")
    flat = {r["article_id"]: r for r in enrich.flatten(docs, with_keywords=True).collect()}
    assert (flat["1"]["detected_language"], flat["1"]["predicted_category"], flat["1"]["keywords"]) == ("fr", "Sports", ["k"])
    assert flat["1"]["ner_entities"][0]["text"] == "A"
    assert (flat["2"]["detected_language"], flat["2"]["sentiment_label"]) == ("de", "Positive")
    assert len(enrich.flatten(docs).columns) == 14
    portal = {r["article_id"]: r for r in enrich.portal_rows(docs).collect()}
    row = portal["3"]
    assert (row["title"], row["domain"], row["source_country"], row["detected_language"]) == ("Untitled Article", "unknown.com", "Global", "en")
    assert (row["predicted_category"], row["sentiment_label"], row["sentiment_polarity"]) == ("General", "Neutral", 0.0)
    assert row["keywords_extracted"] == [] and row["extractive_summary"].startswith("No summary")
    assert len(enrich.portal_rows(docs).columns) == 16
    payload = {r["article_id"]: r for r in collection.payloads(docs).collect()}
    assert payload["1"]["category"] == "Sports" and payload["1"]["language"] == "fr" and payload["3"]["sentiment_score"] == 0.0


def test_hashed_embedding(spark):
    rows = [(1, "alpha beta"), (2, "beta alpha alpha beta"), (3, ""), (4, None), (5, "gamma")]
    out = {r["i"]: np.array(r["vector"]) for r in collection.embed_hashed(spark.createDataFrame(rows, "i int, x string"), "x").collect()}
    assert all(len(v) == 384 for v in out.values())
    assert np.linalg.norm(out[1]) == pytest.approx(1, abs=1e-6) and not out[3].any() and not out[4].any()
    assert out[1] @ out[2] == pytest.approx(1, abs=1e-6) and abs(out[1] @ out[5]) < 0.9


def test_plugged_embedder(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bbb"), (3, "boom")], "i int, x string").coalesce(1)

    def load():
        def run(texts):
            if "boom" in texts:
                raise ValueError("cannot embed")
            return np.array([[len(t), 1.0] for t in texts])

        return run

    out = collection.embed_with(df, "x", load, batch=2).orderBy("i").collect()
    assert [r["vector"] for r in out] == [[1.0, 1.0], [3.0, 1.0], None]


def test_failed_embeddings_are_left_out(spark):
    gold = spark.createDataFrame([("1", "t", "d", "US", None, "fine text"), ("2", "t", "d", "US", None, "boom")], "article_id string, clean_title string, domain string, source_country string, published_date date, full_text_payload string")

    def load():
        return lambda texts: [[1.0] * 384 if "boom" not in t else [1.0] for t in texts]

    out = collection.points(enrich.enrich(gold), load).collect()
    assert [r["payload"]["article_id"] for r in out] == ["1"] and len(out[0]["vector"]) == 384
    tried = collection.points(enrich.enrich(gold), load, failed="why").collect()
    assert {r["point_id"]: r["why"] for r in tried} == {"1": None, "2": "1 components"}


def test_each_text_passes_its_own_model(spark):
    """One pass over texts and languages; a model is loaded only where it is asked for."""
    rows = [(i, t, c) for i, (t, c) in enumerate([("a", "fr"), ("b", "de"), ("c", "en"), (None, "fr"), ("bad", "de"), ("d", None)])]
    df = spark.createDataFrame(rows, "i int, x string, lang string").coalesce(1)

    def marked(code):
        def run(texts):
            assert None not in texts
            if "bad" in texts:
                raise KeyError("bad")
            return [f"{code}:{t}" for t in texts]

        return lambda: run

    def unloadable():
        raise RuntimeError("never asked for")

    out = language.translate(df, "x", "lang", {"fr": marked("fr"), "de": marked("de"), "it": unloadable}).orderBy("i").collect()
    assert [r["translated_text"] for r in out] == ["fr:a", "de:b", "c", None, "bad", "d"]
    assert [r["translation_error"] for r in out] == [None] * 4 + ["KeyError: 'bad'", None]
    assert [r["translation_failed"] for r in out] == [False] * 4 + [True, False]


def test_summary_against_plain_matrices():
    """Erkan & Radev with one row and column per sentence, copies included."""
    import random
    import re

    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in "bcdf" for b in ("ame", "ilo", "unt")]
    parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 7))) + "." for _ in range(25)]
    parts += [parts[3]] * 10 + ["123."]
    bags = [re.findall(r"[a-z]+", p) for p in parts]
    terms = sorted({w for b in bags for w in b})
    idf = {w: np.log(len(bags) / (1 + sum(w in b for b in bags))) for w in terms}
    table = np.array([[b.count(w) / max((b.count(x) for x in b), default=1) * idf[w] for w in terms] for b in bags])
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, norms, out=np.zeros_like(table), where=norms > 0)
    links = (table @ table.T > summary.THRESHOLD).astype(float)
    links /= np.maximum(links.sum(axis=1, keepdims=True), 1)
    rank, moved = np.full(len(bags), 1 / len(bags)), 1.0
    while moved > summary.EPSILON:
        new = links.T @ rank
        rank, moved = new, np.linalg.norm(new - rank)
    best = sorted(np.argsort(-np.round(rank, 12), kind="stable")[:2])
    assert summary._summarizer(2)(parts) == " ".join(parts[i] for i in best)


def test_text_results_over_many_batches(spark, small_batches):
    texts = [("cafÃ© good " * (i % 50 + 1) + f"number {i}.",) for i in range(200)]
    df = spark.createDataFrame(texts, "x string").coalesce(1)
    out = df.select(
        enrich.repair_text(F.col("x")).alias("r"), get_sentiment(F.col("x")).alias("s"), summary.summarize(F.col("x")).alias("t")
    ).collect()
    assert len(out) == 200 and all("café" in r["r"] and r["s"]["label"] == "Positive" and r["t"] for r in out)


def test_gazetteer_table_equals_list(spark, small_batches):
    """All tasks with the gazetteer as a table of 100,000 names, null and repeated ones among them."""
    texts = ["Paris met Old Town in New York. Zürich, Paris and Atlantis. On 3 May 2024 $5 million.", "", None, "Nothing here", "Paris " * 300]
    rows = [(str(i), "t", "d", "US", None, t) for i, t in enumerate(texts)]
    gold = spark.createDataFrame(rows, "article_id string, clean_title string, domain string, source_country string, published_date date, full_text_payload string")
    known = ["paris", "new york", "atlantis"]
    table = spark.range(100_000).selectExpr("concat('place ', id) AS name").unionByName(spark.createDataFrame([(x,) for x in [*known, None, "paris"]], "name string"))
    columns = ["article_id", "ner_entities", "extracted_locations"]
    by_list, by_table = (sorted(enrich.run_tasks(gold, gazetteer=g).select(columns).collect(), key=lambda r: r[0]) for g in (known, table))
    assert by_table == by_list and by_list[0]["extracted_locations"]


def test_lexicon_of_any_size(one):
    """Ten thousand more words change nothing in texts that have none of them."""
    texts = ["A very good, NOT bad day but awful!", "good " * 40, "nothing known", "", None]
    large = {**d.VALENCES, **{f"madeup{i}": 1.5 for i in range(10_000)}}
    small = one(lambda x: get_sentiment(x)["polarity_score"], *texts)
    assert one(lambda x: get_sentiment(x, large)["polarity_score"], *texts) == small
    assert one(lambda x: get_sentiment(x, large)["label"], "madeup9999", "plain") == ["Positive", "Neutral"]


def test_sentiment_of_slices_is_that_of_the_whole(spark, monkeypatch):
    # Only the words of a slice are in memory; one text alone may be longer than a slice.
    texts = ["good", None, "", "NOT very good but bad!", "x" * 50, "terrible " * 20, "a plain text", "great"]
    parts = [p.to_pylist() for p in sentiment.text_slices(pa.array(texts), 10)]
    assert [t for p in parts for t in p] == texts and len(parts) > 3
    assert all(sum(len(t or "") for t in p[:-1]) < 20 for p in parts)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)

    def scores():
        return [r[1] for r in df.select("i", sentiment.sentiment_scores(F.col("t"))).orderBy("i").collect()]

    whole = scores()
    monkeypatch.setattr(sentiment, "SLICE_BYTES", 10)
    assert scores() == whole


def test_cleaned_text_is_made_once_and_python_gets_texts_twice(spark):
    # Repaired texts go to Python once, cleaned ones once for sentiment and summary together.
    df = spark.createDataFrame([("a", "<p>One text. Another <b>text</b>.</p>")], "article_id string, full_text_payload string")
    tasks = enrich.run_tasks(df.repartition(1))
    for columns in (["ner_entities", "category_scores", "keywords", "cleaned_word_count"], tasks.columns):
        plan = tasks.select(*columns)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("<[^>]+>") == 1
        assert len(re.findall(r"ArrowEvalPython", plan)) <= 2
    assert tasks.first()["cleaned_text"] == "One text. Another text."

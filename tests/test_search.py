import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presswork.operators import collection, enrich, portal, ranking, search, vector_index
from presswork.plans import lake
from presswork.sources import buckets
from presswork.sources.jsonl import newest_run

CATEGORIES = ["Technology", "Sports", "Business"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = []
    for i in range(200):
        # A third of the articles are copies of one.
        v = [1.0, 0.5, 0.0, 0.25] if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(4)]
        out.append((f"a{i:03d}", v, f"title {i}", CATEGORIES[i % 2], ["US", "FR", "DE"][i % 3], ["Positive", "Negative"][i % 2], ["x", "y"][: i % 3]))
    out.append(("zero", [0.0] * 4, "zero", "Business", "US", "Neutral", []))
    return out


@pytest.fixture(scope="module")
def points(spark, rows):
    schema = "article_id string, vector array<float>, title string, category string, source_country string, sentiment_label string, entities array<string>"
    return spark.createDataFrame(rows, schema).repartition(7)


def best(rows, query, keep, k):
    q = np.array(query)

    def score(r):
        v = np.array(r[1], dtype=np.float32).astype(float)
        scale = np.linalg.norm(v) * np.linalg.norm(q)
        return float(v @ q / scale) if scale else 0.0

    found = [(-round(score(r), 9), r[0]) for r in rows if keep(r)]
    return [i for _, i in sorted(found)[:k]]


QUERY = [0.3, -0.2, 0.9, 0.1]


def test_search_against_brute_force(points, rows):
    hits = search.hybrid_search(points, search.literal_vector(QUERY), limit=9).collect()
    assert [r["article_id"] for r in hits] == best(rows, QUERY, lambda r: True, 9)
    scores = [r["similarity_score"] for r in hits]
    assert scores == sorted(scores, reverse=True) and "vector" not in hits[0].asDict()


def test_filters_come_before_the_ranking(points, rows):
    hits = search.hybrid_search(points, search.literal_vector(QUERY), "Sports", "FR", "Negative", 4).collect()
    assert [r["article_id"] for r in hits] == best(rows, QUERY, lambda r: r[3:6] == ("Sports", "FR", "Negative"), 4)
    assert search.hybrid_search(points, search.literal_vector(QUERY), "Weather").count() == 0


def test_advanced_search(points, rows):
    filters = {"countries": ["US", "DE"], "min_score": 0.2}
    hits = search.advanced_search(points, search.literal_vector(QUERY), filters, 50).collect()
    assert all(r["similarity_score"] >= 0.2 and r["source_country"] in ("US", "DE") for r in hits)
    assert [r["article_id"] for r in hits] == best(rows, QUERY, lambda r: r[4] in ("US", "DE"), 50)[: len(hits)]
    assert search.advanced_search(points, search.literal_vector(QUERY)).count() == 10


def test_query_text(spark):
    texts = spark.createDataFrame([("a", "river flood"), ("b", "stock market")], "article_id string, text string")
    points = collection.embed_hashed(texts, "text")
    hits = search.hybrid_search(points, search.query_vector(spark, "market stock"), limit=1).collect()
    assert hits[0]["article_id"] == "b" and hits[0]["similarity_score"] == pytest.approx(1, abs=1e-6)


def test_related(points, rows):
    target = dict((r[0], r[1]) for r in rows)["a001"]
    plain = search.related(points, "a001", 5).collect()
    assert [r["article_id"] for r in plain] == best(rows, target, lambda r: r[0] != "a001", 5)
    biased = search.related(points, "a001", 5, "Technology").collect()
    assert [r["article_id"] for r in biased] == best(rows, target, lambda r: r[0] != "a001" and r[3] == "Technology", 5)
    assert search.related(points, "a001", 5, "Weather").collect() == plain
    # The only Business article has no other of its kind.
    assert search.related(points, "zero", 3, "Business").count() == 3
    assert search.related(points, "missing", 3).count() == 0


def test_related_batch(points, rows, small_batches):
    targets = points.filter(F.col("article_id").isin("a000", "a001", "a002", "zero"))
    out = search.related_batch(points, targets, 4).orderBy("target_id", "rank").collect()
    vectors = dict((r[0], r[1]) for r in rows)
    for t in ("a000", "a001", "a002", "zero"):
        assert [r["article_id"] for r in out if r["target_id"] == t] == best(rows, vectors[t], lambda r: r[0] != t, 4)
    assert search.related_batch(points, targets.limit(0), 4).count() == 0


def test_related_batch_with_empty_partitions(points, rows):
    few = points.filter("article_id < 'a010'").repartition(32)
    out = search.related_batch(few, points.filter("article_id = 'a001'"), 3).orderBy("rank").collect()
    vector = dict((r[0], r[1]) for r in rows)["a001"]
    assert [r["article_id"] for r in out] == best(rows, vector, lambda r: "a001" != r[0] < "a010", 3)


def test_related_batch_in_blocks(points, monkeypatch):
    whole = search.related_batch(points, points, 3)
    monkeypatch.setattr(search, "TARGETS_PER_BLOCK", 10)
    blocks = search.related_batch(points, points, 3)
    key = lambda r: (r["target_id"], r["rank"], r["article_id"])
    assert sorted(map(key, blocks.collect())) == sorted(map(key, whole.collect()))


def test_browse_and_trending(points, rows):
    page = search.browse(points, "Sports", "US", 3).collect()
    assert [r["payload"]["article_id"] for r in page] == [r[0] for r in rows if r[3] == "Sports" and r[4] == "US"][:3]
    top = search.trending(points, 1).collect()
    assert (top[0]["entity"], top[0]["count"]) == ("x", sum("x" in r[6] for r in rows))


def test_upsert(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    once = collection.upsert(stored, batch, "k")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 3), ("c", 4)]
    assert sorted(map(tuple, collection.upsert(once, batch, "k").collect())) == sorted(map(tuple, once.collect()))
    twice = spark.createDataFrame([("b", 3, 1), ("b", 9, 2)], "k string, v int, n int")
    assert sorted(map(tuple, collection.upsert(stored, twice, "k", "n").collect())) == [("a", 1), ("b", 9)]


def test_row_numbers(spark):
    rng = random.Random(2)
    values = [(i, rng.choice([1.0, 1.0, 1.0, rng.random()])) for i in range(1000)]
    df = spark.createDataFrame(values, "i int, s double").repartition(6)
    out = ranking.number_rows(df, F.desc("s"), F.col("i")).orderBy("rank").collect()
    assert [r["i"] for r in out] == [i for i, _ in sorted(values, key=lambda v: (-v[1], v[0]))]
    assert [r["rank"] for r in out] == list(range(1000))
    assert ranking.number_rows(df.limit(0), F.col("i")).count() == 0


PORTAL = "article_id string, title string, full_news_text string, predicted_category string, sentiment_label string, source_country string, sentiment_polarity double, extractive_summary string, detected_language string, preprocessed_text string"


@pytest.fixture(scope="module")
def articles(spark):
    rows = [(f"a{i:03d}", f"Title {i}", "Some Text", ["Sports", "Opera"][i % 2], ["Positive", "Odd"][i % 2], "US", 0.06 - 0.03 * (i % 5), "s" * (118 + i), "en", "p" * 301) for i in range(7)]
    return spark.createDataFrame(rows, PORTAL).withColumn("ner_entities", F.array().cast("array<struct<text:string,label:string>>"))


def test_facets_and_filters(articles):
    facets = [(r["facet"], r["value"], r["articles"]) for r in portal.facets(articles).collect()]
    assert facets == [
        ("predicted_category", "Opera", 3), ("predicted_category", "Sports", 4),
        ("sentiment_label", "Odd", 3), ("sentiment_label", "Positive", 4), ("source_country", "US", 7),
    ]
    assert portal.filter_articles(articles, categories=["Sports"], countries=["US"]).count() == 4
    assert portal.filter_articles(articles, categories=[]).count() == 0
    assert portal.filter_articles(articles).count() == 7


def test_kpis(articles):
    row = portal.kpis(articles, portal.selected(categories=["Sports"])).first()
    assert (row["total_articles"], row["filtered_articles"], row["topics"]) == (7, 4, 2)
    assert row["avg_sentiment"] == pytest.approx(round(sum(0.06 - 0.03 * (i % 5) for i in (0, 2, 4, 6)) / 4, 2))
    assert portal.kpis(articles, portal.selected(categories=["None"])).first()["avg_sentiment"] is None


def test_cards_and_detail(articles):
    cards = {r["article_id"]: r for r in portal.cards(articles).collect()}
    assert cards["a000"]["color"] == "green" and cards["a001"]["color"] == "gray" and cards["a001"]["marker"] == ""
    assert cards["a002"]["snippet"] == "s" * 120 and cards["a003"]["snippet"] == "s" * 120 + "..."
    one = portal.detail(articles, "a001").first()
    assert one["language"] == "EN" and one["text_preview"] == "p" * 300 + "..."
    assert portal.detail(articles, "nobody").count() == 0


def test_grid_and_keyword(articles):
    out = portal.grid(articles).orderBy("article_id").collect()
    assert [(r["grid_row"], r["grid_col"]) for r in out] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0)]
    assert portal.keyword_search(articles, "TITLE 3").count() == 1 and portal.keyword_search(articles, "some text").count() == 7


def test_ranked_articles(points, rows, spark):
    table = points.select("article_id", F.col("category").alias("predicted_category"))
    out = portal.ranked_articles(table, points, search.literal_vector(QUERY), "Sports").orderBy("rank").collect()
    everything = best(rows, QUERY, lambda r: True, len(rows))
    sports = {r[0] for r in rows if r[3] == "Sports"}
    assert [(r["article_id"], r["rank"]) for r in out] == [(a, i) for i, a in enumerate(everything) if a in sports]


def test_text_search_of_the_portal(spark):
    texts = [("a", "soccer tonight", "Sports"), ("b", "the soccer match", "Business"), ("c", "rain", "Sports")]
    df = spark.createDataFrame(texts, "article_id string, text string, predicted_category string")
    points = collection.embed_hashed(df.select("article_id", "text"), "text", 64)
    out = portal.search_articles(df, points, "Soccer").orderBy("rank").collect()
    assert [r["article_id"] for r in out] == ["a", "c"] and out[0]["rank"] == 0
    assert portal.search_articles(df, points, "rain").count() == 3


def test_related_panel_defaults(points):
    out = portal.related_panel(points.withColumn("sentiment_label", F.lit("")), "a001", "Sports").collect()
    assert len(out) == 3 and {r["sentiment"] for r in out} == {"Neutral"} and {r["color"] for r in out} == {"green"}
    assert all(r["match"].endswith("%") for r in out)


def test_lake_jobs(spark, tmp_path):
    from presswork.operators.silver import PARTITIONS, to_silver
    from presswork.plans.articles import bronze_articles
    from presswork.sources.tables import overwrite_table

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    paths = {n: f"{tmp_path}/{n}" for n in ("silver", "gold", "runs", "points")}
    kept = overwrite_table(to_silver(bronze_articles(docs)), paths["silver"], PARTITIONS)
    written = lake.build_gold(spark, paths["silver"], paths["gold"])
    assert written[lake.NLP_INPUT] == written[lake.SEARCH_FEATURES] == kept == 191
    lake.build_documents(spark, paths["gold"], paths["runs"])
    assert lake.build_enriched(spark, paths["runs"], paths["gold"], ("source_country",), with_keywords=True) == kept
    assert lake.index_newest_run(spark, paths["runs"], paths["points"]) == kept
    assert lake.index_newest_run(spark, paths["runs"], paths["points"]) == kept
    points = lake.searchable(lake.read_collection(spark, paths["points"]))
    stats = collection.collection_stats(points, "news").first()
    assert (stats["vectors_count"], stats["vector_size"]) == (kept, 384)
    assert search.hybrid_search(points, search.query_vector(spark, "the election"), limit=5).count() == 5
    assert enrich.enrichment_report(newest_run(spark, paths["runs"])).first()["enriched"] == kept
    lake.clear_collection(spark, paths["points"])
    assert lake.read_collection(spark, paths["points"]).count() == 0


def test_nothing_to_index(spark, tmp_path):
    assert lake.index_newest_run(spark, f"{tmp_path}/runs", f"{tmp_path}/points") == 0


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    folder, schema = f"{tmp_path}/table", StructType.fromDDL("k string, v int")
    rows = spark.createDataFrame([(f"k{i}", i, 0) for i in range(300)], "k string, v int, n int")
    assert buckets.read_buckets(spark, folder, schema).count() == 0
    assert len(buckets.upsert_buckets(rows, folder, "k", "n", buckets=16)) == 16
    batch = spark.createDataFrame([("k7", 70, 1), ("k7", 71, 2), ("new", 5, 1)], rows.schema)
    touched = buckets.upsert_buckets(batch, folder, "k", "n")
    assert len(touched) <= 2
    first, second = sorted(p.name for p in tmp_path.glob("table/data/*"))
    got = {r["k"]: r["v"] for r in buckets.read_buckets(spark, folder, schema).collect()}
    assert got == {f"k{i}": i for i in range(300)} | {"k7": 71, "new": 5}
    # The merge reads the touched buckets, and the new state keeps the files of the others.
    assert {p.name for p in tmp_path.glob(f"table/data/{second}/bucket=*")} == {f"bucket={b}" for b in touched}
    read = buckets.read_buckets(spark, folder, schema, touched).inputFiles()
    assert read and all(second in f for f in read)
    assert any(first in f for f in buckets.read_buckets(spark, folder, schema).inputFiles())


def test_old_states_expire(spark, tmp_path):
    folder, schema = f"{tmp_path}/table", StructType.fromDDL("k int, v int")
    for v in range(5):
        rows = spark.createDataFrame([(k, v, 0) for k in range(20)], "k int, v int, n int")
        buckets.upsert_buckets(rows, folder, "k", "n", buckets=2, keep=2)
        (tmp_path / "table/data/state_0_broken").mkdir()
    assert len(buckets.states(spark, folder)) == 2 and len(list(tmp_path.glob("table/data/*"))) == 3
    assert {r["v"] for r in buckets.read_buckets(spark, folder, schema).collect()} == {4}
    assert buckets.upsert_buckets(rows.limit(0), folder, "k", "n") == []
    buckets.clear_buckets(spark, folder)
    assert buckets.read_buckets(spark, folder, schema).count() == 0


def test_last_of_repeated_articles_is_indexed(spark, tmp_path):
    lines = ['{"article_id": "a", "title": "%s", "full_text_payload": "text"}' % t for t in ("first", "second", "third")]
    run = tmp_path / "runs" / "enriched_articles_20260101_000000.jsonl"
    run.parent.mkdir()
    run.write_text("\n".join(lines) + "\n")
    assert lake.index_newest_run(spark, f"{tmp_path}/runs", f"{tmp_path}/points") == 1
    assert [r["title"] for r in lake.searchable(lake.read_collection(spark, f"{tmp_path}/points")).collect()] == ["third"]


@pytest.fixture(scope="module")
def index(spark, points, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    assert vector_index.build_index(points, folder, centres=8) == points.count()
    return vector_index.Index.open(spark, folder)


@pytest.mark.parametrize("query", [QUERY, [1.0, 0.5, 0.0, 0.25], [-1.0, 0, 0, 0], [0.0] * 4])
def test_stored_search_equals_a_scan(index, rows, query):
    hits = index.search(query, limit=9).collect()
    assert [r["article_id"] for r in hits] == best(rows, query, lambda r: True, 9)
    hits = index.search(query, "Sports", "FR", "Negative", limit=4).collect()
    assert [r["article_id"] for r in hits] == best(rows, query, lambda r: r[3:6] == ("Sports", "FR", "Negative"), 4)
    hits = index.search(query, country=["US", "DE"], min_score=0.2, limit=500).collect()
    assert all(r["similarity_score"] >= 0.2 for r in hits)
    assert [r["article_id"] for r in hits] == best(rows, query, lambda r: r[4] in ("US", "DE"), 500)[: len(hits)]
    assert index.search(query, "Weather").count() == 0


def test_stored_neighbours(index, points):
    for bias in (None, "Sports", "Weather"):
        want = search.related(points, "a004", 5, bias).collect()
        assert [r["article_id"] for r in index.related("a004", 5, bias).collect()] == [r["article_id"] for r in want]
    assert index.related("missing").count() == 0


def test_folders_that_cannot_hold_a_hit_stay_closed(spark, tmp_path, monkeypatch):
    """Vectors in twenty bundles: a search for one opens a few folders only."""
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(20, 16))
    rows = [(f"a{i}", (middle[i % 20] + rng.normal(size=16) / 20).tolist(), "Sports") for i in range(600)]
    df = spark.createDataFrame(rows, "article_id string, vector array<float>, category string")
    wide = df.withColumns({c: F.lit(None).cast("string") for c in ("title", "source_country", "sentiment_label")})
    vector_index.build_index(wide, str(tmp_path), centres=20)
    index, opened = vector_index.Index.open(spark, str(tmp_path)), []
    read = vector_index.Index.rows
    monkeypatch.setattr(vector_index.Index, "rows", lambda self, folders: opened.append(len(folders)) or read(self, folders))
    query = middle[3].tolist()
    hits = index.search(query, limit=5)
    assert [r["article_id"] for r in hits.collect()] == [r["article_id"] for r in search.hybrid_search(wide, search.literal_vector(query), limit=5).collect()]
    assert len(index.folders) >= 10 and max(opened) <= 4
    assert "PartitionFilters: [" in hits._jdf.queryExecution().toString() and "cluster" in hits._jdf.queryExecution().toString()
    stored = index.rows(index.folders)
    assert stored.agg(F.max(F.abs(F.col("length") - collection.norm(F.col("vector"))))).first()[0] == 0


def test_empty_index(spark, points, tmp_path):
    assert vector_index.build_index(points.limit(0), str(tmp_path)) == 0
    assert vector_index.Index.open(spark, str(tmp_path)).search(QUERY).count() == 0

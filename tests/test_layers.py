import datetime
import shutil

import pytest
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from presswork.operators import gold, records, silver
from presswork.plans import articles
from presswork.schemas import ARTICLE_EVENT, BRONZE
from presswork.sources import feeds, jsonl, tables
from presswork.sources.tables import append_stream
from presswork.sources.topic import from_topic, to_topic
from presswork.streaming.layers import bronze_stream, bronze_to_silver, topic_to_bronze


def words(n):
    return " ".join(f"w{i}" for i in range(n))


ENTRY = "url string, title string, published string, summary string, description string, source_country string, extracted_text string"


def test_fetched_records(spark):
    rows = [
        (None, "no link", "", words(50), None, "US", None),
        ("", "empty link", "", words(50), None, "US", None),
        ("http://a", None, None, "", words(30), "US", words(29)),
        ("http://b", "BREAKING now", "d", words(10), None, "UK", words(31)),
        ("http://c", "short", "d", words(29), None, "UK", words(29)),
    ]
    entries = spark.createDataFrame(rows, ENTRY)
    kept = {r["url"]: r for r in records.fetched_records(entries).collect()}
    assert set(kept) == {"http://a", "http://b"}
    assert kept["http://a"]["title"] == "No Title" and kept["http://a"]["published_at"] == ""
    assert kept["http://a"]["content"] == words(30) and kept["http://a"]["word_count"] == 30
    assert kept["http://b"]["is_breaking_news"] and kept["http://b"]["word_count"] == 31
    reasons = {r["url"]: r["reject_reason"] for r in records.rejected_entries(entries).collect()}
    assert reasons == {None: records.NO_LINK, "": records.NO_LINK, "http://c": records.NO_TEXT}


def test_validation(spark):
    rows = [
        ("1", "t", "u", "US", "c", "", "12", None),
        ("2", None, "u", "US", "c", "", "12", "true"),
        ("3", "t", "u", "US", "c", "", "many", "maybe"),
    ]
    events = spark.createDataFrame(
        rows, "id string, title string, url string, source_country string, content string, published_at string, word_count string, is_breaking_news string"
    )
    for f in ARTICLE_EVENT.fields:
        if f.name not in events.columns:
            events = events.withColumn(f.name, F.lit(None).cast(f.dataType))
    valid, rejected = records.validate(events)
    row = valid.first()
    assert valid.count() == 1 and row["word_count"] == 12 and row["is_breaking_news"] is False
    assert row["summary_snippet"] == "" and row["article_id"] is None
    assert {r["id"]: r["violations"] for r in rejected.collect()} == {
        "2": ["title is missing"],
        "3": ["word_count is not int", "is_breaking_news is not boolean"],
    }


BRONZE_ROW = "id string, title string, url string, source_country string, content string, full_content string, published_at string"


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_ROW)


def test_silver_rules(spark):
    when = "Mon, 31 Aug 2026 09:45:00 GMT"
    rows = [
        ("29", "t", "http://x/a", "US", words(29), None, when),
        ("30", "<b>t</b>", "http://www.x/a", "US", f"<p>{words(30)}</p>", None, when),
        ("hidden", "t", "http://x", "US", words(40), "", when),
        ("baddate", "t", "ftp://x", "US", words(40), None, "yesterday"),
        (None, "t", "http://x", "US", words(40), None, when),
        ("notitle", None, "http://x", "US", words(40), None, when),
    ]
    out = {r["id"]: r for r in silver.to_silver(bronze(spark, rows)).collect()}
    assert set(out) == {"30", "baddate"}
    assert out["30"]["clean_title"] == "t" and out["30"]["domain"] == "x"
    assert out["30"]["full_text_payload"] == "t\n\n" + words(30)
    assert out["baddate"]["published_date"] is None and out["baddate"]["domain"] == ""
    assert "hidden" in {r["id"] for r in silver.to_silver(bronze(spark, rows), skip_empty=True).collect()}


def test_silver_without_text_columns(spark):
    df = spark.createDataFrame([("1", "t", "u", "US", "")], "id string, title string, url string, source_country string, published_at string")
    assert silver.clean_articles(df).first()["word_count"] == 0
    assert silver.to_silver(df).count() == 0


def test_metrics_of_one_crowded_publisher(spark):
    rows = [(str(i), "t", "http://x/a", "US", words(30 + i % 2), None, "Mon, 31 Aug 2026 09:45:00 GMT") for i in range(300)]
    out = gold.daily_publisher_metrics(silver.to_silver(bronze(spark, rows))).collect()
    assert len(out) == 1
    assert (out[0]["total_articles"], out[0]["total_word_count"], out[0]["avg_word_count"]) == (300, 9150, 30.5)


def test_quality_report_of_nothing(spark):
    none = bronze(spark, []).withColumn("is_breaking_news", F.lit(False))
    row = gold.quality_report(silver.clean_articles(none)).first()
    assert row["kept_rows"] == 0 and row["countries"] == 0
    assert row["avg_word_count"] is None


def test_topic_round_trip(spark):
    entries = spark.createDataFrame([("http://a", "t", "d", "s", None, "US", words(5))], ENTRY)
    events = records.scraped_events(entries)
    message = to_topic(events).first()
    assert message["key"] == "US" and '"ingest_timestamp":null' in message["value"]
    back = from_topic(to_topic(events)).first()
    assert back["id"] == events.first()["id"] and back["word_count"] == 5 and back["processed_timestamp"]


def test_topic_accepts_old_and_broken_messages(spark):
    values = [('{"id":"1","title":"t","published":"d"}',), ("not json",), (None,)]
    out = from_topic(spark.createDataFrame(values, "value string")).collect()
    assert sorted((r["id"], r["published_at"]) for r in out if r["id"]) == [("1", "d")]
    assert len(out) == 3


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{tmp_path}/nothing")


def test_overwrite_replaces_schema_and_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert tables.overwrite_table(spark.range(10).withColumn("k", F.col("id") % 2), path, ["k"]) == 10
    assert tables.overwrite_table(spark.range(3).withColumnRenamed("id", "other"), path) == 3
    assert tables.read_table(spark, path).columns == ["other"]


def test_table_check_and_preview(spark):
    df = spark.createDataFrame([(i, f"2026-01-0{i}") for i in (3, 1, 2)], "id int, at string")
    assert tuple(tables.table_check(df, "at").first()) == (3, 2, "2026-01-01")
    assert [r["id"] for r in tables.preview_rows(df, "id", ["id"], 2).collect()] == [1, 2]


def test_schema_grows(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(2).write.parquet(path)
    spark.range(2).withColumn("extra", F.lit("x")).write.mode("append").parquet(path)
    out = tables.read_table(spark, path, merge_schema=True)
    assert set(out.columns) == {"id", "extra"} and out.filter("extra IS NULL").count() == 2


def test_newest_run(spark, tmp_path):
    folder = f"{tmp_path}/runs"
    with pytest.raises(FileNotFoundError):
        jsonl.newest_run(spark, folder)
    assert jsonl.newest_run(spark, folder, missing_ok=True).count() == 0
    day = datetime.datetime(2026, 1, 2, tzinfo=datetime.timezone.utc)
    for title, at in (("neu", day), ("alt – é", day - datetime.timedelta(days=1))):
        df = spark.createDataFrame([("1", title, None)], "article_id string, title string, processed_text string")
        path = jsonl.save_run(df, folder, at)
    raw = "".join(r["value"] for r in spark.read.text(path).collect())
    assert "alt – é" in raw and '"processed_text":null' in raw
    assert [r["title"] for r in jsonl.newest_run(spark, folder).collect()] == ["neu"]
    (tmp_path / "runs" / "enriched_articles_20270101_000000.jsonl").mkdir()
    assert [r["title"] for r in jsonl.newest_run(spark, folder).collect()] == ["neu"]


def test_blank_lines_are_skipped(spark, tmp_path):
    folder = tmp_path / "runs"
    folder.mkdir()
    (folder / "enriched_articles_20260101_000000.jsonl").write_text('{"article_id":"1"}\n\n  \n{"article_id":"2"}\n')
    assert jsonl.newest_run(spark, str(folder)).count() == 2


def test_feeds(spark, tmp_path):
    for country in ("US", "UK"):
        (tmp_path / country).mkdir()
        (tmp_path / country / "feed.xml").write_text(
            f"<rss><channel><title>c</title><item><title>{country} a</title><link>http://{country}/1</link>"
            "<description>text &amp; more</description><pubDate>Mon, 31 Aug 2026 09:45:00 GMT</pubDate></item>"
            "<item><title>b</title></item></channel></rss>"
        )
    out = feeds.read_feeds(spark, {c: [f"{tmp_path}/{c}"] for c in ("US", "UK")})
    rows = {(r["source_country"], r["title"]): r for r in out.collect()}
    assert len(rows) == 4
    first = rows["US", "US a"]
    assert first["url"] == "http://US/1" and first["description"] == "text & more"
    assert first["published"] == "Mon, 31 Aug 2026 09:45:00 GMT" and rows["UK", "b"]["url"] is None


def run_silver(spark, root, **options):
    query = bronze_to_silver(bronze_stream(spark, f"{root}/bronze"), f"{root}/silver", f"{root}/check", **options)
    query.awaitTermination()
    return tables.read_table(spark, f"{root}/silver")


def test_stream_restarts_without_repeats_and_accepts_new_columns(spark, tmp_path):
    when = "Mon, 31 Aug 2026 09:45:00 GMT"
    first = spark.createDataFrame([("1", "t", "http://x", "US", words(30), when)], "id string, title string, url string, source_country string, content string, published_at string")
    first.write.parquet(f"{tmp_path}/bronze")
    assert run_silver(spark, tmp_path).count() == 1
    assert run_silver(spark, tmp_path).count() == 1
    first.withColumns({"id": F.lit("2"), "full_content": F.lit(words(31))}).write.mode("append").parquet(f"{tmp_path}/bronze")
    out = run_silver(spark, tmp_path)
    assert {r["id"]: r["word_count"] for r in out.collect()} == {"1": 30, "2": 31}


def test_silver_by_processing_day(spark, tmp_path):
    row = ("1", "t", "http://x", "US", words(30), None, "bad date")
    bronze(spark, [row]).write.parquet(f"{tmp_path}/bronze")
    out = run_silver(spark, tmp_path, partition_by=("processed_date",))
    assert out.first()["processed_date"] == out.first()["silver_processed_at"].date()


def test_polling_trigger(spark, tmp_path):
    bronze(spark, []).write.parquet(f"{tmp_path}/bronze")
    query = bronze_to_silver(bronze_stream(spark, f"{tmp_path}/bronze"), f"{tmp_path}/s", f"{tmp_path}/c", every="300 seconds")
    try:
        assert query.isActive
    finally:
        query.stop()


def test_topic_stream(spark, tmp_path):
    values = [("US", '{"id":"1","title":"t","word_count":3}'), ("US", "broken")]
    spark.createDataFrame(values, "key string, value string").write.parquet(f"{tmp_path}/topic")
    messages = spark.readStream.schema("key string, value string").parquet(f"{tmp_path}/topic")
    topic_to_bronze(messages, f"{tmp_path}/bronze", f"{tmp_path}/check").awaitTermination()
    out = tables.read_table(spark, f"{tmp_path}/bronze")
    assert out.columns == [f.name for f in BRONZE.fields]
    assert [r["id"] for r in out.filter("id IS NOT NULL").collect()] == ["1"]


def test_crowded_partition_has_writers_for_its_bytes_and_batches_repeat(spark, tmp_path):
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    crowded = F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("p")
    spark.range(200_000).select(crowded, F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(6).write.parquet(f"{tmp_path}/in")
    rows = spark.read.parquet(f"{tmp_path}/in")
    spark.conf.set(conf, "1m")
    try:
        for _ in range(2):
            append_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check", ["p"]).awaitTermination()
            files = {p.name: len(list(p.glob("*.parquet"))) for p in tmp_path.glob("out/p=*")}
            # The micro-batch is lost from the log of the stream, not from that of the sink.
            for commit in tmp_path.glob("check/commits/*"):
                commit.unlink()
    finally:
        spark.conf.unset(conf)
    assert files["p=99"] > 4 and min(files.values()) == 1
    assert spark.read.parquet(f"{tmp_path}/out").count() == 200_000


def test_stored_silver_does_not_guess_types_from_folder_names(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(articles.COUNTRY_OF_LANGUAGE, "en", "01")
    docs = spark.range(1, 31).select(F.col("id").alias("doc_id"), F.lit(words(40)).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["silver_stream"](spark, str(tmp_path)).select("source_country", "published_date").collect()
    assert {r["source_country"] for r in out} == {"01"}
    assert sorted({r["published_date"] for r in out}) == ["2024-01-01", "2024-01-02"] and len(out) == 30


def test_python_holds_few_texts_however_long_they_are(spark):
    tables.prepare(spark)
    rows = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))

    @F.arrow_udf("long")
    def together(texts):
        import pyarrow as pa

        return pa.array([texts.nbytes] * len(texts), pa.int64())

    held = rows.select(together("text").alias("n")).agg(F.max("n"), F.count("n")).first()
    assert held[0] <= 2 * tables.BATCH_BYTES and held[1] == 200


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    tables.prepare(spark)
    days = spark.range(0, 60, 1, 1).select("id", F.col("id").alias("day"))
    days.write.partitionBy("day").parquet(f"{tmp_path}/t")
    spark.sparkContext.setJobGroup("listing", "")
    try:
        rows = tables.read_table(spark, f"{tmp_path}/t", schema=days.schema)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [s for job in status.getJobIdsForGroup("listing") for s in status.getJobInfo(job).stageIds]
    tasks = [status.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= tables.LISTERS_PER_CORE * spark.sparkContext.defaultParallelism
    assert rows.count() == 60


PLACES = ("US", "01", "a/b", "50% =é?#", "x y+z", "", None)
PLACED = "id long, at timestamp, words array<string>, n int, ok boolean, score double, place string, day date"


def placed(spark, first, days=("2024-01-01", "2366-02-28", None)):
    """Rows in every place on every day; some values are null, and some times are too late for nanoseconds."""
    rows = [
        (first + i, None if i % 5 == 0 else f"{2024 + 25 * i}-03-04 05:06:07.000008", ["a", None][: i % 3], i or None, i % 2 == 0, i / 3, place, day)
        for i, (place, day) in enumerate((p, d) for p in PLACES for d in days)
    ]
    stamped = spark.createDataFrame(rows, PLACED.replace("timestamp", "string").replace("date", "string"))
    return stamped.withColumns({"at": F.col("at").cast("timestamp"), "day": F.col("day").cast("date")})


def same_rows(spark, path, schema, keys):
    """A table read in tasks, held against Spark's own scan of it."""
    scanned = spark.read.schema(schema).parquet(path)
    read = tables.read_table(spark, path, schema=schema, partition_by=keys)
    assert read.inputFiles() == [] and len(scanned.inputFiles()) > 1
    assert read.dtypes == scanned.dtypes
    found = sorted(map(repr, read.collect()))
    assert found == sorted(map(repr, scanned.collect()))
    return len(found)


def test_table_read_in_tasks_has_the_rows_of_a_scan(spark, tmp_path):
    path, rows = f"{tmp_path}/table in %20", placed(spark, 0)
    tables.overwrite_table(rows, path, ["place", "day"])
    placed(spark, 100).drop("words").write.mode("append").partitionBy("place", "day").parquet(path)
    assert same_rows(spark, path, rows.schema, ["place", "day"]) == 42
    few = tables.read_table(spark, path, schema=rows.select("day", "n").schema, partition_by=["place", "day"])
    assert few.columns == ["n", "day"] and few.filter("day IS NULL").count() == 14
    (tmp_path / "table in %20" / "place=US" / "other=1").mkdir()
    with pytest.raises(Exception, match="no folder of day"):
        tables.read_table(spark, path, schema=rows.schema, partition_by=["place", "day"]).collect()
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{tmp_path}/nothing", schema=rows.schema, partition_by=["day"])
    tables.overwrite_table(rows.limit(0), f"{tmp_path}/empty", ["day"])
    assert tables.read_table(spark, f"{tmp_path}/empty", schema=rows.schema, partition_by=["day"]).count() == 0


def test_stream_read_in_tasks_has_the_files_of_its_log(spark, tmp_path):
    path, schema = f"{tmp_path}/out", placed(spark, 0).schema
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "2")
    try:
        for run in range(4):
            placed(spark, 100 * run).repartition(1).write.mode("append").parquet(f"{tmp_path}/in")
            append_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), path, f"{tmp_path}/check", ["place", "day"]).awaitTermination()
            # A file that a failed attempt left is in no log.
            placed(spark, 9000, ["2025-01-01"]).write.mode("append").partitionBy("place", "day").parquet(f"{tmp_path}/left")
            shutil.copytree(tmp_path / "left", path, dirs_exist_ok=True)
            assert same_rows(spark, path, schema, ["place", "day"]) == 21 * (run + 1)
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")
    assert tables.log_entries(["0", "1.compact", "2", "3.compact", "4", "junk"]) == ["3.compact", "4"]


def many_days(spark, tmp_path):
    docs = spark.range(0, 480, 1, 2).select(F.col("id").alias("doc_id"), F.lit(words(40)).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_gold_tables_are_not_listed_by_the_driver(spark, tmp_path):
    out = QUERIES["gold_tables_written"](spark, many_days(spark, tmp_path))
    assert out.inputFiles() == []
    assert {(r["published_date"], r["articles"]) for r in out.collect()} == {(f"2024-01-{d:02}", 24) for d in range(1, 21)}


def test_stored_silver_is_not_listed_by_the_driver(spark, tmp_path):
    out = QUERIES["silver_stream"](spark, many_days(spark, tmp_path))
    assert out.inputFiles() == [] and out.count() == 480

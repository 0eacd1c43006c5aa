"""Plans that must hold at any size."""

import pathlib
import re

import pytest

from catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).parent.parent


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["vec_search", "vec_search_filtered", "vec_related", "vec_related_fallback", "vec_trending", "vec_browse"])
def test_top_k_stays_bounded(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_first_per_key_is_cut_before_the_shuffle(spark):
    text = plan(spark, "dedup_first")
    assert text.count("WindowGroupLimit") == 2


def test_metrics_aggregate_before_the_shuffle(spark):
    text = plan(spark, "gold_daily_publisher_metrics")
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>", text)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.endswith("_stream")}))
def test_no_pairing_of_whole_tables(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_text_is_cleaned_once(spark):
    """The length rule must not run the cleaning a second time below."""
    text = plan(spark, "silver_articles")
    assert text.count("regexp_replace(regexp_replace") == 1


def test_library_brings_no_rows_to_the_driver():
    calls = re.compile(r"\.(collect|toPandas|toLocalIterator)\(\)|localCheckpoint|crossJoin|\.rdd\b")
    found = [
        f"{p.relative_to(ROOT)}: {line.strip()}"
        for p in sorted((ROOT / "presswork").rglob("*.py"))
        if "llm" not in p.parts
        for line in p.read_text().splitlines()
        if calls.search(line)
    ]
    # What comes is bounded: one block of targets, a row per folder, the best k scores, a row per bucket.
    bounded = ("stored.filter(block == i).collect()", "known.collect()", 'select("similarity_score").collect()', "json(f\"{folder}/{name}\").collect()", 'select("bucket").distinct().collect()')
    assert len(found) == len(bounded) and all(any(b in line for line in found) for b in bounded)

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presswork.operators import dedup
from presswork.sources.tables import read_table
from presswork.streaming import ttl as ttl_module
from presswork.streaming.ttl import admit_stream, first_seen_stream, rocksdb_state

DAY = 86_400


def admitted_by_hand(rows, ttl):
    last, out = {}, set()
    for key, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or t >= last[key] + ttl:
            last[key] = t
            out.add((key, t, i))
    return out


def events(spark, rows):
    df = spark.createDataFrame(rows, "k string, s long, i long")
    return df.withColumn("ts", F.timestamp_seconds("s"))


def collected(df):
    return {(r["k"], int(r["ts"].timestamp()), r["i"]) for r in df.collect()}


def crowd(seed, n=3000):
    """A third of the rows on one key, repeated times, gaps around the expiry."""
    rng = random.Random(seed)
    keys = ["hot"] * 4 + [f"k{i}" for i in range(8)]
    return [(rng.choice(keys), rng.choice([rng.randint(-40, 400) * 3600, rng.randint(-8, 30) * DAY]), i) for i in range(n)]


@pytest.fixture
def partitions(spark, request):
    """Number of ranges that rows are cut into."""
    conf = "spark.sql.shuffle.partitions"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(request.param))
    yield request.param
    spark.conf.set(conf, before)


# A minute, a day and 60 days: sparse keys, both kinds, and dense ones with gaps.
@pytest.mark.parametrize("ttl", [60, DAY, 7 * DAY, 60 * DAY])
@pytest.mark.parametrize("partitions", [1, 4, 23], indirect=True)
def test_expiry_against_brute_force(spark, small_batches, partitions, ttl):
    rows = crowd(7, 1500)
    assert collected(dedup.admissions(events(spark, rows), "k", "ts", "i", ttl)) == admitted_by_hand(rows, ttl)


def chains(times, ttl):
    ready, out = times[0], []
    for j, t in enumerate(times):
        if t >= ready:
            out.append(j)
            ready = t + ttl
    return out


@given(st.lists(st.integers(0, 300), min_size=1, max_size=60), st.integers(1, 40), st.integers(1, 7), st.booleans())
def test_blocks_of_one_key(times, ttl, n, dense):
    """Any cut into blocks admits what one scan does, for either kind of block."""
    times = np.sort(np.array(times))
    place = (times - times[0]) % ttl if dense else times
    ranged = np.lexsort((np.arange(len(times)), times, place))
    key = (pa.scalar("k"), None)
    blocks = [
        pa.table({"k": ["k"] * len(b), "t": times[b], "i": b, "first": [int(times[0])] * len(b), "dense": [dense] * len(b)})
        for b in np.array_split(ranged, n) if len(b)
    ]
    steps = [dedup._block_steps(ttl)((key[0], pa.scalar(i)), b) for i, b in enumerate(blocks)]
    if dense:
        windows = len(set(((times - times[0]) // ttl).tolist()))
        assert all(len(s) <= min(windows, len(b)) for s, b in zip(steps, blocks, strict=True))
    entries = dedup._entries(key, pa.concat_tables(steps).take(np.random.permutation(sum(map(len, steps)))))
    admitted = []
    for i, b in enumerate(blocks):
        entered = entries.filter(pa.compute.equal(entries.column("block"), i))
        admitted += dedup._admit_block(ttl)(b, entered).column("i").to_pylist()
    assert sorted(admitted) == chains(times.tolist(), ttl)


@pytest.mark.parametrize("partitions", [12], indirect=True)
@pytest.mark.parametrize("ttl", [60, 7 * DAY])
def test_crowded_key_is_spread(spark, partitions, ttl, monkeypatch):
    """A key with nine tenths of the rows: no block holds much more than its share."""
    rng = random.Random(3)
    rows = [("hot" if i % 10 else f"k{i % 70}", rng.randint(0, 90 * DAY), i) for i in range(12_000)]
    stored = {}
    write = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, label: stored.setdefault(label, write(df, label)))
    assert collected(dedup.admissions(events(spark, rows), "k", "ts", "i", ttl)) == admitted_by_hand(rows, ttl)
    sizes = [r["count"] for r in stored["blocks"].groupBy("block").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * sum(sizes) / 12
    ranges = [r["count"] for r in stored["ranges"].filter("k = 'hot'").groupBy("part").count().collect()]
    assert len(ranges) >= 10 and max(ranges) < 2 * sum(ranges) / len(ranges)
    assert stored["spanning"].filter("k = 'hot'").first()["dense"] == (ttl > DAY)


def test_expiry_boundaries(spark):
    rows = [("a", 0, 1), ("a", 7 * DAY - 3600, 2), ("a", 7 * DAY, 3), ("a", 8 * DAY, 4), ("b", 5, 5), ("b", 5, 6)]
    out = dedup.admissions(events(spark, rows), "k", "ts", "i", 7 * DAY)
    assert {i for _, _, i in collected(out)} == {1, 3, 5}
    assert not collected(dedup.admissions(events(spark, rows).limit(0), "k", "ts", "i", 7 * DAY))
    with pytest.raises(ValueError):
        dedup.admissions(events(spark, rows), "k", "ts", "i", 0)


def test_gap_between_admissions(spark):
    table = read_table(spark, "/root/testdata/sf0.01/events.parquet")
    out = dedup.admissions(table, "user_id", "ts", "event_id", 7 * DAY).toPandas().sort_values(["user_id", "ts"])
    gaps = out.groupby("user_id")["ts"].diff().dropna()
    assert len(out) == 666 and out["user_id"].nunique() == 150
    assert (gaps.dt.total_seconds() >= 7 * DAY).all()


def test_whole_rows_and_missing_keys(spark):
    rows = [("a", 0, 1), ("a", 1, 2), (None, 0, 3)]
    df = events(spark, rows).withColumn("text", F.concat(F.lit("t"), "i"))
    out = dedup.admit_within_ttl(df, "k", "ts", "i").collect()
    assert [(r["i"], r["text"]) for r in out] == [(1, "t1")]


def test_first_and_unseen(spark):
    rows = [("a", 5, 2), ("a", 5, 1), ("a", 9, 0), ("b", 1, 3)]
    assert {r["i"] for r in dedup.first_seen(events(spark, rows), "k", "ts", "i").collect()} == {1, 3}
    seen = spark.createDataFrame([("a",), ("a",)], "k string")
    assert {r["k"] for r in dedup.unseen(events(spark, rows), seen, "k").collect()} == {"b"}


def test_stream_in_several_batches(spark, small_batches, tmp_path):
    rows = crowd(11, 600)
    rows.sort(key=lambda r: (r[1], r[2]))
    schema = events(spark, rows).schema
    for n in range(3):
        part = rows[n * 200 : (n + 1) * 200]
        events(spark, part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        with rocksdb_state(spark):
            query = (
                admit_stream(stream, "k", "ts", "i", 7 * DAY)
                .writeStream.format("parquet")
                .option("checkpointLocation", f"{tmp_path}/check")
                .trigger(availableNow=True)
                .start(f"{tmp_path}/out")
            )
            query.awaitTermination()
    assert collected(spark.read.parquet(f"{tmp_path}/out")) == admitted_by_hand(rows, 7 * DAY)


def test_stream_carries_columns(spark, small_batches, tmp_path):
    rows = [("a", i * 3600, i) for i in range(300)] + [("b", 5, 300)]
    df = events(spark, rows).withColumn("text", F.concat(F.lit("t"), "i"))
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    with rocksdb_state(spark):
        admitted = admit_stream(stream, "k", "ts", "i", columns=["text"])
        admitted.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert {(r["i"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {(0, "t0"), (168, "t168"), (300, "t300")}


def run_stream(spark, folder, stream_of, batches):
    """Feed batches one by one; the sink's rows and the rows of state after each."""
    schema = events(spark, [("a", 0, 0)]).schema
    states = []
    for rows in batches:
        events(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        with rocksdb_state(spark):
            query = stream_of(stream).writeStream.format("parquet").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start(f"{folder}/out")
            query.awaitTermination()
        states.append([sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress if p.stateOperators][-1])
    return collected(spark.read.parquet(f"{folder}/out")), states


def test_stream_forgets_expired_keys(spark, small_batches, tmp_path):
    batches = [[(f"k{b}-{j}", b * 30 * DAY + j * 3600, b * 100 + j) for j in range(40)] for b in range(3)]
    admitted, states = run_stream(spark, tmp_path, lambda s: admit_stream(s, "k", "ts", "i", 7 * DAY), batches)
    assert len(admitted) == 120 and states[2] == states[1] == states[0]


def test_waiting_stream_takes_any_order(spark, small_batches, tmp_path):
    """Old events in random order are admitted as by the batch job."""
    rows = [(k, t % (300 * DAY), i) for k, t, i in crowd(11, 600)]
    random.Random(5).shuffle(rows)
    end = [("end", 5000 * DAY, 9999)]
    late = [("a", 5, 10_000)]  # older than the watermark
    batches = [rows[:200], rows[200:400], rows[400:], end, [("end", 9000 * DAY, 9998)], late]
    admitted, states = run_stream(spark, tmp_path, lambda s: admit_stream(s, "k", "ts", "i", 7 * DAY, late_seconds=400 * DAY, wait=True), batches)
    assert {r for r in admitted if r[0] != "end"} == admitted_by_hand(rows, 7 * DAY)
    assert states[-1] <= 2  # one key and its timer


@given(st.lists(st.integers(0, 200), max_size=40), st.integers(1, 60), st.integers(0, 100), st.lists(st.integers(0, 200), max_size=5))
def test_thinned_runs_lose_no_admission(times, ttl, ready, later):
    """Whatever else comes at or after ``ready``, the thinned run admits the same rows."""
    run = pd.DataFrame({"t": sorted(times), "i": 0})
    thin = ttl_module._thinned(run, ready, ttl)
    more = pd.DataFrame({"t": [max(x, ready) for x in later], "i": 0})
    whole, some = (ttl_module._admitted(pd.concat([x, more]).sort_values("t"), ready, ttl)["t"].tolist() for x in (run, thin))
    assert whole == some


def test_first_of_stream(spark, tmp_path):
    batches = [[("a", 5 * DAY, 1), ("b", 5 * DAY + 1, 2)], [("a", 6 * DAY, 3), ("c", 6 * DAY, 4)], [("a", 60 * DAY, 5)], [("d", DAY, 6), ("a", 61 * DAY, 7)]]
    admitted, _ = run_stream(spark, tmp_path, lambda s: first_seen_stream(s, "k", "ts", 7 * DAY), batches)
    # "a" comes again once the watermark of a batch before has passed its seven days; "d" is too late.
    assert {i for _, _, i in admitted} == {1, 2, 4, 7}

"""De-duplication by key: with expiry, without expiry, against a seen table."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.cluster import materialize, shuffle_partitions
from presswork.functions.frames import plain_text

TTL_SECONDS = 604_800
MICROS = 1_000_000
BEFORE_ALL = -(1 << 63)
RANGE_FIELDS = (
    T.StructField("part", T.IntegerType()),
    T.StructField("border", T.BooleanType()),
    T.StructField("alone", T.BooleanType()),
)


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(seen.select(key), key, "left_anti")


def first_seen(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """First row of every key. Each task keeps one row per key before the shuffle."""
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")
    )


def _links(times, ttl: int, windows=None):
    """For each of the sorted ``times`` the row that is admitted next, if that one is; else the end.

    With ``windows``, the next row must lie in the window after.
    """
    import numpy as np

    end = len(times)
    link = np.searchsorted(times, times + ttl)
    if windows is not None:
        inside = np.minimum(link, end - 1)
        link = np.where((link < end) & (windows[inside] == windows + 1), link, end)
    return link


def _last(link):
    """The last row that each row leads to."""
    import numpy as np

    at = np.arange(len(link))
    step = np.where(link < len(link), link, at)
    while True:
        further = step[step]
        if np.array_equal(further, step):
            return step
        step = further


def _follow(link, starts) -> list[int]:
    """All rows that the ``starts`` lead to, themselves included."""
    hops, out = link.tolist(), []
    for at in starts:
        while at < len(hops):
            out.append(at)
            at = hops[at]
    return out


def _scan_sorted(ttl: int):
    """Admissions within one range of rows sorted by key and time.

    Rows of the range's first and last key all stay, as the key may reach into other
    ranges; ``alone`` says which of them are admitted if it does not.
    """

    def scan(batches):
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        part, held, first = TaskContext.get().partitionId(), [], True

        def finished(is_border):
            rows = held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            admitted = _follow(_links(rows["t"].to_numpy(), ttl), [0])
            alone = np.zeros(len(rows), bool)
            alone[admitted] = True
            rows = rows.assign(part=np.int32(part), border=is_border, alone=alone)
            return plain_text(rows if is_border else rows.iloc[admitted])

        for batch in batches:
            keys = batch["k"].to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)] if len(keys) else []
            for start, end in zip(cuts[:-1], cuts[1:]):
                if held and held[0]["k"].iloc[0] != keys[start]:
                    yield finished(first)
                    held, first = [], False
                held.append(batch.iloc[start:end])
        if held:
            yield finished(True)

    return scan


def _block_steps(ttl: int):
    """What a block of a crowded key does to the state it is entered with.

    In a block of consecutive times the state is the time from which a row is admitted; in
    a block of places within the expiry it is the number of the expiry window. Rows
    ``state, exit``: entered with at most ``state`` (and more than that of the row before),
    or with just that window, the block is left with ``exit``.
    """

    def steps(key, rows):
        import numpy as np
        import pyarrow as pa

        rows = rows.sort_by("t")
        times = rows.column("t").to_numpy()
        first, dense = rows.column("first")[0].as_py(), rows.column("dense")[0].as_py()
        if dense:
            windows = (times - first) // ttl
            state, begins = np.unique(windows, return_index=True)
            exits = windows[_last(_links(times, ttl, windows))[begins]] + 1
        else:
            exits = times[_last(_links(times, ttl))] + ttl
            ends = np.flatnonzero(np.append(exits[1:] != exits[:-1], True))
            state, exits = times[ends], exits[ends]
        n = len(state)
        return pa.table(
            {
                "k": pa.array([key[0].as_py()] * n, rows.schema.field("k").type), "block": pa.array(np.full(n, key[1].as_py(), np.int32)),
                "dense": pa.array([dense] * n, pa.bool_()), "state": pa.array(state), "exit": pa.array(exits),
            }
        )

    return steps


def _entries(key, rows):
    """States in which the blocks of one key are entered, in the end: ``k, block, state``."""
    import numpy as np
    import pyarrow as pa

    rows = rows.sort_by([("block", "ascending"), ("state", "ascending")])
    blocks, states, exits = (rows.column(c).to_numpy() for c in ("block", "state", "exit"))
    names, begins = np.unique(blocks, return_index=True)
    bounds = [*begins.tolist(), len(blocks)]
    out = []
    if rows.column("dense")[0].as_py():
        known = [dict(zip(states[a:b].tolist(), exits[a:b].tolist())) for a, b in zip(bounds[:-1], bounds[1:])]
        windows = np.unique(states).tolist()
        at = windows[0]
        while True:
            for name, leads in zip(names.tolist(), known):
                to = leads.get(at)
                if to is not None:
                    out.append((name, at))
                    at = to
            following = bisect_right(windows, at)
            if following == len(windows):
                break
            at = windows[following]
    else:
        at = BEFORE_ALL
        for name, a, b in zip(names.tolist(), bounds[:-1], bounds[1:]):
            found = a + bisect_left(states[a:b], at)
            if found < b:
                out.append((name, at))
                at = int(exits[found])
    return pa.table(
        {
            "k": pa.array([key[0].as_py()] * len(out), rows.schema.field("k").type),
            "block": pa.array([b for b, _ in out], pa.int32()), "state": pa.array([s for _, s in out], pa.int64()),
        }
    )


def _admit_block(ttl: int):
    """Admitted rows of a block that is entered in known states."""

    def admit(rows, entries):
        import numpy as np

        if not len(rows) or not len(entries):
            return rows.slice(0, 0).select(["k", "t", "i"])
        rows = rows.sort_by([("t", "ascending"), ("i", "ascending")])
        times, states = rows.column("t").to_numpy(), np.sort(entries.column("state").to_numpy())
        if rows.column("dense")[0].as_py():
            windows = (times - rows.column("first")[0].as_py()) // ttl
            link, starts = _links(times, ttl, windows), np.searchsorted(windows, states)
        else:
            link, starts = _links(times, ttl), np.searchsorted(times, states)
        return rows.take(_follow(link, starts.tolist())).select(["k", "t", "i"])

    return admit


def _admit_spanning(rows: DataFrame, ttl: int) -> DataFrame:
    """Admissions of keys that fill more than one range.

    ``rows`` have the key's ``first`` time and whether it is ``dense``: few expiries and many
    rows. Blocks of a sparse key are ranges of time. Blocks of a dense key are ranges of
    the place within the expiry, each over all expiries: an admission never lies at an
    earlier place than the one before, unless an expiry is left without a row. A block of
    ``n`` rows and ``w`` expiries so leaves at most ``min(n, w)`` steps for a dense key, and
    for a sparse one as many as rows lie in the last expiry of the block.
    """
    place = F.when(F.col("dense"), F.pmod(F.col("t") - F.col("first"), F.lit(ttl))).otherwise(F.col("t"))
    parts = shuffle_partitions(rows.sparkSession)
    ranged = rows.withColumn("place", place).repartitionByRange(parts, "k", "place", "t", "i").drop("place")
    blocks = materialize(ranged.withColumn("block", F.spark_partition_id()), "blocks")
    kind = blocks.schema["k"].dataType.simpleString()
    steps = blocks.groupBy("k", "block").applyInArrow(
        _block_steps(ttl), f"k {kind}, block int, dense boolean, state long, exit long"
    )
    entries = steps.groupBy("k").applyInArrow(_entries, f"k {kind}, block int, state long")
    return (
        blocks.groupBy("k", "block")
        .cogroup(entries.groupBy("k", "block"))
        .applyInArrow(_admit_block(ttl), blocks.select("k", "t", "i").schema)
    )


def admissions(
    df: DataFrame,
    key: str,
    time: str,
    row_id: str,
    ttl_seconds: int = TTL_SECONDS,
) -> DataFrame:
    """``key, time, row_id`` of the rows that pass an expiring seen-set.

    The first row of a key is admitted; later ones only once ``ttl_seconds``
    have gone by since the last admission. Repeats do not extend the expiry.
    Equal times go by ``row_id``. Rows without key or time are not admitted.

    Rows are cut into equal ranges by key and time, whatever the keys. Keys inside
    a range are worked off there. Only the keys at its two ends may go on in
    other ranges: those that do, at most one per range, are cut into blocks. Each
    block tells in which state it is left for every state it can be entered in;
    one task per such key puts these steps together and finds how each block
    is entered; then all blocks admit at the same time.
    """
    if ttl_seconds <= 0:
        raise ValueError("the expiry must be positive")
    spark = df.sparkSession
    ttl = ttl_seconds * MICROS
    kind = df.schema[time].dataType
    moment = F.col(time).cast("timestamp") if isinstance(kind, T.TimestampNTZType) else F.col(time)
    slim = df.select(
        F.col(key).alias("k"), F.unix_micros(moment).alias("t"), F.col(row_id).alias("i")
    ).filter("k IS NOT NULL AND t IS NOT NULL")

    order = ("k", "t", "i")
    ranged = slim.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    found = T.StructType([*slim.schema.fields, *RANGE_FIELDS])
    scanned = materialize(ranged.mapInPandas(_scan_sorted(ttl), found), "ranges")

    border = scanned.filter("border")
    extent = border.groupBy("k").agg(
        F.min("part").alias("lowest"), F.max("part").alias("highest"),
        F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("latest"),
    )
    expiries = F.floor((F.col("latest") - F.col("first")) / ttl) + 1
    spanning = F.broadcast(
        materialize(extent.filter("lowest < highest").select("k", "first", (expiries * expiries <= F.col("n")).alias("dense")), "spanning")
    )
    whole = scanned.filter("alone").join(spanning.select("k"), "k", "left_anti").select("k", "t", "i")
    rest = border.select("k", "t", "i").join(spanning, "k")
    admitted = whole.unionByName(_admit_spanning(rest, ttl))
    return admitted.select(
        F.col("k").alias(key),
        F.timestamp_micros("t").cast(kind).alias(time),
        F.col("i").alias(row_id),
    )


def admit_within_ttl(
    df: DataFrame,
    key: str,
    time: str,
    row_id: str,
    ttl_seconds: int = TTL_SECONDS,
) -> DataFrame:
    """The admitted rows with all their columns; ``row_id`` must be unique."""
    admitted = admissions(df, key, time, row_id, ttl_seconds)
    return df.join(admitted.select(row_id), row_id, "left_semi")

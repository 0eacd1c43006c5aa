"""A keyed table in buckets: an upsert rewrites only the buckets its keys fall into.

Layout: ``data/<state>/bucket=<n>`` holds the rows a state has written, ``state_<stamp>`` says
for every bucket which state's data are its current ones. A state is complete once its
list is; the list is one row per bucket. Old states, and data no kept state refers to,
are removed by the next upsert. One job writes at a time.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presswork.cluster import materialize
from presswork.sources.tables import delete_path, entry_names, is_complete

BUCKETS = 64
KEPT_STATES = 3
PREFIX = "state_"
STATE = "buckets int, bucket int, state string"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def states(spark: SparkSession, folder: str) -> list[str]:
    """Names of complete states, newest first."""
    names = sorted((n for n in entry_names(spark, folder) if n.startswith(PREFIX)), reverse=True)
    return [n for n in names if is_complete(spark, f"{folder}/{n}")]


def _placed(spark: SparkSession, folder: str, name: str) -> tuple[int, dict[int, str]]:
    rows = spark.read.schema(STATE).json(f"{folder}/{name}").collect()
    return rows[0]["buckets"], {r["bucket"]: r["state"] for r in rows if r["bucket"] is not None}


def current(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> tuple[int, dict[int, str]]:
    """Number of buckets, and the state that holds the data of each that has any."""
    known = states(spark, folder)
    return _placed(spark, folder, known[0]) if known else (buckets, {})


def read_buckets(spark: SparkSession, folder: str, schema: StructType, only: Iterable[int] | None = None) -> DataFrame:
    """The table, or some of its buckets; no other folder is opened."""
    _, held = current(spark, folder)
    paths = [f"{folder}/data/{held[b]}/bucket={b}" for b in (sorted(held) if only is None else only) if b in held]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _commit(spark: SparkSession, folder: str, name: str, buckets: int, held: dict[int, str]) -> None:
    rows = [(buckets, b, s) for b, s in sorted(held.items())] or [(buckets, None, None)]
    spark.createDataFrame(rows, STATE).coalesce(1).write.json(f"{folder}/{name}")


def _expire(spark: SparkSession, folder: str, keep: int) -> None:
    known = states(spark, folder)
    referred = {s for name in known[:keep] for s in _placed(spark, folder, name)[1].values()}
    for name in known[keep:]:
        delete_path(spark, f"{folder}/{name}")
    for name in entry_names(spark, f"{folder}/data"):
        if name not in referred:
            delete_path(spark, f"{folder}/data/{name}")


def upsert_buckets(
    batch: DataFrame, folder: str, key: str, sequence: str, buckets: int = BUCKETS, keep: int = KEPT_STATES
) -> list[int]:
    """Put the rows of ``batch`` in place of those with their key; the buckets rewritten.

    Of rows with one key that with the highest ``sequence`` (a column of the batch alone)
    stays. ``buckets`` counts for a new table only.
    """
    spark = batch.sparkSession
    schema = StructType([f for f in batch.schema if f.name != sequence])
    count, held = current(spark, folder, buckets)
    staged = materialize(batch.withColumn("bucket", bucket_of(F.col(key), count)), "batch")
    touched = sorted(r["bucket"] for r in staged.select("bucket").distinct().collect())
    if not touched:
        return []
    name = PREFIX + datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    latest = Window.partitionBy("bucket", key).orderBy(F.col(sequence).desc())
    fresh = staged.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n", sequence)
    old = read_buckets(spark, folder, schema, touched).withColumn("bucket", bucket_of(F.col(key), count))
    kept = old.join(staged.select("bucket", key), ["bucket", key], "left_anti")
    merged = kept.unionByName(fresh).hint("rebalance", F.col("bucket"))
    merged.write.partitionBy("bucket").parquet(f"{folder}/data/{name}")
    _commit(spark, folder, name, count, held | dict.fromkeys(touched, name))
    _expire(spark, folder, keep)
    return touched


def clear_buckets(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> None:
    """A new, empty state."""
    name = PREFIX + datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    _commit(spark, folder, name, buckets, {})

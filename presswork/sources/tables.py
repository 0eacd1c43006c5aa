"""Table readers and writers. The format is a parameter, parquet by default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presswork.cluster import shared_root, shuffle_partitions
from presswork.sources.folders import BATCH_BYTES, SINK_LOG, find_store, log_entries, read_in_tasks

# --- Fixed values: listing tasks, reading tasks of a stream and of a table of many folders.
LISTERS_PER_CORE = 4
READERS_PER_CORE = 4

MIN_READERS = "spark.sql.files.minPartitionNum"


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    merge_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Batch scan; a missing path is reported as ``FileNotFoundError``.

    ``merge_schema`` reads a table whose files gained columns over time. With ``schema`` the
    types of partition columns are not guessed from the names of all folders. If they are
    named as well, in ``partition_by``, folders are listed and files read by tasks, so the
    driver's memory does not follow the number of folders. Such a table is listed when its
    rows are computed, gives the columns of ``schema`` only and must not be overwritten from
    itself. In a store that only Spark opens, and in other formats, Spark lists it.
    """
    if partition_by and schema is not None and fmt == "parquet":
        fs, location = _file_system(spark, path)
        found = find_store(fs.makeQualified(location).toString())
        if found is not None:
            log = f"{path}/{SINK_LOG}"
            logged = log_entries(entry_names(spark, log)) if fs.exists(_file_system(spark, log)[1]) else None
            return read_in_tasks(spark, *found, logged, schema, partition_by, reading_tasks(spark))
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(
                f"no table at {path}; run the job that writes it first"
            ) from error
        raise


def reading_tasks(spark: SparkSession) -> int:
    """Tasks that read a table of many folders: several per core, or as many as the session asks for."""
    return max(READERS_PER_CORE * spark.sparkContext.defaultParallelism, shuffle_partitions(spark))


def _file_system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def entry_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder, one per run or file; none when it is missing."""
    fs, location = _file_system(spark, folder)
    if not fs.exists(location):
        return []
    return [status.getPath().getName() for status in fs.listStatus(location)]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that is in it."""
    fs, location = _file_system(spark, path)
    fs.delete(location, True)


def _is_file(spark: SparkSession, path: str) -> bool:
    fs, location = _file_system(spark, path)
    return fs.getFileStatus(location).isFile()


def is_complete(spark: SparkSession, path: str) -> bool:
    """A single file, or a folder whose write job has committed."""
    if _is_file(spark, path):
        return True
    fs, marker = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of a table directory, or of a table kept as one file."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if _is_file(spark, path):
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).load(folder)
    return reader.load(path)


def overwrite_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> int:
    """Replace a table, schema included; returns the rows written.

    Rows are rebalanced on the partition columns first: small partitions share
    a task and a partition holding a large part of the rows is split over
    several, so neither file count nor task size follows the skew.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return written.get["rows"]


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    every: str | None = None,
):
    """Start an append sink. Without ``every`` it stops when the input is read.

    The rows of each micro-batch are rebalanced on the partition columns, as in
    ``overwrite_table``: small partitions share a writer, and a large one gets as
    many as its bytes ask for (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    It is split by the tasks that read the input, so a session that does not say how many
    these are gets several per core, from then on.
    The sink's own log makes a repeated micro-batch add nothing.
    """
    spark = df.sparkSession
    if partition_by and spark.conf.get(MIN_READERS, None) is None:
        spark.conf.set(MIN_READERS, READERS_PER_CORE * spark.sparkContext.defaultParallelism)
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("mergeSchema", "true")
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = (
        writer.trigger(availableNow=True)
        if every is None
        else writer.trigger(processingTime=every)
    )
    return writer.start(path)


def preview_rows(df: DataFrame, key: str, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(key).select(*columns).limit(n)


def table_check(df: DataFrame, stamp: str) -> DataFrame:
    """Rows, columns and first time stamp of a table about to be published."""
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min(stamp).alias("first_stamp"),
    )


def prepare(spark: SparkSession) -> None:
    """Session settings the jobs rely on.

    A Python worker holds a few megabytes of texts at a time, however long they are. The
    folders of a table are listed by a few tasks per core, not by one task each.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    listers = LISTERS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", listers)
    shared_root(spark)

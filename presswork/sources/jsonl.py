"""Runs of JSON documents: one directory or file per run, named by time."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presswork.schemas import ENRICHED
from presswork.sources.tables import entry_names, is_complete

RUN_PREFIX = "enriched_articles_"


def save_run(records: DataFrame, folder: str, now: datetime | None = None) -> str:
    """Write one run; null fields are kept and text is not escaped to ASCII."""
    stamp = (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S_%f")
    path = f"{folder.rstrip('/')}/{RUN_PREFIX}{stamp}.jsonl"
    records.write.option("ignoreNullFields", "false").json(path)
    return path


def newest_path(spark: SparkSession, folder: str, prefix: str) -> str | None:
    """Path of the newest complete entry of ``folder`` by name, None without one.

    Names sort by time. Runs are not opened, and one whose job broke off is
    passed over.
    """
    names = sorted((n for n in entry_names(spark, folder) if n.startswith(prefix)), reverse=True)
    paths = (f"{folder.rstrip('/')}/{name}" for name in names)
    return next((p for p in paths if is_complete(spark, p)), None)


def newest_run(
    spark: SparkSession,
    folder: str,
    schema: StructType = ENRICHED,
    missing_ok: bool = False,
    place: str | None = None,
) -> DataFrame:
    """Documents of the newest run; blank lines are skipped.

    ``place`` names a column for the position of a line in the run: file, block, line.
    """
    newest = newest_path(spark, folder, RUN_PREFIX)
    if newest is not None:
        run = spark.read.schema(schema).json(newest)
        line = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
        return run if place is None else run.select("*", line.alias(place))
    if missing_ok:
        none = spark.createDataFrame([], schema)
        return none if place is None else none.withColumn(place, F.lit(0))
    raise FileNotFoundError(f"no runs in {folder}")

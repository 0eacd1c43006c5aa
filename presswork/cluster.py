"""Shared-folder and size-check helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a temporary one only within a single process."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        if not re.match(r"local($|\[)", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="presswork-"))
        root = context.getCheckpointDir()
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/presswork/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    The rows are computed once, and stages after it survive lost executors.
    """
    path = shared_path(df.sparkSession, label)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Remove tables of ``materialize`` that nothing reads any more; other frames stay."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def is_small(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no more than needed."""
    return df.limit(max_rows + 1).count() <= max_rows


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

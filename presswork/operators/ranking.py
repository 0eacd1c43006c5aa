"""Positions in a total order, without bringing the rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.cluster import materialize, shuffle_partitions

# Layout of monotonically_increasing_id: the partition above, the row in it below.
ROW_BITS = 33


def number_rows(df: DataFrame, *order: str | Column, name: str = "rank", start: int = 0) -> DataFrame:
    """Add the position of every row in the given order.

    Rows are range-partitioned and sorted, so equal shares of the order lie in
    consecutive partitions; a row's place within its partition is written with it
    and moved up by the size of the partitions before, a table of one row per
    partition. The order must be unique (end it with a key), then a frequent value
    is split over partitions as well. Pass only key and order columns and join the
    ranks back: whatever ``df`` holds is shuffled and written once. Finding the
    ranges samples the order columns, which computes them a second time.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = shuffle_partitions(df.sparkSession)
    sorted_rows = df.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    stored = materialize(sorted_rows.withColumn("_id", F.monotonically_increasing_id()), "ranked")
    placed = stored.withColumns(
        {"_part": F.shiftright("_id", ROW_BITS), "_inside": F.col("_id").bitwiseAND((1 << ROW_BITS) - 1)}
    )
    sizes = placed.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_inside") + start)
        .drop("_id", "_part", "_inside", "_offset")
    )

"""Positions in a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from capledger.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def global_rank(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """Add the 1-based position of each row in ``order`` over the whole table.

    Rows are range-partitioned and sorted, numbered inside their partition, and shifted by the
    sizes of the earlier partitions. The sorted rows are written to the checkpoint folder first,
    so both passes see the same partitions even when tasks are run again.
    """
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftrightunsigned("_row", _ROW_BITS))
    )
    # One row per partition: a handful of numbers, whatever the size of the table.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    in_part = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + in_part)
        .select(*df.columns, name)
    )


def rank_within(df: DataFrame, key: str, order: list[str], name: str = "position") -> DataFrame:
    """1-based position of each row inside its ``key``, also for keys of any size."""
    ranked = global_rank(df, [key, *order], "_position")
    first = ranked.groupBy(key).agg(F.min("_position").alias("_first"))
    return (
        ranked.join(first, key)
        .withColumn(name, F.col("_position") - F.col("_first") + 1)
        .select(*df.columns, name)
    )

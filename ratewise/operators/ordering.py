"""Global positions and running totals without a single-task window.

A window without PARTITION BY pulls every row into one task. Here the rows are
range-partitioned on a unique sort key (so no partition can be flooded by one
value), each partition is numbered on its own, and the partition offsets - one
row per partition - are added afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.session import checkpointed


def _sorted_parts(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    # Range boundaries come from sampling: they may differ between two
    # executions, so the numbered rows are fixed on storage before use.
    return checkpointed(
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
    )


def _with_offsets(parts: DataFrame, *totals: Column) -> DataFrame:
    """Per-partition totals and, for each, the sum over all earlier partitions."""
    per_part = parts.groupBy("_part").agg(F.min("_row").alias("_first"), *totals)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = [c for c in per_part.columns if c not in ("_part", "_first")]
    return per_part.select(
        "_part",
        "_first",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before{n}") for n in names],
    )


def with_position(
    df: DataFrame, order: Sequence[Column | str], name: str = "position", start: int = 1
) -> DataFrame:
    """Add the position of each row in the global order of ``order`` (a unique key)."""
    parts = _sorted_parts(df, order)
    offsets = _with_offsets(parts, F.count(F.lit(1)).alias("_n"))
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before_n") + F.col("_row") - F.col("_first") + F.lit(start))
        .drop("_part", "_row", "_first", "_before_n")
    )


def with_running_total(
    df: DataFrame, order: Sequence[Column | str], value: str, name: str
) -> DataFrame:
    """Add the sum of ``value`` over this and all earlier rows of the global order."""
    parts = _sorted_parts(df, order)
    offsets = _with_offsets(parts, F.sum(value).alias("_n"))
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        parts.withColumn("_inside", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before_n") + F.col("_inside"))
        .drop("_part", "_row", "_first", "_before_n", "_inside")
    )


def smallest(df: DataFrame, order: Sequence[Column | str], k: int, unique_limit: int = 10_000) -> DataFrame:
    """First ``k`` rows: a top-k in each task for small k, positions for large k."""
    if k <= unique_limit:
        return df.orderBy(*order).limit(k)
    return with_position(df, order, "_position").where(F.col("_position") <= k).drop("_position")

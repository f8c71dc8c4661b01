"""Surrogate keys and running totals over a global order, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from citeloom.session import stage

# monotonically_increasing_id() keeps the partition number above this many bits.
_ROW_BITS = 33


def _slice_offsets(sizes: DataFrame) -> DataFrame:
    """Exclusive prefix sum over one row per slice (at most one per shuffle partition)."""
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))


def surrogate_key(df: DataFrame, natural: Sequence[str], out: str) -> DataFrame:
    """Distinct natural keys with a dense 0-based id in key order.

    The keys are range-partitioned and sorted per partition; the place inside the partition
    is written out together with the key, so ids cannot change when a task runs again.
    """
    order = [F.col(c).asc_nulls_last() for c in natural]
    sorted_keys = df.select(*natural).distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(sorted_keys.withColumn("_place", F.monotonically_increasing_id()), "keys")
    slices = placed.select(
        *natural,
        F.shiftright("_place", _ROW_BITS).alias("_slice"),
        F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    sizes = slices.groupBy("_slice").agg((F.max("_row") + 1).alias("_size"))
    return slices.join(_slice_offsets(sizes), "_slice").select(
        (F.col("_offset") + F.col("_row")).alias(out), *natural
    )


def running_total(df: DataFrame, order_by: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over all rows before this one in the order of ``order_by``.

    ``order_by`` must tell all rows apart.
    """
    order: list[Column] = [F.col(c).asc_nulls_last() for c in order_by]
    spread = stage(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices")
    before = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    sizes = spread.groupBy("_slice").agg(F.sum(value).alias("_size"))
    return (
        spread.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
        .join(_slice_offsets(sizes), "_slice")
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_slice", "_inside", "_offset")
    )


def join_left_composite(df: DataFrame, dim: DataFrame, cs: Sequence[str], id_col: str) -> DataFrame:
    """Fetch a surrogate id over a natural key of several columns; null parts match null."""
    facts, codes = df.alias("f"), dim.select(*cs, id_col).alias("d")
    match = [F.col(f"f.{c}").eqNullSafe(F.col(f"d.{c}")) for c in cs]
    return facts.join(codes, match, "left").select("f.*", f"d.{id_col}")

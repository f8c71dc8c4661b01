"""Shares, percentile ranks and top lists.

All of them work on grouped tables. Totals come from a scalar subquery and ranks from a
range-partitioned running total, so no step gathers a table of unknown size in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from citeloom.operators.joins import join_split
from citeloom.operators.keys import running_total


def share_of_total(df: DataFrame, c: str, out: str, factor: float = 100.0) -> DataFrame:
    """``c`` as a percentage of its sum over the whole table."""
    total = df.agg(F.sum(c)).scalar()
    return df.withColumn(out, F.col(c) / total * F.lit(factor))


def window_normalise(df: DataFrame, part: Sequence[str], c: str) -> DataFrame:
    """``c`` divided by its sum over the rows with the same key."""
    sums = df.groupBy(*part).agg(F.sum(c).alias("_sum"))
    return join_split(df, sums, part).withColumn(c, F.col(c) / F.col("_sum")).drop("_sum")


def percent_rank_of_counts(counts: DataFrame, groups: Sequence[str], c: str, n: str, out: str) -> DataFrame:
    """``percent_rank`` of every value of a group, from the number ``n`` of its rows.

    The rank of a value is the number of rows below it, read off a running total over all
    groups, so a group of any size is ranked by many tasks.
    """
    keys = [*groups, c]
    placed = running_total(counts.select(*keys, F.col(n).alias("_n")), keys, "_n", "_before")
    if groups:
        start = placed.groupBy(*groups).agg(F.min("_before").alias("_first"), F.sum("_n").alias("_rows"))
        placed = join_split(placed, start, groups)
    else:
        placed = placed.withColumn("_first", F.lit(0)).withColumn("_rows", placed.agg(F.sum("_n")).scalar())
    rank = F.when(F.col("_rows") > 1, (F.col("_before") - F.col("_first")) / (F.col("_rows") - 1)).otherwise(F.lit(0.0))
    return placed.select(*keys, rank.alias(out))


def percent_rank_within(df: DataFrame, groups: Sequence[str], c: str, out: str) -> DataFrame:
    """``percent_rank`` of ``c`` among the rows of its group; null values are not ranked.

    Rows are first counted per (group, value). Call with a staged table if ``c`` is a
    floating-point aggregate.
    """
    keys = [*groups, c]
    counts = df.where(F.col(c).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return join_split(df, percent_rank_of_counts(counts, groups, c, "_n", out), keys, "left")


def sort_desc(df: DataFrame, cs: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Largest first, nulls last, ties in the order of ``tie``."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in cs], *[F.col(t).asc_nulls_last() for t in tie])


def with_position(df: DataFrame, cs: Sequence[str], tie: Sequence[str] = (), out: str = "position") -> DataFrame:
    """The 1-based place of each row in the order of ``sort_desc``, for numeric columns.

    The order has to tell all rows apart. Places are running totals over ranges, so the table is not
    sorted by one task.
    """
    falling = [f"_falling_{c}" for c in cs]
    keyed = df.withColumns({f: -F.col(c) for f, c in zip(falling, cs)} | {"_one": F.lit(1)})
    placed = running_total(keyed, [*falling, *tie], "_one", "_before")
    return placed.withColumn(out, (F.col("_before") + 1).cast("long")).drop(*falling, "_one", "_before")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_threshold(df: DataFrame, c: str, minimum: float, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest rows among those with at least ``minimum``."""
    return sort_desc(df.where(F.col(c) >= F.lit(minimum)), [c], tie).limit(n)


def top_percentile(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Rows above every one of the given percentile limits."""
    for c, limit in limits.items():
        df = df.where(F.col(c) > F.lit(limit))
    return df

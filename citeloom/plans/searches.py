"""Results of several searches merged into one list of records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from citeloom.operators.grouping import dedupe_keep_best
from citeloom.operators.joins import join_outer_accumulate, union_all


def merge_searches(
    dfs: Mapping[str, DataFrame], uid: str, score: str, tie: str, minimum: float | None = None
) -> DataFrame:
    """One row per record: its score in every search and the row with the best score.

    ``minimum`` keeps only records whose best score reaches it.
    """
    stacked = union_all(*[df.withColumn("topic", F.lit(name)) for name, df in dfs.items()])
    return merge_stacked(stacked, uid, "topic", score, list(dfs), tie, minimum)


def merge_stacked(
    found: DataFrame, uid: str, topic: str, score: str, topics: list[str], tie: str, minimum: float | None = None
) -> DataFrame:
    """The same for results that already stand in one table with their topic."""
    scores = join_outer_accumulate(found, uid, topic, score, topics)
    best = dedupe_keep_best(found, [uid], score, [tie])
    merged = scores.join(best, uid)
    return merged if minimum is None else merged.where(F.col(score) >= F.lit(minimum))

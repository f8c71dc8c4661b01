"""Connected components of an undirected graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citeloom.session import stage


def _fingerprint(pairs: DataFrame) -> tuple:
    """Tells two sets of pairs apart, by sums over the whole table."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31)), F.sum(F.xxhash64("b", "a") % F.lit(1 << 31))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node of ``edges`` (a, b), as (node, component).

    Large-star and small-star steps in turn: every node hands its larger, then its smaller
    neighbours to the smallest one it knows, until nothing changes. A chain of n nodes takes
    in the order of log(n) squared steps. Each round is written to the shared folder.

    Edges with a null end and edges of a node to itself count for nothing, and a node without other
    edges is not returned; repeated edges count once; no edges give no rows.
    """
    low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    pairs = stage(edges.filter("a <> b").select(high, low).distinct(), "edges")
    before = None
    while (now := _fingerprint(pairs)) != before:
        before = now
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = stage(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        pairs = stage(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)

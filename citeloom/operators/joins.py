"""Join shapes of the input and report jobs.

No side carries a broadcast hint: the planner broadcasts a side when its measured size is
under the session's threshold and otherwise shuffles, splitting hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """Stack by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct_keys(edges: DataFrame, ends: Sequence[str] = ("from", "to"), out: str = "org_id") -> DataFrame:
    """Every node that occurs at an end of an edge, once."""
    return reduce(DataFrame.unionByName, [edges.select(F.col(e).alias(out)) for e in ends]).distinct()


def keep_keys_of(df: DataFrame, c: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``c`` is among the keys of another table."""
    return join_split(df, keys.where(F.col(key).isNotNull()).select(F.col(key).alias(c)), [c], "left_semi")


def combine_with_codes(df: DataFrame, codes: Sequence[str], out: str) -> DataFrame:
    """Every row with every code of a short literal list (the category x type grid)."""
    return df.withColumn(out, F.explode(F.array(*[F.lit(c) for c in codes])))


def join_outer_accumulate(df: DataFrame, uid: str, topic: str, score: str, topics: Sequence[str]) -> DataFrame:
    """One row per record with its best score in each search, null where it was not found."""
    return df.groupBy(uid).pivot(topic, list(topics)).agg(F.max(score))


def join_many_to_many(edges: DataFrame, names: DataFrame, id_col: str = "org_id", label: str = "name", metric: str = "nb_records") -> DataFrame:
    """Labels and a metric for both ends of every edge; repeated ids repeat the edge."""
    def side(end: str, n: int) -> DataFrame:
        return names.select(F.col(id_col).alias(end), F.col(label).alias(f"{label}_{n}"), F.col(metric).alias(f"{metric}_{n}"))

    return join_split(join_split(edges, side("from", 1), ["from"]), side("to", 2), ["to"])


def join_composite_id(ids: DataFrame, registry_ids: DataFrame, locations: DataFrame, geo: DataFrame) -> DataFrame:
    """Places of organisations: external id (type, value) -> registry entry -> place.

    ``registry_ids`` holds the ids of the entries that may match (active ones). Where two
    entries put an organisation in the same place the smaller id stays.
    """
    matched = ids.select("org_id", "type", "value").join(registry_ids.select("id", "type", "value"), ["type", "value"])
    places = matched.select("org_id", "id").distinct()
    places = join_split(places, locations.select("id", "geonames_id"), ["id"])
    one_per_place = places.groupBy("org_id", "geonames_id").agg(F.min("id").alias("id"))
    return join_split(one_per_place, geo.where(F.col("geonames_id").isNotNull()), ["geonames_id"])


def join_lookup_code(df: DataFrame, codes: DataFrame, c: str, code: str, label: str, missing: dict[str, str]) -> DataFrame:
    """Label of a code; ``missing`` gives labels for codes that stand for no value."""
    found = df.join(codes.select(F.col(code).alias(c), label), c, "left")
    special = reduce(lambda acc, kv: F.when(F.col(c) == kv[0], F.lit(kv[1])).otherwise(acc), missing.items(), F.col(label))
    return found.withColumn(label, special)


def join_taxonomy_crosswalk(a: DataFrame, b: DataFrame, id_col: str, shared: Sequence[str]) -> DataFrame:
    """Pairs of nodes of two taxonomies that share an outside id; missing ids never match."""
    def matched(by: str) -> DataFrame:
        left = a.where(F.col(by).isNotNull()).select(F.col(id_col).alias("id"), by)
        right = b.where(F.col(by).isNotNull()).select(F.col(id_col).alias("id_m"), by)
        return left.join(right, by).select("id", "id_m", F.lit(by).alias("matched_by"))

    return reduce(DataFrame.unionByName, [matched(by) for by in shared])


def join_split(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` whose hot keys can be split at run time; null matches null.

    The run-time split needs a shuffle directly below both sides of the join. A side that
    was just grouped by the same keys would skip that shuffle, and then all rows of a hot
    key meet in one task. Joining on a struct of the keys keeps the shuffle on both sides;
    of the grouped side it moves one row per key.
    """
    rekeyed = [df.withColumn("_key", F.struct(*keys)) for df in (left, right)]
    return rekeyed[0].join(rekeyed[1].drop(*keys), "_key", how).drop("_key")

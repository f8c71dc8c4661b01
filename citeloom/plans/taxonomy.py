"""Category taxonomies: edges, nodes, ancestors and the link to records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.functions.nested import array_filter_map
from citeloom.functions.scalars import strip_prefix
from citeloom.operators.grouping import attach_group, children_per_parent
from citeloom.operators.joins import join_split, union_all

# The id namespace and the markers of the stored hierarchy.
ID_NAMESPACE = "https://openalex.org/"
NOT_APPLICABLE = "N/A"
NO_ANCESTOR = "0"

# Concepts whose label repeats another one, and homonyms told apart.
DUPLICATE_CONCEPTS = ("C21036866", "C8880873", "C2776095024", "C205147927")
HOMONYM_LABELS = {"C151011524": "Metre (SI)", "C182181037": "Metre (poetry)"}

TOPIC_LEVELS = {"domain": 0, "field": 1, "subfield": 2}


def build_concept_edges(concepts: DataFrame, namespace: str = ID_NAMESPACE) -> dict[str, DataFrame]:
    """Nodes, parent edges (one level up) and sibling edges (same level) of nested concepts."""
    node_id = strip_prefix("ids.openalex", namespace)
    lists = concepts.select(
        node_id.alias("category_id"),
        array_filter_map("ancestors", "level", -1).alias("parents"),
        array_filter_map("related_concepts", "level", 0).alias("siblings"),
    )

    def edges(array: str, end: str, size: str) -> DataFrame:
        return (
            lists.select("category_id", F.size(array).alias(size), F.explode(array).alias(end))
            .withColumn(end, strip_prefix(end, namespace))
            .where(F.col(end).isNotNull())
        )

    nodes = concepts.select(
        node_id.alias("category_id"),
        "level",
        "display_name",
        "works_count",
        "cited_by_count",
        F.col("ids.wikidata").alias("wikidata"),
        F.col("ids.wikipedia").alias("wikipedia"),
    )
    return {
        "nodes": nodes,
        "parents": edges("parents", "parent", "nb_parents"),
        "siblings": edges("siblings", "sibling", "nb_siblings"),
    }


def build_taxonomy_nodes(topics: DataFrame, namespace: str = ID_NAMESPACE) -> dict[str, DataFrame]:
    """Four-level taxonomy from topic rows that carry their own subfield, field and domain.

    Upper nodes with an unknown id, label or outside id are left out, as grouping drops them
    in the original tables.
    """
    leaf = topics.select(
        strip_prefix("ids.openalex", namespace).alias("category_id"),
        F.lit(3).alias("level"),
        "display_name",
        F.lit(None).cast("string").alias("wikidata"),
        F.col("ids.wikipedia").alias("wikipedia"),
        *[strip_prefix(f"{part}.id", namespace).alias(f"{part}_id") for part in TOPIC_LEVELS],
    )

    def upper(part: str, level: int) -> DataFrame:
        return (
            topics.select(
                strip_prefix(f"{part}.id", namespace).alias("category_id"),
                F.lit(level).alias("level"),
                F.col(f"{part}.display_name").alias("display_name"),
                F.col(f"{part}.wikidata").alias("wikidata"),
                F.col(f"{part}.wikipedia").alias("wikipedia"),
            )
            .na.drop("any")
            .distinct()
            .withColumn(f"{part}_id", F.col("category_id"))
        )

    nodes = union_all(leaf, *[upper(part, level) for part, level in TOPIC_LEVELS.items()])
    steps = [("field_id", "domain_id"), ("subfield_id", "field_id"), ("category_id", "subfield_id")]
    parents = union_all(
        *[
            children_per_parent(leaf.select(F.col(child).alias("child"), F.col(parent).alias("parent")), "child", "parent")
            for child, parent in steps
        ]
    ).withColumnRenamed("child", "category_id")
    siblings = (
        topics.select(
            strip_prefix("ids.openalex", namespace).alias("category_id"),
            F.size("siblings").alias("nb_siblings"),
            F.explode("siblings.id").alias("sibling"),
        )
        .withColumn("sibling", strip_prefix("sibling", namespace))
        .where(F.col("sibling").isNotNull())
    )
    return {"nodes": nodes, "parents": parents, "siblings": siblings}


def _resolved(nodes: DataFrame, edges: DataFrame, max_level: int) -> DataFrame:
    """Nodes with the ids and labels of their level-1 and level-0 ancestors.

    One row per node and distinct pair of ancestors. Level k looks up the finished rows of
    level k-1 through its parent edges, so a level costs two joins, edges to removed nodes
    find nothing and vanish, and many paths to the same ancestors stay one row.

    A node without a level counts as one of level 0. Nodes above ``max_level``, the number of
    levels the taxonomy has, stay as rows without ancestors.
    """
    nodes = nodes.withColumn("level", F.coalesce("level", F.lit(0).cast(nodes.schema["level"].dataType)))
    found = ["parent_1", "parent_0", "display_name_1", "display_name_0"]

    def at(level: int) -> DataFrame:
        return nodes.where(F.col("level") == level)

    def or_none(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(NO_ANCESTOR))

    nothing = F.lit(None).cast("string")
    own_id, own_name = F.col("category_id"), F.col("display_name")
    done = [
        at(0).select("*", F.lit(NOT_APPLICABLE).alias("parent_1"), own_id.alias("parent_0"),
                     nothing.alias("display_name_1"), own_name.alias("display_name_0"))
    ]
    for level in range(1, max_level + 1):
        above = done[-1].select(F.col("category_id").alias("parent"), *found)
        upward = edges.select("category_id", "parent").join(above, "parent").drop("parent").distinct()
        here = at(level).join(upward, "category_id", "left")
        first = level == 1
        done.append(
            here.select(
                *nodes.columns,
                (own_id if first else or_none("parent_1")).alias("parent_1"),
                or_none("parent_0").alias("parent_0"),
                (own_name if first else F.col("display_name_1")).alias("display_name_1"),
                "display_name_0",
            ).distinct()
        )
    apart = nodes.where((F.col("level") > max_level) | (F.col("level") < 0)).select(
        "*", F.lit(NOT_APPLICABLE).alias("parent_1"), F.lit(NOT_APPLICABLE).alias("parent_0"),
        nothing.alias("display_name_1"), nothing.alias("display_name_0"),
    )
    return union_all(*done, apart.distinct())


def _with_parent_counts(rows: DataFrame, *parents: str) -> DataFrame:
    """Each row with the numbers of different ancestors of its category."""
    return attach_group(rows, ["category_id"], *[F.count_distinct(p).cast("long").alias(f"nb_{p}") for p in parents])


def resolve_hierarchy(nodes: DataFrame, parent_edges: DataFrame, max_level: int = 5) -> DataFrame:
    """Discipline (level 1) and domain (level 0) of every category, one row per combination.

    ``nodes`` has category_id, level, display_name and raw_display_name; an edge joins a
    category to a parent one level up. A missing ancestor is ``'0'`` and the discipline of a
    domain is ``'N/A'``; both count as values in nb_parent_1 and nb_parent_0.
    """
    wanted = nodes.select("category_id", "level", "display_name", "raw_display_name")
    return _with_parent_counts(_resolved(wanted, parent_edges, max_level), "parent_1", "parent_0").select(
        "category_id", "level", "display_name", "raw_display_name", "parent_1", "parent_0",
        "display_name_1", "display_name_0", "nb_parent_1", "nb_parent_0",
    )


def resolve_topic_hierarchy(nodes: DataFrame, parent_edges: DataFrame) -> DataFrame:
    """Subfield, field and domain of every node of the four-level taxonomy.

    Levels 0 to 2 follow the edges, topics (level 3) carry their ancestors in columns. Nodes
    of no or another level stay, as in ``_resolved``.
    """
    upper = nodes.where(F.col("level").isNull() | (F.col("level") != 3)).select("category_id", "level", "display_name")
    is_subfield = F.col("level") == 2
    resolved = _resolved(upper, parent_edges, 2).select(
        "*",
        F.when(is_subfield, F.col("category_id")).otherwise(NOT_APPLICABLE).alias("parent_2"),
        F.when(is_subfield, F.col("display_name")).alias("display_name_2"),
    )
    leaves = nodes.where(F.col("level") == 3).select(
        "category_id", "level", "display_name",
        F.col("subfield_id").alias("parent_2"), F.col("field_id").alias("parent_1"), F.col("domain_id").alias("parent_0"),
    )
    parents = ("parent_2", "parent_1", "parent_0")
    for parent in parents:
        names = upper.select(F.col("category_id").alias(parent), F.col("display_name").alias(f"display_name_{parent[-1]}"))
        leaves = leaves.join(names, parent, "left")
    return _with_parent_counts(union_all(resolved, leaves).distinct(), *parents).select(
        "category_id", "level", "display_name", *parents,
        *[f"display_name_{p[-1]}" for p in parents], *[f"nb_{p}" for p in parents],
    )


def discipline_labels(hierarchy: DataFrame) -> DataFrame:
    """The raw labels of every discipline, one row each, with its number of categories.

    Categories of level 0 and those without a known ancestor are left out.
    """
    key = ["parent_1", "display_name_1"]
    below = hierarchy.where((F.col("level") > 0) & (F.col("parent_1") != NO_ANCESTOR))
    for c in key:
        below = below.where(F.col(c).isNotNull())
    sizes = below.groupBy(*key).agg(F.count_distinct("category_id").alias("nb_id"))
    return join_split(below.select(*key, "raw_display_name").distinct(), sizes, key).select(*key, "raw_display_name", "nb_id")


def link_categories(cats: DataFrame, hierarchy: DataFrame, record: str, value: str, label: str) -> DataFrame:
    """Record categories with their place in the taxonomy.

    The label is matched as written. ``is_not_linked`` is true on all rows of a record none
    of whose labels is known. It is found from the plain label list, so the many-to-many
    join below runs once.
    """
    known = cats.where(F.col(record).isNotNull()).select(record, F.col(value).alias(label))
    hierarchy = hierarchy.where(F.col(label).isNotNull())
    labels = hierarchy.where(F.col("category_id").isNotNull()).select(label).distinct().withColumn("_known", F.lit(True))
    flags = (
        join_split(known, labels, [label], "left").groupBy(record).agg((F.count("_known") == 0).alias("is_not_linked"))
    )
    return join_split(join_split(known, hierarchy, [label], "left"), flags, [record], "left")


def fields_of_study(categories: DataFrame, record: str) -> DataFrame:
    """(record, value) of the labels that the taxonomies know, out of all kinds of categories."""
    return categories.where(F.col("type") == "fields_of_study").select(record, "value")


def link_topics(cats: DataFrame, topics: DataFrame, record: str, value: str = "value") -> DataFrame:
    """Record labels with every node of the four-level taxonomy that bears the label.

    ``topics`` is the resolved topic hierarchy. A label may stand on several levels at once; the record then
    has a row for each, with the ancestors of that node at the three upper levels.
    ``is_not_linked`` is as in ``link_categories``.
    """
    return link_categories(cats, topics, record, value, "display_name")

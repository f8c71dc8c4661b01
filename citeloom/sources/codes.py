"""Fixed code tables and the thesaurus of document types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Document type codes.
DOCUMENT_TYPE_CODES = (
    ("AA", "Article"),
    ("PP", "Proceedings paper"),
    ("RR", "Review"),
    ("RP", "Retracted paper"),
    ("PX", "Preprint"),
    ("DD", "Data"),
    ("OO", "Other"),
)

# Rows for records without a citation topic, one per level.
TOPIC_CODE_DEFAULTS = ((1, 0, "Other"), (2, 0, "Other"), (3, 0, "Other"))

# Unified document type -> label and raw types.
DOCUMENT_TYPE_THESAURUS = {
    "ja": ("Journal Article", ["journal article", "journal", "journal volume", "journal issue"]),
    "bc": ("Book Chapter", ["book chapter"]),
    "pp": ("Preprint", ["preprint"]),
    "db": ("Dataset", ["dataset"]),
    "cp": ("Conference Article", ["conference proceedings article"]),
    "rv": ("Review", ["review"]),
    "nt": (
        "Non-traditional research output (NTRO)",
        [
            "other", "dissertation", "standard", "reference entry", "component",
            "conference proceedings", "unknown", "retraction notice", "working paper",
        ],
    ),
    "bk": ("Book", ["book"]),
    "gl": ("Grey Literature", ["report"]),
    "ed": ("Editorial", ["editorial", "letter", "news"]),
    "ct": ("Clinical Trial", ["clinical trial", "clinical study"]),
}

DOCUMENT_TYPE_SCHEMA = T.StructType(
    [T.StructField("doctype_code", T.StringType()), T.StructField("doctype", T.StringType())]
)
TOPIC_CODE_SCHEMA = T.StructType(
    [
        T.StructField("level", T.IntegerType()),
        T.StructField("id", T.IntegerType()),
        T.StructField("topic_label", T.StringType()),
    ]
)
CATEGORY_CODE_SCHEMA = T.StructType(
    [
        T.StructField("id_source", T.StringType()),
        T.StructField("id_level", T.ShortType()),
        T.StructField("id", T.StringType()),
        T.StructField("id_label", T.StringType()),
    ]
)
THESAURUS_SCHEMA = T.StructType(
    [
        T.StructField("pubtype_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("source_types", T.ArrayType(T.StringType())),
    ]
)


def static_code_table(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType) -> DataFrame:
    """A literal table; rows are fixed in the code, never data."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def topic_codes(lookup: DataFrame) -> DataFrame:
    """A topic lookup completed by the default row of every level."""
    return lookup.unionByName(static_code_table(lookup.sparkSession, TOPIC_CODE_DEFAULTS, TOPIC_CODE_SCHEMA))


def type_thesaurus(
    spark: SparkSession, entries: Mapping[str, tuple[str, Sequence[str]]] = DOCUMENT_TYPE_THESAURUS
) -> DataFrame:
    rows = [(code, label, list(raw)) for code, (label, raw) in entries.items()]
    return static_code_table(spark, rows, THESAURUS_SCHEMA)


def unify_document_type(df: DataFrame, thesaurus: DataFrame, c: str) -> DataFrame:
    """Adds the unified type (pubtype_id) of a raw type; unknown raw types give null."""
    raw = thesaurus.select("pubtype_id", F.explode("source_types").alias(c))
    return df.join(raw, c, "left")

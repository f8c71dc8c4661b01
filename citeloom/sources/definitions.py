"""Search and thesaurus definitions: nested documents to one flat table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Section of a definition file (spelled as in the files) -> row type.
SECTION_TYPES = {"topics": "topic", "aggegations": "aggregate", "thesaurus": "thesaurus"}

_ENTRY = "struct<name:string,value:string>"
_DOCUMENT = f"map<string,map<string,map<string,array<map<string,{_ENTRY}>>>>>"


def flatten_documents(docs: DataFrame, text: str) -> DataFrame:
    """Rows (source, category, type, id, name, value) of definition documents in a column.

    A document nests source -> category -> section -> list of {id: {name, value}}; ``value``
    stays JSON text. Sections of other names hold no definitions.
    """
    kind = F.create_map(*[F.lit(part) for pair in SECTION_TYPES.items() for part in pair])
    return (
        docs.select(F.explode(F.from_json(text, _DOCUMENT)).alias("source", "_categories"))
        .select("source", F.explode("_categories").alias("category", "_sections"))
        .select("source", "category", F.explode("_sections").alias("_section", "_entries"))
        .where(F.col("_section").isin(list(SECTION_TYPES)))
        .select("source", "category", kind[F.col("_section")].alias("type"), F.explode("_entries").alias("_entry"))
        .select("source", "category", "type", F.explode("_entry").alias("id", "_d"))
        .select("source", "category", "type", "id", "_d.name", "_d.value")
    )


def flatten_config(spark: SparkSession, path: str) -> DataFrame:
    """The same over definition files, one document per file."""
    return flatten_documents(spark.read.text(path, wholetext=True), "value")


def thesaurus_from_config(config: DataFrame, entry: str = "publication_type") -> DataFrame:
    """Unified types (pubtype_id, name, source_types) out of a flattened definition table."""
    value = F.from_json("value", "map<string,struct<label:string,source_types:array<string>>>")
    rows = config.where((F.col("type") == "thesaurus") & (F.col("id") == entry))
    return rows.select(F.explode(value).alias("pubtype_id", "_v")).select(
        "pubtype_id", F.col("_v.label").alias("name"), "_v.source_types"
    )

"""Organisation registry: nested entries to tables.

Everything about an entry stands in its own row, so the main table is built with array
functions and only the place table needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.functions.nested import array_element, array_length, flatten_nested
from citeloom.operators.grouping import distinct_on_key


def _first_name(kind: str) -> Column:
    return array_element(F.filter("names", lambda n: F.array_contains(n["types"], kind)), 1)["value"]


def _first_link(kind: str) -> Column:
    return array_element(F.filter("links", lambda n: n["type"] == kind), 1)["value"]


def registry_main(registry: DataFrame) -> DataFrame:
    """One row per organisation: display name, links, types and administration."""
    return registry.select(
        "id",
        _first_name("ror_display").alias("ror_display"),
        _first_name("acronym").alias("acronym"),
        _first_link("website").alias("website"),
        _first_link("wikipedia").alias("wikipedia"),
        "established",
        "status",
        array_length("types").alias("nb_types"),
        array_length("relationships").alias("nb_relationships"),
        array_element("types", 1).alias("main_type"),
        array_element("types", 2).alias("second_type"),
        array_element("types", 3).alias("third_type"),
        F.col("admin.created.date").alias("created_date"),
        F.col("admin.created.schema_version").alias("created_schema_version"),
        F.col("admin.last_modified.date").alias("last_modified_date"),
        F.col("admin.last_modified.schema_version").alias("last_modified_schema_version"),
    )


def registry_tables(registry: DataFrame) -> dict[str, DataFrame]:
    """Main table, places, external ids, names, domains and relationships."""
    places = flatten_nested(registry, ["id"], "locations")
    geo = places.select("id", "geonames_id", "geonames_details.*")
    external = registry.select("id", F.explode("external_ids").alias("e")).select(
        "id", "e.type", "e.preferred", F.explode_outer("e.all").alias("value")
    )
    names = registry.select("id", F.explode("names").alias("n")).select(
        "id", "n.value", "n.lang", F.explode_outer("n.types").alias("type")
    )
    relationships = registry.select(F.col("id").alias("from"), F.explode("relationships").alias("r"))
    return {
        "ror": registry_main(registry),
        "ror_location": places.select("id", "geonames_id"),
        "ror_location_id": distinct_on_key(geo, ["geonames_id"], ["id"]).drop("id"),
        "ror_external_id": external.withColumn("preferred", F.coalesce("preferred", "value")),
        "ror_names": names,
        "ror_domains": registry.select("id", F.explode("domains").alias("domain")),
        "ror_relationships": relationships.select(
            "from", F.col("r.id").alias("to"), F.col("r.type").alias("type"), F.col("r.label").alias("to_ror_display")
        ),
    }

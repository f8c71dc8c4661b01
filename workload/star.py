"""The star-schema tables seen as scholarly data.

An order stands for a record, its line numbers for contributions, suppliers for
organisations, customers for sources, nations for countries and disciplines, regions for
domains, and part brands for funders. Nested documents are derived row by row, so deriving
them needs no grouping and grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citeloom.functions.predicates import fix_duplicate_labels
from citeloom.operators.joins import union_all
from citeloom.plans.network import collaboration_network, team_sizes
from citeloom.plans.taxonomy import link_categories, resolve_hierarchy
from citeloom.session import stage
from citeloom.sources.codes import type_thesaurus, unify_document_type

YEARS = (1996, 2000)

# Stand-ins for the label corrections and the type thesaurus, in the terms of these tables.
REPEATED_NODES = ("S3", "S5", "S8", "S13")
NEW_LABELS = {"S1": "Supplier (first)", "S2": "Supplier (second)"}
TYPE_GROUPS = {
    "ja": ("Journal Article", ["1-URGENT", "2-HIGH"]),
    "cp": ("Conference Article", ["3-MEDIUM"]),
    "pp": ("Preprint", ["4-NOT SPECIFIED"]),
}


#: Topics up to this number can bear the label of their nation.
SHARED_TOPICS = 40

# Declared, so that opening a table costs no job that looks into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, sizes: DataFrame | None = None) -> DataFrame:
    """Orders as records; a record without lines has no known team size.

    ``sizes`` are the team sizes where they are at hand already.
    """
    teams = team_records(spark, sf_dir) if sizes is None else sizes
    return record_facts(spark, sf_dir).join(teams, "lens_id", "left")


def record_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("lens_id"),
        F.year("o_orderdate").cast("long").alias("year_published"),
        F.col("o_orderpriority").alias("publication_type"),
        F.col("o_custkey").alias("source_id"),
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("citations"),
        (F.col("o_orderstatus") == "P").alias("is_retracted"),
        F.col("o_orderdate").alias("date_published"),
    )


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("title"))


def contribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return lines.select(
        F.col("l_orderkey").alias("lens_id"), F.concat_ws("#", "l_orderkey", "l_linenumber").alias("contribution_id")
    )


def affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line: record, contribution and organisation."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("lens_id"),
        F.concat_ws("#", "l_orderkey", "l_linenumber").alias("contribution_id"),
        F.col("l_suppkey").alias("org_id"),
    )


def team_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the line number as contribution, enough where the record is at hand."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("lens_id"),
        F.col("l_linenumber").alias("contribution_id"),
        F.col("l_suppkey").alias("org_id"),
    )


#: The bound of the definition: records of more authors are no collaboration.
MAX_TEAM_SIZE = 20


def team_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with their number of authors."""
    return team_sizes(team_lines(spark, sf_dir))


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; those of nation 0 stand for organisations without a known country."""
    nation = F.col("s_nationkey")
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("org_id"),
        F.col("s_name").alias("name"),
        F.when(nation == 0, F.lit("??")).otherwise(F.concat(F.lit("N"), nation)).alias("country_code"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries on the map: every nation with a code of its own but the last one."""
    return load(spark, sf_dir, "nation").where(F.col("n_nationkey").between(1, 23)).select(
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("country_code"),
        F.col("n_name").alias("country"),
        F.concat_ws(" ", F.lit("State of"), F.col("n_name")).alias("admin"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the organisations with a balance that is not negative."""
    placed = load(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    nation = load(spark, sf_dir, "nation")
    return placed.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("org_id"),
        F.concat(F.lit("r"), F.col("s_suppkey")).alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("country_code"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the organisations with coordinates; rich ones have two, and nation 0 has no coordinates."""
    placed = load(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    own, other = F.col("s_nationkey"), (F.col("s_nationkey") + 7) % 25
    listed = F.when(F.col("s_acctbal") >= 5000, F.array(own, other)).otherwise(F.array(own))
    lines = placed.select(F.col("s_suppkey").alias("org_id"), F.explode(listed.cast("array<bigint>")).alias("geonames_id"))
    known = F.col("geonames_id") > 0
    return lines.select(
        "org_id", "geonames_id", F.when(known, F.col("geonames_id") * 1.5).alias("lat"), F.when(known, F.col("geonames_id") * -2.0).alias("lng")
    )


def funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as funders of the records that order them; parts of size 1 have no project."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("lens_id"),
        F.expr("nullif(p_brand, 'Brand#1')").alias("org"),
        F.when(F.col("p_size") > 1, F.col("l_partkey").cast("string")).alias("funding_id"),
        F.expr("nullif(p_type, 'PROMO')").alias("country"),
    )


def taxonomy_nodes(spark: SparkSession, sf_dir: str, deep: bool = False) -> DataFrame:
    """Regions, nations, suppliers and (deep) parts as levels 0 to 3, labels corrected."""
    def level(table: str, letter: str, key: str, label: Column, n: int) -> DataFrame:
        return load(spark, sf_dir, table).select(
            F.concat(F.lit(letter), F.col(key)).alias("category_id"), F.lit(n).cast("long").alias("level"), label.alias("display_name")
        )

    levels = [
        level("region", "R", "r_regionkey", F.col("r_name"), 0),
        level("nation", "N", "n_nationkey", F.col("n_name"), 1),
        level("supplier", "S", "s_suppkey", F.col("s_name"), 2),
    ]
    if deep:
        levels.append(level("part", "P", "p_partkey", F.concat_ws(" ", "p_name", "p_partkey"), 3))
    return fix_duplicate_labels(union_all(*levels), "category_id", "display_name", REPEATED_NODES, NEW_LABELS)


def taxonomy_edges(spark: SparkSession, sf_dir: str, deep: bool = False) -> DataFrame:
    """Each node to its parents; a part has as many parents as it has suppliers."""
    def edge(df: DataFrame, child: str, c: str, parent: str, p: str) -> DataFrame:
        return df.select(F.concat(F.lit(child), F.col(c)).alias("category_id"), F.concat(F.lit(parent), F.col(p)).alias("parent"))

    edges = [
        edge(load(spark, sf_dir, "nation"), "N", "n_nationkey", "R", "n_regionkey"),
        edge(load(spark, sf_dir, "supplier"), "S", "s_suppkey", "N", "s_nationkey"),
    ]
    if deep:
        supply = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
        edges.append(edge(supply, "P", "l_partkey", "S", "l_suppkey"))
    return union_all(*edges)


def hierarchy(spark: SparkSession, sf_dir: str, deep: bool = False) -> DataFrame:
    return resolve_hierarchy(
        taxonomy_nodes(spark, sf_dir, deep), taxonomy_edges(spark, sf_dir, deep), max_level=3 if deep else 2
    )


def record_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of a record: the names of the suppliers of its lines, each once."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    names = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return lines.join(names, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("lens_id"), F.col("s_name").alias("value")
    )


def linked_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_categories(
        record_categories(spark, sf_dir), stage(hierarchy(spark, sf_dir), "hierarchy"), "lens_id", "value", "raw_display_name"
    )


def typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with their unified type, for the citation baselines."""
    typed = unify_document_type(record_facts(spark, sf_dir), type_thesaurus(spark, TYPE_GROUPS), "publication_type")
    return typed.withColumnRenamed("year_published", "year")


def network(spark: SparkSession, sf_dir: str, sizes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Stored network tables and what the collaboration reports read besides; ``sizes`` as in ``records``."""
    teams = team_records(spark, sf_dir) if sizes is None else sizes
    edges, nodes = collaboration_network(team_lines(spark, sf_dir), teams, organisations(spark, sf_dir), MAX_TEAM_SIZE)
    return {
        "net_org_edges": edges,
        "net_org_nodes": stage(nodes, "nodes"),
        "locations": locations(spark, sf_dir),
        "countries": countries(spark, sf_dir),
    }


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested publication documents, one per order.

    The quarter gives the number of authors (none to three); the first author has one
    affiliation, the second two (or an unknown list in status P), the third an empty list.
    The order status decides which of the other lists are filled, empty or missing.
    """
    orders, customer, nation = (load(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    base = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    typed = "array<struct<type:string,value:string>>"
    own_org = (
        "named_struct('name', concat('Org ', c_custkey), 'name_original', c_name,"
        " 'country_code', if(o_orderstatus = 'F', null, concat('N', c_nationkey)),"
        " 'grid_id', if(o_orderstatus = 'F', null, concat('g', c_custkey)),"
        " 'ids', array(named_struct('type', 'ror', 'value', concat('ror:', c_custkey)),"
        " named_struct('type', 'grid', 'value', if(o_orderstatus = 'F', null, concat('g', c_custkey)))))"
    )
    state_org = (
        "named_struct('name', concat('State Org ', c_nationkey), 'name_original', n_name,"
        " 'country_code', concat('N', c_nationkey), 'grid_id', cast(null as string),"
        f" 'ids', cast(null as {typed}))"
    )

    def author(i: int, ids: str, affiliations: str) -> str:
        return (
            f"named_struct('first_name', 'A{i}', 'last_name', c_name, 'ids', {ids}, 'affiliations', {affiliations})"
        )

    orcid = "array(named_struct('type', 'orcid', 'value', concat('P', o_orderkey, '-{}')))"
    authors = ", ".join(
        [
            author(1, orcid.format(1), f"array({own_org})"),
            author(2, orcid.format(2), f"if(o_orderstatus = 'P', null, array({own_org}, {state_org}))"),
            author(3, f"cast(null as {typed})", f"filter(array({own_org}), x -> false)"),
        ]
    )
    return base.select(
        F.expr("concat('P', o_orderkey)").alias("lens_id"),
        F.year("o_orderdate").alias("year_published"),
        F.to_date("o_orderdate").alias("date_published"),
        F.expr("o_orderstatus = 'O'").alias("is_open_access"),
        F.expr("o_orderstatus = 'P'").alias("is_retracted"),
        F.col("o_orderpriority").alias("publication_type"),
        F.expr("cast(quarter(o_orderdate) - 1 as int)").alias("author_count"),
        F.expr("cast(floor(o_totalprice / 1000) as bigint)").alias("scholarly_citations_count"),
        F.expr("cast(day(o_orderdate) as bigint)").alias("references_resolved_count"),
        F.expr("cast(day(o_orderdate) + month(o_orderdate) as bigint)").alias("references_count"),
        F.expr("cast(month(o_orderdate) as bigint)").alias("patent_citations_count"),
        F.expr(
            "case o_orderstatus when 'O' then array(named_struct('type', 'doi', 'value', concat('10.1/', o_orderkey)))"
            " when 'P' then array(named_struct('type', 'doi', 'value', concat('10.1/', o_orderkey)),"
            " named_struct('type', 'magid', 'value', cast(o_custkey as string))) end"
        ).alias("external_ids"),
        F.expr(
            "if(c_mktsegment = 'BUILDING', null, named_struct('title', c_name, 'publisher', c_mktsegment,"
            " 'type', 'journal', 'country', if(c_acctbal < 0, null, n_name), 'issn',"
            " array(named_struct('type', 'print', 'value', concat('1-', c_custkey)),"
            " named_struct('type', 'electronic', 'value', concat('2-', c_custkey)))))"
        ).alias("source"),
        F.expr(
            "case o_orderstatus when 'F' then array(n_name, c_mktsegment) when 'O' then filter(array(n_name), x -> false) end"
        ).alias("fields_of_study"),
        F.expr(
            "case o_orderstatus when 'F' then array(named_struct('mesh_heading', c_mktsegment, 'mesh_id', concat('D', c_nationkey),"
            " 'qualifier_name', 'methods', 'qualifier_id', 'Q1'))"
            " when 'P' then array(named_struct('mesh_heading', n_name, 'mesh_id', 'D0', 'qualifier_name', cast(null as string),"
            " 'qualifier_id', cast(null as string)), named_struct('mesh_heading', c_mktsegment, 'mesh_id', 'D1',"
            " 'qualifier_name', 'trends', 'qualifier_id', 'Q2')) end"
        ).alias("mesh_terms"),
        F.expr(f"slice(array({authors}), 1, quarter(o_orderdate) - 1)").alias("authors"),
        F.expr(
            "case o_orderstatus when 'F' then array(named_struct('org', c_mktsegment, 'funding_id', concat('G', c_custkey), 'country', n_name))"
            " when 'P' then array(named_struct('org', c_mktsegment, 'funding_id', cast(null as string), 'country', n_name),"
            " named_struct('org', n_name, 'funding_id', concat('G', o_orderkey), 'country', cast(null as string)))"
            " else filter(array(named_struct('org', c_mktsegment, 'funding_id', n_name, 'country', n_name)), x -> false) end"
        ).alias("funding"),
        F.expr("o_totalprice").alias("score"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested registry entries, one per customer; those in debt are no longer active."""
    customer, nation = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    base = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    stamp = "named_struct('date', '{}', 'schema_version', '{}')"
    return base.select(
        F.expr("concat('r', c_custkey)").alias("id"),
        F.expr("cast(1900 + c_nationkey as int)").alias("established"),
        F.expr("if(c_acctbal < 0, 'inactive', 'active')").alias("status"),
        F.expr(
            "case c_mktsegment when 'MACHINERY' then array('company', 'facility', 'funder')"
            " when 'BUILDING' then array('education', 'funder') else array('other') end"
        ).alias("types"),
        F.expr("if(c_mktsegment = 'BUILDING', array(concat('c', c_custkey, '.example')), array())").cast("array<string>").alias("domains"),
        F.expr(
            "array(named_struct('geonames_id', cast(c_nationkey as bigint), 'geonames_details', named_struct('name', concat('City ', c_nationkey),"
            " 'country_code', concat('N', c_nationkey), 'country_name', n_name,"
            " 'lat', c_nationkey * 1.5D, 'lng', c_nationkey * -2.0D)))"
        ).alias("locations"),
        F.expr(
            "array(named_struct('type', 'ror', 'preferred', cast(null as string), 'all', array(concat('ror:', c_custkey))),"
            " named_struct('type', 'grid', 'preferred', concat('g', c_custkey), 'all', array(concat('g', c_custkey), concat('old', c_custkey))))"
        ).alias("external_ids"),
        F.expr(
            "array(named_struct('value', concat('C', c_custkey), 'types', array('acronym'), 'lang', cast(null as string)),"
            " named_struct('value', c_name, 'types', array('ror_display', 'label'), 'lang', 'en'))"
        ).alias("names"),
        F.expr(
            "if(c_mktsegment = 'FURNITURE', array(), array(named_struct('type', 'website', 'value', concat('w', c_custkey)),"
            " named_struct('type', 'wikipedia', 'value', concat('p', c_custkey))))"
        ).cast("array<struct<type:string,value:string>>").alias("links"),
        F.expr(
            "if(c_acctbal < 0, array(), array(named_struct('type', 'parent', 'label', n_name, 'id', concat('n', c_nationkey))))"
        ).cast("array<struct<type:string,label:string,id:string>>").alias("relationships"),
        F.expr(
            f"named_struct('created', {stamp.format('2018-11-14', '1.0')}, 'last_modified', {stamp.format('2024-10-15', '2.0')})"
        ).alias("admin"),
    )


def topics(spark: SparkSession, sf_dir: str, shared_labels: bool = False) -> DataFrame:
    """Nested topics, one per customer, below segment, nation and region.

    The first nation has no outside id, so its node is missing from the upper levels. With
    ``shared_labels`` the first topics bear the label of their nation, two levels above.
    """
    customer, nation, region = (load(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    base = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    space = "https://openalex.org/"
    own = F.col("c_name")
    return base.select(
        (F.when(F.col("c_custkey") <= SHARED_TOPICS, F.col("n_name")).otherwise(own) if shared_labels else own).alias("display_name"),
        F.expr(f"array(named_struct('id', concat('{space}C', c_custkey + 1), 'display_name', c_name),"
               f" named_struct('id', cast(null as string), 'display_name', n_name))").alias("siblings"),
        F.expr(f"named_struct('openalex', concat('{space}C', c_custkey), 'wikipedia', concat('wiki/', c_name))").alias("ids"),
        F.expr(f"named_struct('id', concat('{space}N', n_nationkey, '-', c_mktsegment), 'display_name', concat(n_name, ' ', c_mktsegment),"
               f" 'wikidata', concat('Q', n_nationkey, c_mktsegment), 'wikipedia', concat('wiki/', c_mktsegment))").alias("subfield"),
        F.expr(f"named_struct('id', concat('{space}N', n_nationkey), 'display_name', n_name,"
               f" 'wikidata', if(n_nationkey = 0, null, concat('Q', n_nationkey)), 'wikipedia', concat('wiki/', n_name))").alias("field"),
        F.expr(f"named_struct('id', concat('{space}R', r_regionkey), 'display_name', r_name,"
               f" 'wikidata', concat('QR', r_regionkey), 'wikipedia', concat('wiki/', r_name))").alias("domain"),
    )


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested concepts, one per supplier (level 2) with its nation and region as ancestors."""
    supplier, nation = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "nation")
    base = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    space = "https://openalex.org/"
    node = "named_struct('id', concat('" + space + "{}', {}), 'level', {}, 'display_name', {})"
    return base.select(
        F.col("s_name").alias("display_name"),
        F.lit(2).alias("level"),
        F.col("s_suppkey").alias("works_count"),
        F.col("s_suppkey").alias("cited_by_count"),
        F.expr(f"array({node.format('R', 'n_regionkey', 0, 'n_name')}, {node.format('N', 's_nationkey', 1, 'n_name')})").alias("ancestors"),
        F.expr(f"array({node.format('S', 's_suppkey + 1', 2, 's_name')}, {node.format('N', 's_nationkey', 1, 'n_name')})").alias("related_concepts"),
        F.expr(f"named_struct('openalex', concat('{space}S', s_suppkey), 'wikidata', concat('Q', s_suppkey),"
               " 'wikipedia', if(s_acctbal < 0, null, concat('wiki/', s_name)))").alias("ids"),
    )

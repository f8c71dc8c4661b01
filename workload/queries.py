"""One registered query per operator or report, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citeloom.functions import nested, predicates, scalars
from citeloom.operators import grouping, joins, keys, ranking
from citeloom.plans import baseline, network, publications, registry, reports, searches, taxonomy
from citeloom.session import discard, new_path, shuffles_dropped, spread, stage, staging, tune
from citeloom.sources import codes, definitions, files
from workload import oracle, star
from workload.star import YEARS, load

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spread(tune(spark)), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _REGISTERED[fn.__name__] = run
    return run


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def _r6(*cs: str) -> list[Column]:
    return [F.round(c, 6).alias(c) for c in cs]


# --- reports --------------------------------------------------------------------------


def _types(spark, d, records=None):
    return reports.report_document_types({"records": records or star.records(spark, d)}, YEARS)


@query
def report_document_types(spark, d):
    return _types(spark, d)["table"].select(
        "publication_type", *_r6("share_records"), "nb_records", "avg_nb_authors", "median_nb_authors"
    )


@query
def report_document_types_headings(spark, d):
    """The top list under the headings readers see."""
    top = _types(spark, d)["top"].withColumn("share_records", F.round("share_records", 6))
    return reports.with_headings(top, "document_types")


def _sources(spark, d, records=None):
    tables = {"records": records or star.records(spark, d), "source": star.source(spark, d)}
    return reports.report_sources(tables, YEARS)


@query
def report_sources(spark, d):
    return _sources(spark, d)["table"].select(
        "title", "share_records", "nb_records", "avg_year", "avg_nb_authors", "median_nb_authors"
    )


@query
def report_sources_top(spark, d):
    return _sources(spark, d)["top"].select("title", "nb_records")


def _years(spark, d, records=None):
    return reports.report_years({"records": records or star.records(spark, d)}, YEARS)


@query
def report_years(spark, d):
    return _years(spark, d)["table"].select("year_published", "nb_records", "avg_nb_authors", "median_nb_authors")


@query
def trend_line(spark, d):
    return _years(spark, d)["trend"].select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


def _countries(spark, d, records=None):
    tables = {
        "records": records or star.records(spark, d),
        "contribution": star.contribution(spark, d),
        "affiliation": star.affiliation(spark, d).select("contribution_id", "org_id"),
        "organisations": star.organisations(spark, d),
        "countries": star.countries(spark, d),
    }
    return reports.report_countries(tables, YEARS)


@query
def report_countries(spark, d):
    """Every country of the records under the map's names, also those that are not on the map, and the unknown one."""
    return _countries(spark, d)["whole"].select(
        "country_code", "country", "nb_records", "avg_nb_authors", "median_nb_authors", "avg_year", *_r6("share_records")
    )


@query
def report_countries_all(spark, d):
    """All countries, also those that are not on the map, and the unknown one."""
    return _countries(spark, d)["all"].select(
        "country_code", "country", "nb_records", "avg_nb_authors", "median_nb_authors", "avg_year", *_r6("share_records")
    )


@query
def report_sources_position(spark, d):
    """The place of every source in the order of the report."""
    return ranking.with_position(_sources(spark, d)["table"].select("title", "nb_records"), ["nb_records"], ["title"])


@query
def report_countries_position(spark, d):
    table = _countries(spark, d)["table"].select("country", "country_code", "nb_records")
    return ranking.with_position(table, ["nb_records"], ["country", "country_code"]).select("country", "nb_records", "position")


@query
def report_sources_headings(spark, d):
    return reports.with_headings(_sources(spark, d)["table"], "sources")


@query
def report_years_headings(spark, d):
    return reports.with_headings(_years(spark, d)["table"], "years")


@query
def report_countries_headings(spark, d):
    return reports.with_headings(_countries(spark, d)["table"], "countries")


@query
def report_funders_headings(spark, d):
    return reports.with_headings(_funders(spark, d)[0]["table"], "funders")


@query
def report_domains_disciplines_headings(spark, d):
    return reports.with_headings(_domains(spark, d)["table"], "domains_disciplines")


@query
def report_collaborations_headings(spark, d):
    return reports.with_headings(reports.report_collaborations(star.network(spark, d), limit=1.0)["table"], "collaborations")


@query
def bin_values(spark, d):
    """Legend bins of the country map."""
    return _countries(spark, d)["map"].select("country_code", "nb_records", F.col("bin").cast("long").alias("bin"))


def _funders(spark, d, records=None):
    tables = {"records": records or star.records(spark, d), "funding": star.funding(spark, d)}
    return reports.report_funders(tables), tables


@query
def report_funders(spark, d):
    return _funders(spark, d)[0]["table"].select(
        "org", "country", "nb_projects", "nb_records", "share_projects", "share_records",
        "avg_nb_authors", "median_nb_authors", "avg_year",
    )


@query
def report_funders_top(spark, d):
    return _funders(spark, d)[0]["top"].select("org", "country", "nb_projects")


@query
def funded_records(spark, d):
    return _funders(spark, d)[0]["funded"].select(*_r6("subtotal"))


@query
def report_fund_recipients(spark, d):
    tables = {"records": star.records(spark, d), "funding": star.funding(spark, d)}
    return reports.report_fund_recipients(tables)["table"].select(
        "org", "country", "nb_projects", *_r6("nb_records", "share_projects", "share_records"), "avg_nb_authors",
        "median_nb_authors", "avg_year",
    )


@query
def report_fund_recipients_top(spark, d):
    """The older form's largest funders, with their countries as they are."""
    tables = {"records": star.records(spark, d), "funding": star.funding(spark, d)}
    return reports.report_fund_recipients(tables)["top"].select("org", "country", "nb_projects")


def _domains(spark, d):
    tables = {
        "records": star.record_facts(spark, d),
        "categories": star.linked_categories(spark, d),
    }
    return reports.report_domains_disciplines(tables, YEARS, marker="N")


@query
def report_domains_disciplines(spark, d):
    return _domains(spark, d)["table"]


@query
def domain_discipline_ranks(spark, d):
    return _domains(spark, d)["data"].select(
        "parent_0", "parent_1", *_r6("nb_1", "nb_0", "percentile_0", "percentile_1")
    )


@query
def flow_domain_discipline_shown(spark, d):
    """Weights of the flows of the disciplines that the report shows."""
    return _domains(spark, d)["flows"].select("display_name_0", "display_name_1", *_r6("weight"))


@query
def flow_domain_discipline(spark, d):
    """Weights of all domain to discipline flows."""
    records = predicates.filter_year_range(star.record_facts(spark, d), "year_published", YEARS)
    data = star.linked_categories(spark, d).join(records.select("lens_id"), "lens_id", "left_semi")
    return reports.flow_domain_discipline(reports.discipline_counts(data, "N")).select(
        "display_name_0", "display_name_1", *_r6("weight")
    )


@query
def domain_match_classes(spark, d):
    return _domains(spark, d)["stats"].select("distance_type", *_r6("nb_orgs"))


@query
def report_heroes(spark, d):
    """The headline figure of each grouped report; the records with their team sizes are made once for all."""
    records = stage(star.records(spark, d), "records")
    heroes = {
        "document_types": _types(spark, d, records)["hero"],
        "sources": _sources(spark, d, records)["hero"],
        "years": _years(spark, d, records)["hero"],
        "countries": _countries(spark, d, records)["hero"],
        "funders": _funders(spark, d, records)[0]["hero"],
        "domains_disciplines": _domains(spark, d)["hero"],
    }
    return joins.union_all(*[df.select(F.lit(name).alias("report"), "hero") for name, df in heroes.items()])


@query
def report_heroes_more(spark, d):
    """Headline figures of the remaining reports, and the totals that the domain report shows beside its own.

    The team sizes are counted once, for the records and for the bound of the network.
    """
    sizes = stage(star.team_records(spark, d), "sizes")
    funding = {"records": star.records(spark, d, sizes), "funding": star.funding(spark, d)}
    net, domains = star.network(spark, d, sizes), _domains(spark, d)
    heroes = {
        "fund_recipients": reports.report_fund_recipients(funding)["hero"],
        "collaborations": reports.report_collaborations(net, limit=1.0)["hero"],
        "collaboration_map": reports.report_collaboration_map(net, limit=1.0)["hero"],
        "domains_shown": domains["shown"],
        "domains_total": domains["total"],
    }
    return joins.union_all(*[df.toDF("hero").select(F.lit(name).alias("report"), "hero") for name, df in heroes.items()])


@query
def report_collaborations(spark, d):
    return reports.report_collaborations(star.network(spark, d), limit=1.0)["table"].select(
        "from", "to", "name_1", "name_2", "weight", "nb_records_1", "nb_records_2"
    )


@query
def report_collaboration_map(spark, d):
    """Countries of the located organisations in external collaborations."""
    return reports.report_collaboration_map(star.network(spark, d), limit=1.0)["countries"].select(
        "country_code", "nb_org", F.col("bin").cast("long").alias("bin"), "label"
    )


@query
def collaboration_map_markers(spark, d):
    return reports.report_collaboration_map(star.network(spark, d), limit=1.0)["markers"].select(
        "org_id", "researchers", "inventors", "projects", "label"
    )


@query
def collaboration_map_popups(spark, d):
    """What a click on an organisation shows."""
    return reports.report_collaboration_map(star.network(spark, d), limit=1.0)["markers"].select("org_id", "popup")


@query
def report_collaboration_map_simple(spark, d):
    return reports.report_collaboration_map_simple(star.network(spark, d), limit=1.0)["markers"].select("org_id", "label")


@query
def map_distance_classes(spark, d):
    return reports.report_collaboration_map(star.network(spark, d), limit=1.0)["stats"].select("distance_type", *_r6("nb_orgs"))


@query
def graph_vertices(spark, d):
    net = star.network(spark, d)
    return network.graph_vertices(net["net_org_nodes"], net["net_org_edges"])


@query
def graph_edges(spark, d):
    return network.graph_edges(star.network(spark, d)["net_org_edges"]).select(
        "from", "to", *_r6("width", "min_width", "max_width")
    )


# --- network --------------------------------------------------------------------------


@query
def collaboration_edges(spark, d):
    edges = network.collaboration_edges(star.team_lines(spark, d), star.team_records(spark, d), star.MAX_TEAM_SIZE)
    return edges.select("from", "to", "is_ext", *_r6("weight"))


@query
def collaboration_bounded(spark, d):
    """The network with a bound on the team size that leaves many records out."""
    edges = network.collaboration_edges(star.team_lines(spark, d), star.team_records(spark, d), 3)
    return edges.select("from", "to", "is_ext", *_r6("weight"))


@query
def collaboration_left_out(spark, d):
    return network.left_out(star.team_records(spark, d), 3)


@query
def collaboration_nodes(spark, d):
    lines, records = star.team_lines(spark, d), star.team_records(spark, d)
    _, nodes = network.collaboration_network(lines, records, star.organisations(spark, d), star.MAX_TEAM_SIZE)
    return nodes.select("org_id", *_r6("nb_contributions"), "nb_records", "name", "country_code")


SPANS = [(1995, 1997), (1997, 2000)]


def _intervals(spark, d):
    lines, records = star.team_lines(spark, d), star.records(spark, d)
    return network.collaboration_intervals(lines, records, star.organisations(spark, d), SPANS, 25, star.MAX_TEAM_SIZE)


@query
def collaboration_intervals(spark, d):
    """Edges among the 25 largest organisations of each of two spans of years that share a year."""
    return _intervals(spark, d)[0].select(
        F.col("first_year").cast("long").alias("first_year"), F.col("last_year").cast("long").alias("last_year"),
        "from", "to", "is_ext", *_r6("weight"),
    )


@query
def collaboration_interval_nodes(spark, d):
    return _intervals(spark, d)[1].select(
        F.col("first_year").cast("long").alias("first_year"), F.col("last_year").cast("long").alias("last_year"),
        F.col("position").cast("long").alias("position"), "org_id", *_r6("nb_contributions"), "nb_records", "name", "country_code",
    )


@query
def collaboration_lines(spark, d):
    """External collaborations with the coordinates of both ends; some organisations have two places."""
    edges = network.collaboration_edges(star.team_lines(spark, d), star.team_records(spark, d), star.MAX_TEAM_SIZE)
    return network.edge_lines(edges.where("is_ext"), star.places(spark, d)).select(
        "from", "to", *_r6("weight"), "lat_1", "lng_1", "lat_2", "lng_2"
    )


@query
def collaboration_by_country(spark, d):
    lines = star.team_lines(spark, d).join(star.organisations(spark, d).select("org_id", "country_code"), "org_id")
    return network.collaboration_edges(lines, star.team_records(spark, d), star.MAX_TEAM_SIZE, level="country_code").select("from", "to", "is_ext", *_r6("weight"))


@query
def collaboration_sample(spark, d):
    """The network over a repeatable sample of records."""
    edges = network.collaboration_edges(star.team_lines(spark, d), star.team_records(spark, d), star.MAX_TEAM_SIZE, sample=1000)
    return edges.select("from", "to", "is_ext", *_r6("weight"))


@query
def top_pairs_unweighted(spark, d):
    return network.top_pairs_unweighted(star.team_lines(spark, d), star.team_records(spark, d), 30, star.MAX_TEAM_SIZE)


# --- taxonomy -------------------------------------------------------------------------


@query
def resolve_hierarchy(spark, d):
    """Four levels, the last with many parents per node."""
    return star.hierarchy(spark, d, deep=True)


@query
def discipline_labels(spark, d):
    return taxonomy.discipline_labels(star.hierarchy(spark, d, deep=True))


@query
def resolve_hierarchy_any_level(spark, d):
    """Parts on a level above the taxonomy's last one, and one region without a level."""
    nodes = star.taxonomy_nodes(spark, d, deep=True)
    level = F.when(F.col("category_id") == "R1", F.lit(None)).when(F.col("level") == 3, F.lit(6)).otherwise(F.col("level"))
    nodes = nodes.withColumn("level", level.cast("long"))
    return taxonomy.resolve_hierarchy(nodes, star.taxonomy_edges(spark, d, deep=True))


def _topic_tables(spark, d):
    return taxonomy.build_taxonomy_nodes(star.topics(spark, d))


@query
def build_taxonomy_nodes(spark, d):
    return _topic_tables(spark, d)["nodes"].select(
        "category_id", F.col("level").cast("long").alias("level"), "display_name", "wikidata", "wikipedia",
        "domain_id", "field_id", "subfield_id",
    )


@query
def taxonomy_parent_edges(spark, d):
    return _topic_tables(spark, d)["parents"].select("category_id", "parent", "nb_children")


@query
def taxonomy_sibling_edges(spark, d):
    return _topic_tables(spark, d)["siblings"].select("category_id", "sibling", F.col("nb_siblings").cast("long").alias("nb_siblings"))


@query
def resolve_topic_hierarchy(spark, d):
    tables = _topic_tables(spark, d)
    resolved = taxonomy.resolve_topic_hierarchy(tables["nodes"], tables["parents"])
    return resolved.withColumn("level", F.col("level").cast("long"))


@query
def build_concept_edges(spark, d):
    tables = taxonomy.build_concept_edges(star.concepts(spark, d))
    parents = tables["parents"].select("category_id", F.col("parent").alias("other"), F.lit("parent").alias("kind"), F.col("nb_parents").alias("nb"))
    siblings = tables["siblings"].select("category_id", F.col("sibling").alias("other"), F.lit("sibling").alias("kind"), F.col("nb_siblings").alias("nb"))
    return joins.union_all(parents, siblings).withColumn("nb", F.col("nb").cast("long"))


@query
def link_categories(spark, d):
    return star.linked_categories(spark, d).select("lens_id", "raw_display_name", "category_id", "parent_1", "parent_0", "is_not_linked")


def _shared_topics(spark, d):
    tables = taxonomy.build_taxonomy_nodes(star.topics(spark, d, shared_labels=True))
    resolved = taxonomy.resolve_topic_hierarchy(tables["nodes"], tables["parents"])
    return stage(resolved.withColumn("level", F.col("level").cast("long")), "topics")


@query
def link_topics(spark, d):
    """Labels of records in the four-level taxonomy; some labels stand on two levels."""
    cats = taxonomy.fields_of_study(publications.build_categories(star.publications(spark, d)), "lens_id")
    return taxonomy.link_topics(cats, _shared_topics(spark, d), "lens_id").select(
        "lens_id", "display_name", "category_id", "level", "parent_2", "parent_1", "parent_0", "is_not_linked"
    )


@query
def join_taxonomy_crosswalk(spark, d):
    a = load(spark, d, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("category_id"),
        F.when(F.col("s_acctbal") >= 0, scalars.strip_prefix("s_name", "Supplier#")).alias("wikipedia"),
        F.col("s_suppkey").cast("string").alias("wikidata"),
    )
    b = load(spark, d, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("category_id"),
        scalars.strip_prefix("c_name", "Customer#").alias("wikipedia"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")).alias("wikidata"),
    )
    return joins.join_taxonomy_crosswalk(a, b, "category_id", ["wikipedia", "wikidata"])


# --- citation baselines and document types --------------------------------------------


@query
def unify_document_type(spark, d):
    typed = codes.unify_document_type(star.record_facts(spark, d), codes.type_thesaurus(spark, star.TYPE_GROUPS), "publication_type")
    return typed.select("lens_id", "publication_type", "pubtype_id")


def _baseline_input(spark, d):
    return star.typed_records(spark, d), star.linked_categories(spark, d).select("lens_id", "parent_1")


@query
def citation_baseline(spark, d):
    return baseline.citation_baseline(*_baseline_input(spark, d), YEARS).withColumn("avg_citations", F.round("avg_citations", 6))


@query
def citation_distribution(spark, d):
    return baseline.citation_distribution(*_baseline_input(spark, d), YEARS)


@query
def normalised_impact(spark, d):
    return baseline.normalised_impact(*_baseline_input(spark, d), YEARS).select(
        "lens_id", "parent_1", "pubtype_id", "year", "citations", *_r6("cnci", "percentile"), "is_top10", "is_top01"
    )


@query
def category_type_grid(spark, d):
    """Every discipline with every unified type and the number of its records."""
    disciplines = load(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("parent_1"))
    grid = joins.combine_with_codes(disciplines, list(star.TYPE_GROUPS), "pubtype_id")
    records, categories = _baseline_input(spark, d)
    counts = baseline.discipline_records(records, categories).groupBy("parent_1", "pubtype_id").agg(F.count(F.lit(1)).alias("nb"))
    return grid.join(counts, ["parent_1", "pubtype_id"], "left").select("parent_1", "pubtype_id", F.coalesce("nb", F.lit(0)).alias("nb_records"))


# --- publications ---------------------------------------------------------------------


@query
def records_id(spark, d):
    return publications.build_records_id(star.publications(spark, d))


@query
def source_dimension(spark, d):
    return publications.build_source(star.publications(spark, d))["source"]


@query
def source_issn(spark, d):
    return publications.build_source(star.publications(spark, d))["source_issn"]


@query
def build_records(spark, d):
    pubs = star.publications(spark, d)
    facts = publications.build_records(pubs, publications.build_source(pubs)["source"])
    return facts.withColumn("year_published", F.col("year_published").cast("long")).withColumn("nb_authors", F.col("nb_authors").cast("long"))


@query
def build_categories(spark, d):
    return publications.build_categories(star.publications(spark, d)).select(
        "lens_id", "value", "category_id", "qualifier", "qualifier_id", "type"
    )


@query
def build_funding(spark, d):
    return publications.build_funding(star.publications(spark, d))


def _contributions(spark, d):
    return publications.build_contributions(star.publications(spark, d))


@query
def explode_contributions(spark, d):
    rows = _contributions(spark, d)["contribution"]
    return rows.select(
        "contribution_id", "lens_id", *[F.col(c).cast("long").alias(c) for c in ("author_position", "nb_ids", "nb_affiliations")],
        "first_name", "last_name",
    )


@query
def contributors_id(spark, d):
    return _contributions(spark, d)["contributors_id"]


@query
def build_affiliation(spark, d):
    return _contributions(spark, d)["affiliation"]


@query
def build_organisations(spark, d):
    return _contributions(spark, d)["organisations"].withColumn("nb_ids", F.col("nb_ids").cast("long"))


@query
def organisations_id(spark, d):
    return _contributions(spark, d)["organisations_id"]


@query
def registry_match(spark, d):
    """Places of organisations found through an active registry entry."""
    tables = registry.registry_tables(star.registry(spark, d))
    return publications.build_locations(_contributions(spark, d)["organisations_id"], tables)


#: Documents in a file of JSON lines. A gzip part is read by one task, so a part stays small.
DOCUMENTS_PER_FILE = 16_384


def publication_tables(spark, d):
    """All project tables, made from documents that were written as JSON lines."""
    path = new_path(spark, "json")
    pubs = star.publications(spark, d)
    pubs.write.option("compression", "gzip").option("maxRecordsPerFile", DOCUMENTS_PER_FILE).json(path)
    tables = publications.build_publication_tables(
        files.scan_nested_json(spark, path, pubs.schema), registry.registry_tables(star.registry(spark, d)),
        concepts=stage(star.hierarchy(spark, d), "hierarchy"), topics=_shared_topics(spark, d), max_team_size=star.MAX_TEAM_SIZE,
    ).land()
    discard(spark, path)
    return tables


@query
def build_publication_tables(spark, d):
    """Per project table its number of rows and a sum of row digests, whatever their order.

    The tables are summed up one after the other, so that the disk holds the shuffles of one and the steps still needed.
    """
    def summary(name: str, table: DataFrame) -> DataFrame:
        text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in oracle.PUBLICATION_DIGESTS[name]])
        digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
        rows = table.agg(F.count(F.lit(1)).alias("nb_rows"), F.sum(digest).alias("digest"))
        return rows.select(F.lit(name).alias("name"), "nb_rows", "digest")

    with staging(spark), shuffles_dropped(spark):
        tables = publication_tables(spark, d)
        return joins.union_all(*[stage(summary(*each), "summary", outlives=True) for each in tables.in_turn()])


# --- registry -------------------------------------------------------------------------


def _registry(spark, d):
    return registry.registry_tables(star.registry(spark, d))


@query
def registry_main(spark, d):
    table = _registry(spark, d)["ror"]
    return table.select(*[F.col(c).cast("long").alias(c) if c in ("established", "nb_types", "nb_relationships") else c for c in table.columns])


@query
def registry_names(spark, d):
    return _registry(spark, d)["ror_names"]


@query
def registry_external_ids(spark, d):
    return _registry(spark, d)["ror_external_id"]


@query
def registry_locations(spark, d):
    tables = _registry(spark, d)
    return tables["ror_location"].join(tables["ror_location_id"], "geonames_id")


@query
def registry_domains(spark, d):
    return _registry(spark, d)["ror_domains"]


@query
def registry_relationships(spark, d):
    return _registry(spark, d)["ror_relationships"]


# --- searches and predicates ----------------------------------------------------------

TOPICS = ["click", "error", "purchase", "signup", "view"]


@query
def merge_searches(spark, d):
    events = load(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return searches.merge_stacked(events, "user_id", "event_type", "value", TOPICS, "event_id")


@query
def merge_searches_minimum(spark, d):
    """Only records whose best score reaches a minimum."""
    events = load(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return searches.merge_stacked(events, "user_id", "event_type", "value", TOPICS, "event_id", minimum=MINIMUM_SCORE)


@query
def dedupe_keep_best(spark, d):
    """One document per text: the longest, ties to the smallest id."""
    documents = load(spark, d, "documents").select("doc_id", "n_chars", "lang", F.sha2("text", 256).alias("digest"))
    return grouping.dedupe_keep_best(documents, ["digest"], "n_chars", ["doc_id"])


MINIMUM_SCORE = 150.0

SEARCH = {
    "bool": {
        "should": [
            {"match": {"publication_type": "1-URGENT"}},
            {"term": {"authors.affiliations.country_code": "N3"}},
            {"bool": {"must": [{"match": {"is_retracted": True}}, {"range": {"scholarly_citations_count": {"gte": "100", "lte": "200"}}}]}},
        ]
    }
}


@query
def bool_predicate(spark, d):
    pubs = star.publications(spark, d)
    shared = [{"term": {"external_ids.type": "doi"}}]
    found = predicates.combine_query_params(pubs.schema, SEARCH, shared, "year_published", YEARS)
    return pubs.where(found).select("lens_id", F.col("year_published").cast("long").alias("year_published"))


FULL_SEARCH = {
    "bool": {
        "filter": {"range": {"scholarly_citations_count": {"gt": "20", "lt": "200"}}},
        "must_not": [{"match": {"publication_type": "1-URGENT"}}, {"term": {"authors.affiliations.country_code": "N3"}}],
    },
    "range": {"scholarly_citations_count": {"gte": "30", "lte": "190"}},
}


@query
def bool_predicate_full(spark, d):
    """Exclusions, open bounds and several clauses in one definition."""
    pubs = star.publications(spark, d)
    found = predicates.bool_predicate(FULL_SEARCH, pubs.schema)
    return pubs.where(found).select("lens_id", F.col("year_published").cast("long").alias("year_published"))


@query
def filter_in_list(spark, d):
    kept = predicates.filter_in_list(load(spark, d, "part"), "p_type", ["PROMO", "ECONOMY"], negate=True)
    kept = predicates.filter_contains(kept, "p_name", "ring")
    masked = predicates.mask_when(kept, "p_brand", F.col("p_size") > 40, "large")
    return predicates.project_rename(masked, {"p_partkey": "part_id", "p_name": "label", "p_brand": "brand"})


@query
def sample_keys(spark, d):
    return grouping.sample_keys(star.team_lines(spark, d), "lens_id", 500, seed=7)


# --- grouping, windows, keys ----------------------------------------------------------


@query
def date_histogram(spark, d):
    facts = star.record_facts(spark, d)
    return grouping.date_histogram(facts, "date_published", "citations", ["publication_type"]).withColumn("avg_value", F.round("avg_value", 6))


@query
def date_histogram_days(spark, d):
    events = load(spark, d, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return grouping.date_histogram(events, "ts", "cents", ["event_type"], grain="day").withColumn("avg_value", F.round("avg_value", 6))


@query
def global_agg(spark, d):
    return grouping.global_agg(star.record_facts(spark, d), "year_published", "citations")


@query
def terms_agg(spark, d):
    """The first 50 source names with the number of their records."""
    orders = load(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    cities = load(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("city"))
    return grouping.terms_agg(orders.join(cities, "custkey"), "city", 50)


@query
def nested_agg(spark, d):
    """Per year its figures and the first sources in name order."""
    facts = star.record_facts(spark, d).join(star.source(spark, d), "source_id")
    metrics = [F.round(F.avg("citations"), 6).alias("avg_citations"), F.max("citations").alias("max_citations")]
    return grouping.nested_agg(facts, "year_published", "title", 50, metrics).withColumn("position", F.col("position").cast("long"))


@query
def fractional_count(spark, d):
    return grouping.fractional_count(star.team_lines(spark, d), "lens_id", ["org_id"]).select("org_id", *_r6("nb_records"))


@query
def distinct_counts_per_record(spark, d):
    """Number of organisations and rows of the record next to every distinct line."""
    lines = star.team_lines(spark, d).distinct()
    return grouping.distinct_count_per(lines, ["lens_id"], "org_id", "nb_orgs")


@query
def count_distinct_pair(spark, d):
    return grouping.count_distinct_pair(star.funding(spark, d), "funding_id", "org")


@query
def two_level_totals(spark, d):
    leaves = stage(star.funding(spark, d).groupBy("country", "org").agg(F.count(F.lit(1)).alias("n")), "leaves")
    return grouping.two_level_totals(leaves.where(F.col("country").isNotNull()), ["country"], ["org"], "n", "nb_1", "nb_0")


@query
def window_normalise(spark, d):
    rows = load(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("weight"))
    return ranking.window_normalise(rows, ["l_orderkey"], "weight").select("l_orderkey", "l_suppkey", *_r6("weight"))


@query
def percent_rank_groups(spark, d):
    totals = stage(load(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("total")), "totals")
    ranked = ranking.percent_rank_within(totals, [], "total", "percentile")
    return ranked.select("l_partkey", "total", *_r6("percentile"))


@query
def top_percentile(spark, d):
    totals = stage(load(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("total")), "totals")
    ranked = ranking.percent_rank_within(totals, [], "total", "percentile")
    return ranking.top_percentile(ranked, {"percentile": 0.95}).select("l_partkey", "total")


@query
def surrogate_key(spark, d):
    """Dense ids of (part, supplier) pairs, fetched back by a two-column join."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    pairs = keys.surrogate_key(lines, ["l_partkey", "l_suppkey"], "pair_id")
    return keys.join_left_composite(lines, pairs, ["l_partkey", "l_suppkey"], "pair_id")


@query
def pivot_type_to_column(spark, d):
    """First value of three event types per user, in time order."""
    return nested.pivot_type_to_column(
        load(spark, d, "events"), "user_id", "event_type", "value",
        {"click": "first_click", "purchase": "first_purchase", "absent": "first_absent"}, "event_id",
    )


@query
def year_spine(spark, d):
    """Records per year over an unbroken list of years."""
    bounds = load(spark, d, "orders").agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    years = bounds.select(F.explode(scalars.year_range(F.col("lo") - 1, F.col("hi") + 1)).alias("y"))
    spine = years.select(F.col("y").cast("long").alias("year_published"))
    counts = star.record_facts(spark, d).groupBy("year_published").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "year_published", "left").select("year_published", F.coalesce("n", F.lit(0)).alias("nb_records"))


# --- scalars and nested values --------------------------------------------------------


@query
def format_labels(spark, d):
    money = F.col("s_acctbal")
    return load(spark, d, "supplier").select(
        "s_suppkey",
        scalars.replace_in_string("s_name", "Supplier#", "S-").alias("code"),
        scalars.format_thousands(money).alias("balance"),
        F.ceil(money / 10).cast("long").alias("tens"),
        scalars.round_after_fetch(F.col("s_suppkey") / 2).alias("half_even"),
        scalars.round_in_query(F.col("s_suppkey") / 2).alias("half_up"),
        scalars.label_text("<strong>%s</strong><br/>%s records", "s_name", scalars.format_thousands("s_suppkey")).alias("label"),
        scalars.n_choose_2("s_nationkey").alias("pairs"),
        scalars.if_null_then(F.expr("cast(nullif(s_nationkey, 1) as string)"), "s_name", "Unknown").alias("nation"),
        *scalars.scaled_estimates("s_acctbal", {"fifth": 5.0, "twentieth": 20.0}),
    )


@query
def array_filter_map(spark, d):
    """Places of an embedding whose rounded value equals the label less one."""
    rows = load(spark, d, "embeddings").select(
        "vec_id", (F.col("label") % 3).alias("level"),
        F.transform(
            "embedding",
            lambda x, i: F.struct(i.cast("string").alias("id"), F.floor(x.cast("double") * 10).cast("int").alias("level")),
        ).alias("ancestors"),
    )
    ids = nested.array_filter_map("ancestors", "level", -1)
    return rows.select("vec_id", nested.array_length(ids).cast("long").alias("nb"), nested.array_element(ids, 2).alias("second"), F.array_join(ids, ",").alias("ids"))


@query
def flatten_json_props(spark, d):
    return nested.dict_index_to_rows(load(spark, d, "events"), ["event_id"], "props", "bigint", "bucket", "nb")


@query
def static_code_table(spark, d):
    """Topic codes completed by their defaults, with the records that carry them."""
    lookup = load(spark, d, "nation").select(
        F.lit(1).alias("level"), (F.col("n_nationkey") + 1).cast("int").alias("id"), F.col("n_name").alias("topic_label")
    )
    table = codes.topic_codes(lookup)
    customer = load(spark, d, "customer").select(F.lit(1).alias("level"), F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey") + 1).otherwise(0).alias("id"))
    used = customer.groupBy("level", "id").agg(F.count(F.lit(1)).alias("n"))
    return table.join(used, ["level", "id"], "left").select(
        F.col("level").cast("long").alias("level"), F.col("id").cast("long").alias("id"), "topic_label", F.coalesce("n", F.lit(0)).alias("nb_records")
    )


@query
def document_codes(spark, d):
    """Records per document type code, by the fixed table of codes."""
    table = codes.static_code_table(spark, codes.DOCUMENT_TYPE_CODES, codes.DOCUMENT_TYPE_SCHEMA)
    code = F.when(F.col("is_retracted"), "RP").when(F.col("publication_type") == "1-URGENT", "AA").when(F.col("publication_type") == "2-HIGH", "RR").otherwise("OO")
    counts = star.record_facts(spark, d).groupBy(code.alias("doctype_code")).agg(F.count(F.lit(1)).alias("n"))
    return table.join(counts, "doctype_code", "left").select("doctype_code", "doctype", F.coalesce("n", F.lit(0)).alias("nb_records"))


@query
def config_document_types(spark, d):
    """Definition files, one per source, whose thesaurus unifies the types of records."""
    types = load(spark, d, "orders").select("o_orderpriority").distinct()
    code = F.lower(F.substring("o_orderpriority", 3, 2))
    entry = F.format_string('{"publication_type": {"name": "types", "value": {"%s": {"label": "%s", "source_types": ["%s"]}}}}', code, "o_orderpriority", "o_orderpriority")
    text = F.format_string('{"source of %s": {"unification": {"thesaurus": [%s]}, "main": {"notes": [{"x": {"name": "n"}}]}}}', "o_orderpriority", entry)
    path = new_path(spark, "definitions")
    types.select(text.alias("value"), F.md5("o_orderpriority").alias("part")).write.partitionBy("part").text(path)
    thesaurus = definitions.thesaurus_from_config(definitions.flatten_config(spark, path + "/*"))
    typed = codes.unify_document_type(star.record_facts(spark, d), thesaurus, "publication_type")
    return typed.groupBy("pubtype_id", "publication_type").agg(F.count(F.lit(1)).alias("nb_records"))


@query
def flatten_config(spark, d):
    """Definition documents derived from the customers, one per segment and customer."""
    docs = load(spark, d, "customer").select(
        F.format_string(
            '{"%s": {"main": {"topics": [{"topic_%d": {"name": "%s", "value": {"term": {"org": %d}}}}], "note": [{"x": {"name": "n"}}]},'
            ' "unification": {"thesaurus": [{"publication_type": {"name": "types", "value": {"ja": {"label": "J", "source_types": ["a", "b"]}}}}]}}}',
            "c_mktsegment", "c_custkey", "c_name", "c_custkey",
        ).alias("text")
    )
    return definitions.flatten_documents(docs, "text")


# --- files ----------------------------------------------------------------------------


@query
def roundtrip_gzip_json(spark, d):
    """Events written as gzip JSON lines and read back with their schema."""
    events = load(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props")
    path = new_path(spark, "gzip")
    events.write.option("compression", "gzip").json(path)
    return files.scan_gzip_jsonl(spark, path, events.schema)


@query
def roundtrip_manifest(spark, d):
    """Events written as gzip parts, listed in a manifest with another prefix and read by it."""
    events = load(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props")
    path, manifest = new_path(spark, "parts"), new_path(spark, "manifest")
    events.write.option("compression", "gzip").json(path)
    url = F.regexp_replace(F.input_file_name(), "^.*/", "s3://dump/")
    parts = spark.read.schema("event_id bigint").json(path).select(url.alias("url")).distinct()
    entries = parts.agg(F.sort_array(F.collect_list(F.struct("url"))).alias("entries"))
    entries.select(F.to_json(F.struct("entries")).alias("value")).write.text(manifest)
    return files.scan_manifest(spark, manifest, events.schema, {"s3://dump": path})


@query
def roundtrip_nested_json(spark, d):
    """Publication documents written as JSON lines, read back and flattened."""
    path = new_path(spark, "json")
    pubs = star.publications(spark, d)
    pubs.write.json(path)
    return publications.build_records_id(files.scan_nested_json(spark, path, pubs.schema))


@query
def roundtrip_json_dump(spark, d):
    """Registry entries written as JSON arrays, one per line, and read back."""
    entries = star.registry(spark, d)
    path = new_path(spark, "dump")
    entries.select(F.to_json(F.array(F.struct("*"))).alias("value")).write.text(path)
    return files.scan_json_dump(spark, path, entries.schema, multi_line=False).select("id", "status", F.col("established").cast("long").alias("established"))


@query
def roundtrip_json_array(spark, d):
    """Registry entries written as files that are one JSON array each, and read back."""
    entries = star.registry(spark, d)
    path = new_path(spark, "arrays")
    part = F.floor(F.substring("id", 2, 18).cast("bigint") / ENTRIES_PER_FILE).alias("part")
    arrays = entries.groupBy(part).agg(F.to_json(F.collect_list(F.struct(*entries.columns))).alias("value"))
    arrays.write.partitionBy("part").text(path)
    read = files.scan_json_dump(spark, path + "/*", entries.schema)
    return read.select("id", "status", F.col("established").cast("long").alias("established"), nested.array_element("types", 1).alias("type"))


ENTRIES_PER_FILE = 400
EVENTS_PER_PAGE = 40


@query
def scan_paged_first_score(spark, d):
    """Pages of several rows, one search per event type; later pages take the first page's score."""
    events = load(spark, d, "events").select(
        F.col("event_type").alias("search"), F.floor(F.col("event_id") / EVENTS_PER_PAGE).alias("page_number"), "event_id", "user_id", "value"
    )
    own = F.when(F.col("user_id") % 3 != 0, F.col("value")).alias("score")
    pages = events.groupBy("search", "page_number").agg(
        F.max("value").alias("max_score"), F.collect_list(F.struct("event_id", "user_id", own)).alias("data")
    )
    path = new_path(spark, "pages")
    pages.select(F.to_json(F.struct("search", "page_number", "max_score", "data")).alias("value")).write.text(path)
    return files.scan_paged_append(spark, path, "event_id bigint, user_id bigint, score double", "score", first_page=True).drop("page")


@query
def scan_paged_append(spark, d):
    """Result pages (one JSON object per page) appended to one table."""
    events = load(spark, d, "events").select("event_id", "user_id", "event_type", F.expr("nullif(event_type, 'view')").alias("_s"), "value")
    page = events.select(
        F.to_json(
            F.struct(
                F.lit(1000.0).alias("max_score"),
                F.array(F.struct("event_id", "user_id", F.when(F.col("_s").isNotNull(), F.col("value")).alias("score"))).alias("data"),
            )
        ).alias("value")
    )
    path = new_path(spark, "pages")
    page.write.text(path)
    return files.scan_paged_append(spark, path, "event_id bigint, user_id bigint, score double", "score").drop("page")


@query
def roundtrip_table(spark, d):
    """Records stored by year and read back with a filter that prunes folders."""
    path = new_path(spark, "table")
    files.write_table(star.record_facts(spark, d).select("lens_id", "year_published", "citations"), path, ["year_published"])
    read = files.scan_table_filtered(spark, path, F.col("year_published") >= 1998, ["lens_id", "citations", "year_published"])
    return read.withColumn("year_published", F.col("year_published").cast("long"))


@query
def roundtrip_tsv(spark, d):
    """Label counts of one taxonomy level written as tab-separated text and read back."""
    path = new_path(spark, "tsv")
    files.write_tsv(files.label_counts(star.taxonomy_nodes(spark, d), 2), path)
    return spark.read.option("sep", "\t").option("header", True).schema("category_id string, display_name string, nb bigint").csv(path)


@query
def geo_features(spark, d):
    """Nations written as feature collections, read back and joined to their customers."""
    nation = load(spark, d, "nation")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.concat(F.lit("N"), "n_nationkey").alias("ISO_A2"), F.col("n_name").alias("ADMIN")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col("n_nationkey")).alias("coordinates")).alias("geometry"),
    )
    path = new_path(spark, "geo")
    collections = nation.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))).alias("value"))
    collections.write.text(path)
    features = files.scan_geo_features(spark, path, multi_line=False)
    counts = load(spark, d, "customer").groupBy(F.concat(F.lit("N"), "c_nationkey").alias("country_code")).agg(F.count(F.lit(1)).alias("nb"))
    return features.join(counts, "country_code").select("country_code", "admin", "geometry", "nb")

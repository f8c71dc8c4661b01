"""Report queries over the project tables.

A report takes the tables it needs in a dict and returns its data frames: ``table`` (the
report), ``hero`` (its headline figure) and, where the report draws them, ``top``,
``stats`` and others. The grouped result is staged once; everything after it (shares, ranks,
top lists, headline) reads that small table, never the base data again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.functions.predicates import filter_null_any, filter_null_subset, filter_optional_threshold, filter_year_range
from citeloom.functions.scalars import (
    bin_edges, bin_of, format_thousands, if_null_then, label_text, round_after_fetch, round_in_query, scaled_estimates, settled,
)
from citeloom.operators.grouping import filter_flagged, trend_line, weighted_median
from citeloom.operators.joins import join_lookup_code, join_many_to_many, keep_keys_of, union_distinct_keys
from citeloom.operators.ranking import percent_rank_within, share_of_total, sort_desc, top_n, top_n_threshold, top_percentile
from citeloom.session import stage

Tables = Mapping[str, DataFrame]
Report = dict[str, DataFrame]
Years = tuple[int, int] | None

# Divisors of the placeholder figures on the organisation card.
CARD_DIVISORS = {"researchers": 5, "inventors": 20, "projects": 10, "location": 30, "topic": 40, "strength": 50}
# Names and divisors of the placeholder distance classes.
MATCH_CLASSES = {"Exact": 5.0, "Close": 5.0 / 2.0, "Related": 5.0 / 3.0}
DISTANCE_CLASSES = {"local": 5.0, "national": 5.0 / 2.0, "international": 5.0 / 3.0}
# Texts of the map's labels; a click shows the hover label and one line more.
COUNTRY_LABEL = "<strong>%s</strong><br/>%s organisations"
SHORT_LABEL = "<strong>%s</strong><br/>%s records"
CARD_LABEL = (
    "<strong>%s</strong><br/>%s records<br/>%d researchers<br/>%d inventors<br/>%d projects<br/><hr/>"
    "Location: %d<br/>Topic: %d<br/>R&D strength: %d"
)
CLICK_LINE = "<br/>Review Profile"
# Headings of the report tables.
HEADINGS = {
    "document_types": {
        "publication_type": "Document type",
        "share_records": "Share of records (%)",
        "nb_records": "Count of records",
        "avg_nb_authors": "Average number of contributors by document",
        "median_nb_authors": "Median number of contributors by document",
    },
    "sources": {
        "title": "Journal",
        "share_records": "Share of records (%)",
        "nb_records": "Count of records",
        "avg_year": "Average year of publication",
        "avg_nb_authors": "Average number of contributors by document",
        "median_nb_authors": "Median number of contributors by document",
    },
    "years": {
        "year_published": "Year of publication",
        "nb_records": "Count of records",
        "avg_nb_authors": "Average number of contributors by document",
        "median_nb_authors": "Median number of contributors by document",
    },
    "countries": {"country": "Country", "nb_records": "Count of records"},
    "funders": {
        "org": "Funding organisation/institute",
        "nb_projects": "Count of projects",
        "nb_records": "Count of records",
        "share_projects": "Share of projects (%)",
        "share_records": "Share of records (%)",
        "avg_nb_authors": "Average number of contributors",
        "median_nb_authors": "Median number of contributors by document",
        "avg_year": "Average year of publication",
    },
    "domains_disciplines": {
        "display_name_0": "Domain",
        "display_name_1": "Discipline",
        "nb_1": "Count of records by discipline",
        "nb_0": "Count of records by domain",
        "percentile_1": "Percentile of discipline",
        "percentile_0": "Percentile of domain",
    },
    "collaborations": {
        "name_1": "Organisation 1",
        "name_2": "Organisation 2",
        "weight": "Number of collaborations",
        "nb_records_1": "Total count of records by organisation 1",
        "nb_records_2": "Total count of records by organisation 2",
    },
}


def with_headings(table: DataFrame, report: str) -> DataFrame:
    """The report table under the headings shown to readers."""
    return table.select(*[F.col(c).alias(h) for c, h in HEADINGS[report].items()])


def _mean(c: str) -> Column:
    return round_in_query(F.avg(c), 1)


def _median(c: str) -> Column:
    return round_in_query(F.median(c), 1)


def _row_mean(c: str, n: str = "n") -> Column:
    """Mean over the rows behind cells that stand for ``n`` rows each."""
    filled = F.when(F.col(c).isNotNull(), F.col(n))
    return round_in_query(F.sum(F.col(c) * F.col(n)) / F.sum(filled), 1)


def _row_median(c: str, n: str = "n") -> Column:
    return round_in_query(weighted_median(c, n), 1)


def _headline(df: DataFrame, value: Column) -> DataFrame:
    return df.agg(format_thousands(F.coalesce(value, F.lit(0))).alias("hero"))


def _classes(df: DataFrame, total: Column, divisors: Mapping[str, float]) -> DataFrame:
    """One row per placeholder class: the total divided by its divisor."""
    rows = F.array(*[F.struct(F.lit(n).alias("distance_type"), F.lit(d).alias("divisor")) for n, d in divisors.items()])
    return df.agg(total.cast("double").alias("_total")).select("_total", F.explode(rows).alias("r")).select(
        "r.distance_type", (F.col("_total") / F.col("r.divisor")).alias("nb_orgs")
    )


def report_document_types(tables: Tables, years: Years = None, top: int = 10) -> Report:
    """Records per document type with their share and team sizes."""
    grouped = (
        filter_year_range(tables["records"], "year_published", years)
        .groupBy("publication_type")
        .agg(
            F.count(F.lit(1)).alias("nb_records"),
            _mean("nb_authors").alias("avg_nb_authors"),
            _median("nb_authors").alias("median_nb_authors"),
        )
    )
    shares = share_of_total(stage(grouped, "types"), "nb_records", "share_records")
    clean = filter_null_any(shares)
    return {
        "table": sort_desc(clean, ["nb_records"], ["publication_type"]),
        "top": top_n(clean, [F.col("share_records").desc_nulls_last(), F.col("publication_type").asc_nulls_last()], top),
        "hero": _headline(clean, F.max("nb_records")),
    }


def report_sources(tables: Tables, years: Years = None, top: int = 10) -> Report:
    """Records per source title with share, mean year and team sizes."""
    facts = filter_year_range(tables["records"], "year_published", years).select("source_id", "nb_authors", "year_published")
    grouped = (
        facts.join(tables["source"].select("source_id", "title"), "source_id", "left")
        .groupBy("title")
        .agg(
            F.count(F.lit(1)).alias("nb_records"),
            _mean("nb_authors").alias("avg_nb_authors"),
            _median("nb_authors").alias("median_nb_authors"),
            _mean("year_published").alias("avg_year"),
        )
    )
    shares = share_of_total(stage(grouped, "sources"), "nb_records", "share_records")
    clean = filter_null_any(shares).withColumn("share_records", round_after_fetch("share_records", 1))
    return {
        "table": sort_desc(clean, ["nb_records"], ["title"]),
        "top": top_n(clean, [F.col("nb_records").desc_nulls_last(), F.col("title").asc_nulls_last()], top),
        "hero": _headline(clean, F.count_distinct("title")),
    }


def report_years(tables: Tables, years: Years = None) -> Report:
    """Records per year of publication with team sizes, and the trend of the yearly counts."""
    grouped = (
        filter_year_range(tables["records"], "year_published", years)
        .groupBy("year_published")
        .agg(
            F.count(F.lit(1)).alias("nb_records"),
            _mean("nb_authors").alias("avg_nb_authors"),
            _median("nb_authors").alias("median_nb_authors"),
        )
    )
    clean = filter_null_any(stage(grouped, "years"))
    return {
        "table": sort_desc(clean, ["year_published"]),
        "hero": _headline(clean, F.sum("nb_records")),
        "trend": trend_line(clean, "year_published", "nb_records"),
    }


def report_countries(tables: Tables, years: Years = None, top: int = 10) -> Report:
    """Records per country of the affiliated organisations.

    A record counts once in each of its countries. Means and medians are over affiliation
    rows, so a record with many affiliations in a country weighs more. Rows are first
    counted per (country, record), which combines on the map side, and every figure of the
    country follows from those counts.
    """
    records = filter_year_range(tables["records"], "year_published", years).select("lens_id", "nb_authors", "year_published")
    rows = (
        records.join(tables["contribution"].select("lens_id", "contribution_id"), "lens_id", "left")
        .join(tables["affiliation"].select("contribution_id", "org_id"), "contribution_id", "left")
        .join(tables["organisations"].select("org_id", "country_code"), "org_id", "left")
    )
    cells = rows.groupBy("country_code", "lens_id", "nb_authors", "year_published").agg(F.count(F.lit(1)).alias("n"))
    grouped = cells.groupBy("country_code").agg(
        F.count("lens_id").alias("nb_records"),
        _row_mean("nb_authors").alias("avg_nb_authors"),
        _row_median("nb_authors").alias("median_nb_authors"),
        _row_mean("year_published").alias("avg_year"),
    )
    shares = share_of_total(stage(grouped, "countries"), "nb_records", "share_records")
    named = join_lookup_code(filter_null_any(shares), tables["countries"], "country_code", "country_code", "country", {"??": "unknown"})
    # The table shows the countries of the map under their names there.
    on_map = named.drop("country").join(tables["countries"].select("country_code", F.col("admin").alias("country")), "country_code")
    whole = join_lookup_code(filter_null_any(shares), tables["countries"].select("country_code", "admin"), "country_code", "country_code", "admin", {"??": "unknown"})
    most = on_map.agg(F.max("nb_records")).scalar()
    return {
        "table": sort_desc(on_map, ["nb_records"], ["country"]),
        "whole": sort_desc(whole.withColumnRenamed("admin", "country"), ["nb_records"], ["country_code"]),
        "all": sort_desc(named, ["nb_records"], ["country_code"]),
        "top": top_n(named, [F.col("nb_records").desc_nulls_last(), F.col("country_code").asc_nulls_last()], top),
        "hero": _headline(named, F.sum("nb_records")),
        "map": on_map.withColumn("bin", bin_of("nb_records", bin_edges(most, plus_one=False))),
    }


def report_funders(tables: Tables, years: Years = None, minimum: float = 10, n: int = 20) -> Report:
    """Funding organisations: fractional records, distinct projects and their shares.

    A record with several funding lines drops those without an organisation, then counts
    1 in total over the lines left. The year window is optional and off by default.
    """
    records = filter_year_range(tables["records"], "year_published", years).select("lens_id", "nb_authors", "year_published")
    lines = (
        tables["funding"]
        .select("lens_id", "org", if_null_then("funding_id", "org", "Unknown").alias("funding_id"), "country")
        .distinct()
    )
    kept = filter_flagged(records, stage(lines, "lines"), "lens_id", "org")
    # One pass counts the rows per project, per measure, and per pair of project and organisation; all
    # counts are combined on the map side, and every figure of the report follows from them. The
    # different pairs are counted in a row of their own.
    funder, measures = ["org", "country"], ["nb_authors", "year_published"]
    sets = [[*funder, "funding_id"], [*funder, *measures], ["funding_id", "org"]]
    is_pair = (F.grouping("country") == 1).alias("is_pair")
    cells = kept.groupingSets(sets, *funder, "funding_id", *measures).agg(
        F.sum(F.lit(1.0) / F.col("nb_rows")).alias("part"),
        F.count(F.lit(1)).alias("n"),
        (F.grouping("funding_id") == 0).alias("is_project"),
        is_pair,
    )
    cells = cells.withColumns({c: F.when(~F.col("is_pair"), F.col(c)) for c in funder})
    figures = stage(
        cells.groupBy(*funder, "is_pair").agg(
            settled(F.sum(F.when(~F.col("is_project"), F.col("part")))).alias("nb_records"),
            F.count(F.when(F.col("is_project"), F.col("funding_id"))).alias("nb_projects"),
            _row_mean("nb_authors").alias("avg_nb_authors"),
            _row_median("nb_authors").alias("median_nb_authors"),
            _row_mean("year_published").alias("avg_year"),
            F.count(F.lit(1)).alias("_pairs"),
        ),
        "funders",
    )
    grouped = figures.where(~F.col("is_pair")).drop("is_pair", "_pairs")
    shares = share_of_total(grouped, "nb_records", "share_records")
    shares = share_of_total(shares, "nb_projects", "share_projects")
    clean = filter_null_subset(shares, ["org"])
    tie = ["org", "country"]
    finished = clean.select(
        "org", "country", "nb_projects", round_after_fetch("nb_records").alias("nb_records"),
        round_after_fetch("share_projects", 1).alias("share_projects"),
        round_after_fetch("share_records", 1).alias("share_records"),
        "avg_nb_authors", "median_nb_authors", "avg_year",
    )
    funded = shares.agg(F.sum(F.when(F.col("org").isNotNull(), F.col("nb_records"))).alias("subtotal"))
    return {
        "data": clean,
        "table": sort_desc(finished, ["nb_projects"], tie),
        "top": top_n_threshold(clean, "nb_projects", minimum, n, tie).withColumn("country", F.coalesce("country", F.lit("Other"))),
        "hero": _headline(figures.where("is_pair"), F.max("_pairs")),
        "funded": funded,
    }


def report_fund_recipients(tables: Tables, years: Years = None, minimum: float = 10, n: int = 20) -> Report:
    """The older form of the funder report: unrounded table, countries left as they are."""
    report = report_funders(tables, years, minimum, n)
    clean = report["data"]
    return {
        "table": sort_desc(clean, ["nb_projects"], ["org", "country"]),
        "top": top_n_threshold(clean, "nb_projects", minimum, n, ["org", "country"]),
        "hero": report["hero"],
    }


DOMAIN = ["parent_0", "display_name_0"]
DISCIPLINE = ["parent_1", "display_name_1"]


def _discipline_cells(linked: DataFrame, marker: str) -> DataFrame:
    """Per domain and discipline: fractional records (nb_1) and linked records that are first counted there.

    One pass over the rows gathers the different (domain, discipline) pairs of a record; there are at most as
    many as the taxonomy has. Records without any stand in a row of their own (``is_cell`` false).
    """
    known = F.col("category_id").isNotNull() & F.col("parent_1").contains(marker)
    pair = F.struct(*DOMAIN, *DISCIPLINE)
    records = linked.where(F.col("lens_id").isNotNull()).groupBy("lens_id").agg(
        F.collect_set(F.when(known, pair)).alias("pairs"), F.bool_or("is_not_linked").alias("missing")
    )
    rows = records.select("missing", F.size("pairs").alias("k"), F.posexplode_outer("pairs").alias("place", "pair"))
    first = F.coalesce("place", F.lit(0)) == 0
    return rows.groupBy(F.col("pair").isNotNull().alias("is_cell"), *[F.col(f"pair.{c}").alias(c) for c in [*DOMAIN, *DISCIPLINE]]).agg(
        settled(F.sum(F.lit(1.0) / F.greatest("k", F.lit(1)))).alias("nb_1"), F.count_if(first & ~F.col("missing")).alias("nb_linked")
    )


def discipline_counts(linked: DataFrame, marker: str) -> DataFrame:
    """Fractional records (nb_1) per domain and discipline.

    Each record counts 1 over the distinct (domain, discipline) pairs of its linked
    categories. ``marker`` is the letter that ids of real categories hold. A known category
    makes its record a linked one, so ``is_not_linked`` need not be looked at.
    """
    return _discipline_cells(linked, marker).where("is_cell").drop("is_cell", "nb_linked")


def flow_domain_discipline(flows: DataFrame) -> DataFrame:
    """Weight of every domain -> discipline flow of the alluvial chart."""
    return flows.groupBy("display_name_0", "display_name_1").agg(F.sum("nb_1").alias("weight"))


def report_domains_disciplines(tables: Tables, years: Years = None, marker: str = "C") -> Report:
    """Domains and disciplines with fractional counts and percentile ranks at both levels."""
    records = filter_year_range(tables["records"], "year_published", years).select("lens_id")
    data = tables["categories"].join(records, "lens_id", "left_semi")
    cells = stage(_discipline_cells(data, marker), "flows")
    leaves = cells.where("is_cell").drop("is_cell", "nb_linked")
    domains = stage(leaves.groupBy(*DOMAIN).agg(settled(F.sum("nb_1")).alias("nb_0")), "domains")
    disciplines = stage(leaves.groupBy(*DISCIPLINE).agg(settled(F.sum("nb_1")).alias("nb_1_total")), "disciplines")
    ranked = leaves.join(
        percent_rank_within(domains, [], "nb_0", "percentile_0").select("parent_0", "nb_0", "percentile_0"), "parent_0"
    ).join(percent_rank_within(disciplines, [], "nb_1_total", "percentile_1").select("parent_1", "percentile_1"), "parent_1")
    largest = top_percentile(filter_null_any(ranked), {"percentile_1": 0.95, "percentile_0": 0.1})
    linked_total = F.coalesce(F.sum("nb_linked"), F.lit(0))
    table = ranked.select(
        "display_name_0", "display_name_1", round_after_fetch("nb_1").alias("nb_1"), round_after_fetch("nb_0").alias("nb_0"),
        round_after_fetch(F.col("percentile_1") * 100, 1).alias("percentile_1"),
        round_after_fetch(F.col("percentile_0") * 100, 1).alias("percentile_0"),
    )
    return {
        "data": ranked,
        "table": sort_desc(table, ["percentile_1", "percentile_0"], ["display_name_0", "display_name_1"]),
        "top": largest,
        "flows": flow_domain_discipline(largest),
        "hero": _headline(largest, F.count_distinct("parent_1")),
        "shown": largest.agg(format_thousands(F.ceil(F.coalesce(F.sum("nb_1"), F.lit(0.0)))).alias("shown")),
        "total": cells.agg(format_thousands(linked_total).alias("total")),
        "stats": _classes(cells, linked_total, MATCH_CLASSES),
    }


def _external(tables: Tables, limit: float | None) -> tuple[DataFrame, DataFrame]:
    """External edges between located organisations, and those organisations."""
    edges = filter_optional_threshold(tables["net_org_edges"].where("is_ext"), "weight", limit)
    seen = union_distinct_keys(edges)
    places = keep_keys_of(tables["locations"].withColumnRenamed("name", "city"), "org_id", seen, "org_id")
    nodes = places.join(tables["net_org_nodes"].select("org_id", "name", "nb_records", "nb_contributions"), "org_id")
    located = nodes.select("org_id").distinct()
    for end in ("from", "to"):
        edges = keep_keys_of(edges, end, located, "org_id")
    return edges, nodes


def report_collaborations(tables: Tables, limit: float | None = None) -> Report:
    """Pairs of organisations that work together, both named, with their record counts."""
    edges, nodes = _external(tables, limit)
    rounded = edges.select("from", "to", round_after_fetch("weight", 1).alias("weight"))
    table = join_many_to_many(rounded, nodes)
    return {
        "table": sort_desc(table, ["weight"], ["from", "to"]),
        "nodes": nodes,
        "edges": edges,
        "hero": _headline(edges, F.count(F.lit(1))),
    }


def report_collaboration_map(tables: Tables, limit: float | None = None, short_labels: bool = False) -> Report:
    """The collaboration report with organisations per country and the map labels.

    ``tables["countries"]`` lists the countries on the map (country_code, admin). The
    figures on the organisation card are placeholders: record counts over fixed divisors. A marker is
    told apart by its ``org_id``; ``label`` shows on hovering, ``popup`` on a click.
    """
    report = report_collaborations(tables, limit)
    nodes = stage(report["nodes"], "mapnodes")
    counts = nodes.groupBy("country_code").agg(F.count(F.lit(1)).alias("nb_org"))
    countries = stage(counts.join(tables["countries"].select("country_code", "admin"), "country_code"), "mapcountries")
    top = countries.agg(F.max("nb_org")).scalar()
    country_label = label_text(COUNTRY_LABEL, "admin", format_thousands("nb_org"))
    shaded = countries.withColumn("bin", bin_of("nb_org", bin_edges(top))).withColumn("label", country_label)
    short = label_text(SHORT_LABEL, "name", format_thousands("nb_records"))
    card = label_text(CARD_LABEL, "name", format_thousands("nb_records"), *CARD_DIVISORS)
    figured = nodes.select("*", *scaled_estimates("nb_records", CARD_DIVISORS))
    return {
        **report,
        "countries": shaded,
        "markers": figured.withColumn("label", short if short_labels else card).withColumn("popup", F.concat("label", F.lit(CLICK_LINE))),
        "stats": _classes(countries, F.max("nb_org"), DISTANCE_CLASSES),
    }


def report_collaboration_map_simple(tables: Tables, limit: float | None = None) -> Report:
    """The map with short organisation labels."""
    return report_collaboration_map(tables, limit, short_labels=True)

"""Nested publication documents to the relational project tables.

Contribution and affiliation ids are built from the record id and the place in the document
(``P1#2``, ``P1#2#1``), so they need no ordering of the whole table. Only the two small
dimensions, sources and organisations, get dense numbers.

The documents are parsed once: ``build_publication_tables`` lands them as Parquet, and the author
and affiliation lines below them, and every table is made from those when it is asked for. A
table reads the nested columns it needs and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from citeloom.functions.nested import array_length, flatten_nested, posexplode_list, struct_default
from citeloom.functions.predicates import drop_columns
from citeloom.operators.grouping import distinct_on_key
from citeloom.operators.joins import join_composite_id, union_all
from citeloom.operators.keys import join_left_composite, surrogate_key
from citeloom.plans.network import edges_of_teams, gather_teams, nodes_of_teams, records_within, small_teams
from citeloom.plans.taxonomy import fields_of_study, link_categories, link_topics
from citeloom.session import discard, noting, stage

# What stands for a missing source field, country, registry id or name.
OTHER = "other"
NO_CODE = "??"
NO_NAME = "unknown"

DOCUMENT_COLUMNS = [
    "year_published", "is_open_access", "publication_type", "author_count", "scholarly_citations_count",
    "references_resolved_count", "references_count", "patent_citations_count", "external_ids", "source", "fields_of_study",
    "mesh_terms", "authors", "funding",
]
SOURCE_KEY = ["title", "publisher_name", "type", "country"]
ORGANISATION_KEY = ["name", "country_code", "grid_id"]


def build_records_id(pubs: DataFrame, record: str = "lens_id") -> DataFrame:
    """External ids; a record without any keeps one row."""
    return flatten_nested(pubs, [record], "external_ids", outer=True)


def _source_columns(pubs: DataFrame, record: str) -> DataFrame:
    def field(name: str, out: str):
        return F.coalesce(F.col(f"source.{name}"), F.lit(OTHER)).alias(out)

    return pubs.select(
        record, field("title", "title"), field("publisher", "publisher_name"), field("type", "type"),
        field("country", "country"), F.col("source.issn").alias("issn"),
    )


def build_source(pubs: DataFrame, record: str = "lens_id") -> dict[str, DataFrame]:
    """Source dimension and its serial numbers, the latter from the first record of a source."""
    source = surrogate_key(_source_columns(pubs, record), SOURCE_KEY, "source_id")
    return {"source": source, "source_issn": source_issn(pubs, source, record)}


def source_issn(pubs: DataFrame, source: DataFrame, record: str = "lens_id") -> DataFrame:
    """Serial numbers of every source, from the first of its records that has any."""
    columns = _source_columns(pubs, record)
    first = distinct_on_key(columns.where(F.col("issn").isNotNull()), SOURCE_KEY, [record])
    numbered = join_left_composite(first.select(*SOURCE_KEY, "issn"), source, SOURCE_KEY, "source_id")
    return flatten_nested(numbered, ["source_id"], "issn", outer=True)


def build_records(pubs: DataFrame, source: DataFrame, record: str = "lens_id") -> DataFrame:
    """Record facts with the id of their source."""
    facts = pubs.select(
        record, "year_published", "is_open_access", "publication_type", F.col("author_count").alias("nb_authors"),
        "scholarly_citations_count", "references_resolved_count", "references_count", "patent_citations_count",
        *[F.coalesce(F.col(f"source.{name}"), F.lit(OTHER)).alias(out)
          for name, out in (("title", "title"), ("publisher", "publisher_name"), ("type", "type"), ("country", "country"))],
    )
    return drop_columns(join_left_composite(facts, source, SOURCE_KEY, "source_id"), SOURCE_KEY)


def build_record_tables(pubs: DataFrame, record: str = "lens_id") -> Mapping[str, DataFrame]:
    """External ids, sources with their serial numbers, and record facts."""
    return build_publication_tables(pubs, record=record).only("records_id", "source", "source_issn", "records")


def build_categories(pubs: DataFrame, record: str = "lens_id") -> DataFrame:
    """Fields of study and subject headings as one long table, told apart by ``type``."""
    fields = pubs.where(F.col("fields_of_study").isNotNull()).select(
        record, F.explode_outer("fields_of_study").alias("value"), F.lit("fields_of_study").alias("type")
    )
    headings = pubs.where(F.col("mesh_terms").isNotNull()).select(record, F.explode_outer("mesh_terms").alias("m")).select(
        record, F.col("m.mesh_heading").alias("value"), F.col("m.mesh_id").alias("category_id"),
        F.col("m.qualifier_name").alias("qualifier"), F.col("m.qualifier_id").alias("qualifier_id"),
        F.lit("mesh_terms").alias("type"),
    )
    return union_all(fields, headings)


def build_funding(pubs: DataFrame, record: str = "lens_id") -> DataFrame:
    """Funding lines; an unfunded record keeps one row without an organisation."""
    return flatten_nested(pubs, [record], "funding", outer=True)


def author_lines(pubs: DataFrame, record: str = "lens_id") -> DataFrame:
    """One row per author with its place; a record without authors keeps one row."""
    authors = posexplode_list(pubs, [record], "authors", "author_position", "author").withColumn(
        "author_position", F.coalesce("author_position", F.lit(1))
    )
    return authors.select(F.concat_ws("#", record, "author_position").alias("contribution_id"), record, "author_position", "author.*")


def affiliation_lines(authors: DataFrame) -> DataFrame:
    """One row per affiliation of an author, with the organisation as it is written there.

    An author without a list has none; an empty list counts as one unknown affiliation.
    """
    listed = authors.select("contribution_id", "affiliations").where(F.col("affiliations").isNotNull())
    element = listed.schema["affiliations"].dataType.elementType
    filler = {"name": NO_NAME, "name_original": NO_NAME, "country_code": NO_CODE}
    each = posexplode_list(listed, ["contribution_id"], "affiliations", "_place", "a").withColumn(
        "a", struct_default("a", filler, element)
    )
    return each.select(
        F.concat_ws("#", "contribution_id", F.coalesce("_place", F.lit(1))).alias("affiliation_id"),
        "contribution_id", F.col("a.name").alias("name"),
        F.coalesce("a.country_code", F.lit(NO_CODE)).alias("country_code"),
        F.coalesce("a.grid_id", F.lit(NO_CODE)).alias("grid_id"), F.col("a.ids").alias("ids"),
    )


def contributions(authors: DataFrame, record: str = "lens_id") -> DataFrame:
    """Author facts. The affiliations of an author stand in one list, so counting them needs no grouping."""
    return authors.select(
        "contribution_id", record, "author_position", "first_name", "last_name", array_length("ids").alias("nb_ids"),
        F.when(F.col("affiliations").isNotNull(), F.greatest(F.size("affiliations"), F.lit(1))).alias("nb_affiliations"),
    )


def typed_ids(rows: DataFrame, key: str) -> DataFrame:
    """(key, type, value) of the ids of authors or organisations; incomplete ones are left out."""
    return flatten_nested(rows.select(key, "ids"), [key], "ids").select(key, "type", "value").na.drop("any")


def build_contributions(pubs: DataFrame, record: str = "lens_id") -> Mapping[str, DataFrame]:
    """Authors, their ids, their affiliations and the organisations behind them."""
    names = ("contribution", "contributors_id", "affiliation", "organisations", "organisations_id")
    # All of them come from the author lines, so the documents are read once without landing.
    return _tables(lambda t: pubs, record).only(*names)


def build_locations(organisations_id: DataFrame, registry: dict[str, DataFrame]) -> DataFrame:
    """Places of the organisations that an active registry entry identifies."""
    active = registry["ror"].where(F.col("status") == "active").select("id")
    ids = registry["ror_external_id"].select("id", "type", "value").join(active, "id", "left_semi").distinct()
    found = join_composite_id(organisations_id, ids, registry["ror_location"], registry["ror_location_id"])
    return found.select("org_id", "id", "geonames_id", "name", "country_code", "country_name", "lat", "lng")


Builder = Callable[["LazyTables"], DataFrame]


class LazyTables(Mapping[str, DataFrame]):
    """Tables by name, each made when it is first asked for.

    A builder gets the mapping itself, so that tables are made from one another. Names with an
    underscore are steps between and are not listed; ``readers`` has the tables and staged steps that read the files of a step.
    """

    def __init__(self, builders: Mapping[str, Builder], readers: Mapping[str, Sequence[str]] | None = None) -> None:
        self._builders, self._made, self._paths = dict(builders), {}, {}
        self._names = [name for name in self._builders if not name.startswith("_")]
        self._readers = {step: [r for r in listed if r in self._builders] for step, listed in (readers or {}).items()}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            with noting() as self._paths[name]:
                self._made[name] = self._builders[name](self)
        return self._made[name]

    def in_turn(self) -> Iterator[tuple[str, DataFrame]]:
        """The listed tables with their names, each to be read before the next is asked for.

        A step is deleted once all its tables are read and the steps made from it are staged. So
        the disk does not hold all steps together, and the mapping can not be used after.
        """
        read = set()
        for name in self._names:
            yield name, self[name]
            read.add(name)
            for step, readers in self._readers.items():
                tables = [r for r in readers if not r.startswith("_")]
                if step not in self._paths or not read.issuperset(tables):
                    continue
                between = [r for r in readers if r.startswith("_")]
                if tables:
                    for r in between:
                        self[r]
                if all(r in self._made for r in between):
                    for path in self._paths.pop(step):
                        discard(self._made[step].sparkSession, path)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def land(self) -> LazyTables:
        """The same tables, with the documents read: their files may go."""
        self["_documents"]
        return self

    def only(self, *names: str) -> LazyTables:
        """The same tables, of which only some are listed."""
        self._names = list(names)
        return self


#: The tables and staged steps that read the files of a step.
READERS = {
    "_documents": [
        "records_id", "source_issn", "records", "categories", "funding", "categories_concepts", "categories_topics",
        "_sources", "_authors", "_within",
    ],
    "_authors": ["contribution", "contributors_id", "_lines", "_small"],
    "_lines": ["affiliation", "_organisations", "_described"],
    "_within": ["_small"],
    "_small": ["_members"],
    "_members": ["_teams"],
}


def build_publication_tables(
    pubs: DataFrame, registry: Mapping[str, DataFrame] | None = None, record: str = "lens_id",
    concepts: DataFrame | None = None, topics: DataFrame | None = None, max_team_size: int | None = None,
) -> LazyTables:
    """All project tables of a set of publication documents.

    ``registry`` adds the places of organisations, ``concepts`` and ``topics`` (resolved hierarchies) the
    linked categories, ``max_team_size`` the network of the teams up to that size.
    """
    landed = pubs.select(record, *DOCUMENT_COLUMNS)
    return _tables(lambda t: stage(landed, "documents"), record, registry, concepts, topics, max_team_size)


def _tables(
    documents: Builder, record: str, registry: Mapping[str, DataFrame] | None = None, concepts: DataFrame | None = None,
    topics: DataFrame | None = None, max_team_size: int | None = None,
) -> LazyTables:
    builders: dict[str, Builder] = {
        "_documents": documents,
        "_authors": lambda t: stage(author_lines(t["_documents"], record), "authors"),
        "_lines": lambda t: stage(affiliation_lines(t["_authors"]), "affiliations"),
        "_organisations": lambda t: surrogate_key(t["_lines"], ORGANISATION_KEY, "org_id"),
        "_described": lambda t: stage(
            join_left_composite(distinct_on_key(t["_lines"], ORGANISATION_KEY, ["affiliation_id"]), t["_organisations"], ORGANISATION_KEY, "org_id"),
            "organisations",
        ),
        "_sources": lambda t: surrogate_key(_source_columns(t["_documents"], record), SOURCE_KEY, "source_id"),
        "records_id": lambda t: build_records_id(t["_documents"], record),
        "source": lambda t: t["_sources"],
        "source_issn": lambda t: source_issn(t["_documents"], t["_sources"], record),
        "records": lambda t: build_records(t["_documents"], t["_sources"], record),
        "categories": lambda t: build_categories(t["_documents"], record),
        "funding": lambda t: build_funding(t["_documents"], record),
    }
    # Tables of the documents come first, those of authors last, so that steps can go early.
    if concepts is not None:
        builders["categories_concepts"] = lambda t: drop_columns(
            link_categories(fields_of_study(t["categories"], record), concepts, record, "value", "raw_display_name"), ["raw_display_name"]
        )
    if topics is not None:
        builders["categories_topics"] = lambda t: link_topics(fields_of_study(t["categories"], record), topics, record)

    def numbered(t: LazyTables) -> DataFrame:
        lines = join_left_composite(drop_columns(t["_lines"], ["ids"]), t["_organisations"], ORGANISATION_KEY, "org_id")
        return lines.select("affiliation_id", "contribution_id", "org_id")

    builders |= {
        # The network reads the lines too, so their organisations are looked up once for both.
        "affiliation": numbered if max_team_size is None else lambda t: stage(numbered(t), "affiliation"),
        "organisations": lambda t: t["_described"].select("org_id", "name", "country_code", array_length("ids").alias("nb_ids")),
        "organisations_id": lambda t: typed_ids(t["_described"], "org_id"),
    }
    if registry is not None:
        builders["locations"] = lambda t: build_locations(t["organisations_id"], registry)
    builders |= {
        "contribution": lambda t: contributions(t["_authors"], record),
        "contributors_id": lambda t: typed_ids(t["_authors"], "contribution_id"),
    }
    if max_team_size is not None:
        builders |= {
            "_within": lambda t: stage(records_within(t["records"], record, max_team_size), "within"),
            "_small": lambda t: stage(small_teams(t["contribution"].select(record, "contribution_id"), t["_within"], record, None), "small"),
            "_members": lambda t: stage(_team_lines(t["_small"], t["affiliation"]), "lines"),
            "_teams": lambda t: gather_teams(t["_members"], [record], "org_id"),
            "net_org_edges": lambda t: stage(edges_of_teams(t["_teams"], record), "edges"),
            "net_org_nodes": lambda t: nodes_of_teams(t["_teams"], t["net_org_edges"], t["organisations"], record),
        }
    return LazyTables(builders, READERS)


def _team_lines(authors: DataFrame, affiliation: DataFrame) -> DataFrame:
    """Every author of a record with each of the organisations; authors without one keep a row."""
    return authors.join(affiliation.select("contribution_id", "org_id"), "contribution_id", "left")

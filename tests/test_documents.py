"""Nested documents, the registry, and files in every supported layout."""

import glob
import gzip
import json
import os
from collections import Counter

import duckdb
import pytest

from pyspark.sql import functions as F

from citeloom import session
from citeloom.plans import publications, registry, taxonomy
from citeloom.sources import definitions, files, schemas
from tests.conftest import rows
from tests.oracle_check import compare
from workload import oracle, queries

AUTHOR_CASES = [
    {"lens_id": "1", "author_count": 3, "source": {"title": "J", "issn": [{"type": "print", "value": "1"}]},
     "external_ids": [{"type": "doi", "value": "d1"}], "fields_of_study": ["a", "b"], "mesh_terms": [],
     "authors": [
         {"last_name": "x", "ids": [{"type": "orcid", "value": "o1"}, {"type": "magid", "value": None}],
          "affiliations": [{"name": "O", "country_code": "FR", "grid_id": "g1", "ids": [{"type": "ror", "value": "r1"}]},
                           {"name": "P", "country_code": None, "grid_id": None}]},
         {"last_name": "y", "affiliations": []},
         {"last_name": "z"}],
     "funding": [{"org": "F", "funding_id": None, "country": None}]},
    {"lens_id": "2", "authors": [], "external_ids": [], "funding": [], "source": None},
    {"lens_id": "3", "source": {"title": "J", "issn": [{"type": "print", "value": "2"}]}},
]


@pytest.fixture(scope="module")
def pubs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pubs") / "pubs.json"
    path.write_text("\n".join(json.dumps(d) for d in AUTHOR_CASES))
    return files.scan_nested_json(spark, str(path), schemas.PUBLICATION)


def test_contributions(pubs):
    tables = publications.build_contributions(pubs)
    assert rows(tables["contribution"], "contribution_id", "author_position", "nb_ids", "nb_affiliations") == [
        ("1#1", 1, 2, 2), ("1#2", 2, 0, 1), ("1#3", 3, 0, None), ("2#1", 1, 0, None), ("3#1", 1, 0, None)
    ]
    assert rows(tables["organisations"]) == [(0, "O", "FR", 1), (1, "P", "??", 0), (2, "unknown", "??", 0)]
    assert rows(tables["affiliation"]) == [("1#1#1", "1#1", 0), ("1#1#2", "1#1", 1), ("1#2#1", "1#2", 2)]
    assert rows(tables["contributors_id"]) == [("1#1", "orcid", "o1")]
    assert rows(tables["organisations_id"]) == [(0, "ror", "r1")]


def test_record_tables(pubs):
    tables = publications.build_record_tables(pubs)
    assert rows(tables["records_id"]) == [("1", "doi", "d1"), ("2", None, None), ("3", None, None)]
    assert rows(tables["source"], "source_id", "title") == [(0, "J"), (1, "other")]
    assert rows(tables["source_issn"]) == [(0, "print", "1")]
    assert rows(tables["records"], "lens_id", "source_id") == [("1", 0), ("2", 1), ("3", 0)]
    assert rows(publications.build_categories(pubs), "lens_id", "value", "type") == [
        ("1", None, "mesh_terms"), ("1", "a", "fields_of_study"), ("1", "b", "fields_of_study")
    ]
    assert rows(publications.build_funding(pubs), "lens_id", "org") == [("1", "F"), ("2", None), ("3", None)]


REGISTRY = [
    {"id": "r1", "status": "active", "types": ["education", "funder", "other"],
     "names": [{"value": "U", "types": ["acronym"]}, {"value": "Univ", "types": ["label", "ror_display"]}],
     "links": [{"type": "website", "value": "w"}],
     "locations": [{"geonames_id": 7, "geonames_details": {"name": "Paris", "country_code": "FR", "country_name": "France", "lat": 1.0, "lng": 2.0}}],
     "external_ids": [{"type": "ror", "preferred": None, "all": ["r1"]}, {"type": "isni", "preferred": "i", "all": []}],
     "relationships": [{"type": "child", "label": "Lab", "id": "r2"}], "domains": ["u.example"]},
    {"id": "r2", "status": "inactive", "types": [], "names": [], "locations": [], "external_ids": [{"type": "ror", "all": ["r2"]}]},
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("registry") / "dump.json"
    path.write_text(json.dumps(REGISTRY, indent=1))
    return registry.registry_tables(files.scan_json_dump(spark, str(path), schemas.ORGANISATION))


def test_registry_tables(tables):
    assert rows(tables["ror"], "id", "ror_display", "acronym", "website", "nb_types", "nb_relationships", "main_type", "third_type") == [
        ("r1", "Univ", "U", "w", 3, 1, "education", "other"), ("r2", None, None, None, 0, 0, None, None)
    ]
    assert rows(tables["ror_external_id"], "id", "type", "preferred", "value") == [
        ("r1", "isni", "i", None), ("r1", "ror", "r1", "r1"), ("r2", "ror", "r2", "r2")
    ]
    assert rows(tables["ror_location_id"], "geonames_id", "name") == [(7, "Paris")]
    assert rows(tables["ror_relationships"]) == [("r1", "r2", "child", "Lab")]
    assert rows(tables["ror_domains"]) == [("r1", "u.example")]
    assert tables["ror_names"].count() == 3


def test_locations_need_an_active_entry(spark, pubs, tables):
    found = publications.build_publication_tables(pubs, tables)["locations"]
    assert rows(found, "org_id", "id", "geonames_id", "name") == [(0, "r1", 7, "Paris")]
    ids = spark.createDataFrame([(5, "ror", "r2")], "org_id long, type string, value string")
    assert publications.build_locations(ids, tables).count() == 0


def test_broken_lines_are_kept(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('{"a": 1}\n{"a": \n')
    got = rows(files.scan_nested_json(spark, str(path), "a int", keep_corrupt=True))
    assert got == [(None, '{"a": '), (1, None)]


def test_manifest_and_gzip_parts(spark, tmp_path):
    for n in (1, 2):
        with gzip.open(tmp_path / f"part_{n}.gz", "wt") as out:
            out.write(json.dumps({"a": n}) + "\n")
    manifest = tmp_path / "manifest.json"
    manifest.write_text(json.dumps({"entries": [{"url": f"s3://bucket/part_{n}.gz"} for n in (1, 2)]}))
    rewrite = {"s3://bucket": str(tmp_path)}
    assert rows(files.scan_manifest(spark, str(manifest), "a int", rewrite)) == [(1,), (2,)]
    assert rows(files.scan_gzip_jsonl(spark, str(tmp_path), "a int")) == [(1,), (2,)]


def test_pages_keep_their_name_and_score(spark, tmp_path):
    for n, rows_ in ((1, [{"id": 1, "score": 4.0}]), (2, [{"id": 2}, {"id": 3}])):
        (tmp_path / f"page_{n}.json").write_text(json.dumps({"max_score": 9.0, "data": rows_}))
    got = files.scan_paged_append(spark, str(tmp_path), "id long, score double", "score")
    assert rows(got, "id", "score") == [(1, 4.0), (2, 9.0), (3, 9.0)]
    assert {r.page.rsplit("/", 1)[1] for r in got.select("page").collect()} == {"page_1.json", "page_2.json"}


def test_geo_features(spark, tmp_path):
    path = tmp_path / "countries.geojson"
    feature = {"type": "Feature", "properties": {"ISO_A2": "FR", "ADMIN": "France"}, "geometry": {"type": "Point", "coordinates": [1]}}
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}, indent=1))
    (code, name, geometry), = rows(files.scan_geo_features(spark, str(path)))
    assert (code, name) == ("FR", "France") and json.loads(geometry) == feature["geometry"]


def test_definitions(spark, tmp_path):
    (tmp_path / "search.json").write_text(json.dumps({
        "scholarly": {
            "main": {"topics": [{"topic_1": {"name": "one", "value": {"term": {"a": 1}}}}]},
            "agg": {"aggegations": [{"agg_1": {"name": "years", "value": {"x": {}}}}], "notes": []},
            "unification": {"thesaurus": [{"publication_type": {"name": "t", "value": {"ja": {"label": "J", "source_types": ["a"]}}}}]},
        }
    }, indent=1))
    config = definitions.flatten_config(spark, str(tmp_path))
    assert rows(config, "category", "type", "id", "value") == [
        ("agg", "aggregate", "agg_1", '{"x":{}}'), ("main", "topic", "topic_1", '{"term":{"a":1}}'),
        ("unification", "thesaurus", "publication_type", '{"ja":{"label":"J","source_types":["a"]}}'),
    ]
    assert rows(definitions.thesaurus_from_config(config)) == [("ja", "J", ["a"])]


def test_tables_and_tsv(spark, tmp_path):
    df = spark.createDataFrame([("C1", "a", 1), ("C2", "b", 2)], "category_id string, display_name string, level int")
    path = str(tmp_path / "t")
    files.write_table(df, path, ["level"])
    files.write_table(df, path, ["level"])
    assert rows(files.scan_table_filtered(spark, path, "level = 1", ["category_id"])) == [("C1",)]
    files.write_tsv(files.label_counts(df, 1), str(tmp_path / "tsv"))
    text = "".join(p.read_text() for p in (tmp_path / "tsv").glob("*.csv"))
    assert text.splitlines()[0] == "category_id\tdisplay_name\tnb" and "C1\ta\t1" in text


def parses(df):
    """How often a plan reads the JSON documents."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan json" in line and "lens_id" in line for line in plan.splitlines())


def test_documents_are_parsed_once_for_all_tables(spark, tables, tmp_path, monkeypatch):
    path = tmp_path / "pubs.json"
    path.write_text("\n".join(json.dumps(d) for d in AUTHOR_CASES))
    documents = files.scan_nested_json(spark, str(path), schemas.PUBLICATION)
    landed = []

    def noting(df, label="stage"):
        landed.append((label, parses(df)))
        return stage(df, label)

    stage = publications.stage
    monkeypatch.setattr(publications, "stage", noting)
    nodes = spark.createDataFrame([("C1", 0, "a", "a")], "category_id string, level int, display_name string, raw_display_name string")
    edges = spark.createDataFrame([], "category_id string, parent string")
    concepts = taxonomy.resolve_hierarchy(nodes, edges)
    topic = {c: None for c in ("subfield_id", "field_id", "domain_id")}
    topics = taxonomy.resolve_topic_hierarchy(nodes.drop("raw_display_name").select("*", *[F.lit(v).cast("string").alias(c) for c, v in topic.items()]), edges)
    made = publications.build_publication_tables(documents, tables, concepts=concepts, topics=topics, max_team_size=20)
    assert landed == []
    assert rows(made["funding"], "lens_id", "org") == [("1", "F"), ("2", None), ("3", None)]
    assert landed == [("documents", 1)]
    assert {name: parses(made[name]) for name in made} == dict.fromkeys(made, 0)
    labels = [label for label, _ in landed]
    assert all(labels.count(label) == 1 for label in labels) and sum(n for _, n in landed) == 1
    assert len(made) == 16 and set(made) >= {"categories_topics", "categories_concepts", "net_org_edges", "locations"}
    assert rows(made["categories_topics"], "lens_id", "display_name", "category_id", "is_not_linked") == [("1", "a", "C1", False), ("1", "b", None, False)]
    assert rows(made["categories_concepts"], "lens_id", "category_id", "parent_0") == [("1", None, None), ("1", "C1", "C1")]
    # The empty list of the second author stands for one unknown organisation.
    assert rows(made["net_org_edges"], "from", "to", "is_ext") == [(0, 2, True), (1, 2, True)]


def test_network_of_publication_tables(spark, tmp_path):
    def author(*names):
        return {"affiliations": [{"name": n, "country_code": "FR", "grid_id": n} for n in names]}

    cases = [
        {"lens_id": "1", "author_count": 2, "authors": [author("A"), author("B", "C")]},
        {"lens_id": "2", "author_count": 40, "authors": [author("A"), author("C")]},
        {"lens_id": "3", "author_count": 2, "authors": [author("A"), {"affiliations": None}]},
    ]
    path = tmp_path / "pubs.json"
    path.write_text("\n".join(json.dumps(d) for d in cases))
    made = publications.build_publication_tables(files.scan_nested_json(spark, str(path), schemas.PUBLICATION), max_team_size=20)
    assert rows(made["net_org_edges"], "from", "to", "is_ext", "weight") == [(0, 1, True, 0.5), (0, 2, True, 0.5)]
    assert rows(made["net_org_nodes"], "name", "nb_records") == [("A", 2), ("B", 1), ("C", 1)]


def test_later_pages_take_the_first_pages_score(spark, tmp_path):
    pages = {
        "2015/page_1.json": (9.0, [{"id": 1, "score": 4.0}, {"id": 2}]),
        "2015/page_2.json": (3.0, [{"id": 3, "score": 1.0}]),
        "2016/page_1.json": (5.0, [{"id": 4, "score": 5.0}]),
        "2016/page_2.json": (7.0, []),
        "2016/page_3.json": (6.0, [{"id": 5}, {"id": 6, "score": 2.0}]),
    }
    for name, (score, data) in pages.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps({"max_score": score, "data": data}))
    got = files.scan_paged_append(spark, str(tmp_path), "id long, score double", "score", first_page=True)
    assert rows(got, "id", "score") == [(1, 4.0), (2, None), (3, 9.0), (4, 5.0), (5, 5.0), (6, 5.0)]


def test_pages_of_one_file_are_ordered_by_their_number(spark, tmp_path):
    lines = [{"search": s, "page_number": n, "max_score": m, "data": [{"id": i, "score": 0.5}]} for s, n, m, i in (("b", 10, 2.0, 1), ("b", 9, 8.0, 2), ("c", 1, 3.0, 3), ("b", 11, 1.0, 4))]
    (tmp_path / "pages.json").write_text("\n".join(map(json.dumps, lines)))
    got = files.scan_paged_append(spark, str(tmp_path), "id long, score double", "score", first_page=True)
    assert rows(got, "id", "score") == [(1, 8.0), (2, 0.5), (3, 0.5), (4, 8.0)]


def test_organisations_of_affiliations_are_looked_up_once_for_the_network(spark, tmp_path, monkeypatch):
    """The lines that the network reads and the table of affiliations are one staged table."""
    labels = []

    def spy(df, label="stage", *more, make=publications.stage):
        labels.append(label)
        return make(df, label, *more)

    monkeypatch.setattr(publications, "stage", spy)
    path = tmp_path / "pubs.jsonl"
    org = {"name": "A", "country_code": "N1", "grid_id": "g1"}
    path.write_text(json.dumps({"lens_id": "P1", "author_count": 2, "authors": [{"affiliations": [org]}, {"affiliations": [{**org, "name": "B"}]}]}))
    made = publications.build_publication_tables(files.scan_nested_json(spark, str(path), schemas.PUBLICATION), max_team_size=20)
    assert rows(made["affiliation"], "affiliation_id", "contribution_id", "org_id") == [("P1#1#1", "P1#1", 0), ("P1#2#1", "P1#2", 1)]
    assert rows(made["net_org_edges"], "from", "to", "is_ext", "weight") == [(0, 1, True, 1.0)]
    assert labels.count("affiliation") == 1


def folders(spark):
    return os.listdir(session.shared_dir(spark).removeprefix("file:"))


def test_steps_leave_the_disk_once_nothing_reads_them(spark, tables, tmp_path):
    """Tables asked for in turn are those of the mapping, and the steps between do not lie on the disk together."""
    path = tmp_path / "pubs.json"
    org = {"country_code": "FR", "grid_id": None}
    teams = [
        {"lens_id": n, "author_count": size, "authors": [{"affiliations": [{**org, "name": x} for x in names]} for names in authors]}
        for n, size, authors in (("4", 2, ["A", "BC"]), ("5", 40, ["A", "D"]), ("4", 2, ["B", "D"]), (None, 2, ["A", "E"]))
    ]
    path.write_text("\n".join(json.dumps(d) for d in AUTHOR_CASES + teams))
    documents = files.scan_nested_json(spark, str(path), schemas.PUBLICATION)
    nodes = spark.createDataFrame([("C1", 0, "a", "a")], "category_id string, level int, display_name string, raw_display_name string")
    concepts = taxonomy.resolve_hierarchy(nodes, spark.createDataFrame([], "category_id string, parent string"))

    def made():
        return publications.build_publication_tables(documents, tables, concepts=concepts, max_team_size=20)

    with session.staging(spark):
        plain = made()
        expected = {name: Counter(map(str, plain[name].collect())) for name in plain}
    earlier, found, lying = set(folders(spark)), {}, {}
    with session.staging(spark):
        for name, table in made().in_turn():
            lying[name] = {f.split("-")[0] for f in set(folders(spark)) - earlier}
            found[name] = Counter(map(str, table.collect()))
    assert found == expected and len(found) == 15
    assert "documents" in lying["categories_concepts"] and "documents" not in lying["affiliation"]
    assert "affiliations" in lying["affiliation"] and "affiliations" not in lying["contribution"]
    assert "authors" in lying["contributors_id"] and not {"authors", "within"} & lying["net_org_edges"]
    assert {"teams", "edges"} <= lying["net_org_nodes"] and not {"lines", "small", "authors", "documents"} & lying["net_org_nodes"]


def test_a_step_stays_while_a_table_reads_it(spark):
    """Steps made inside other steps keep their files when those go."""
    def step(label, *below):
        return lambda t: session.stage(t[below[0]] if below else spark.range(3), label)

    def table(step):
        return lambda t: t[step].withColumnRenamed("id", "n")

    builders = {"_low": step("low"), "_high": step("high", "_low"), "first": table("_high"), "second": table("_low")}
    made = publications.LazyTables(builders, {"_low": ["second", "_high"], "_high": ["first"]})
    earlier, seen = set(folders(spark)), []
    with session.staging(spark):
        for name, df in made.in_turn():
            seen.append((name, rows(df, "n"), sorted(f.split("-")[0] for f in set(folders(spark)) - earlier)))
        assert set(folders(spark)) == earlier
    numbers = [(0,), (1,), (2,)]
    assert seen == [("first", numbers, ["high", "low"]), ("second", numbers, ["low"])]


STAR_ROWS = {
    "region": "SELECT i::INT AS r_regionkey, 'REGION ' || i AS r_name FROM range(2) r(i)",
    "nation": "SELECT i::INT AS n_nationkey, 'NATION ' || i AS n_name, (i % 2)::INT AS n_regionkey FROM range(5) r(i)",
    "supplier": "SELECT i AS s_suppkey, 'Supplier#' || i AS s_name, (i % 5)::INT AS s_nationkey, 10e0 * i - 20 AS s_acctbal FROM range(7) r(i)",
    "customer": "SELECT i AS c_custkey, 'Customer#' || i AS c_name, (i % 5)::INT AS c_nationkey, 100e0 * i - 300 AS c_acctbal,"
    " ['BUILDING', 'MACHINERY', 'FURNITURE'][i % 3 + 1] AS c_mktsegment FROM range(11) r(i)",
    "orders": "SELECT i AS o_orderkey, i % 11 AS o_custkey, ['O', 'F', 'P'][i % 3 + 1] AS o_orderstatus, 1000e0 * i AS o_totalprice,"
    " TIMESTAMP '1996-01-01' + to_days((i * 17)::INT) AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(300) r(i)",
}


def test_documents_of_the_query_are_packed_and_go_when_they_are_read(spark, tmp_path, monkeypatch):
    """JSON parts are packed and small, and after the call only the sums of the tables lie on the disk."""
    con = duckdb.connect()
    for name, sql in STAR_ROWS.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    parts, steps = [], []

    def watched(spark, path):
        steps.append([f.split("-")[0] for f in set(folders(spark)) - earlier])
        for part in glob.glob(f"{path.removeprefix('file:')}/part-*"):
            with gzip.open(part) as f:
                parts.append((part.endswith(".json.gz"), len(f.readlines())))
        session.discard(spark, path)

    monkeypatch.setattr(queries, "discard", watched)
    monkeypatch.setattr(queries, "DOCUMENTS_PER_FILE", 64)
    earlier = set(folders(spark))
    sums = queries.registered()["build_publication_tables"](spark, str(tmp_path))
    assert sum(n for _, n in parts) == 300 and all(packed and n <= 64 for packed, n in parts)
    assert set(steps[0]) == {"json", "hierarchy", "topics", "documents"}
    left = set(folders(spark)) - earlier
    assert len(left) == 16 and {f.split("-")[0] for f in left} == {"summary"}
    assert compare(sums, con, oracle.statements()["build_publication_tables"]) is None

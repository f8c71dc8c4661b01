"""Reports read their facts once, and show what readers see."""

import datetime

import pytest

from citeloom.operators import grouping
from citeloom.plans import reports
from tests.conftest import rows
from workload import queries, star


@pytest.fixture
def stored(spark, tmp_path):
    def write(name, data, schema):
        path = str(tmp_path / name)
        spark.createDataFrame(data, schema).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture
def reading(monkeypatch):
    """The plans of staged tables, in order."""
    plans = []
    stage = reports.stage

    def noting(df, label="stage"):
        plans.append(plan_of(df))
        return stage(df, label)

    for module in (reports, grouping):
        monkeypatch.setattr(module, "stage", noting)
    return plans


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan, column):
    """How many scans read a column of the stored tables themselves (staged ones lie elsewhere)."""
    return sum("FileScan" in line and "/pytest-" in line and f"{column}:" in line.split("ReadSchema")[-1] for line in plan.splitlines())


FUNDING = [
    (1, "F", "G1", "FR"), (1, None, None, None), (2, "F", None, "FR"), (2, "H", "G2", "DE"), (3, None, "G3", "DE"), (4, "F", "G1", "BE"),
    (5, "H", "G2", "DE"),
]


def test_funders_come_from_one_pass(stored, reading):
    records = stored("records", [(k, 2 * k, 2000 + k) for k in range(1, 8)], "lens_id long, nb_authors long, year_published long")
    funding = stored("funding", FUNDING, "lens_id long, org string, funding_id string, country string")
    report = reports.report_funders({"records": records, "funding": funding}, minimum=1)
    assert [sum(scans(p, column) for p in reading) for column in ("year_published", "funding_id")] == [1, 1]
    assert all(scans(plan_of(df), column) == 0 for df in report.values() for column in ("year_published", "funding_id"))
    # Different (project, organisation) pairs: F G1, F Unknown, H G2, none G3, none none.
    assert rows(report["hero"]) == [("5",)]
    assert rows(report["data"], "org", "country", "nb_projects", "nb_records") == [
        ("F", "BE", 1, 1.0), ("F", "FR", 2, 1.5), ("H", "DE", 1, 1.5)
    ]
    assert rows(report["funded"]) == [(4.0,)]


def test_domains_come_from_one_pass(stored, reading):
    records = stored("records", [(k, 2000) for k in range(1, 6)], "lens_id long, year_published long")
    cell = lambda k, one, zero: (k, f"C{one}{zero}", zero, f"D{zero}", one, f"E{one}", False)
    linked = [cell(1, "C1", "C0"), cell(1, "C1", "C0"), cell(1, "C2", "C0"), cell(2, "C2", "C0"), (3, None, None, None, None, None, True),
              (4, "C9", "C9", "D9", "N/A", None, False), cell(9, "C1", "C0")]
    schema = "lens_id long, category_id string, parent_0 string, display_name_0 string, parent_1 string, display_name_1 string, is_not_linked boolean"
    categories = stored("categories", linked, schema)
    report = reports.report_domains_disciplines({"records": records, "categories": categories})
    assert sum(scans(p, "category_id") for p in reading) == 1
    assert all(scans(plan_of(df), "category_id") == 0 for df in report.values())
    assert rows(report["data"], "parent_1", "nb_1", "nb_0") == [("C1", 0.5, 2.0), ("C2", 1.5, 2.0)]
    # Record 4 is linked although its category has no discipline; record 3 is not.
    assert rows(report["total"]) == [("3",)]
    assert rows(report["stats"], "distance_type", "nb_orgs")[1] == ("Exact", 0.6)


def test_country_table_shows_the_maps_names(spark):
    tables = {
        "records": spark.createDataFrame([(1, 2, 2000), (2, 3, 2001)], "lens_id long, nb_authors long, year_published long"),
        "contribution": spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "lens_id long, contribution_id string"),
        "affiliation": spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("b", 3)], "contribution_id string, org_id long"),
        "organisations": spark.createDataFrame([(1, "FR"), (2, "??"), (3, "XX")], "org_id long, country_code string"),
        "countries": spark.createDataFrame([("FR", "France", "French Republic")], "country_code string, country string, admin string"),
    }
    report = reports.report_countries(tables)
    assert rows(reports.with_headings(report["table"], "countries")) == [("French Republic", 2)]
    assert rows(report["all"], "country_code", "country", "nb_records") == [("??", "unknown", 1), ("FR", "France", 2), ("XX", None, 1)]


def test_a_click_shows_one_line_more(spark):
    net = {
        "net_org_edges": spark.createDataFrame([(1, 2, True, 2.0)], "`from` long, `to` long, is_ext boolean, weight double"),
        "net_org_nodes": spark.createDataFrame([(1, "A", 10, 1.0), (2, "B", 1234, 2.0)], "org_id long, name string, nb_records long, nb_contributions double"),
        "locations": spark.createDataFrame([(1, "x", "FR"), (2, "y", "FR")], "org_id long, name string, country_code string"),
        "countries": spark.createDataFrame([("FR", "France")], "country_code string, admin string"),
    }
    markers = reports.report_collaboration_map(net)["markers"]
    (label, popup), = rows(markers.where("org_id = 2"), "label", "popup")
    assert label.startswith("<strong>B</strong><br/>1,234 records<br/>247 researchers") and popup == label + "<br/>Review Profile"


def test_the_country_query_returns_every_country(spark, tmp_path):
    """Nation 0 has no known code, 24 is not on the map; the query leaves neither out."""
    when = datetime.datetime(1998, 1, 1)
    tables = {
        "supplier": [(n, f"S{n}", n, 1.0) for n in (0, 5, 24)],
        "nation": [(n, f"NATION {n}", 0) for n in range(25)],
        "orders": [(n, 1, "O", 10.0, when, "1-URGENT") for n in (0, 5, 24)],
        "lineitem": [(n, 1, n, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", when) for n in (0, 5, 24)],
    }
    for name, listed in tables.items():
        spark.createDataFrame(listed, star.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    got = queries.registered()["report_countries"](spark, str(tmp_path))
    assert rows(got, "country_code", "country", "nb_records") == [("??", "unknown", 1), ("N24", None, 1), ("N5", "State of NATION 5", 1)]


def test_headline_report_makes_the_records_once(spark, monkeypatch):
    """Five of the reports read the records with their team sizes; these are grouped once for all of them."""
    made = []

    def counted(session, folder, make=star.records):
        made.append(folder)
        return make(session, folder)

    monkeypatch.setattr(star, "records", counted)
    heroes = queries.registered()["report_heroes"](spark, "/root/testdata/sf0.001")
    assert heroes.count() == 6 and len(made) == 1


def test_second_headline_report_counts_team_sizes_once(spark, monkeypatch):
    """The bound of the network and the records of the funders read the same team sizes."""
    made = []

    def counted(df, *more, make=star.team_sizes):
        made.append(df)
        return make(df, *more)

    monkeypatch.setattr(star, "team_sizes", counted)
    heroes = queries.registered()["report_heroes_more"](spark, "/root/testdata/sf0.001")
    assert heroes.count() == 5 and len(made) == 1

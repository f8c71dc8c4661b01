import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from citeloom.plans import network
from tests.conftest import rows

SCHEMA = "lens_id long, contribution_id long, org_id long"


def edge_weights(df):
    return {(r["from"], r["to"], r["is_ext"]): r["weight"] for r in df.collect()}


def net(df, cap=20, **more):
    return network.collaboration_edges(df, network.team_sizes(df), cap, **more)


def by_hand(lines, cap=20):
    """The definition, author pair by author pair."""
    records = {}
    for record, author, org in lines:
        records.setdefault(record, {}).setdefault(author, set())
        if org is not None:
            records[record][author].add(org)
    total = {}
    for authors in records.values():
        if len(authors) > cap:
            continue
        weights = {}
        for a, b in combinations(sorted(authors), 2):
            one, two = authors[a], authors[b]
            external = not one & two
            pairs = [tuple(sorted((x, y))) for x in one for y in two]
            for pair in pairs:
                if external or pair[0] == pair[1]:
                    key = (*pair, external)
                    weights[key] = weights.get(key, 0) + len(set(pairs))
        whole = sum(weights.values())
        for key, w in weights.items():
            total[key] = total.get(key, 0) + w / whole
    return total


def test_worked_example(spark):
    lines = [(1, 1, 10), (1, 2, 20), (1, 3, 30), (2, 1, 10), (2, 1, 20), (2, 2, 10), (3, 1, 10)]
    got = edge_weights(net(spark.createDataFrame(lines, SCHEMA)))
    third = pytest.approx(1 / 3)
    assert got == {(10, 10, False): 1.0, (10, 20, True): third, (10, 30, True): third, (20, 30, True): third}


def test_team_cap_and_lonely_authors(spark):
    lines = [(1, a, a) for a in range(21)] + [(2, a, a) for a in range(20)] + [(3, 1, 5)]
    got = edge_weights(net(spark.createDataFrame(lines, SCHEMA)))
    assert len(got) == 190 and sum(got.values()) == pytest.approx(1.0)
    assert edge_weights(net(spark.createDataFrame(lines, SCHEMA), 19)) == {}


def test_authors_without_organisation(spark):
    lines = [(1, 1, 10), (1, 2, None), (1, 3, 20), (2, 1, None), (2, 2, None)]
    got = edge_weights(net(spark.createDataFrame(lines, SCHEMA)))
    assert got == {(10, 20, True): 1.0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_teams_match_the_definition(spark, partitions, seed):
    rng = random.Random(seed)
    lines = [(rng.randrange(40), rng.randrange(6), rng.choice([None, *range(7)])) for _ in range(600)]
    df = spark.createDataFrame(lines, SCHEMA)
    want = {k: pytest.approx(v) for k, v in by_hand(lines).items()}
    for got in partitions(lambda: edge_weights(net(df))):
        assert got == want


def test_every_team_weighs_one(spark):
    rng = random.Random(9)
    lines = [(r, a, rng.randrange(9)) for r in range(50) for a in range(rng.randrange(1, 6))]
    got = edge_weights(net(spark.createDataFrame(lines, SCHEMA)))
    teams = {r for r, a, _ in lines if a > 0}
    assert sum(got.values()) == pytest.approx(len(teams))


def test_one_record_with_a_third_of_all_lines(spark):
    """Wide, overlapping authors of one record next to many small records."""
    rng = random.Random(5)
    lines = [(0, a, o) for a in range(7) for o in range(300)] * 3
    lines += [(r, a, rng.randrange(300)) for r in range(1, 3000) for a in range(4)]
    df = spark.createDataFrame(lines, SCHEMA)
    got = edge_weights(net(df))
    want = by_hand(lines)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v) for k, v in want.items())


def test_nodes_count_fractions_and_records(spark):
    lines = [(1, 1, 10), (1, 2, 20), (2, 1, 10), (2, 2, 10), (3, 1, 99)]
    df = spark.createDataFrame(lines, SCHEMA)
    orgs = spark.createDataFrame([(10, "A", "N1"), (20, "B", "N2"), (99, "C", "N3")], "org_id long, name string, country_code string")
    edges, nodes = network.collaboration_network(df, network.team_sizes(df), orgs, 20)
    assert rows(nodes, "org_id", "nb_contributions", "nb_records") == [(10, 1.5, 2), (20, 0.5, 1)]
    assert rows(network.graph_vertices(nodes, edges)) == [(10, "A", "N1"), (20, "B", "N2")]


def test_network_between_countries(spark):
    lines = [(1, 1, "N1"), (1, 2, "N2"), (2, 1, "N1"), (2, 2, "N1")]
    df = spark.createDataFrame(lines, "lens_id long, contribution_id long, country_code string")
    assert edge_weights(net(df, level="country_code")) == {("N1", "N2", True): 1.0, ("N1", "N1", False): 1.0}


def test_top_pairs(spark):
    lines = [(1, 1, 10), (1, 2, 20), (2, 1, 20), (2, 2, 10), (3, 1, 10), (3, 2, 30)]
    top = network.top_pairs_unweighted(spark.createDataFrame(lines, SCHEMA), network.team_sizes(spark.createDataFrame(lines, SCHEMA)), 1, 20)
    assert rows(top) == [(10, 20, 2)]


def test_the_records_own_number_of_authors_counts(spark):
    lines = spark.createDataFrame([(r, a, a) for r in (1, 2, 3, 4) for a in (1, 2)], SCHEMA)
    records = spark.createDataFrame([(1, 500), (2, 2), (3, None)], "lens_id long, nb_authors int")
    assert edge_weights(network.collaboration_edges(lines, records, 20)) == {(1, 2, True): 1.0}
    assert edge_weights(network.collaboration_edges(lines, records, None)) == {(1, 2, True): 3.0}
    assert rows(network.left_out(records, 20)) == [(2, 3)]


def test_a_very_large_record_without_a_bound(spark):
    lines = [(1, a, a % 40) for a in range(5000)]
    got = edge_weights(net(spark.createDataFrame(lines, SCHEMA), None))
    assert len(got) == 40 * 39 // 2 + 40 and sum(got.values()) == pytest.approx(1.0)


def pairs_by_hand(lines, n):
    records = {}
    for record, _, org in lines:
        records.setdefault(record, set()).add(org)
    counts = {}
    for orgs in records.values():
        for pair in combinations(sorted(orgs), 2):
            counts[pair] = counts.get(pair, 0) + 1
    return sorted(((a, b, c) for (a, b), c in counts.items()), key=lambda r: (-r[2], r[0], r[1]))[:n]


@pytest.mark.parametrize(("n", "seeds"), [(1, 2), (7, 3), (30, 4), (400, 2)])
def test_top_pairs_of_random_records(spark, monkeypatch, n, seeds):
    monkeypatch.setattr(network, "SEEDS", seeds)
    rng = random.Random(n)
    lines = [(r, a, min(int(rng.expovariate(0.15)), 39)) for r in range(150) for a in range(rng.randrange(1, 5))]
    df = spark.createDataFrame(lines, SCHEMA)
    top = network.top_pairs_unweighted(df, network.team_sizes(df), n, None)
    assert [tuple(r) for r in top.orderBy(F.col("nb_records").desc(), "from", "to").collect()] == pairs_by_hand(lines, n)


@pytest.mark.parametrize("others", [True, False])
def test_top_pairs_do_not_pair_all_organisations_of_a_record(spark, monkeypatch, others):
    joined = []

    def counting(left, right, keys, how="inner"):
        out = join_split(left, right, keys, how)
        if keys == ["lens_id"] and how == "inner":
            joined.append(out.count())
        return out

    join_split = network.join_split
    monkeypatch.setattr(network, "join_split", counting)
    large = [(0, a, 1000 + a) for a in range(5000)]
    lines = large + ([(r, a, (r + a) % 9) for r in range(1, 60) for a in range(3)] if others else [])
    df = spark.createDataFrame(lines, SCHEMA)
    top = network.top_pairs_unweighted(df, network.team_sizes(df), 5, None)
    assert rows(top) == sorted(pairs_by_hand(lines[5000:] if others else [(0, a, 1000 + a) for a in range(9)], 5))
    assert sum(joined) < 200_000  # all pairs would be 25 million


def test_top_pairs_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert network.top_pairs_unweighted(df, network.team_sizes(df), 3, 20).count() == 0


def test_intervals_hold_the_network_of_each_span(spark):
    rng = random.Random(2)
    lines = [(r, a, rng.randrange(12)) for r in range(80) for a in range(rng.randrange(1, 4))]
    df = spark.createDataFrame(lines, SCHEMA)
    years = {r: 2000 + r % 7 for r in range(79)}  # the last record has no year
    records = spark.createDataFrame([(r, 3, years.get(r)) for r in range(80)], "lens_id long, nb_authors int, year_published int")
    orgs = spark.createDataFrame([(o, f"O{o}", "N1") for o in range(12)], "org_id long, name string, country_code string")
    spans = [(2000, 2002), (2002, 2006)]
    edges, nodes = network.collaboration_intervals(df, records, orgs, spans, 5, 20)
    for a, b in spans:
        own = df.join(records.where(F.col("year_published").between(a, b)), "lens_id").select(*df.columns)
        all_edges, all_nodes = network.collaboration_network(own, records, orgs, 20)
        largest = sorted(all_nodes.collect(), key=lambda r: (-r.nb_contributions, r.org_id))[:5]
        got = nodes.where((F.col("first_year") == a) & (F.col("last_year") == b)).orderBy("position").collect()
        assert [(r.org_id, r.nb_contributions, r.nb_records, r.name) for r in got] == [(r.org_id, r.nb_contributions, r.nb_records, r.name) for r in largest]
        ids = [r.org_id for r in largest]
        kept = all_edges.where(F.col("from").isin(ids) & F.col("to").isin(ids))
        assert edge_weights(edges.where(F.col("first_year") == a)) == edge_weights(kept)


def test_edges_are_drawn_between_one_place_each(spark):
    edges = spark.createDataFrame([(1, 2, True, 1.0), (1, 3, True, 2.0), (2, 4, True, 3.0)], "`from` long, `to` long, is_ext boolean, weight double")
    places = [(1, 9, 1.0, 1.5), (1, 4, 2.0, 2.5), (1, 3, None, 0.0), (2, 4, 2.0, 2.5), (3, 7, 3.0, 3.5), (4, 8, 4.0, None)]
    locations = spark.createDataFrame(places, "org_id long, geonames_id long, lat double, lng double")
    got = rows(network.edge_lines(edges, locations), "from", "to", "lat_1", "lng_1", "lat_2", "lng_2")
    assert got == [(1, 2, 2.0, 2.5, 2.0, 2.5), (1, 3, 2.0, 2.5, 3.0, 3.5)]


def test_pairs_are_made_once_and_inside_rows(spark, monkeypatch):
    """Records of few lines are paired without a join, crowded ones by a join; both give the definition's network."""
    rng = random.Random(4)
    lines = [(r, a % 4, rng.randrange(12)) for r in range(60) for a in range(rng.randrange(1, 9))]
    lines += [(60, a, a % 9) for a in range(200)]
    want = {k: pytest.approx(v) for k, v in by_hand(lines, 300).items()}
    df, joined = spark.createDataFrame(lines, SCHEMA), []
    join_split = network.join_split

    def noting(left, right, keys, how="inner"):
        joined.append((how, left.select("lens_id").distinct().count() if "lens_id" in left.columns else 0))
        return join_split(left, right, keys, how)

    monkeypatch.setattr(network, "join_split", noting)
    assert edge_weights(network.edges_of_teams(df)) == want
    assert [n for how, n in joined if how == "inner"] == [1]


def test_top_pairs_are_counted_anew_only_for_more_organisations(spark, monkeypatch):
    """Organisations of about equal size are all paired in the first round, so one more would find nothing."""
    rng = random.Random(6)
    lines = [(r, a, rng.randrange(400)) for r in range(8000) for a in range(4)]
    df, rounds = spark.createDataFrame(lines, SCHEMA), []
    joint_records = network.joint_records
    monkeypatch.setattr(network, "joint_records", lambda *a: rounds.append(a[3]) or joint_records(*a))
    top = network.top_pairs_unweighted(df, network.team_sizes(df), 20, 20)
    assert rows(top) == sorted(pairs_by_hand(lines, 20))
    assert len(rounds) == 2


def test_figures_of_crowded_and_other_records(spark):
    lines = [(1, a, a % 3) for a in range(100)] + [(2, 1, 0), (2, 1, 0), (2, 2, 5)]
    got = rows(network.figures_of_teams(spark.createDataFrame(lines, SCHEMA)))
    assert got == [(0, pytest.approx(0.34 + 2 / 3), 2), (1, 0.33, 1), (2, 0.33, 1), (5, pytest.approx(1 / 3), 1)]


def staged_labels(monkeypatch, module):
    labels = []

    def spy(df, label="stage", *more, make=module.stage):
        labels.append(label)
        return make(df, label, *more)

    monkeypatch.setattr(module, "stage", spy)
    return labels


def test_network_gathers_teams_before_the_bound(spark, monkeypatch):
    """Lines are not written out to find the small teams; the crowded record goes through the join, the large one is left out."""
    lines = [(1, 1, 10), (1, 2, 20), (1, 2, 20), (2, 1, 10), (2, 1, 20), (2, 2, 10), (None, 1, 10), (None, 2, 30), (3, 1, None), (3, 2, 10)]
    lines += [(4, a, a) for a in range(21)] + [(5, a, a) for a in range(90)] + [(6, a % 3, a) for a in range(70)]
    df = spark.createDataFrame(lines, SCHEMA)
    organisations = spark.createDataFrame([(o, f"o{o}") for o in range(90)], "org_id long, name string")
    labels = staged_labels(monkeypatch, network)
    edges, nodes = network.collaboration_network(df, network.team_sizes(df), organisations, 20)
    want = {k: pytest.approx(v) for k, v in by_hand([x for x in lines if x[0] is not None]).items()}
    assert edge_weights(edges) == want and want
    assert rows(nodes.where("org_id in (10, 20)"), "org_id", "nb_records") == [(10, 4), (20, 3)]
    assert "lines" not in labels and "crowd" in labels


def test_files_of_teams_are_bounded_in_rows(spark, monkeypatch):
    """The memory of a task that adds up pairs goes with its rows, however well their bytes are packed."""
    monkeypatch.setattr(network, "TEAMS_PER_FILE", 50, raising=False)
    df = spark.range(2000).select(F.col("id").alias("lens_id"), F.explode(F.array(*[F.lit(k).cast("long") for k in (1, 2, 3)])).alias("contribution_id"))
    teams = network.gather_teams(df.withColumn("org_id", F.col("contribution_id")), ["lens_id"], "org_id").rows
    files = teams.groupBy(F.input_file_name().alias("file")).count()
    assert files.agg(F.max("count"), F.sum("count")).first() == (50, 2000)


def test_authors_of_organisations_of_their_own_are_paired_by_line(spark, monkeypatch):
    """Sets are made only where an author has several organisations and an organisation several authors."""
    lines = [(1, 1, 10), (1, 1, 11), (1, 1, 11), (1, 2, 20), (1, 3, 30), (1, 3, 31), (1, 3, 32), (2, 1, 10), (2, 1, 20), (3, 1, 10), (3, 2, 10), (3, 2, 10)]
    lines += [(4, None, 10), (4, None, 20), (4, 1, 30)]
    seen = []

    def spy(df, by, make=network._set_pairs):
        seen.append(df)
        return make(df, by)

    monkeypatch.setattr(network, "_set_pairs", spy)
    df = spark.createDataFrame(lines, SCHEMA)
    records = df.select("lens_id").distinct().withColumn("nb_authors", F.lit(3))
    got = edge_weights(network.collaboration_edges(df, records, 20))
    assert got == {k: pytest.approx(v) for k, v in by_hand([(r, a or 0, o) for r, a, o in lines]).items()}
    assert [df.count() for df in seen] == [0]

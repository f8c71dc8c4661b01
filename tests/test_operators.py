import hashlib
import random

import pytest
from pyspark.sql import Window as W, functions as F

from citeloom.functions import nested, predicates, scalars
from citeloom.operators import grouping, joins, keys, ranking
from citeloom.plans import baseline, searches
from citeloom.session import stage
from citeloom.sources import codes
from tests.conftest import rows


# --- keys and ranks --------------------------------------------------------------------


def test_surrogate_keys_do_not_depend_on_partitions(spark, partitions):
    rng = random.Random(3)
    data = [(rng.choice([None, "x", "y", "ä"]), rng.randrange(50)) for _ in range(500)]
    df = spark.createDataFrame(data, "a string, b int").repartition(7)
    want = sorted(set(data), key=lambda r: (r[0] is None, r[0] or "", r[1]))
    for got in partitions(lambda: rows(keys.surrogate_key(df, ["a", "b"], "id"), "id", "a", "b")):
        assert got == [(i, *k) for i, k in enumerate(want)]


def test_composite_key_join_matches_null_parts(spark):
    dim = spark.createDataFrame([(0, "a", None), (1, "a", "b")], "id long, x string, y string")
    facts = spark.createDataFrame([(7, "a", None), (8, "a", "b"), (9, "c", None)], "f long, x string, y string")
    assert rows(keys.join_left_composite(facts, dim, ["x", "y"], "id"), "f", "id") == [(7, 0), (8, 1), (9, None)]


def test_running_total_is_exclusive(spark, partitions):
    df = spark.createDataFrame([(i, 2 * i) for i in range(100)], "k int, v long").repartition(5)
    for got in partitions(lambda: rows(keys.running_total(df, ["k"], "v", "t"), "k", "t")):
        assert got == [(i, i * (i - 1)) for i in range(100)]


@pytest.mark.parametrize("hot", [False, True])
def test_percent_rank_equals_the_window_function(spark, partitions, hot):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), 0 if hot and rng.random() < 0.4 else rng.randrange(20)) for _ in range(800)]
    df = spark.createDataFrame(data + [("one", 5)], "g string, v int")
    want = rows(df.withColumn("p", F.percent_rank().over(W.partitionBy("g").orderBy("v"))))
    for got in partitions(lambda: rows(ranking.percent_rank_within(df, ["g"], "v", "p"))):
        assert [r[:2] for r in got] == [r[:2] for r in want]
        assert [r[2] for r in got] == pytest.approx([r[2] for r in want])


def test_nulls_are_not_ranked(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 3.0)], "k string, v double")
    got = rows(ranking.percent_rank_within(df, [], "v", "p"), "k", "p")
    assert got == [("a", 0.0), ("b", None), ("c", 0.5), ("d", 0.5)]


def test_shares_add_up_to_100(spark):
    df = stage(spark.range(1, 50).select("id", (F.col("id") * 3).alias("v")))
    shares = [r.s for r in ranking.share_of_total(df, "v", "s").collect()]
    assert sum(shares) == pytest.approx(100.0)


def test_top_lists_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", None), ("e", 1)], "k string, v int")
    assert [r.k for r in ranking.sort_desc(df, ["v"], ["k"]).collect()] == ["c", "a", "b", "e", "d"]
    assert [r.k for r in ranking.top_n_threshold(df, "v", 5, 2, ["k"]).collect()] == ["c", "a"]
    assert [r.k for r in ranking.top_n(df, [F.col("k").desc()], 2).collect()] == ["e", "d"]


# --- grouping --------------------------------------------------------------------------


def test_fractional_counts_add_up_to_the_records(spark):
    data = [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (None, "a")]
    df = spark.createDataFrame(data, "r long, k string")
    assert rows(grouping.fractional_count(df, "r", ["k"], "n")) == [("a", pytest.approx(2 / 3)), ("b", pytest.approx(4 / 3))]
    assert rows(grouping.fractional_count(df, "r", ["k"], "n", distinct=True)) == [("a", 0.5), ("b", 1.5)]


def test_lines_that_only_say_none_are_dropped(spark):
    records = spark.createDataFrame([(i,) for i in range(1, 6)], "r long")
    lines = spark.createDataFrame(
        [(1, "A", "p"), (1, None, None), (2, None, None), (3, None, "x"), (3, None, "y"), (4, "A", "p"), (4, "B", "q")],
        "r long, org string, p string",
    )
    got = rows(grouping.filter_flagged(records, lines, "r", "org"), "r", "org", "nb_rows")
    assert got == [(1, "A", 1), (2, None, 1), (4, "A", 2), (4, "B", 2), (5, None, 1)]


def test_best_row_per_key_is_stable(spark, partitions):
    df = spark.createDataFrame([(1, 5.0, 3), (1, 5.0, 2), (1, None, 1), (2, None, 4)], "k long, s double, id long")
    for got in partitions(lambda: rows(grouping.dedupe_keep_best(df, ["k"], "s", ["id"]))):
        assert got == [(1, 5.0, 2), (2, None, 4)]
    once = grouping.dedupe_keep_best(df, ["k"], "s", ["id"])
    assert rows(grouping.dedupe_keep_best(once, ["k"], "s", ["id"])) == rows(once)


def test_flags_and_distinct_counts(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, None), (3, "x"), (3, "y")], "r long, c string")
    assert rows(grouping.all_null_flag(df, "r", "c", "f").select("r", "f").distinct()) == [(1, False), (2, True), (3, False)]
    assert rows(grouping.distinct_count_per(df, ["r"], "c", "n").select("r", "n").distinct()) == [(1, 1), (2, 0), (3, 2)]


def test_pairs_with_a_null_side_count(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None), ("a", "b")], "x string, y string")
    assert grouping.count_distinct_pair(df, "x", "y", "n").first().n == 3


def test_sampling_keeps_all_rows_of_a_key(spark, partitions):
    df = spark.createDataFrame([(i % 30, i) for i in range(300)], "k long, v long")
    results = partitions(lambda: rows(grouping.sample_keys(df, "k", 7, seed=1)))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 70 and len({k for k, _ in results[0]}) == 7


def test_weighted_median(spark):
    df = spark.createDataFrame([(1, 1), (4, 2), (9, 1)], "v int, n long")
    assert df.agg(grouping.weighted_median("v", "n").alias("m")).first().m == 4.0


def test_trend_line(spark):
    line = grouping.trend_line(spark.createDataFrame([(x, 3 * x + 2) for x in range(5)], "x int, y int"), "x", "y").first()
    assert (line.slope, line.intercept) == (pytest.approx(3), pytest.approx(2))


# --- predicates and scalars ------------------------------------------------------------


def test_boolean_definition_reaches_into_arrays(spark):
    schema = "id long, year int, kind string, authors array<struct<affiliations:array<struct<country:string>>>>"
    data = [
        (1, 2019, "a", [([("AU",)],), ([("FR",), ("DE",)],)]),
        (2, 2020, "a", [([("AU",)],)]),
        (3, 2015, "b", []),
        (4, 2019, "b", None),
    ]
    df = spark.createDataFrame(data, schema)
    both = {"bool": {"must": [
        {"range": {"year": {"gte": "2018", "lte": "2023"}}},
        {"bool": {"must": [{"term": {"authors.affiliations.country": "AU"}}, {"term": {"authors.affiliations.country": "FR"}}]}},
    ]}}
    either = {"bool": {"should": [{"match": {"kind": "b"}}, {"term": {"authors.affiliations.country": "FR"}}]}}
    find = lambda c: [r.id for r in df.where(c).orderBy("id").collect()]
    assert find(predicates.bool_predicate(both, df.schema)) == [1]
    assert find(predicates.bool_predicate(either, df.schema)) == [1, 3, 4]
    assert find(predicates.combine_query_params(df.schema, either, [{"match": {"kind": "b"}}], "year", (2018, 2020))) == [4]
    with pytest.raises(ValueError):
        predicates.bool_predicate({"regexp": {"kind": "b"}}, df.schema)


def test_boolean_definition_supports_or_refuses_every_part(spark):
    df = spark.createDataFrame([("x", 1), ("y", 5), ("z", 9), (None, 7)], "b string, n int")
    find = lambda spec: sorted(r.n for r in df.where(predicates.bool_predicate(spec, df.schema)).collect())
    assert find({"bool": {"must_not": [{"match": {"b": "x"}}]}}) == [5, 7, 9]
    assert find({"range": {"n": {"gte": 2, "lt": 9}}}) == [5, 7]
    assert find({"range": {"n": {"gt": 5}}}) == [7, 9]
    assert find({"match": {"b": "y", "n": 5}}) == [5] and find({"match": {"b": "y", "n": 9}}) == []
    assert find({"match": {"b": "y"}, "range": {"n": {"gt": 5}}}) == []
    assert find({"bool": {"filter": {"match": {"b": "z"}}, "should": {"match": {"n": 9}}}}) == [9]
    for wrong in ({}, {"bool": {"mst": []}}, {"range": {"n": {"from": 1}}}, {"range": {"n": {}}}, {"match": {}}, {"match": {"b": {"query": "x"}}}, {"terms": {"b": ["x"]}}):
        with pytest.raises(ValueError):
            predicates.bool_predicate(wrong, df.schema)


def test_label_corrections(spark):
    df = spark.createDataFrame([("C1", "Metre"), ("C2", "Metre"), ("C3", "Dup")], "id string, name string")
    got = predicates.fix_duplicate_labels(df, "id", "name", ["C3"], {"C1": "Metre (SI)"})
    assert rows(got) == [("C1", "Metre (SI)", "Metre"), ("C2", "Metre", "Metre")]


def test_null_handling(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    assert rows(predicates.filter_null_any(df)) == [(2, "y")]
    assert rows(predicates.filter_null_subset(df, ["b"])) == [(None, "x"), (2, "y")]
    assert rows(predicates.fill_sentinel(df, {"b": "other"}), "b") == [("other",), ("x",), ("y",)]
    assert rows(predicates.mask_when(df, "b", F.col("a") == 2, "z"), "b") == [(None,), ("x",), ("z",)]
    assert predicates.filter_optional_threshold(df, "a", None).count() == 3
    assert predicates.filter_optional_threshold(df, "a", 2).count() == 1


def test_two_kinds_of_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double")
    got = rows(df, "v", scalars.round_after_fetch("v").alias("even"), scalars.round_in_query("v").alias("up"))
    assert got == [(0.5, 0.0, 1.0), (1.5, 2.0, 2.0), (2.5, 2.0, 3.0)]


def test_bins_close_the_last_one(spark):
    df = spark.createDataFrame([(0,), (1,), (11,), (12,), (21,), (51,), (100,)], "v int")
    edges = scalars.bin_edges(F.lit(100))
    got = rows(df, "v", scalars.bin_of("v", edges).alias("b"))
    assert got == [(0, None), (1, 1), (11, 2), (12, 2), (21, 3), (51, 4), (100, 4)]


def test_small_scalars(spark):
    got = spark.range(1).select(
        scalars.strip_prefix(F.lit("https://openalex.org/C1"), "https://openalex.org/").alias("a"),
        scalars.format_thousands(F.lit(1234567.0)).alias("b"),
        scalars.n_choose_2(F.lit(20)).alias("c"),
        scalars.if_null_then(F.lit(None).cast("string"), F.lit("x"), "Unknown").alias("d"),
        scalars.year_range(2019, 2021).alias("e"),
    ).first()
    assert tuple(got) == ("C1", "1,234,567", 190.0, "Unknown", [2019, 2020, 2021])
    low, high = scalars.default_year_window()
    window = spark.range(1).select(low.alias("lo"), high.alias("hi"), F.year(F.current_date()).alias("now")).first()
    assert (window.lo, window.hi) == (window.now - 4, window.now)


# --- nested values ---------------------------------------------------------------------


def test_lists_that_are_empty_or_missing(spark):
    df = spark.createDataFrame([(1, [("a", 1)]), (2, []), (3, None)], "id long, l array<struct<t:string,n:int>>")
    assert rows(nested.flatten_nested(df, ["id"], "l")) == [(1, "a", 1)]
    assert rows(nested.flatten_nested(df, ["id"], "l", outer=True)) == [(1, "a", 1), (2, None, None), (3, None, None)]
    assert rows(df, "id", nested.array_length("l").alias("n")) == [(1, 1), (2, 0), (3, 0)]
    assert rows(nested.posexplode_list(df, ["id"], "l", "p", "e"), "id", "p") == [(1, 1), (2, None), (3, None)]
    assert rows(nested.explode_list(df, ["id"], "l", "e").select("id")) == [(1,), (2,), (3,)]
    assert rows(nested.struct_to_columns(df.select("id", F.explode("l").alias("e")), ["id"], "e")) == [(1, "a", 1)]


def test_first_value_per_type(spark):
    df = spark.createDataFrame([(1, "x", "b", 2), (1, "x", "a", 1), (1, "y", "c", 3), (2, "z", "d", 1)], "id long, t string, v string, o int")
    assert rows(nested.pivot_type_to_column(df, "id", "t", "v", {"x": "first_x", "y": "first_y"}, "o")) == [(1, "a", "c"), (2, None, None)]


def test_json_object_to_rows(spark):
    df = spark.createDataFrame([(1, '{"2019": 3, "2020": 5}'), (2, "{}")], "id long, j string")
    assert rows(nested.dict_index_to_rows(df, ["id"], "j", "bigint", "bucket", "n")) == [(1, "2019", 3), (1, "2020", 5)]


# --- joins, searches, codes, baselines ----------------------------------------------------


def test_crosswalk_ignores_missing_ids(spark):
    a = spark.createDataFrame([("T1", "w", None), ("T2", None, "q")], "id string, wikipedia string, wikidata string")
    b = spark.createDataFrame([("C1", "w", None), ("C2", None, "q"), ("C3", None, None)], "id string, wikipedia string, wikidata string")
    assert rows(joins.join_taxonomy_crosswalk(a, b, "id", ["wikipedia", "wikidata"])) == [("T1", "C1", "wikipedia"), ("T2", "C2", "wikidata")]


def test_many_to_many_labels_repeat_edges(spark):
    edges = spark.createDataFrame([(1, 2, 3.0)], "from long, to long, weight double")
    names = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, "b", 6)], "org_id long, name string, nb_records long")
    assert joins.join_many_to_many(edges, names).count() == 2


def test_searches_are_merged(spark):
    one = spark.createDataFrame([("P1", 2.0, "a"), ("P2", 1.0, "b")], "lens_id string, score double, title string")
    two = spark.createDataFrame([("P1", 5.0, "c")], "lens_id string, score double, title string")
    merged = searches.merge_searches({"t1": one, "t2": two}, "lens_id", "score", "title")
    assert rows(merged, "lens_id", "t1", "t2", "topic", "title") == [("P1", 2.0, 5.0, "t2", "c"), ("P2", 1.0, None, "t1", "b")]
    assert searches.merge_searches({"t1": one, "t2": two}, "lens_id", "score", "title", minimum=3.0).count() == 1


def test_document_types(spark):
    df = spark.createDataFrame([("journal",), ("report",), ("?",)], "t string")
    assert rows(codes.unify_document_type(df, codes.type_thesaurus(spark), "t")) == [("?", None), ("journal", "ja"), ("report", "gl")]
    table = codes.static_code_table(spark, codes.DOCUMENT_TYPE_CODES, codes.DOCUMENT_TYPE_SCHEMA)
    assert table.count() == 7
    empty = spark.createDataFrame([], codes.TOPIC_CODE_SCHEMA)
    assert rows(codes.topic_codes(empty)) == [(1, 0, "Other"), (2, 0, "Other"), (3, 0, "Other")]


def test_baseline_counts_a_record_once_per_discipline(spark):
    records = spark.createDataFrame(
        [(1, 2020, "ja", 10, False), (2, 2020, "ja", 30, False), (3, 2020, "ja", 5, True), (4, 2020, None, 5, False)],
        "lens_id long, year int, pubtype_id string, citations long, is_retracted boolean",
    )
    cats = spark.createDataFrame(
        [(1, "C1"), (1, "C1"), (1, "C2"), (2, "C1"), (3, "C1"), (4, "C1"), (2, "0"), (2, "N/A")], "lens_id long, parent_1 string"
    )
    got = rows(baseline.citation_baseline(records, cats))
    assert got == [("C1", "ja", 2020, 2, 20.0, 10, 30, 2), ("C2", "ja", 2020, 1, 10.0, 10, 10, 1)]
    impact = rows(baseline.normalised_impact(records, cats), "lens_id", "parent_1", "cnci", "percentile", "is_top10")
    assert impact == [(1, "C1", 0.5, 0.0, False), (1, "C2", 1.0, 0.0, False), (2, "C1", 1.5, 1.0, True)]
    assert rows(baseline.citation_distribution(records, cats).where("parent_1 = 'C1'"), "citations", "nb_records") == [(10, 1), (30, 1)]


# --- sampling and positions at scale --------------------------------------------------------


@pytest.mark.parametrize(("digits", "cell"), [(4, 65_536), (1, 3), (1, 40)])
@pytest.mark.parametrize("share", [0.0, 0.001, 1 / 3, 1.0, 2.0])
def test_sample_is_the_keys_of_smallest_digests(spark, monkeypatch, digits, cell, share):
    monkeypatch.setattr(grouping, "CELL_DIGITS", digits)
    monkeypatch.setattr(grouping, "CELL_KEYS", cell)
    n = int(3000 * share)
    df = spark.range(6000).select((F.col("id") % 3000).alias("k"), F.lit(1).alias("v")).unionByName(spark.sql("SELECT NULL AS k, 1 AS v"))
    got = sorted(r.k for r in grouping.sample_keys(df, "k", n, seed=5).collect())
    order = sorted(range(3000), key=lambda k: (hashlib.md5(f"{k}:5".encode()).hexdigest(), k))
    assert got == sorted(order[:n] * 2)


def test_sampling_many_keys_sorts_nothing_in_one_task(spark):
    df = spark.range(300_000).select(F.col("id").alias("k"))
    picked = grouping.sample_keys(df, "k", 100_000)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert picked.count() == 100_000
    assert not any(step in plan for step in ("Exchange", "Sort", "TakeOrdered", "Join"))


def test_positions_follow_the_sorted_order(spark, partitions):
    data = [("a", 5.0), ("b", 7.0), ("c", 5.0), ("d", None), ("e", -1.0)]
    df = spark.createDataFrame(data, "k string, v double").repartition(3)
    for got in partitions(lambda: rows(ranking.with_position(df, ["v"], ["k"]), "position", "k", "v")):
        assert got == [(1, "b", 7.0), (2, "a", 5.0), (3, "c", 5.0), (4, "e", -1.0), (5, "d", None)]
    assert ranking.with_position(df, ["v"], ["k"]).columns == ["k", "v", "position"]


def test_an_unknown_country_does_not_exclude_a_record(spark):
    schema = "lens_id string, authors array<struct<affiliations:array<struct<country_code:string>>>>"
    affiliation = lambda *codes: {"affiliations": [{"country_code": c} for c in codes]}
    data = [("1", [affiliation(None)]), ("2", [affiliation(None), affiliation("N3")]), ("3", [affiliation("N4")]), ("4", []), ("5", None)]
    df = spark.createDataFrame(data, schema)
    search = {"bool": {"must_not": [{"term": {"authors.affiliations.country_code": "N3"}}]}}
    assert rows(df.where(predicates.bool_predicate(search, df.schema)), "lens_id") == [("1",), ("3",), ("4",), ("5",)]

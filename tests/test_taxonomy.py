from citeloom.plans import taxonomy
from tests.conftest import rows

NODES = "category_id string, level int, display_name string, raw_display_name string"


def nodes(spark, *pairs):
    return spark.createDataFrame([(i, n, i.lower(), i.lower()) for i, n in pairs], NODES)


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "category_id string, parent string")


def test_worked_example(spark):
    n = nodes(spark, ("A", 0), ("B", 1), ("B2", 1), ("C", 2), ("D", 3), ("X", 2))
    e = edges(spark, ("B", "A"), ("B2", "A"), ("C", "B"), ("C", "B2"), ("D", "C"), ("D", "X"))
    got = rows(taxonomy.resolve_hierarchy(n, e), "category_id", "parent_1", "parent_0")
    assert got == sorted(
        [("A", "N/A", "A"), ("B", "B", "A"), ("B2", "B2", "A"), ("C", "B", "A"), ("C", "B2", "A"), ("X", "0", "0"),
         ("D", "B", "A"), ("D", "B2", "A"), ("D", "0", "0")]
    )


def test_labels_and_parent_counts(spark, partitions):
    n = nodes(spark, ("A", 0), ("A2", 0), ("B", 1), ("B2", 1), ("C", 2))
    e = edges(spark, ("B", "A"), ("B2", "A2"), ("C", "B"), ("C", "B2"), ("C", "GONE"))
    def run():
        return rows(
            taxonomy.resolve_hierarchy(n, e).where("level = 2"),
            "parent_1", "parent_0", "display_name_1", "display_name_0", "nb_parent_1", "nb_parent_0",
        )
    for got in partitions(run):
        assert got == [("B", "A", "b", "a", 2, 2), ("B2", "A2", "b2", "a2", 2, 2)]


def test_nodes_of_no_or_a_high_level_stay(spark):
    n = nodes(spark, ("A", 0), ("B", 1), ("H", 6), ("U", None))
    got = rows(taxonomy.resolve_hierarchy(n, edges(spark, ("B", "A"), ("H", "B"))), "category_id", "level", "parent_1", "parent_0")
    assert got == [("A", 0, "N/A", "A"), ("B", 1, "B", "A"), ("H", 6, "N/A", "N/A"), ("U", 0, "N/A", "U")]


def test_many_paths_stay_one_row(spark):
    middle = [(f"M{i}", 2) for i in range(30)]
    n = nodes(spark, ("A", 0), ("B", 1), *middle, ("Z", 3), ("Y", 4), ("X", 5))
    e = edges(
        spark, ("B", "A"), *[(m, "B") for m, _ in middle], *[("Z", m) for m, _ in middle], ("Y", "Z"), ("X", "Y")
    )
    assert rows(taxonomy.resolve_hierarchy(n, e).where("level >= 3"), "category_id", "parent_1", "parent_0") == [
        ("X", "B", "A"), ("Y", "B", "A"), ("Z", "B", "A")
    ]


def test_edges_of_nested_concepts(spark):
    space = "https://openalex.org/"
    node = lambda i, n: {"id": space + i, "level": n, "display_name": i}
    schema = (
        "display_name string, level int, works_count bigint, cited_by_count bigint,"
        " ancestors array<struct<id:string,level:int,display_name:string>>,"
        " related_concepts array<struct<id:string,level:int,display_name:string>>,"
        " ids struct<openalex:string,wikidata:string,wikipedia:string>"
    )
    data = [
        ("c", 2, 1, 1, [node("A", 0), node("B", 1), node("B2", 1)], [node("D", 2), node("E", 3)], {"openalex": space + "C"}),
        ("n", 1, 1, 1, None, [], {"openalex": space + "N"}),
    ]
    tables = taxonomy.build_concept_edges(spark.createDataFrame(data, schema))
    assert rows(tables["parents"], "category_id", "parent", "nb_parents") == [("C", "B", 2), ("C", "B2", 2)]
    assert rows(tables["siblings"], "category_id", "sibling", "nb_siblings") == [("C", "D", 1)]
    assert tables["nodes"].count() == 2


def test_unlinked_records_are_flagged(spark):
    cats = spark.createDataFrame([(1, "b"), (1, "?"), (2, "?"), (2, None), (3, "B")], "lens_id long, value string")
    hierarchy = spark.createDataFrame([("B", "b", "B", "A"), ("B", "b", "B", "A2")], "category_id string, raw_display_name string, parent_1 string, parent_0 string")
    got = rows(taxonomy.link_categories(cats, hierarchy, "lens_id", "value", "raw_display_name"), "lens_id", "raw_display_name", "parent_0", "is_not_linked")
    assert got == [(1, "?", None, False), (1, "b", "A", False), (1, "b", "A2", False), (2, None, None, True), (2, "?", None, True), (3, "B", None, True)]


def test_topics_link_every_level_that_bears_the_label(spark):
    topics = spark.createDataFrame(
        [("D1", 0, "Health", None, None, None), ("F1", 1, "Health", None, None, None), ("S1", 2, "Care", None, None, None), ("T1", 3, "Health", "S1", "F1", "D1")],
        "category_id string, level int, display_name string, subfield_id string, field_id string, domain_id string",
    )
    resolved = taxonomy.resolve_topic_hierarchy(topics, edges(spark, ("F1", "D1"), ("S1", "F1")))
    cats = spark.createDataFrame([(1, "Health"), (1, "None such"), (2, "health"), (3, None), (3, "Care")], "lens_id long, value string")
    got = rows(taxonomy.link_topics(cats, resolved, "lens_id"), "lens_id", "display_name", "category_id", "parent_2", "parent_1", "parent_0", "is_not_linked")
    assert got == [
        (1, "Health", "D1", "N/A", "N/A", "D1", False), (1, "Health", "F1", "N/A", "F1", "D1", False), (1, "Health", "T1", "S1", "F1", "D1", False),
        (1, "None such", None, None, None, None, False), (2, "health", None, None, None, None, True),
        (3, None, None, None, None, None, False), (3, "Care", "S1", "S1", "F1", "D1", False),
    ]

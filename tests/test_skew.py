"""Queries on tables in which single keys hold a third of all rows."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from citeloom.operators import joins
from citeloom.operators.grouping import attach_group
from citeloom.plans import taxonomy
from tests.oracle_check import compare, connect
from tests.skew import skewed_tables

SMALL = "/root/testdata/sf0.001"
NAMES = [
    "report_sources", "report_countries", "report_funders", "domain_discipline_ranks", "collaboration_edges", "collaboration_nodes",
    "link_categories", "normalised_impact", "merge_searches", "dedupe_keep_best", "surrogate_key", "fractional_count",
    "build_affiliation", "resolve_hierarchy", "nested_agg",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    return skewed_tables(SMALL, str(tmp_path_factory.mktemp("hot")))


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, hot, name):
    assert compare(entry.queries()[name](spark, hot), connect(hot), entry.oracle_sql()[name]) is None


@pytest.fixture
def splitting(spark):
    """Settings under which small tables are split, with broadcasts off."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_rows(spark, **columns):
    """400,000 rows, a third of them with the key 1; each column is the key or a filler."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    return spark.range(0, 400_000, numPartitions=16).select(*[(key if v == "key" else F.xxhash64("id", F.lit(c)) if v is None else F.lit(v)).alias(c) for c, v in columns.items()])


def attached(spark):
    return attach_group(hot_rows(spark, k="key", v=None), ["k"], F.count(F.lit(1)).alias("n")), 400_000


def semi(spark):
    keys = hot_rows(spark, key="key").distinct()
    return joins.keep_keys_of(hot_rows(spark, k="key", v=None), "k", keys, "key"), 400_000


def both_ends(spark):
    edges = hot_rows(spark, **{"from": "key", "to": "key", "weight": None})
    names = hot_rows(spark, org_id="key").distinct().withColumns({"name": F.lit("x"), "nb_records": F.lit(1)})
    return joins.join_many_to_many(edges, names), 400_000


def labelled(spark):
    cats = hot_rows(spark, lens_id=None, value="key").withColumn("value", F.col("value").cast("string"))
    hierarchy = hot_rows(spark, category_id="key").distinct().select(F.col("category_id").cast("string").alias("category_id"), F.col("category_id").cast("string").alias("label"))
    return taxonomy.link_categories(cats, hierarchy, "lens_id", "value", "label"), 400_000


def placed(spark):
    ids = spark.range(0, 400_000, numPartitions=16).select(F.col("id").alias("org_id"), F.lit("t").alias("type"), F.col("id").cast("string").alias("value"))
    registry = ids.select(F.col("org_id").alias("id"), "type", "value")
    place = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("geonames_id")
    locations = registry.select("id", place)
    return joins.join_composite_id(ids, registry, locations, locations.select("geonames_id").distinct().withColumn("city", F.lit("c"))), 400_000


@pytest.mark.parametrize("make", [attached, semi, both_ends, labelled, placed])
def test_hot_join_keys_are_split(spark, splitting, make):
    """A join onto a key that holds a third of the rows is split between tasks."""
    df, expected = make(spark)
    rows = df.where(F.lit(True))
    assert len(rows.collect()) == expected
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()

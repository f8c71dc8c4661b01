"""The pipeline's stages, each on its predecessor's rows, and the registered queries' SQL."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from tests.oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


def rows_of(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]

    def stage(name, docs):
        steps[name](spark, docs, SMALL).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    good = stage("quality_rules", docs)
    failed = {d for d, t in rows_of(docs) if brute.quality(t)[5]}
    assert good.columns == columns and not failed & {d for d, _ in rows_of(good)}

    lines = stage("line_dedup", good)
    expected = {d: t for d, (n, gone, t) in brute.passage_dedup(rows_of(good)).items() if not gone or len(gone) < n}
    assert lines.columns == columns and dict(rows_of(lines)) == expected

    single = stage("near_duplicates", lines)
    classes = brute.components(rows_of(lines))
    assert single.columns == columns and {d for d, _ in rows_of(single)} == set(classes.values())

    clean = stage("decontamination", single)
    items = [(str(r[0]), r[1]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contamination(rows_of(single), items) if r[5]}
    assert clean.columns == columns and {d for d, _ in rows_of(clean)} == {d for d, _ in rows_of(single)} - bad

    pieces = stage("packing", clean)
    assert {r[0] for r in pieces.select("doc_id").collect()} == {d for d, _ in rows_of(clean)}


def test_run_on_empty_documents(spark, none):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SMALL)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_sql(spark, name):
    assert compare(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names

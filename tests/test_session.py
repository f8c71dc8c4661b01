"""Staged tables and their owner."""

import os
import time

import pytest
from pyspark.sql import functions as F

from citeloom.session import new_path, noting, shared_dir, shuffles_dropped, spread, stage, staging, tune


def test_staged_tables_live_as_long_as_their_block(spark):
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    outside = stage(spark.range(3), "outside")
    with staging(spark):
        with staging(spark):
            inner = stage(spark.range(5), "inner")
            assert inner.count() == 5
        with pytest.raises(Exception, match="PATH|exist|FAILED_READ"):
            inner.collect()
        kept = stage(spark.range(7), "kept")
        new_path(spark, "never-written")
        assert kept.count() == 7
    after = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    assert [p.split("-")[0] for p in after - before] == ["outside"] and outside.count() == 3


def test_staged_tables_go_when_the_block_fails(spark):
    with pytest.raises(ValueError), staging(spark):
        path = new_path(spark, "failing")
        spark.range(2).write.parquet(path)
        raise ValueError
    assert not os.path.exists(path.removeprefix("file:"))


def test_shuffles_start_with_enough_partitions(spark):
    """A query cuts its shuffles finely, and keeps a larger number of the session's own."""
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(name, None) for name in names]
    try:
        spark.conf.unset(names[1])
        spark.conf.set(names[0], "8")
        assert spread(spark).conf.get(names[1]) == "400"
        spark.conf.set(names[0], "1000")
        assert spread(spark).conf.get(names[1]) == "1000"
    finally:
        for name, value in zip(names, before):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_scans_are_cut_as_finely_as_shuffles(spark):
    """A task of a scan reads no more than a task of a shuffle, however large the table."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = [spark.conf.get(name, None) for name in names]
    try:
        spark.conf.set(names[0], "128m")
        tune(spark)
        # About 120 MB in files of 15 MB, cheap to open and not cut for the number of cores, so that files share a part.
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], "1")
        table = stage(spark.range(0, 8 * 240_000, numPartitions=8).select(F.sha2(F.col("id").cast("string"), 256).alias("text")), "wide")
        rows = table.groupBy(F.spark_partition_id().alias("part")).count()
        assert rows.agg(F.max("count")).first()[0] <= 2 * 240_000
        assert spark.conf.get(names[0]) == "16m"
    finally:
        for name, value in zip(names, before):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_summaries_outlive_the_block_they_are_staged_in(spark):
    with staging(spark):
        with staging(spark):
            kept = stage(spark.range(4), "kept", outlives=True)
            gone = new_path(spark, "gone")
            spark.range(1).write.parquet(gone)
        assert kept.count() == 4 and not os.path.exists(gone.removeprefix("file:"))
    with pytest.raises(Exception, match="PATH|exist|FAILED_READ"):
        kept.collect()


def test_noted_paths_are_those_of_the_innermost_block(spark):
    with staging(spark):
        with noting() as outer:
            first = new_path(spark, "first")
            with noting() as inner:
                second = new_path(spark, "second")
            spark.range(1).write.parquet(second)
        assert (outer, inner) == ([first], [second]) and os.path.exists(second.removeprefix("file:"))
    assert not os.path.exists(second.removeprefix("file:"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark):
    """Inside the block, whether or not the driver has collected anything as garbage; the setting is put back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name)

    def left(label):
        before = shuffle_files(spark)
        counted = stage(spark.range(0, 20_000, numPartitions=4).groupBy((F.col("id") % 5_000).alias("k")).count(), label)
        assert counted.agg(F.sum("count")).first()[0] == 20_000
        return before

    with staging(spark), shuffles_dropped(spark):
        before = left("dropped")
        for _ in range(50):  # they are deleted beside the driver's work
            if not shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting

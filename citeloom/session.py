"""Session settings the jobs rely on, and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Hot join keys are split at run time, also where the split costs one more exchange.
SPLIT_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # What one task reads, sorts and groups; in memory it is several times as large.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # The same for scans, also of staged tables: a task combines or pairs the rows of its whole part in memory.
    "spark.sql.files.maxPartitionBytes": "16m",
    **SPLIT_SETTINGS,
}


def split_hot_keys(spark: SparkSession) -> SparkSession:
    """Let joins split hot keys; the session's other settings stay."""
    for key, value in SPLIT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply all run-time settings above to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Partitions a shuffle starts with at least; small ones are merged at run time, large ones are not cut.
INITIAL_PARTITIONS = 400


def spread(spark: SparkSession) -> SparkSession:
    """Let shuffles start with enough partitions that a task's share stays small when tables grow."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = [int(spark.conf.get(key, None) or 0) for key in (name, "spark.sql.shuffle.partitions")]
    spark.conf.set(name, str(max(INITIAL_PARTITIONS, *own)))
    return spark


def local_session(cores: int | str = 8, name: str = "citeloom", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own; on a cluster a
    machine-local folder would lose staged tables together with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="citeloom-")
    context.setCheckpointDir(own)
    return context.getCheckpointDir().rstrip("/")


#: Paths handed out inside the open ``staging`` blocks and the open ``noting`` blocks, the innermost last.
_owned: list[list[str]] = []
_noted: list[list[str]] = []


def new_path(spark: SparkSession, label: str, outlives: bool = False) -> str:
    """A path in the shared folder that no earlier run has used.

    With ``outlives`` it belongs to the ``staging`` block around the innermost one.
    """
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for lists in (_owned[:-1] if outlives else _owned, _noted):
        if lists:
            lists[-1].append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a path that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Owns the tables staged inside the block and deletes them at its end.

    Data frames made inside read those tables, so write their results before the block ends.
    """
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            discard(spark, path)


@contextmanager
def noting() -> Iterator[list[str]]:
    """Lists the paths handed out inside the block, without those of blocks of this kind inside it. Nothing is deleted."""
    _noted.append([])
    try:
        yield _noted[-1]
    finally:
        _noted.pop()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Every query run inside the block deletes its shuffle files when it ends.

    Otherwise they lie on the disk until the driver collects the query's plan as garbage. Not for a data frame that
    is run again: its shuffles would be made anew.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stage(df: DataFrame, label: str = "stage", rows_per_file: int = 0, outlives: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, so the several outputs of a report read one small table instead of
    the base data again, and the planner sees the true size of the table. With ``rows_per_file`` no file holds
    more rows: a bound on what a task reads for rows that grow in its memory, where bytes say little as they are packed.
    ``outlives`` is as in ``new_path``.
    """
    spark = df.sparkSession
    path = new_path(spark, label, outlives)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

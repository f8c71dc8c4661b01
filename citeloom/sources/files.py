"""Readers and writers for landed files and stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from citeloom.functions.scalars import replace_in_string
from citeloom.operators.joins import join_split
from citeloom.sources.schemas import COUNTRY_FEATURES

CORRUPT = "_corrupt_record"


Schema = T.StructType | str


def _fields(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _with_corrupt(schema: Schema) -> T.StructType:
    """The declared schema plus a column that keeps lines which do not parse."""
    return T.StructType([*_fields(schema).fields, T.StructField(CORRUPT, T.StringType())])


def scan_nested_json(spark: SparkSession, path: str | Sequence[str], schema: Schema, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines with nested documents; plain or compressed, any number of files."""
    read = _with_corrupt(schema) if keep_corrupt else schema
    return spark.read.schema(read).option("mode", "PERMISSIVE").json(path)


def scan_gzip_jsonl(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Gzip parts of a JSON-lines dump, one task per part.

    A gzip part cannot be split, so the rows are spread again before heavy work.
    """
    return spark.read.schema(schema).option("pathGlobFilter", "*.gz").json(path).hint("rebalance")


def scan_manifest(spark: SparkSession, manifest: str, schema: Schema, rewrite: Mapping[str, str]) -> DataFrame:
    """The parts a manifest lists (``entries[].url``), with url prefixes rewritten.

    A manifest is a short list of files, so its paths are read by the driver.
    """
    entries = spark.read.option("multiLine", True).schema("entries array<struct<url:string>>").json(manifest)
    url: Column = F.col("entry.url")
    for old, new in rewrite.items():
        url = replace_in_string(url, old, new)
    paths = [r.url for r in entries.select(F.explode("entries").alias("entry")).select(url.alias("url")).collect()]
    return spark.read.schema(schema).json(paths)


def scan_json_dump(spark: SparkSession, path: str, schema: Schema, multi_line: bool = True) -> DataFrame:
    """A dump that is one JSON array per file, or (``multi_line=False``) one array per line.

    A file that is one array is read by one task, so its rows are spread over the cluster
    after the read. Dumps of one array per line are split like any text.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path).hint("rebalance")


def scan_paged_append(
    spark: SparkSession, path: str, schema: Schema, score: str | None = None, first_page: bool = False
) -> DataFrame:
    """Landed result pages as one table, with the page each row came from.

    A page is one JSON object with ``data`` (rows) and ``max_score``, and optionally the ``search`` it
    answers and its number ``page_number`` there. Without ``first_page`` rows that have no score of their own take the
    one of their page. With it the pages of a search follow their first page: its rows keep their own
    scores, and all rows of later pages get its ``max_score`` in place of theirs. A page that names no search
    belongs to that of its folder; without numbers the names of files tell the order.
    """
    page = T.StructType(
        [
            T.StructField("search", T.StringType()),
            T.StructField("page_number", T.LongType()),
            T.StructField("max_score", T.DoubleType()),
            T.StructField("data", T.ArrayType(_fields(schema))),
        ]
    )
    file = F.input_file_name()
    pages = spark.read.schema(page).option("recursiveFileLookup", True).json(path)
    pages = pages.withColumn("page", file).withColumn("search", F.coalesce("search", F.regexp_replace("page", "/[^/]*$", "")))
    if score and first_page:
        order = F.struct(F.col("page_number").alias("number"), F.col("page").alias("name"))
        first = pages.groupBy("search").agg(F.min(order).alias("_first"), F.min_by("max_score", order).alias("_stamp"))
        pages = join_split(pages.withColumn("_order", order), first, ["search"])
        rows = pages.select("page", (F.col("_order") == F.col("_first")).alias("_is_first"), "_stamp", F.explode("data").alias("_d"))
        rows = rows.select("page", "_is_first", "_stamp", "_d.*")
        return rows.withColumn(score, F.when(F.col("_is_first"), F.col(score)).otherwise(F.col("_stamp"))).drop("_is_first", "_stamp")
    rows = pages.select("page", "max_score", F.explode("data").alias("_d")).select("page", "max_score", "_d.*")
    if score:
        rows = rows.withColumn(score, F.coalesce(score, "max_score"))
    return rows.drop("max_score")


def scan_geo_features(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Country features of a feature collection (per file or per line); the geometry stays text."""
    whole = spark.read.schema(COUNTRY_FEATURES).option("multiLine", multi_line).json(path)
    return whole.select(F.explode("features").alias("f")).select(
        F.col("f.properties.ISO_A2").alias("country_code"), F.col("f.properties.ADMIN").alias("admin"), "f.geometry"
    )


def scan_table_filtered(spark: SparkSession, name: str, where: Column | str | None = None, cs: Sequence[str] = ("*",)) -> DataFrame:
    """Rows and columns of a stored table (catalog name, or path with a slash)."""
    table = spark.read.parquet(name) if "/" in name else spark.table(name)
    return (table if where is None else table.where(where)).select(*cs)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a stored table (catalog name, or path with a slash)."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in path:
        writer.save(path)
    else:
        writer.saveAsTable(path)


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


def label_counts(nodes: DataFrame, level: int) -> DataFrame:
    """Number of rows per node of one level: the table that goes to the TSV file."""
    return nodes.where(F.col("level") == level).groupBy("category_id", "display_name").agg(F.count(F.lit(1)).alias("nb"))

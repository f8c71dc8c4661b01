"""Token ids as ORC files in document order.

ORC keeps integers in run-length-encoded stripes with an index every ``ROW_INDEX`` rows and a
Bloom filter on ``doc_id``. Stripes are read in parallel, and a search for some documents
skips files, stripes and row groups by their ranges and filters.

Cases: a null text is an empty one (the end id alone); documents with a null id come last;
rows that repeat an id are ordered by a hash of the text, and equal rows follow each other, so
each keeps a place of its own; other columns of the input are ignored; no rows give no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from citeloom.llm.common import text_chunks, utf8
from citeloom.llm.tokens import encoder

SCHEMA = "doc_id bigint, place bigint, n_tokens int, ids array<int>"
ROW_INDEX = 1000
STRIPE_BYTES = 32 << 20
# A place has the number of the file above this many bits.
_ROW_BITS = 33


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, lower_case: bool) -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending order of ``doc_id``.

    ``place`` grows with that order. One shuffle moves the texts, which are smaller than their ids.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(tokenizer, lower_case)
        for chunk in text_chunks(batches, limit=4 << 20):
            flat, bounds = work.encode_flat(chunk.column("text").to_pylist())
            values = pa.array(np.insert(flat, bounds[1:], end_id).astype("<i4"))
            ends = bounds + np.arange(len(bounds))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(np.diff(ends).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)],
                names=["doc_id", "n_tokens", "ids"],
            )

    order = [F.col("doc_id").asc_nulls_last(), F.col("hash")]
    ordered = docs.select("doc_id", utf8(), F.xxhash64("text").alias("hash")).repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = ordered.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, n_tokens int, ids array<int>")
    (
        encoded.select("doc_id", F.monotonically_increasing_id().alias("place"), "n_tokens", "ids")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", ROW_INDEX)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The written rows; with ``doc_ids`` those documents only, pruned by the files' metadata."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: the number of ids before it, its own number, their crc32."""

    def checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B")
            ends = ids.offsets.to_numpy().tolist()
            crc = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("place"), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "place", "n_tokens", "ids_crc32"],
            )

    file = F.shiftright("place", _ROW_BITS).alias("file")
    rows = read_token_files(spark, path)
    # One row per file goes through the second window.
    sizes = rows.groupBy(file).agg(F.sum("n_tokens").alias("size"))
    before_file = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("size").over(before_file), F.lit(0)).alias("file_start"))
    inside = W.partitionBy("file").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    read = rows.select("doc_id", "place", "ids").mapInArrow(checksums, "doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint")
    return (
        read.withColumn("file", file)
        .withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(starts, "file")
        .select("doc_id", (F.col("file_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )

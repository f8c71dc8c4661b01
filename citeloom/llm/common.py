"""Helpers the operators over training documents share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Text bytes a task works on at once; the arrays made from them are a small multiple of it.
CHUNK_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str = "text") -> Column:
    """The text as UTF-8 bytes; null stays null."""
    return F.col(text).cast("binary").alias("text")


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``limit`` text bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([len(t) if t is not None else 0 for t in (x.as_buffer() for x in batch.column(text))], dtype=np.int64)
        begin, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if row > begin and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        yield batch.slice(begin)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

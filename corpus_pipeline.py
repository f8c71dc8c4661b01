"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a data frame that is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.

1. ``quality_rules`` drops documents that fail the base rules or the divergence test.
2. ``line_dedup`` deletes repeated runs of lines, and repeated passages of one or two long lines;
   documents that consist of nothing else go.
3. ``near_duplicates`` keeps the document of smallest id of each group.
4. ``decontamination`` drops documents that hold a window of the benchmark.
5. ``packing`` returns the pieces of token sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from citeloom.llm import decontaminate, line_dedup, near_dup, packing, quality
from citeloom.llm.common import read_table
from citeloom.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_low_quality(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(docs, line_dedup.PASSAGE_WORDS)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: Divergence from counted references and tokenization have no SQL; tests/llm holds the stages
#: against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

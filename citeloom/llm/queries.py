"""Registered queries of the operators over training documents, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citeloom.llm import decontaminate, language, licenses, line_dedup, near_dup, packing, quality, runs, secrets, sharding, suffix_dedup, token_files, whitening
from citeloom.llm.common import read_table
from citeloom.session import new_path, split_hot_keys


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2, lower_case=True)
    return token_files.token_index(spark, path)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language.learn(docs.filter(~F.coalesce(_held_out(), F.lit(False))))
    found = language.predict_languages(docs, model)
    return found.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "languages")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_hash")


def op8_line_dedup(spark: SparkSession, sf_dir: str, passage_words: int | None = None) -> DataFrame:
    out = line_dedup.delete_repeated_lines(read_table(spark, sf_dir, "documents"), ("n_units", "n_deleted", "n_runs"), passage_words=passage_words)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return out.select("doc_id", "n_units", "n_deleted", "n_runs", digest)


def op8_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup with passages of one or two long lines."""
    return op8_line_dedup(spark, sf_dir, line_dedup.PASSAGE_WORDS)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_strings(read_table(spark, sf_dir, "documents")).drop("kept", "spans")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(_planted(read_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    each = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    rows = found.withColumn("longest", longest)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(F.expr("1000 * longest.length DIV -longest.period")).alias("exponent_milli"),
        F.sha2(each.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _planted(docs: DataFrame) -> DataFrame:
    """The documents; in those whose hashed id ends in 0, a stretch of words is repeated to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    places = docs.select("doc_id", "text", F.floor(h / 10).cast("bigint").alias("g"), F.when(chosen, words).alias("w"))
    n = F.size("w").cast("bigint")
    sized = places.withColumn("n", n).withColumn("a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
    sized = sized.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    again = F.expr("concat(slice(w, 1, a), transform(sequence(0, CAST(n - a - 1 AS INT)), i -> w[a + i % p]))")
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_secret_scan,
        op2_quality_rules,
        op3_token_files,
        op4_near_duplicates,
        op5_packing,
        op6_language_id,
        op7_decontamination,
        op8_line_dedup,
        op8_passage_dedup,
        op9_suffix_dedup,
        op10_license_scan,
        op11_periodic_runs,
        op12_whitening,
        op13_sharding,
    )
    return {name: _split(run) for name, run in ({f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}).items()}


def _split(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query in a session whose joins split hot keys."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(split_hot_keys(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def statements() -> dict[str, str]:
    return {"op8_line_dedup": line_dedup.QUERY_SQL, "op8_passage_dedup": line_dedup.PASSAGE_SQL}

"""Citation baselines per discipline, document type and year, and scores against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citeloom.functions.predicates import filter_year_range
from citeloom.operators.joins import join_split
from citeloom.operators.ranking import percent_rank_of_counts
from citeloom.plans.taxonomy import NOT_APPLICABLE, NO_ANCESTOR
from citeloom.session import stage

CELL = ["parent_1", "pubtype_id", "year"]


def discipline_records(
    records: DataFrame, categories: DataFrame, years: tuple[int, int] | None = None, record: str = "lens_id"
) -> DataFrame:
    """Each record once per discipline that any of its categories belongs to.

    ``records`` has year, pubtype_id, citations and is_retracted; retracted records and
    records without a unified type take no part.
    """
    counted = filter_year_range(records, "year", years).where(
        (~F.col("is_retracted")) & F.col("pubtype_id").isNotNull()
    )
    linked = (
        categories.where(F.col("parent_1").isNotNull() & ~F.col("parent_1").isin(NOT_APPLICABLE, NO_ANCESTOR))
        .select(record, "parent_1")
        .distinct()
    )
    return linked.join(counted.select(record, "year", "pubtype_id", "citations"), record)


def citation_baseline(
    records: DataFrame, categories: DataFrame, years: tuple[int, int] | None = None, record: str = "lens_id"
) -> DataFrame:
    """Number of records and mean, extremes and distinct count of citations per cell."""
    return discipline_records(records, categories, years, record).groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("nb_records"),
        F.avg("citations").alias("avg_citations"),
        F.min("citations").alias("min_citations"),
        F.max("citations").alias("max_citations"),
        F.count_distinct("citations").alias("nb_distinct"),
    )


def citation_distribution(
    records: DataFrame, categories: DataFrame, years: tuple[int, int] | None = None, record: str = "lens_id"
) -> DataFrame:
    """Number of records per cell and citation count."""
    return _distribution(discipline_records(records, categories, years, record))


def _distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CELL, "citations").agg(F.count(F.lit(1)).alias("nb_records"))


def normalised_impact(
    records: DataFrame, categories: DataFrame, years: tuple[int, int] | None = None, record: str = "lens_id"
) -> DataFrame:
    """Per record and discipline: citations over the mean of the cell, percentile and top flags.

    An extension: the original names these figures but does not compute them.
    """
    # Mean and ranks both follow from the distribution, and that from the rows, which are joined once.
    rows = stage(discipline_records(records, categories, years, record), "members")
    counts = stage(_distribution(rows), "distribution")
    means = counts.groupBy(*CELL).agg(
        (F.sum(F.col("citations") * F.col("nb_records")) / F.sum(F.when(F.col("citations").isNotNull(), F.col("nb_records")))).alias("_mean")
    )
    known = counts.where(F.col("citations").isNotNull())
    ranks = percent_rank_of_counts(known, CELL, "citations", "nb_records", "percentile")
    scores = join_split(ranks, means, CELL).select(
        *CELL, "citations", "percentile",
        F.when(F.col("_mean") > 0, F.col("citations") / F.col("_mean")).alias("cnci"),
        (F.col("percentile") >= 0.90).alias("is_top10"),
        (F.col("percentile") >= 0.99).alias("is_top01"),
    )
    return join_split(rows, scores, [*CELL, "citations"], "left")

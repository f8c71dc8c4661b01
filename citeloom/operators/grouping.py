"""Grouping operators.

Statistics of a record or category that the reports need next to each row are built as
"group, then join back" rather than as a window: the group step combines on the map side and
the join can be split at run time, so one record holding a large part of all rows does not
end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from citeloom.functions.scalars import settled
from citeloom.operators.joins import join_split, union_all
from citeloom.session import stage


def attach_group(df: DataFrame, keys: Sequence[str], *stats: Column) -> DataFrame:
    """Add per-key statistics to every row; rows with a null key form a group too.

    ``df`` is read twice: stage it first where that is dear.
    """
    return join_split(df, df.groupBy(*keys).agg(*stats), keys, "left")


def distinct_count_per(df: DataFrame, keys: Sequence[str], c: str, out: str) -> DataFrame:
    """Number of distinct non-null values per key, next to every row."""
    return attach_group(df, keys, F.count_distinct(c).alias(out))


def all_null_flag(df: DataFrame, key: str, c: str, out: str) -> DataFrame:
    """True on all rows of a key for which no row has a value in ``c``."""
    return attach_group(df.where(F.col(key).isNotNull()), [key], (F.count(c) == 0).alias(out))


def filter_flagged(records: DataFrame, lines: DataFrame, key: str, c: str) -> DataFrame:
    """Records with their lines, without the lines that only say "none".

    A record without lines keeps one row. Of several lines those with a null ``c`` are
    dropped, and with them a record that has no other line. ``nb_rows`` is the number of
    rows a record has left. The counts come from the lines alone, so the records are read
    once.
    """
    n, filled = F.col("_n"), F.col("_filled")
    counts = lines.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count(c).alias("_filled"))
    counted = stage(records.join(counts, key, "left"), "counted")
    listed = join_split(lines, counted.where((n == 1) | (filled > 0)), [key]).where((n == 1) | F.col(c).isNotNull())
    unlisted = counted.where(n.isNull())
    return (
        union_all(listed, unlisted)
        .withColumn("nb_rows", F.when(n > 1, filled).otherwise(F.lit(1)))
        .drop("_n", "_filled")
    )


#: Hexadecimal digits of a digest that tell cells apart, so a count per cell is at most 65,536 rows.
CELL_DIGITS = 4
#: Keys of one cell that are put in order at once.
CELL_KEYS = 65_536


def sample_keys(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of ``n`` distinct keys picked by a seeded digest, the same on every run.

    The keys of the n smallest digests are those up to one boundary. It is found by counting keys
    per leading digits, then inside the cell in which the n-th key lies, until that cell is
    small; only its keys are put in order. The rows are then picked by a filter on their own digest.
    """
    def digest() -> Column:
        return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))

    keys = stage(df.select(key).where(F.col(key).isNotNull()).distinct().select(F.col(key).alias("_key"), digest().alias("_digest")), "keys")
    known = df.where(F.col(key).isNotNull())
    prefix, rest = "", n
    while True:
        cell = F.substring("_digest", 1, len(prefix) + CELL_DIGITS).alias("_cell")
        inside = keys.where(F.col("_digest").startswith(prefix)) if prefix else keys
        counts = inside.groupBy(cell).agg(F.count(F.lit(1)).alias("_n"))
        placed = counts.withColumn("_upto", F.sum("_n").over(W.orderBy("_cell")))
        hit = placed.where(F.col("_upto") >= rest).orderBy("_cell").first() if rest > 0 else None
        if hit is None:
            # Fewer keys than asked for, or none asked for.
            return known if n > 0 else known.limit(0)
        prefix, rest = hit["_cell"], rest - (hit["_upto"] - hit["_n"])
        if hit["_n"] <= CELL_KEYS or len(prefix) >= 32:
            break
    ordered = keys.where(F.col("_digest").startswith(prefix)).orderBy("_digest", "_key").limit(rest)
    last = ordered.agg(F.max(F.struct("_digest", "_key")).alias("last")).first()["last"]
    return known.where((digest() < last["_digest"]) | ((digest() == last["_digest"]) & (F.col(key) <= F.lit(last["_key"]))))


def fractional_count(
    df: DataFrame, record: str, keys: Sequence[str], out: str = "nb_records", distinct: bool = False
) -> DataFrame:
    """Every record counts 1 in total, spread evenly over its rows; summed per ``keys``.

    With ``distinct`` it is spread over the different ``keys`` of the record instead. Rows
    without a record id are left out first, also because the filter then stands in both
    inputs of the join, which lets them share one scan and one exchange.
    """
    known = df.where(F.col(record).isNotNull()).select(record, *keys)
    rows = F.lit(1) if distinct else F.col("_rows")
    cells = known.distinct() if distinct else known.groupBy(record, *keys).agg(F.count(F.lit(1)).alias("_rows"))
    spread = attach_group(cells, [record], F.sum(rows).alias("_all"))
    return spread.groupBy(*keys).agg(settled(F.sum(rows / F.col("_all"))).alias(out))


def two_level_totals(df: DataFrame, parent: Sequence[str], child: Sequence[str], value: str, leaf: str, total: str) -> DataFrame:
    """Leaf totals with the total of their parent on the same row."""
    leaves = df.groupBy(*parent, *child).agg(F.sum(value).alias(leaf))
    return attach_group(leaves, parent, F.sum(leaf).alias(total))


def distinct_on_key(df: DataFrame, cs: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the stated order.

    Written as ``row_number() = 1`` because the planner turns that into a limit per map
    task, so of a hot key each task sends only one row.
    """
    first = W.partitionBy(*cs).orderBy(*order_by)
    return df.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


def dedupe_keep_best(df: DataFrame, key: Sequence[str], score: str, tie: Sequence[str]) -> DataFrame:
    """One row per key: the highest score, ties to the smallest ``tie``."""
    order = [F.col(score).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]]
    return distinct_on_key(df, key, order)


def count_distinct_pair(df: DataFrame, a: str, b: str, out: str = "nb_pairs") -> DataFrame:
    """Distinct (a, b) pairs over the whole table; pairs with a null side count too."""
    return df.agg(F.count_distinct(F.struct(a, b)).alias(out))


def weighted_median(value: str, weight: str) -> Column:
    """Exact interpolated median of values that stand for ``weight`` rows each."""
    return F.expr(f"percentile({value}, 0.5D, {weight})")


def date_histogram(
    df: DataFrame, ts: str, metric: str, keys: Sequence[str] = (), grain: str = "year", bucket: str = "bucket"
) -> DataFrame:
    """Calendar buckets with count, mean, extremes and number of distinct values."""
    start = F.date_format(F.date_trunc(grain, F.col(ts)), "yyyy-MM-dd")
    return df.groupBy(*keys, start.alias(bucket)).agg(
        F.count(F.lit(1)).alias("nb_records"),
        F.avg(metric).alias("avg_value"),
        F.min(metric).alias("min_value"),
        F.max(metric).alias("max_value"),
        F.count_distinct(metric).alias("nb_distinct"),
    )


def terms_agg(df: DataFrame, c: str, n: int, descending: bool = False) -> DataFrame:
    """The first ``n`` values of a field in value order, with their counts."""
    order = F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("nb_records")).orderBy(order).limit(n)


def nested_agg(df: DataFrame, outer: str, inner: str, n: int, metrics: Sequence[Column]) -> DataFrame:
    """Buckets inside buckets: per outer bucket its metrics and the first ``n`` inner ones."""
    top = df.groupBy(outer).agg(F.count(F.lit(1)).alias("nb_outer"), *metrics)
    cells = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("nb_inner"))
    order = W.partitionBy(outer).orderBy(F.col(inner).asc_nulls_last())
    listed = cells.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)
    return listed.join(top, outer)


def global_agg(df: DataFrame, distinct: str, total: str) -> DataFrame:
    """Number of distinct values of one field and the sum of another, over all rows."""
    return df.agg(
        F.count_distinct(distinct).alias("nb_distinct"), F.sum(total).alias("total"), F.count(F.lit(1)).alias("nb_records")
    )


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y ~ x."""
    return df.agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    )


def children_per_parent(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Distinct (child, parent) edges with the number of children of the parent."""
    edges = df.select(child, parent).na.drop("any").distinct()
    return attach_group(edges, [parent], F.count(F.lit(1)).alias("nb_children"))

"""Arrays, structs and maps: the flattening half of the input jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def explode_list(df: DataFrame, keys: Sequence[str], path: str, out: str, outer: bool = True) -> DataFrame:
    """One row per element; with ``outer`` a parent with an empty or missing list keeps one null row."""
    unnest = F.explode_outer if outer else F.explode
    return df.select(*keys, unnest(path).alias(out))


def struct_to_columns(df: DataFrame, keys: Sequence[str], struct: str) -> DataFrame:
    """The fields of a struct column next to the parent keys."""
    return df.select(*keys, f"{struct}.*")


def flatten_nested(df: DataFrame, keys: Sequence[str], path: str, outer: bool = False) -> DataFrame:
    """Child table of an array of structs; without ``outer`` empty parents give no row."""
    return struct_to_columns(explode_list(df, keys, path, "_e", outer), keys, "_e")


def posexplode_list(
    df: DataFrame, keys: Sequence[str], path: str, position: str, out: str, outer: bool = True
) -> DataFrame:
    """Element with its 1-based place in the list (null place for an empty list)."""
    unnest = F.posexplode_outer if outer else F.posexplode
    return df.select(*keys, unnest(path).alias("_p", out)).select(
        *keys, (F.col("_p") + 1).alias(position), out
    )


def array_length(c: str | Column) -> Column:
    """List size, 0 where there is no list."""
    return F.coalesce(F.size(c), F.lit(0))


def array_filter_map(arr: str | Column, level: str | Column, delta: int = 0, field: str = "id") -> Column:
    """``field`` of the elements whose ``level`` equals the row's level plus ``delta``."""
    wanted = (F.col(level) if isinstance(level, str) else level) + F.lit(delta)
    kept = F.filter(arr, lambda e: e["level"] == wanted)
    return F.transform(kept, lambda e: e[field])


def array_element(c: str | Column, n: int) -> Column:
    """The ``n``-th element (1-based) or null."""
    return F.try_element_at(c, F.lit(n))


def struct_default(c: str | Column, fields: dict[str, str | None], types: T.StructType) -> Column:
    """A missing struct replaced by one built from sentinels."""
    filler = F.struct(
        *[F.lit(fields.get(f.name)).cast(f.dataType).alias(f.name) for f in types.fields]
    )
    return F.coalesce(F.col(c) if isinstance(c, str) else c, filler)


def pivot_type_to_column(
    df: DataFrame, key: str, type_col: str, value_col: str, types: dict[str, str], order_col: str
) -> DataFrame:
    """First value of each type per key, one output column per type.

    ``types`` maps the type to the name of its column; ``order_col`` says which is first.
    """
    picks = [
        F.min_by(
            F.when(F.col(type_col) == kind, F.col(value_col)),
            F.when(F.col(type_col) == kind, F.col(order_col)),
        ).alias(out)
        for kind, out in types.items()
    ]
    return df.groupBy(key).agg(*picks)


def dict_index_to_rows(
    df: DataFrame, keys: Sequence[str], json_col: str, value_type: str, key_out: str, value_out: str
) -> DataFrame:
    """A JSON object keyed by bucket as rows (bucket, value)."""
    buckets = F.from_json(json_col, f"map<string,{value_type}>")
    return df.select(*keys, F.explode(buckets).alias(key_out, value_out))

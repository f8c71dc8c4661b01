"""Row filters, null handling and the boolean search definition."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T


def project_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Column subset with new names: ``{old: new}``."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def drop_columns(df: DataFrame, cs: Sequence[str]) -> DataFrame:
    return df.drop(*cs)


def filter_year_range(df: DataFrame, c: str, years: tuple[int, int] | None) -> DataFrame:
    """Rows whose year lies in the window, both ends included; no window keeps all rows."""
    return df if years is None else df.where(F.col(c).between(*years))


def filter_null_any(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def filter_null_subset(df: DataFrame, cs: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(cs))


def fill_sentinel(df: DataFrame, mapping: Mapping[str, Any]) -> DataFrame:
    """Null replaced by the sentinel of its column."""
    return df.na.fill(dict(mapping))


def mask_when(df: DataFrame, c: str, cond: Column, value: Any) -> DataFrame:
    """``value`` where the condition holds, else the column as it was."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(c, F.when(cond, new).otherwise(F.col(c)))


def filter_in_list(df: DataFrame, c: str, values: Sequence[Any], negate: bool = False) -> DataFrame:
    """Membership in a literal list; long lists belong in a table and a semi join."""
    test = F.col(c).isin(list(values))
    return df.where(~test if negate else test)


def filter_contains(df: DataFrame, c: str, text: str) -> DataFrame:
    return df.where(F.col(c).contains(text))


def filter_optional_threshold(df: DataFrame, c: str, limit: float | None = None) -> DataFrame:
    return df if limit is None else df.where(F.col(c) >= F.lit(limit))


def fix_duplicate_labels(
    df: DataFrame, id_col: str, label: str, drop_ids: Sequence[str], relabel: Mapping[str, str]
) -> DataFrame:
    """Drop ids whose label repeats another one, relabel homonyms, keep the raw label."""
    renamed = reduce(
        lambda acc, item: F.when(F.col(id_col) == item[0], F.lit(item[1])).otherwise(acc),
        relabel.items(),
        F.col(label),
    )
    kept = filter_in_list(df, id_col, drop_ids, negate=True)
    return kept.withColumn(f"raw_{label}", F.col(label)).withColumn(label, renamed)


# --- boolean search definitions -------------------------------------------------------


def _test_field(
    schema: T.StructType, path: Sequence[str], base: Callable[[str], Column], test: Callable[[Column], Column]
) -> Column:
    """Apply ``test`` to a dotted field; inside arrays any matching element is enough."""
    name, rest = path[0], path[1:]
    column, kind = base(name), schema[name].dataType

    def descend(value: Column, value_type: T.DataType) -> Column:
        if isinstance(value_type, T.ArrayType):
            return F.exists(value, lambda e: descend(e, value_type.elementType))
        if rest:
            return _test_field(value_type, rest, lambda n: value[n], test)
        return test(value)

    return descend(column, kind)


_RANGE = {
    "gte": lambda c, v: c >= v,
    "gt": lambda c, v: c > v,
    "lte": lambda c, v: c <= v,
    "lt": lambda c, v: c < v,
}


def _all(parts: Sequence[Column]) -> Column:
    return reduce(Column.__and__, parts, F.lit(True))


def bool_predicate(spec: Mapping[str, Any], schema: T.StructType) -> Column:
    """Turn a nested search definition into one column.

    ``bool`` takes ``must`` and ``filter`` (AND), ``should`` (OR) and ``must_not`` (no clause
    is true; an unknown value does not exclude). ``match`` and ``term`` test equality, also
    inside arrays of structs, and ``range`` takes ``gte``, ``gt``, ``lte`` and ``lt``. Several
    clauses in one definition and several fields in one clause all have to hold. Anything
    else is refused.
    """
    if not spec:
        raise ValueError("an empty definition")
    return _all([_clause(kind, body, schema) for kind, body in spec.items()])


def _clause(kind: str, body: Mapping[str, Any], schema: T.StructType) -> Column:
    if kind == "bool":
        if unknown := set(body) - {"must", "filter", "should", "must_not"}:
            raise ValueError(f"unknown parts of bool: {sorted(unknown)}")

        def inner(name: str) -> list[Column]:
            given = body.get(name) or []
            return [bool_predicate(s, schema) for s in ([given] if isinstance(given, Mapping) else given)]

        parts = inner("must") + inner("filter")
        if should := inner("should"):
            parts.append(reduce(Column.__or__, should))
        parts += [~F.coalesce(c, F.lit(False)) for c in inner("must_not")]
        return _all(parts)
    if kind not in ("match", "term", "range"):
        raise ValueError(f"unknown clause {kind!r}")
    if not body:
        raise ValueError(f"{kind} without a field")
    return _all([_field_clause(kind, field, wanted, schema) for field, wanted in body.items()])


def _field_clause(kind: str, field: str, wanted: Any, schema: T.StructType) -> Column:
    if kind == "range":
        if not wanted or set(wanted) - set(_RANGE):
            raise ValueError(f"a range takes some of {sorted(_RANGE)}, not {sorted(wanted)}")

        def test(c: Column) -> Column:
            number = c.cast("double") if isinstance(_type_of(schema, field), T.NumericType) else c
            return _all([_RANGE[bound](number, F.lit(v)) for bound, v in wanted.items()])
    elif isinstance(wanted, (Mapping, list)):
        raise ValueError(f"{kind} compares with one value, not with {wanted!r}")
    else:
        test = (lambda c: c.isNull()) if wanted is None else (lambda c: c == F.lit(wanted))
    return _test_field(schema, field.split("."), F.col, test)


def _type_of(schema: T.StructType, field: str) -> T.DataType:
    kind: T.DataType = schema
    for name in field.split("."):
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        kind = kind[name].dataType
    return kind


def combine_query_params(
    schema: T.StructType, topic: Mapping[str, Any], shared: Sequence[Mapping[str, Any]] = (),
    year_col: str | None = None, years: tuple[int, int] | None = None,
) -> Column:
    """A topic filter AND the filters shared by all searches AND one year window."""
    whole = reduce(Column.__and__, [bool_predicate(s, schema) for s in (topic, *shared)])
    return whole if years is None else whole & F.col(year_col).between(*years)

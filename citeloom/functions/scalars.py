"""Scalar column functions used by the jobs and the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_prefix(c: ColumnOrName, prefix: str) -> Column:
    """Remove every occurrence of an id namespace from an id."""
    return F.replace(_col(c), F.lit(prefix), F.lit(""))


def replace_in_string(c: ColumnOrName, old: str, new: str) -> Column:
    return F.replace(_col(c), F.lit(old), F.lit(new))


def format_thousands(c: ColumnOrName) -> Column:
    """Whole number with ``,`` between thousands and no exponent."""
    return F.format_number(_col(c), 0)


def round_after_fetch(c: ColumnOrName, digits: int = 0) -> Column:
    """Half-to-even rounding: what the report tables apply to finished results."""
    return F.bround(_col(c), digits)


def round_in_query(c: ColumnOrName, digits: int = 0) -> Column:
    """Half-away-from-zero rounding: what the grouped queries apply to means and medians."""
    return F.round(_col(c), digits)


def settled(c: Column) -> Column:
    """A sum of fractions to 9 places.

    The last digits of such a sum depend on the order of addition. Without them equal sums
    are equal, so that thresholds, ties and half-way roundings come out the same every time.
    """
    return F.round(c, 9)


def n_choose_2(c: ColumnOrName) -> Column:
    """Number of unordered pairs, kept as a double so that no decimal scale cuts it."""
    n = _col(c).cast("double")
    return n * (n - F.lit(1.0)) / F.lit(2.0)


def pair_sorted(a: ColumnOrName, b: ColumnOrName) -> tuple[Column, Column]:
    """Order-free pair as (smaller, larger)."""
    return F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b))


def if_null_then(a: ColumnOrName, b: ColumnOrName, text: str) -> Column:
    """``text`` where ``a`` is missing although ``b`` is known, else ``a``."""
    return F.when(_col(a).isNull() & _col(b).isNotNull(), F.lit(text)).otherwise(_col(a))


def year_range(start: ColumnOrName | int, end: ColumnOrName | int) -> Column:
    """Inclusive list of years."""
    bounds = [F.lit(v) if isinstance(v, int) else _col(v) for v in (start, end)]
    return F.sequence(*bounds)


def default_year_window(length: int = 5) -> tuple[Column, Column]:
    """The last ``length`` calendar years, this year included."""
    this_year = F.year(F.current_date())
    return this_year - F.lit(length - 1), this_year


def label_text(fmt: str, *cs: ColumnOrName) -> Column:
    return F.format_string(fmt, *[_col(c) for c in cs])


def scaled_estimates(c: ColumnOrName, divisors: dict[str, float]) -> list[Column]:
    """Placeholder figures: ``c`` divided and rounded up, one column per divisor."""
    return [F.ceil(_col(c) / F.lit(float(d))).cast("long").alias(name) for name, d in divisors.items()]


def bin_edges(top: Column, plus_one: bool = True) -> list[Column]:
    """Five cut points of the map legend, derived from the largest value."""
    shift = F.lit(1 if plus_one else 0)
    inner = [F.ceil(top / F.lit(float(part))) + shift for part in (10, 5, 2)]
    return [F.lit(1), *inner, top]


def bin_of(value: ColumnOrName, edges: Sequence[Column]) -> Column:
    """1-based bin of a value; the last bin is closed on both sides, outside is null.

    With a small maximum the cut points can fall out of order, so they are sorted
    first, as a legend needs them to be.
    """
    v = _col(value).cast("double")
    cuts = F.sort_array(F.array(*[e.cast("double") for e in edges]))
    passed = sum((F.element_at(cuts, n) <= v).cast("int") for n in range(2, len(edges)))
    inside = (v >= F.element_at(cuts, 1)) & (v <= F.element_at(cuts, len(edges)))
    return F.when(inside, passed + 1)

"""Shards of nearly equal bytes that keep documents of equal text together, natively.

Documents of one text are an atomic group, of the sum of their sizes. Groups are ordered by the
hash of their text and the order is cut into contiguous shards: the capacity is the smallest one
that a greedy filling of all shards can keep (minimax), found by binary search.

Group sizes never travel as a whole. Neighbouring groups of one hash prefix are a cell, and a
bounded number of cells is read with their sums (``2 ** CELL_BITS`` at first). A cell of one group
cannot be cut; any other may be, at places not known yet. Filling with no cell ever cut gives a
capacity that suffices, filling with cells cut anywhere one that no filling goes below. Where the
two differ, the cells in which a cut can fall are read again, ``2 ** ZOOM_BITS`` times finer, until
they agree. Each reading divides the uncertain cells, so their number does not follow the input.

Any cuts that keep to the capacity are a minimax partition. Filling greedily would leave the last
shards short, and empty where one group alone is larger than the mean. So large groups count as
shards of their own, the stretches between them get equal parts, and every cut is set at the known
place nearest to its part, between the last place that the capacity allows and the first from which
the rest still fits.

Cases: null and empty text are one group of the size of an empty text; rows that repeat an id, or
have none, are rows like others; columns beside ``doc_id`` and ``text`` are ignored; more shards
than groups leave shards empty; no rows give no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window as W, functions as F

from citeloom.session import stage

#: Bytes a document counts besides its text.
OVERHEAD = 16
#: Bits of the hash that tell cells apart at first, and how many more each reading adds.
CELL_BITS = 14
ZOOM_BITS = 6
_HASH_BITS = 64
_ROW_BITS = 33

# A cell: (first hash, bits it shares, bytes, groups).
Cell = tuple[int, int, int, int]


def _cells(groups: DataFrame, bits: int) -> list[Cell]:
    """Sums of the groups that share ``bits`` bits of their hash, in the order of hashes."""
    width = _HASH_BITS - bits
    prefix = F.shiftright("group", width)
    sums = groups.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return sorted((r.prefix << width, bits, r.bytes, r.n) for r in sums.collect())


def _finer(groups: DataFrame, cells: list[Cell], chosen: set[int]) -> list[Cell]:
    """The cells with the ``chosen`` places read again, more finely."""
    by_bits: dict[int, list[int]] = {}
    for k in chosen:
        by_bits.setdefault(cells[k][1], []).append(cells[k][0])
    parts = []
    for bits, starts in by_bits.items():
        width = _HASH_BITS - bits
        inside = groups.filter(F.shiftright("group", width).isin([start >> width for start in starts]))
        parts += _cells(inside, min(_HASH_BITS, bits + ZOOM_BITS))
    return sorted([c for k, c in enumerate(cells) if k not in chosen] + parts)


class Filling:
    """Greedy filling of shards from cells in order."""

    def __init__(self, cells: list[Cell], shards: int) -> None:
        self.cells, self.shards = cells, shards
        self.ends = list(accumulate(c[2] for c in cells))
        self.total = self.ends[-1]

    def whole(self, capacity: int) -> list[int]:
        """Bytes before each cut when no cell is cut."""
        at, cuts = 0, []
        for _ in range(self.shards):
            k = bisect_right(self.ends, at + capacity)
            at = self.ends[k - 1] if k else 0
            cuts.append(at)
        return cuts

    def anywhere(self, capacity: int) -> list[int]:
        """The same when a cell of several groups may be cut at any byte."""
        at, cuts = 0, []
        for _ in range(self.shards):
            to = at + capacity
            k = bisect_right(self.ends, to)
            if k == len(self.ends):
                at = self.total
            elif self.cells[k][3] > 1:
                at = to
            else:
                at = self.ends[k - 1] if k else 0
            cuts.append(at)
        return cuts

    def smallest(self, fill, least: int) -> int:
        """The smallest capacity from ``least`` on with which ``fill`` reaches the end."""
        low, high = least, max(least, self.total)
        while low < high:
            middle = (low + high) // 2
            if fill(middle)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def uncertain(self, low: int, high: int) -> set[int]:
        """Cells of several groups in which a cut of a capacity from ``low`` to ``high`` can fall."""
        out: set[int] = set()
        for first, last in zip(self.whole(low), self.anywhere(high)):
            for k in range(bisect_right(self.ends, first), min(bisect_left(self.ends, last) + 1, len(self.cells))):
                if self.cells[k][3] > 1:
                    out.add(k)
        return out


def _capacity(groups: DataFrame, shards: int) -> tuple[int, Filling]:
    """The smallest feasible capacity, and cells between which cuts keep to it."""
    cells = _cells(groups, CELL_BITS)
    largest = groups.agg(F.max("bytes")).first()[0]
    while True:
        filling = Filling(cells, shards)
        least = max(largest, -(-filling.total // shards))
        low, high = filling.smallest(filling.anywhere, least), filling.smallest(filling.whole, least)
        chosen = filling.uncertain(low, high) if low < high else set()
        if not chosen:
            return high, filling
        cells = _finer(groups, cells, chosen)


def _even_cuts(filling: Filling, capacity: int) -> list[int]:
    """Places (numbers of cells before each cut) that keep to the capacity, as even as it allows."""
    ends, shards = [0, *filling.ends], filling.shards
    count = len(ends) - 1
    # first[j]: the first place from which the cells still fit j shards.
    first = [count]
    for _ in range(shards):
        first.append(bisect_left(ends, ends[first[-1]] - capacity))
    sizes = [c[2] for c in filling.cells]
    cuts = [0]
    for left in range(shards, 1, -1):
        begin = cuts[-1]
        rest, large = ends[count] - ends[begin], []
        while True:  # a round sets at least one more cell apart, and fewer than `left` are above the mean
            mean = (rest - sum(sizes[k] for k in large)) / max(1, left - len(large))
            more = [k for k in range(begin, count) if sizes[k] > mean]
            if len(more) == len(large) or len(more) >= left:
                break
            large = more
        # Up to the next large cell the shards get equal parts.
        stretch = ends[large[0] if large else count] - ends[begin]
        goal = ends[begin] + (stretch / max(1, round(stretch / mean)) if stretch else 0)
        aim = bisect_left(ends, goal, 0, count)
        if aim > begin and goal - ends[aim - 1] <= ends[aim] - goal:
            aim -= 1
        latest = bisect_right(ends, ends[begin] + capacity) - 1
        cuts.append(max(first[left - 1], min(latest, max(aim, min(begin + 1, count)))))
    return cuts


def _cut_hashes(groups: DataFrame, shards: int) -> list[int | None]:
    """The first group of every shard but the first; None for shards that start behind the last group."""
    capacity, filling = _capacity(groups, shards)
    starts = [c[0] for c in filling.cells]
    return [starts[k] if k < len(starts) else None for k in _even_cuts(filling, capacity)[1:]]


def assign_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, group, shard, slot) of every row of ``docs``.

    ``group`` is the hash that equal texts share; ``slot`` numbers the rows of a shard from 0, in the order
    of groups and of ids inside a group. A group of any size is spread over many tasks: rows are
    ordered by group, id and place, and only counts per task are added up.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        F.monotonically_increasing_id().alias("place"),
    )
    rows = stage(rows, "shard-rows")
    groups = stage(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    cuts = _cut_hashes(groups, shards) if groups.take(1) else []
    order = ["group", "doc_id", "place"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    shard = F.lit(0)
    for cut in cuts:
        if cut is not None:
            shard = shard + (F.col("group") >= F.lit(cut)).cast("int")
    placed = stage(placed.withColumn("shard", shard), "shard-placed")

    # Rows of one shard in one task follow each other: a row's slot is its place there after the rows of earlier tasks.
    task = F.shiftright("_at", _ROW_BITS).alias("task")
    parts = placed.groupBy("shard", task).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    bases = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return placed.withColumn("task", task).join(bases, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", "group", "shard", (F.col("_before") + F.col("_at") - F.col("_first")).alias("slot")
    )

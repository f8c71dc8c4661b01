"""Near-duplicate documents by bottom-k sketches.

A document's set holds its word shingles. One hash function orders all shingles; the sketch is
the ``SKETCH`` smallest of a set. Two sets of Jaccard similarity 0.75 share 48 of the 64
smallest values of their union on average, and ``SHARED`` of them but for one pair in tens of
millions (sets that fit their sketches are held whole, so their bound is exact). A pair that
must share so many retained values also shares one of the rarest ``SKETCH - SHARED + 1`` of
either side, so only those enter the inverted lists: what many documents share does not.

1. Copies of a set become one node, named by their smallest document id.
2. The nodes of an inverted list are compared in blocks of at most ``BLOCK``: the overlap of
   their sketches, then the estimate from the sketch of the union. A list proposes the pairs of
   highest estimate that connect its nodes; the full sets decide whether they are links.
3. Components of these links. Lists that still hold several components are gone through once
   more, every block with every other: all pairs of different components that pass the estimate
   are held against the full sets, each in one list only and not once its sides are connected.
4. Components over all links give each document its class.

Rows between the steps grow with the entries of the lists, never with pairs: partners travel
packed with a node. Nothing is capped.

Cases: a text without words, and a null text, has the empty set and no link; fewer words than
a shingle are one shingle; rows that repeat a document id are one document; a row without an id
is outside the graph and keeps the class null; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from citeloom.llm.common import mix64, text_chunks, utf8
from citeloom.llm.components import connected_components
from citeloom.session import stage

WORDS = 5
#: Links need 100 * intersection >= 75 * union.
PERCENT = 75
SKETCH = 64
SHARED = 28
#: Nodes of a list that are compared at once, twice as many for two blocks.
BLOCK = 300
#: Shingles of a set that is also held as a Python set.
QUICK_SET = 1000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z are lower-cased, words end at ASCII white space."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    size = min(words, len(found))
    rolled = hashes[: len(hashes) - size + 1].copy()
    for k in range(1, size):
        rolled = mix64(rolled * _STEP + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(mix64(rolled + np.uint64(size)))


def _sketches(batches: Iterable[pa.RecordBatch], words: int, sketch: int) -> Iterator[pa.RecordBatch]:
    for chunk in text_chunks(batches):
        sets = [shingle_set(t, words) for t in chunk.column("text").to_pylist()]
        keys = [b"".join(int(x).to_bytes(8, "little") for x in (s.sum(dtype=np.uint64), mix64(s + _STEP).sum(dtype=np.uint64), len(s))) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("doc_id"),
                chunk.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([s[:sketch].tobytes() for s in sets], pa.binary()),
            ],
            names=["doc_id", "text_hash", "n_shingles", "set_key", "sketch"],
        )


def _unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per retained value."""
    for batch in batches:
        sketches = [np.frombuffer(x, np.int64) for x in batch.column("sketch").to_pylist()]
        at = np.repeat(np.arange(len(sketches)), [len(x) for x in sketches])
        values = np.concatenate(sketches) if sketches else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(at)), batch.column("n").take(pa.array(at)), pa.array(values)], names=["node", "n", "value"])


def _required(n: Column, sketch: int, shared: int) -> Column:
    """Retained values two similar sets share at least, by the size of one of them."""
    # The other set is no larger than n * 100 / PERCENT; while that fits a sketch, both are whole.
    return F.when(n * 100 > sketch * PERCENT, F.least(F.lit(shared), F.ceil(n * PERCENT / 100).cast("int"))).otherwise(F.ceil(n * PERCENT / 100).cast("int"))


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        starts = np.flatnonzero(new).tolist()
        for begin, end in zip(starts, starts[1:] + [batch.num_rows]):
            key = tuple(c[begin] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _likely_pairs(
    sketches: list[np.ndarray], sizes: np.ndarray, sketch: int, shared: int, rows: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that may be links by their sketches, each once, and the estimate from the union's sketch.

    With ``rows`` only pairs that have one of these nodes.
    """
    rows = np.arange(len(sketches)) if rows is None else rows
    flat = np.concatenate(sketches)
    owner = np.repeat(np.arange(len(sketches)), [len(s) for s in sketches])
    _, code = np.unique(flat, return_inverse=True)
    has = np.zeros((len(sketches), int(code.max()) + 1), np.float32)
    has[owner, code] = 1
    common = has[rows] @ has.T
    small, large = np.minimum.outer(sizes[rows], sizes), np.maximum.outer(sizes[rows], sizes)
    exact = common * 100 >= PERCENT * (small + large - common)
    part = common >= np.ceil(large * PERCENT / 100) - (large - sketch)
    fits = np.where(large <= sketch, exact, np.where(small <= sketch, part, common >= shared)) & (small * 100 >= large * PERCENT)
    every = np.arange(len(sketches))
    once = (rows[:, None] < every) | ~np.isin(every, rows)
    at, b = np.nonzero(fits & once)
    a = rows[at]
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.full((len(sketches), sketch), most)
    for k, own in enumerate(sketches):
        padded[k, : len(own)] = own
    estimates = np.zeros(len(a))
    for k in range(0, len(a), 4096):
        both = np.sort(np.concatenate((padded[a[k : k + 4096]], padded[b[k : k + 4096]]), axis=1), axis=1)
        twice = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != most)
        fresh = np.concatenate((np.ones((len(both), 1), bool), ~twice), axis=1) & (both != most)
        rank = np.cumsum(fresh, axis=1)
        inside = np.minimum(rank[:, -1], sketch)
        estimates[k : k + 4096] = (twice & (rank[:, 1:] <= sketch)).sum(axis=1) / np.maximum(inside, 1)
    keep = (large[at, b] <= sketch) | (small[at, b] <= sketch) | (estimates * sketch >= shared)
    return a[keep], b[keep], estimates[keep]


class _Sets:
    """Which of a few elements are connected."""

    def __init__(self, count: int):
        self.up = list(range(count))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Connect; false if they were."""
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _sketches_of(group: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in group.column("sketch").to_pylist()]


def _propose(batches: Iterable[pa.RecordBatch], sketch: int, shared: int) -> Iterator[pa.RecordBatch]:
    """For every block of a list the likeliest pairs that connect its nodes."""
    out: tuple[list, list] = ([], [])
    for group in sorted_groups(batches, ["value", "i"]):
        if group.num_rows > 1:
            nodes = group.column("node").to_pylist()
            a, b, estimate = _likely_pairs(_sketches_of(group), group.column("n").to_numpy(), sketch, shared)
            known = _Sets(len(nodes))
            for k in np.argsort(-estimate, kind="stable").tolist():
                if known.join(int(a[k]), int(b[k])):
                    out[0].append(min(nodes[a[k]], nodes[b[k]])), out[1].append(max(nodes[a[k]], nodes[b[k]]))
        if len(out[0]) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])
            out = ([], [])
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])


def _partners(batches: Iterable[pa.RecordBatch], sketch: int, shared: int) -> Iterator[pa.RecordBatch]:
    """Nodes with likely partners in other components, the partners packed; a pair in its first list only."""
    keys = ["value", "i", "j"]
    for group in sorted_groups(batches, keys):
        component = group.column("c").to_numpy()
        if (component == component[0]).all():
            continue
        value, i, j = (group.column(k)[0].as_py() for k in keys)
        block = group.column("own").to_numpy()
        prefixes = [set(p) for p in group.column("prefix").to_pylist()]
        # Nodes that share a smaller value meet in its list, so two of them need not meet here.
        before = Counter(v for p in prefixes for v in p if v < value)
        rows = np.arange(len(prefixes))
        if before:
            most = before.most_common(1)[0][0]
            rows = np.array([k for k, p in enumerate(prefixes) if most not in p], dtype=np.int64)
            if not len(rows):
                continue
        a, b, _ = _likely_pairs(_sketches_of(group), group.column("n").to_numpy(), sketch, shared, rows)
        apart = component[a] != component[b]
        if i != j:
            apart &= block[a] != block[b]
        nodes = group.column("node").to_pylist()
        found: dict[int, list[int]] = {}
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            if min(prefixes[x] & prefixes[y]) == value:
                found.setdefault(x, []).append(nodes[y])
                found.setdefault(y, [])
        if found:
            at = list(found)
            same = lambda v: pa.array([v] * len(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [same(value), same(i), same(j), pa.array([nodes[x] for x in at], pa.int64()), pa.array([int(component[x]) for x in at], pa.int64()), pa.array([np.array(found[x], np.int64).tobytes() for x in at], pa.binary())],
                names=[*keys, "node", "c", "partners"],
            )


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _similar_sets(x: frozenset, y: frozenset) -> bool:
    common = len(x & y)
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _settle(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Links between components, by the full sets of a block's nodes and their partners."""
    for group in sorted_groups(batches, ["value", "i", "j"]):
        nodes = group.column("node").to_pylist()
        place = {node: k for k, node in enumerate(nodes)}
        sets = [shingle_set(t, words) for t in group.column("text").to_pylist()]
        # Small sets are held as Python sets too, whose intersection is quicker than sorting.
        quick = [frozenset(x.tolist()) if len(x) <= QUICK_SET else None for x in sets]
        known = _Sets(len(nodes))
        first: dict[int, int] = {}
        for k, c in enumerate(group.column("c").to_pylist()):
            known.join(first.setdefault(c, k), k)
        links = []
        for k, packed in enumerate(group.column("partners").to_pylist()):
            for other in np.frombuffer(packed, np.int64).tolist():
                m = place[other]
                if known.root(k) == known.root(m):
                    continue
                if _similar(sets[k], sets[m]) if quick[k] is None or quick[m] is None else _similar_sets(quick[k], quick[m]):
                    known.join(k, m)
                    links.append((nodes[k], other))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar; ``texts`` has one row per node."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            links = []
            for row in range(batch.num_rows):
                if a[row] != last:
                    last, held = a[row], shingle_set(batch.column("text_a")[row].as_py(), words)
                if _similar(held, shingle_set(batch.column("text_b")[row].as_py(), words)):
                    links.append((a[row], b[row]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    of = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    return stage(pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint"), "links")


def near_duplicates(docs: DataFrame, words: int = WORDS, sketch: int = SKETCH, shared: int = SHARED) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest document id reachable over links; ``kept`` tells whether
    it is the document's own.
    """
    texts = docs.select("doc_id", utf8(), F.xxhash64("text").alias("text_hash"))
    rows = stage(
        texts.select("doc_id", "text_hash", "text").mapInArrow(lambda it: _sketches(it, words, sketch), "doc_id bigint, text_hash bigint, n_shingles bigint, set_key binary, sketch binary"),
        "sketches",
    )
    named = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    sets = stage(
        named.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .select("set_key", F.col("first.doc_id").alias("node"), F.col("first.text_hash").alias("text_hash"), "n", "sketch"),
        "sets",
    )
    # Rows that repeat an id with another text join their sets to one node.
    same_id = named.select("doc_id", "set_key").join(sets.select("set_key", "node"), "set_key").filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    repeated = named.groupBy("doc_id").agg(F.count_distinct("set_key").alias("k")).filter("k > 1").select(F.col("doc_id").alias("a"))
    links = same_id.join(repeated, "a", "left_semi").distinct()

    values = sets.select("node", "n", "sketch").mapInArrow(_unpack, "node bigint, n bigint, value bigint")
    frequent = values.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = (
        values.join(frequent, "value", "left")
        .groupBy("node", "n")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "value"))).alias("values"))
    )
    size = F.size("values") - _required(F.col("n"), sketch, shared) + 1
    prefix = F.transform(F.filter(F.slice("values", F.lit(1), size), lambda v: v.df > 1), lambda v: v.value)
    prefixes = stage(ranked.select("node", prefix.alias("prefix")).filter("size(prefix) > 0"), "prefixes")

    def lists(nodes: DataFrame) -> DataFrame:
        """Entries of the lists with their block: (value, node, blocks, own)."""
        entries = nodes.select("node", F.explode("prefix").alias("value"))
        sizes = entries.groupBy("value").agg(F.count("*").alias("entries")).filter("entries > 1")
        blocks = F.ceil(F.col("entries") / BLOCK)
        return entries.join(sizes, "value").select("value", "node", blocks.alias("blocks"), F.pmod(F.xxhash64("node", "value"), blocks).alias("own"))

    held = stage(sets.join(prefixes, "node").select("node", "n", "sketch", "text_hash", "prefix"), "nodes")
    nodes = held.select("node", "n", "sketch", "prefix")
    of_nodes = held.select("node", F.col("node").alias("doc_id"), "text_hash")
    # Texts are shuffled whatever the number of nodes, so that the job is alike at every size.
    node_texts = texts.join(of_nodes.hint("merge"), ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"])
    node_texts = stage(node_texts, "node-texts")

    blocked = lists(prefixes).select("value", F.col("own").alias("i"), "node").join(nodes.select("node", "n", "sketch"), "node")
    blocked = blocked.repartition("value", "i").sortWithinPartitions("value", "i")
    pairs = blocked.mapInArrow(lambda it: _propose(it, sketch, shared), "a bigint, b bigint").distinct()
    links = stage(links.unionByName(_verified(pairs, node_texts, words)), "links")

    known = stage(connected_components(links), "components")
    placed = held.select("node", "prefix").join(known.withColumnRenamed("component", "c"), "node", "left").withColumn("c", F.coalesce("c", "node"))
    placed = stage(placed, "placed")
    spread = placed.select("node", "c", F.explode("prefix").alias("value"))
    open_lists = spread.groupBy("value").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("value")
    entries = lists(placed).join(open_lists, "value", "left_semi").join(placed.select("node", "c"), "node").join(nodes, "node")
    # Every block with itself and each other.
    each = F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j"))))
    crossed = entries.select("value", "own", each.alias("p"), "node", "c", "n", "sketch", "prefix").select("value", "p.i", "p.j", "own", "node", "c", "n", "sketch", "prefix")
    crossed = crossed.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")
    active = stage(crossed.mapInArrow(lambda it: _partners(it, sketch, shared), "value bigint, i bigint, j bigint, node bigint, c bigint, partners binary"), "partners")
    compared = active.join(node_texts, "node").select("value", "i", "j", "node", "c", "partners", "text").repartition("value", "i", "j").sortWithinPartitions("value", "i", "j")
    more = stage(compared.mapInArrow(lambda it: _settle(it, words), "a bigint, b bigint"), "links")
    known = stage(connected_components(more.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b")))), "components")

    classes = sets.select("set_key", "node").join(known, "node", "left").select("set_key", F.coalesce("component", "node").alias("class"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("class")))
    return (
        rows.select("doc_id", "text_hash", "n_shingles", "set_key")
        .join(stage(classes, "classes"), "set_key", "left")
        .select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that represent their class, with all their columns."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")

"""Removal of byte strings that repeat across documents, by a distributed sort of suffixes.

Every byte covered by a ``SPAN``-byte string that also starts in a document of smaller id is
removed. Comparing every suffix of the corpus is spared: of each ``SPAN - GRAM + 1``
consecutive strings of ``GRAM`` bytes the one of smallest hash is an anchor, so equal
``SPAN``-byte strings have their anchor at the same place, and a string is settled where its
anchor is. The context of an anchor is all the strings that have it, one to 27 of them.

1. Tasks find anchors and send, per bucket of hashes, sorted packed entries (hash of the
   anchor, hash of the context, place). Entries of equal context in a task are folded to the
   smallest document first. In a bucket, a context that a smaller document has too is removed
   as a whole. Anchors found in several documents with different contexts remain.
2. The suffixes at those anchors are sorted in runs per task, front-coded (the number of
   leading bytes shared with the suffix before, then the rest) and exchanged by anchor. A
   bucket merges its runs with a loser tree whose nodes remember the common prefix with the
   last suffix taken: of two suffixes the one with the longer known prefix is smaller, and
   bytes are compared only behind equal known prefixes. In merged order suffixes of one anchor
   are neighbours, and their ``SPAN``-byte strings are compared with what stands left of the
   anchor.
3. Removed ranges meet their documents and are united.

Anchors that very many contexts share (a line found in a tenth of all documents) would fill one
bucket. A sample of ``HINT_SHARE`` of the documents names them, at most ``MAX_HINTS``; each of
their strings is entered by its own hash instead, which spreads them. Any choice of such
anchors gives the same result.

Cases: null and empty texts have no bytes; texts under ``SPAN`` bytes stay; documents of equal
id, thus repeated rows, do not remove each other's bytes; a document without an id neither
removes nor loses any; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from citeloom.llm.common import mix64, text_chunks, utf8
from citeloom.session import stage

SPAN = 50
GRAM = 24
WINDOW = SPAN - GRAM + 1
#: Text bytes whose anchors one bucket compares, on average.
BUCKET_BYTES = 12 << 20
#: One document in so many gives hints of frequent anchors; the contexts that make one frequent.
HINT_SHARE = 64
HINT_CONTEXTS = 8
MAX_HINTS = 1 << 16
_SEGMENT = 1 << 17
_LOW = np.uint64((1 << 40) - 1)
_PLACE = np.uint64((1 << 27) - 1)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and powers of an odd number and of its inverse modulo 2 ** 64."""
    size = _SEGMENT + 2 * SPAN
    base = 0x9E3779B97F4A7C15 | 1
    inverse = pow(base, -1, 1 << 64)
    powers, inverses = np.full((2, size + 1), 1, np.uint64)
    powers[1:], inverses[1:] = np.uint64(base), np.uint64(inverse)
    powers, inverses = np.cumprod(powers, dtype=np.uint64), np.cumprod(inverses, dtype=np.uint64)
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(base)), powers, inverses


_BYTE, _POWER, _INVERSE = _tables()


def anchors(text: bytes, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, context hash, place, bytes of context left of it and number of strings, of each anchor."""
    found = []
    last = len(text) - SPAN
    for begin in range(0, last + 1, _SEGMENT):
        part = np.frombuffer(text, np.uint8, min(len(text), begin + _SEGMENT + SPAN - 1) - begin, begin)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _POWER[: len(part)], dtype=np.uint64)))
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * _INVERSE[: len(part) - GRAM + 1])
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while size * 2 <= WINDOW:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[: len(least) - (WINDOW - size)], least[WINDOW - size :])
        at = (least & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        place = at[first]
        count = np.diff(np.concatenate((first, [len(at)])))
        hashes = grams[place]
        left = place - first
        if frequent is not None and len(frequent):
            spread = frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes
            if spread.any():
                # Each string of a frequent anchor stands for itself.
                starts = np.repeat(first[spread], count[spread]) + np.arange(count[spread].sum()) - np.repeat(np.cumsum(count[spread]) - count[spread], count[spread])
                own = mix64((sums[starts + SPAN] - sums[starts]) * _INVERSE[starts] + np.uint64(SPAN))
                hashes, first, place = np.concatenate((hashes[~spread], own)), np.concatenate((first[~spread], starts)), np.concatenate((place[~spread], starts))
                left, count = np.concatenate((left[~spread], np.zeros(len(own), np.int64))), np.concatenate((count[~spread], np.ones(len(own), np.int64)))
        end = first + count + SPAN - 1
        context = mix64((sums[end] - sums[first]) * _INVERSE[first] + (left * 64 + count).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        found.append((hashes, context, place + begin, left, count))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 3


def _item(request: bool, place: np.ndarray, left: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A context as one number: a range to remove, or one whose strings are still to be compared."""
    return (np.int64(request) << 62) | (place.astype(np.int64) << 16) | (left.astype(np.int64) << 8) | count.astype(np.int64)


def _planes(numbers: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _from_planes(data: memoryview, size: int, count: int) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, count).T
    return out.view("<u8")[:, 0]


def _entries(batches: Iterable[pa.RecordBatch], buckets: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Packed entries of each bucket, and the ranges that folding already settled."""
    zip_ = zstandard.ZstdCompressor(level=1)
    for chunk in text_chunks(batches, limit=6 << 20):
        ids = chunk.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        parts, sizes = [], []
        for text in chunk.column("text").to_pylist():
            parts.append(anchors(text, frequent))
            sizes.append(len(parts[-1][0]))
        h, c, place, left, count = (np.concatenate(x) for x in zip(*parts))
        row = np.repeat(np.arange(len(ids)), sizes)
        bucket = ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((ids[row], c, h & _LOW, bucket))
        h, c, place, left, count, row, bucket = (x[order] for x in (h, c, place, left, count, row, bucket))
        fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]))) if len(h) else np.zeros(0, bool)
        leader = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(h) else np.zeros(0, np.int64)
        settled = ids[row] > ids[row[leader]]
        bounds = np.searchsorted(bucket, np.arange(buckets + 1))
        out = ([], [], [], [], [])
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            cut = slice(bounds[b], bounds[b + 1])
            keep = np.flatnonzero(~settled[cut]) + bounds[b]
            gone = np.flatnonzero(settled[cut]) + bounds[b]
            used, own = np.unique(row[keep], return_inverse=True)
            packed = _planes(h[keep], 5) + _planes(c[keep], 6) + _planes(own, 4) + _planes(place[keep], 4) + _planes(left[keep], 1) + _planes(count[keep], 1)
            out[0].append(b), out[1].append(len(keep)), out[2].append(zip_.compress(packed)), out[3].append(zip_.compress(ids[used].tobytes()))
            out[4].append(zip_.compress(np.stack((ids[row[gone]], _item(False, place[gone], left[gone], count[gone]))).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), *[pa.array(x, pa.binary()) for x in out[2:]]], names=["bucket", "n", "packed", "docs", "settled"]
        )


def _compare(key: tuple, table: pa.Table) -> pa.Table:
    """Entries of one bucket: ranges of contexts that a smaller document has, and what is left to compare."""
    unzip = zstandard.ZstdDecompressor()
    parts, docs, items = [], [], []
    for n, packed, ids, settled in zip(*(table.column(c).to_pylist() for c in ("n", "packed", "docs", "settled"))):
        pairs = np.frombuffer(unzip.decompress(settled), np.int64).reshape(2, -1)
        docs.append(pairs[0]), items.append(pairs[1])
        data, at, fields = memoryview(unzip.decompress(packed)), 0, []
        for size in (5, 6, 4, 4, 1, 1):
            fields.append(_from_planes(data[at : at + size * n], size, n))
            at += size * n
        fields[2] = np.frombuffer(unzip.decompress(ids), np.int64)[fields[2].astype(np.int64)] if n else np.zeros(0, np.int64)
        parts.append(fields)
    h, c, doc, place, left, count = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(len(h), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    h, c, doc, place, left, count = (x[again] for x in (h, c, doc, place, left, count))
    order = np.lexsort((doc, c, h))
    h, c, doc, place, left, count = (x[order] for x in (h, c, doc, place, left, count))
    if len(h):
        new_h = np.concatenate(([True], h[1:] != h[:-1]))
        new_c = new_h | np.concatenate(([True], c[1:] != c[:-1]))
        group, context = np.cumsum(new_h) - 1, np.cumsum(new_c) - 1
        settled = doc > doc[np.flatnonzero(new_c)[context]]
        starts = np.flatnonzero(new_h)
        several = (np.add.reduceat(new_c.astype(np.int64), starts) > 1) & (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts))
        ask = ~settled & several[group]
        docs += [doc[settled], doc[ask]]
        items += [_item(False, place[settled], left[settled], count[settled]), _item(True, place[ask], left[ask], count[ask])]
    return pa.table({"doc_id": np.concatenate(docs), "item": np.concatenate(items)})


def _front_code(suffixes: list[bytes]) -> tuple[bytes, bytes]:
    """Common prefix with the one before, and what follows it, of sorted suffixes."""
    known, rest, before = bytearray(), [], b""
    for s in suffixes:
        k, most = 0, min(len(s), len(before))
        while k < most and s[k] == before[k]:
            k += 1
        known.append(k)
        rest.append(bytes([len(s) - k]) + s[k:])
        before = s
    return bytes(known), b"".join(rest)


def _read_run(known: bytes, rest: bytes) -> Iterator[tuple[bytes, int]]:
    """The suffixes of a front-coded run with the prefix each shares with the one before."""
    at, before = 0, b""
    for k in known:
        size = rest[at]
        before = before[:k] + rest[at + 1 : at + 1 + size]
        at += 1 + size
        yield before, k


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """(suffix, prefix shared with the one before, run) of all runs in order.

    A loser tree; ``known[r]`` is the prefix that run r's next suffix shares with the last one
    taken, and a loser's is that with the winner of its match, which passed up the same path.
    """
    width = 1
    while width < max(1, len(runs)):
        width *= 2
    head: list[bytes | None] = [None] * width
    known = [0] * width
    for r, run in enumerate(runs):
        first = next(run, None)
        head[r] = first[0] if first else None

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes that with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            # The longer prefix shared with the last one taken is the smaller suffix; the
            # other's prefix with it is the shorter one, as it stands.
            return (a, b) if known[a] > known[b] else (b, a)
        k, most = known[a], min(len(x), len(y))
        while k < most and x[k] == y[k]:
            k += 1
        less = (len(x), a) < (len(y), b) if k == most else x[k] < y[k]
        winner, loser = (a, b) if less else (b, a)
        known[loser] = k
        return winner, loser

    losers = [0] * width
    champion = list(range(width))
    level = champion
    for depth in range(width.bit_length() - 1, 0, -1):
        upper = []
        for k in range(0, len(level), 2):
            winner, losers[(1 << (depth - 1)) + k // 2] = play(level[k], level[k + 1])
            upper.append(winner)
        level = upper
    top = level[0]
    while head[top] is not None:
        yield head[top], known[top], top
        following = next(runs[top], None)
        head[top], known[top] = following if following else (None, 0)
        node = (width + top) >> 1
        while node:
            top, losers[node] = play(top, losers[node])
            node >>= 1


def _runs(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs of the suffixes at the anchors still to be compared."""
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        asked: dict[int, list] = {}
        for doc, packed, items in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items"))):
            text = unzip.decompress(packed)
            for item in items:
                if item >> 62:
                    place, left, count = (item >> 16) & ((1 << 46) - 1), (item >> 8) & 255, item & 255
                    first, end = place - left, place - left + count + SPAN - 1
                    # Another text under the same id may be shorter; its own anchors are asked for too.
                    if end <= len(text):
                        suffix = text[place:end]
                        asked.setdefault(xxhash.xxh64_intdigest(suffix[:GRAM]) % buckets, []).append((suffix, doc, place, text[first:place]))
        columns = ([], [], [], [], [], [])
        for bucket, found in asked.items():
            found.sort()
            known, rest = _front_code([f[0] for f in found])
            columns[0].append(bucket), columns[1].append(known), columns[2].append(rest)
            columns[3].append(np.array([f[1] for f in found], np.int64).tobytes() + np.array([f[2] for f in found], np.int64).tobytes())
            columns[4].append(bytes(len(f[3]) for f in found)), columns[5].append(b"".join(f[3] for f in found))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["bucket", "known", "rest", "places", "left_sizes", "lefts"])


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    """Ranges of one bucket: strings that start in a smaller document, from the merged runs."""
    runs, docs, places, lefts = [], [], [], []
    for known, rest, where, sizes, left in zip(*(table.column(c).to_pylist() for c in ("known", "rest", "places", "left_sizes", "lefts"))):
        runs.append(_read_run(known, rest))
        both = np.frombuffer(where, np.int64).reshape(2, -1)
        docs.append(iter(both[0].tolist())), places.append(iter(both[1].tolist()))
        ends = np.cumsum(np.frombuffer(sizes, np.uint8).astype(np.int64)).tolist()
        lefts.append(iter([left[e - s : e] for e, s in zip(ends, sizes)]))
    out_docs, out_items = array("q"), array("q")

    def settle(group: list[tuple[bytes, bytes, int, int]]) -> None:
        if len(group) < 2:
            return
        # Equal contexts are compared once, for the smallest of their documents.
        contexts: dict[tuple[bytes, bytes], int] = {}
        for suffix, left, doc, _ in group:
            if contexts.get((left, suffix), doc) >= doc:
                contexts[left, suffix] = doc
        # Anchored at the same place, so the string and where its anchor is must agree.
        strings = lambda left, suffix: [(len(left) - k, (left + suffix)[k : k + SPAN]) for k in range(len(left) + len(suffix) - SPAN + 1)]
        smallest: dict[tuple[int, bytes], int] = {}
        for (left, suffix), doc in contexts.items():
            for string in strings(left, suffix):
                if smallest.get(string, doc) >= doc:
                    smallest[string] = doc
        least = {c: [smallest[string] for string in strings(*c)] for c in contexts}
        for suffix, left, doc, place in group:
            begin, run = place - len(left), 0
            for k, other in enumerate([*least[left, suffix], doc]):
                if other < doc:
                    run += 1
                elif run:
                    out_docs.append(doc), out_items.append(((begin + k - run) << 16) | run)
                    run = 0

    group: list[tuple[bytes, bytes, int, int]] = []
    for suffix, shared, run in merge_runs(runs):
        if shared < GRAM:
            settle(group)
            group = []
        group.append((suffix, next(lefts[run]), next(docs[run]), next(places[run])))
    settle(group)
    return pa.table({"doc_id": pa.array(np.frombuffer(out_docs, np.int64)), "item": pa.array(np.frombuffer(out_items, np.int64))})


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The united ranges of each document, as pairs of begin and end."""
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc, packed, items in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items"))):
            text = unzip.decompress(packed) if packed is not None else b""
            item = np.array(items or [], dtype=np.int64)
            begin = (item >> 16) - ((item >> 8) & 255)
            end = begin + (item & 255) + SPAN - 1
            change = np.zeros(len(text) + 1, np.int32)
            np.add.at(change, np.minimum(begin, len(text)), 1)
            np.add.at(change, np.minimum(end, len(text)), -1)
            gone = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((doc, len(text), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), edges.tolist(), kept))
        if rows:
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def remove_repeated_strings(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): byte counts, removed ranges (``spans``) and what is ``kept``."""
    spark = docs.sparkSession
    named = docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= SPAN)).select("doc_id", utf8())
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def hints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            found = [anchors(t)[:2] for t in chunk.column("text").to_pylist()]
            h, c = (np.concatenate(x) for x in zip(*found))
            pairs = np.unique(np.stack((h, c)), axis=1) if len(h) else np.empty((2, 0), np.uint64)
            own, number = np.unique(pairs[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own[number > 1].view(np.int64)), pa.array(number[number > 1])], names=["h", "n"])

    sample = named.filter(F.pmod(F.xxhash64("doc_id"), F.lit(HINT_SHARE)) == 0).coalesce(max(1, int(buckets) // 8))
    often = sample.mapInArrow(hints, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= HINT_CONTEXTS)
    frequent = np.sort(np.array([r[0] for r in often.orderBy(F.desc("n"), "h").limit(MAX_HINTS).collect()], dtype=np.int64).view(np.uint64))
    frequent = spark.sparkContext.broadcast(frequent)

    entries = named.mapInArrow(lambda it: _entries(it, int(buckets), frequent.value), "bucket int, n bigint, packed binary, docs binary, settled binary")
    items = stage(entries.groupBy("bucket").applyInArrow(_compare, "doc_id bigint, item bigint"), "items")

    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for chunk in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array([zip_.compress(t) if t is not None else None for t in chunk.column("text").to_pylist()], pa.binary())], names=["doc_id", "text"])

    # Compressed texts go through the shuffles.
    small = docs.select("doc_id", utf8()).mapInArrow(shrink, "doc_id bigint, text binary")
    per_doc = lambda x: x.groupBy("doc_id").agg(F.collect_list("item").alias("items"))
    asked = per_doc(items.filter(F.col("item") >= 1 << 62))
    runs = small.filter("text IS NOT NULL").join(asked, "doc_id").select("doc_id", "text", "items").mapInArrow(
        lambda it: _runs(it, int(buckets)), "bucket int, known binary, rest binary, places binary, left_sizes binary, lefts binary"
    )
    more = stage(runs.groupBy("bucket").applyInArrow(_merge, "doc_id bigint, item bigint"), "items")
    ranges = per_doc(items.filter(F.col("item") < 1 << 62).unionByName(more))
    joined = small.join(ranges, "doc_id", "left").select("doc_id", "text", "items")
    return joined.mapInArrow(_cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>, kept binary")

"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words of digits, letters and non-ASCII characters. Of
every ``WINDOW_GRAMS`` consecutive hashes of ``GRAM`` words the smallest is kept (the last of
equal ones), so a shared span of ``GRAM + WINDOW_GRAMS - 1`` words, which is a window, has a
kept hash at the same place on both sides. Documents and items are joined on kept hashes; a
hit fixes how document and item lie against each other, and the words are compared to both
sides of it. Runs of equal words that hold a window of the item are marked. The words of an item are
held once, and meet the documents that hit it once per document.

An item of fewer words than a window is one window of its own length. Its hash over all its
words is looked for at every place of the documents.

A bit map of fixed size made from the items' hashes spares most documents' hashes the join. A
full map would only let more of them through.

Cases: null and empty texts have no words; items without words match nothing; an item id may
repeat with different texts, and any of them may match; items without an id mark words like any
other, so they count in n_hit and contaminated, but not in n_items and items_sha256, which name ids; rows that repeat a document id and its
text get the same result each; other columns are ignored; empty tables give no hits or no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from citeloom.llm.common import mix64, text_chunks, utf8
from citeloom.operators.joins import join_split
from citeloom.session import stage

WINDOW = 10
GRAM = 5
WINDOW_GRAMS = WINDOW - GRAM + 1
#: Bits of the map of the items' hashes: 1 MB, whatever the number of items.
MAP_BITS = 23
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def word_hashes(text: bytes | None) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    words = (text or b"").translate(_WORD_BYTES).split(b" ") if text else []
    words = [w for w in words if w]
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    count = len(words) - size + 1
    if count < 1:
        return np.empty(0, np.uint64)
    rolled = words[:count].copy()
    for k in range(1, size):
        rolled = mix64(rolled * _STEP + words[k : count + k])
    return mix64(rolled + np.uint64(size))


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest of every ``window`` consecutive hashes, the last of equal ones."""
    if len(hashes) < window:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes[::-1], window)
    smallest = np.argmin(views, axis=1)
    return np.unique(len(hashes) - 1 - (smallest + np.arange(len(smallest))))


def _item_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if 0 < len(words) < WINDOW:
        return gram_hashes(words, len(words)), np.zeros(1, np.int64)
    grams = gram_hashes(words, GRAM)
    at = winnow(grams, WINDOW_GRAMS)
    return grams[at], at


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _hash_items(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per item: its words once, and its kept hashes with their places."""
    for chunk in text_chunks(batches):
        words = [word_hashes(t) for t in chunk.column("text").to_pylist()]
        kept = [_item_hashes(w) for w in words]
        ends = pa.array(np.cumsum([0] + [len(h) for h, _ in kept]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("item"),
                chunk.column("item_id"),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([w.tobytes() for w in words], pa.binary()),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([h for h, _ in kept]).view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([at for _, at in kept]).astype(np.int64))),
            ],
            names=["item", "item_id", "n_words", "words", "hashes", "places"],
        )


def _matched(words: np.ndarray, item: np.ndarray, offset: int) -> np.ndarray:
    """Starts in the document of the item's windows that occur there, the item lying at ``offset``."""
    window = min(WINDOW, len(item))
    begin, end = max(0, offset), min(len(words), offset + len(item))
    if end - begin < window:
        return np.empty(0, np.int64)
    equal = words[begin:end] == item[begin - offset : end - offset]
    run = np.concatenate(([0], np.cumsum(equal)))
    return begin + np.flatnonzero(run[window:] - run[:-window] == window)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``."""
    numbered = stage(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("string").alias("item_id"), utf8()), "benchmark")
    items = stage(numbered.mapInArrow(_hash_items, "item bigint, item_id string, n_words bigint, words binary, hashes array<bigint>, places array<bigint>"), "items")
    kept = items.select("item", F.explode(F.arrays_zip("hashes", "places")).alias("f")).select("item", F.col("f.hashes").alias("hash"), F.col("f.places").alias("place"))
    # At most 2 ** MAP_BITS numbers reach the driver, and at most WINDOW - 1 lengths.
    slots = [r[0] for r in kept.select(F.shiftrightunsigned("hash", 64 - MAP_BITS).alias("slot")).distinct().toLocalIterator()]
    short = sorted(r[0] for r in items.filter((F.col("n_words") > 0) & (F.col("n_words") < WINDOW)).select("n_words").distinct().collect())
    bits = np.zeros(1 << MAP_BITS, dtype=bool)
    bits[np.array(slots, dtype=np.int64)] = True
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())

    def hash_docs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(np.frombuffer(packed.value, np.uint8)).astype(bool)
        for chunk in text_chunks(batches):
            counts, found, places = [], [], []
            for text in chunk.column("text").to_pylist():
                words = word_hashes(text)
                grams = gram_hashes(words, GRAM)
                at = winnow(grams, WINDOW_GRAMS)
                hashes, spots = [grams[at]], [at]
                for size in short:
                    own = gram_hashes(words, size)
                    hashes.append(own), spots.append(np.arange(len(own)))
                hashes, spots = np.concatenate(hashes), np.concatenate(spots)
                known = seen[_slot(hashes)]
                counts.append(len(words))
                found.append(hashes[known].view(np.int64))
                places.append(spots[known])
            ends = pa.array(np.cumsum([0] + [len(f) for f in found]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    chunk.column("text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), pa.int64())),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places), pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_words", "hashes", "places"],
            )

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8())
    rows = stage(texts.mapInArrow(hash_docs, "doc_id bigint, text_hash bigint, n_words bigint, hashes array<bigint>, places array<bigint>"), "fingerprints")
    key = ["doc_id", "text_hash"]
    some = rows.filter("size(hashes) > 0").dropDuplicates(key).select(*key, F.explode(F.arrays_zip("hashes", "places")).alias("f"))
    some = some.select(*key, F.col("f.hashes").alias("hash"), F.col("f.places").alias("at"))
    # A word that is an item alone may stand anywhere, so the join splits hot hashes.
    hits = join_split(some, kept, ["hash"]).select(*key, "item", (F.col("at") - F.col("place")).alias("offset")).distinct()
    # One row per document and item with the places; only then the item's words come in.
    lying = hits.groupBy(*key, "item").agg(F.collect_list("offset").alias("offsets"))
    lying = stage(join_split(lying, items.select("item", "item_id", "words"), ["item"]).drop("item"), "lying")

    def extend(key_of, left, right):
        left = left.to_pylist()
        marked: dict[str, None] = {}
        if not left:
            return pa.table({"doc_id": pa.array([], pa.int64()), "text_hash": pa.array([], pa.int64()), "n_hit": pa.array([], pa.int64()), "n_items": pa.array([], pa.int64()), "items_sha256": pa.array([], pa.string())})
        words = word_hashes(left[0]["text"])
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        for item_id, item, offsets in zip(right.column("item_id").to_pylist(), right.column("words").to_pylist(), right.column("offsets").to_pylist()):
            own = np.frombuffer(item, np.uint64)
            for offset in offsets:
                starts = _matched(words, own, offset)
                if len(starts):
                    if item_id is not None:
                        marked[item_id] = None
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + min(WINDOW, len(own)), -1)
        n_hit = int((np.cumsum(cover[:-1]) > 0).sum())
        digest = hashlib.sha256(",".join(sorted(marked)).encode()).hexdigest()
        return pa.table({"doc_id": pa.array([key_of[0].as_py()], pa.int64()), "text_hash": pa.array([key_of[1].as_py()], pa.int64()), "n_hit": [n_hit], "n_items": [len(marked)], "items_sha256": [digest]})

    wanted = texts.join(lying.select(*key).distinct(), (texts["doc_id"].eqNullSafe(lying["doc_id"])) & (texts["text_hash"] == lying["text_hash"]), "left_semi").dropDuplicates(key)
    results = wanted.groupBy(*key).cogroup(lying.groupBy(*key)).applyInArrow(extend, "doc_id bigint, text_hash bigint, n_hit bigint, n_items bigint, items_sha256 string")
    results = stage(results, "hits")
    r, h = rows.select(*key, "n_words").alias("r"), results.alias("h")
    none = hashlib.sha256(b"").hexdigest()
    joined = r.join(h, F.expr("r.doc_id <=> h.doc_id AND r.text_hash = h.text_hash"), "left")
    return joined.select(
        F.col("r.doc_id").alias("doc_id"),
        F.col("r.n_words").alias("n_words"),
        F.coalesce("h.n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("h.n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("h.items_sha256", F.lit(none)).alias("items_sha256"),
        F.coalesce(F.col("h.n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.col("r.text_hash").alias("text_hash"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a word in any item's window, with all their columns."""
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs["text"]) == bad["_bad_text"]), "left_anti")

"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are the same), at least
``EXPONENT`` periods and ``LEAST`` words long, that no neighbouring word extends.

1. The suffixes of every document are sorted by prefix doubling; suffixes that already stand
   alone leave the rounds. After round k the suffixes that begin with the same 2^k words are a
   range of the suffix array, and stay one.
2. Blocks of 2^k words begin at every multiple of 2^(k-1). For a block whose range holds more than
   itself, the range successor of its place is asked of a wavelet matrix over the suffix array:
   the next occurrence in the neighbouring window of one block length.
3. A distance q of at most the block length B is the smallest period of the words from the block
   through its next occurrence, as an earlier occurrence would have been found. Equal distances of
   neighbouring blocks form one progression, and its distance is the candidate period.
4. Progressions are extended word by word on both sides, by less than two blocks, since a longer
   extension would hold another block.

No run is missed: for period q take the B with B/2 < q <= B. A run of 4 q words holds a block of B
words that begins within its first B/2 words, and that block's next occurrence, q words later,
lies in the run as well: B/2 - 1 + B + q < 4 q.

Documents of a chunk are worked on together, sorted by length so that a wavelet matrix has no more levels
than its documents need. Memory follows the chunk, or the longest document where that is larger,
by about 150 bytes a word.

Cases: a null text, an empty one and one of white space have no words and no runs; rows that repeat
an id are each judged; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from citeloom.llm.common import text_chunks, utf8

#: Periods and words that a run has at least.
EXPONENT = 4
LEAST = 6
_WORD_BITS = np.uint64(63)


class WaveletMatrix:
    """Counts and order statistics over ranges of an integer array, one bit level at a time.

    A level holds its bits packed, and the number of ones before every 64 of them.
    """

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits, self.size = bits, len(values)
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        now = values
        for bit in range(bits - 1, -1, -1):
            ones = (now >> bit) & 1
            padded = np.zeros((self.size // 64 + 1) * 64, np.uint8)
            padded[: self.size] = ones
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=before[1:])
            self.levels.append((packed, before, self.size - int(before[-1])))
            one = ones.astype(bool)
            now = np.concatenate([now[~one], now[one]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at.astype(np.uint64) & _WORD_BITS)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & mask)

    def below(self, begin: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values of each range are smaller than ``value``."""
        out = np.zeros(len(begin), np.int64)
        b, e = begin.copy(), end.copy()
        for (packed, before, zeros), bit in zip(self.levels, range(self.bits - 1, -1, -1)):
            ones_b, ones_e = self._ones(packed, before, b), self._ones(packed, before, e)
            one = ((value >> bit) & 1).astype(bool)
            out += np.where(one, (e - b) - (ones_e - ones_b), 0)
            b = np.where(one, zeros + ones_b, b - ones_b)
            e = np.where(one, zeros + ones_e, e - ones_e)
        # Values that need more bits than the array has are above everything.
        return np.where(value >> self.bits > 0, end - begin, out)

    def smallest(self, begin: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of each range that ``rank`` others come before."""
        out = np.zeros(len(begin), np.int64)
        b, e, rank = begin.copy(), end.copy(), rank.copy()
        for packed, before, zeros in self.levels:
            ones_b, ones_e = self._ones(packed, before, b), self._ones(packed, before, e)
            none = (e - b) - (ones_e - ones_b)
            one = rank >= none
            rank -= np.where(one, none, 0)
            out = out * 2 + one
            b = np.where(one, zeros + ones_b, b - ones_b)
            e = np.where(one, zeros + ones_e, e - ones_e)
        return out

    def successor(self, begin: np.ndarray, end: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries with a value from ``least`` to ``most`` in their range, and the smallest such value."""
        rank = self.below(begin, end, least)
        hit = np.flatnonzero(self.below(begin, end, most + 1) > rank)
        return hit, self.smallest(begin[hit], end[hit], rank[hit])


def _blocks(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array of documents laid end to end, and per k the blocks of 2^k words that occur again.

    ``words`` tells words of different documents apart, so suffixes of one document are neighbours.
    A block is its place with the begin and end of its range. Blocks longer than half of the
    longest document cannot be part of a run, so the rounds end there.
    """
    total = len(words)
    ends, places = np.repeat(starts + sizes, sizes), np.arange(total) - np.repeat(starts, sizes)
    order = np.argsort(words, kind="stable")
    rank = np.empty(total, np.int64)  # begin of the range of suffixes that are equal so far
    new = np.ones(total, bool)
    new[1:] = words[order][1:] != words[order][:-1]
    first = np.flatnonzero(new)
    rank[order] = np.repeat(first, np.diff(np.append(first, total)))
    found = []
    # Places in the suffix array whose ranges hold several suffixes.
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
    k = 0
    limit = int(sizes.max(initial=0)) // 2
    while len(open_) and (1 << k) <= limit:
        length, step = 1 << k, max(1, 1 << k >> 1)
        at = order[open_]
        begin = rank[at]
        bounds = np.flatnonzero(np.append(True, begin[1:] != begin[:-1]))
        counts = np.diff(np.append(bounds, len(begin)))
        end = begin + np.repeat(counts, counts)
        fits = (at + length <= ends[at]) & (places[at] % step == 0)
        found.append((k, at[fits], begin[fits], end[fits]))
        # The next round: order the suffixes of a range by what follows after `length` words.
        after = at + length
        inside = after < ends[at]
        key = np.where(inside, rank[np.minimum(after, total - 1)] + 1, 0)
        sort = np.lexsort((key, begin))
        at, key, begin = at[sort], key[sort], begin[sort]
        order[open_] = at
        new = np.ones(len(at), bool)
        new[1:] = (begin[1:] != begin[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)
        rank[at] = np.repeat(open_[first], np.diff(np.append(first, len(at))))
        open_ = open_[~(new & np.append(new[1:], True))]
        k += 1
    return order, found


def _ragged(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the stretches (begin, count), and the stretch each belongs to."""
    owner = np.repeat(np.arange(len(begin)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return begin[owner] + inside, owner


def _equal_for(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """For how many words, up to ``most``, the words from a and from b on (or back) are the same."""
    inside, owner = _ragged(np.zeros(len(a), np.int64), most)
    differ = words[a[owner] + step * inside] != words[b[owner] + step * inside]
    out = most.copy()
    np.minimum.at(out, owner[differ], inside[differ])
    return out


def _runs_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, exponent: int, least: int) -> np.ndarray:
    """Rows (document, start, length, period) of the runs of documents laid end to end."""
    order, found = _blocks(words, starts, sizes)
    none = np.empty((0, 4), np.int64)
    if not found:
        return none
    owners = np.repeat(np.arange(len(sizes)), sizes)
    bits = max(1, int(sizes.max()).bit_length())
    matrix = WaveletMatrix(order - starts[owners[order]], bits)
    runs = []
    for k, at, begin, end in found:
        length = 1 << k
        own = owners[at]
        place = at - starts[own]
        hit, following = matrix.successor(begin, end, place + 1, place + length)
        period = following - place[hit]
        # Shorter periods are found by shorter blocks.
        kept = 2 * period > length
        at, own, period = at[hit][kept], own[hit][kept], period[kept]
        if not len(at):
            continue
        # Blocks of one period that overlap by a period are one progression.
        sort = np.lexsort((at, period, own))
        at, own, period = at[sort], own[sort], period[sort]
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (period[1:] != period[:-1]) | (at[1:] > at[:-1] + length)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        low, high = at[first], at[last] + length + period[first]
        q, own = period[first], own[first]
        most_right = np.minimum(starts[own] + sizes[own] - high, 2 * length)
        high = high + _equal_for(words, high, high - q, most_right, 1)
        most_left = np.minimum(low - starts[own], 2 * length)
        low = low - _equal_for(words, low - 1, low - 1 + q, most_left, -1)
        size = high - low
        long = size >= np.maximum(least, exponent * q)
        runs.append(np.stack([own, low - starts[own], size, q], axis=1)[long])
    return np.unique(np.concatenate(runs), axis=0) if runs else none


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    filled = pc.not_equal(flat, "")
    owner = pc.list_parent_indices(lists).to_numpy()[filled.to_numpy(zero_copy_only=False)]
    return flat.filter(filled), np.bincount(owner, minlength=len(texts))


def periodic_runs(texts: pa.Array, exponent: int = EXPONENT, least: int = LEAST) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Rows (text, start, length, period) by text, start and period; the words; the words of each text."""
    flat, sizes = _words(texts)
    starts = np.cumsum(sizes) - sizes
    codes = flat.dictionary_encode()
    kinds = len(codes.dictionary)
    codes = codes.indices.to_numpy().astype(np.int64)
    found = []
    # Documents of up to twice the length are worked on together.
    classes = np.array([int(s).bit_length() for s in sizes.tolist()])
    for level in np.unique(classes[sizes >= least]).tolist():
        members = np.flatnonzero(classes == level)
        at, owner = _ragged(starts[members], sizes[members])
        own_sizes = sizes[members]
        own_starts = np.cumsum(own_sizes) - own_sizes
        runs = _runs_of(owner * kinds + codes[at], own_starts, own_sizes, exponent, least)
        runs[:, 0] = members[runs[:, 0]]
        found.append(runs)
    runs = np.concatenate(found) if found else np.empty((0, 4), np.int64)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))], flat, sizes


def _collapsed(runs: np.ndarray, flat: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The words outside the repetitions, joined by one space: a run keeps its first period."""
    starts = np.cumsum(sizes) - sizes
    change = np.zeros(len(flat) + 1, np.int64)
    begin = starts[runs[:, 0]] + runs[:, 1]
    np.add.at(change, begin + runs[:, 3], 1)
    np.add.at(change, begin + runs[:, 2], -1)
    kept = np.cumsum(change[:-1]) == 0
    left = np.add.reduceat(np.append(kept, False).astype(np.int64), np.minimum(starts, len(flat))) if len(sizes) else sizes
    left = np.where(sizes > 0, left, 0)
    offsets = np.concatenate([[0], np.cumsum(left)])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.filter(pa.array(kept))), " ")


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs``.

    ``runs`` lists (start, length, period) in words, by start and period; ``collapsed`` is the text
    with every run cut to its first period, words joined by one space.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches):
            # Bytes that are no UTF-8 pass as they are.
            texts = chunk.column("text").cast(options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))
            runs, flat, sizes = periodic_runs(texts, exponent, least)
            offsets = np.searchsorted(runs[:, 0], np.arange(len(sizes) + 1))
            rows = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(_RUN))
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), listed, _collapsed(runs, flat, sizes)], names=["doc_id", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.select("doc_id", utf8()).mapInArrow(run, schema)

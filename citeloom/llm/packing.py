"""Packing of token ids into sequences of bounded length with balanced cost.

The cost of a piece of n tokens is estimated as ``LINEAR * n + QUADRATIC * n * n``: the layers'
products and attention within the piece. A document of more tokens than a sequence holds is cut
into whole sequences and a rest. The rests of a block of documents are taken by descending
length; each goes to the sequence of the lowest cost that has room for it, and where none has,
it is cut to fill the lowest-cost sequences that have any. A block uses as few sequences as its
tokens allow, the last of them of a power of two, so padding stays under one sequence a block.

Each task packs the blocks of its own partition; there is no shuffle. The input must come in
the same order if a task runs again, as it does from files.

Cases: a null text is an empty one (the end id alone); repeated rows are packed like others;
other columns are ignored; no rows give no pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from citeloom.llm.common import text_chunks, utf8
from citeloom.llm.tokens import encoder

SEQUENCE_TOKENS = 1024
#: Tokens packed at once; a longer document is a block of its own.
BLOCK_TOKENS = 4 << 20
LINEAR = 1.0
QUADRATIC = 1.0 / 4096
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
# A sequence id has the number of the partition above this many bits.
_ROW_BITS = 33


def pack(sizes: list[int], capacity: int = SEQUENCE_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of ``sizes`` tokens, sequences from 0."""
    pieces, rests, sequence = [], [], 0
    for doc, size in enumerate(sizes):
        whole = size // capacity
        for k in range(whole):
            pieces.append((doc, k * capacity, capacity, sequence, 0))
            sequence += 1
        if size > whole * capacity:
            rests.append((size - whole * capacity, doc, whole * capacity))
    if not rests:
        return pieces
    rests.sort(key=lambda r: (-r[0], r[1]))
    total = sum(r[0] for r in rests)
    count = -(-total // capacity)
    room = [capacity] * count
    room[-1] = 1 << int(total - (count - 1) * capacity - 1).bit_length()
    size, cost = list(room), [0.0] * count
    # Sequences with room for the rest at hand, by cost; the others by room and by cost. Entries that no
    # longer hold are passed over.
    fitting: list[tuple[float, int]] = []
    by_room, by_cost = [(-r, at) for at, r in enumerate(room)], [(0.0, at) for at in range(count)]
    heapq.heapify(by_room)
    fits = [False] * count
    for length, doc, start in rests:
        while length:
            while by_room and -by_room[0][0] >= length:
                r, at = heapq.heappop(by_room)
                if room[at] == -r and not fits[at]:
                    fits[at] = True
                    heapq.heappush(fitting, (cost[at], at))
            if fitting:
                at = heapq.heappop(fitting)[1]
                if room[at] < length:  # it fitted the end of a rest that was cut
                    fits[at] = False
                    heapq.heappush(by_room, (-room[at], at))
                    continue
            else:
                c, at = heapq.heappop(by_cost)
                if cost[at] != c or not room[at]:
                    continue
            put = min(length, room[at])
            pieces.append((doc, start, put, sequence + at, size[at] - room[at]))
            room[at] -= put
            cost[at] += linear * put + quadratic * put * put
            length, start = length - put, start + put
            fits[at] = False
            if room[at]:
                heapq.heappush(by_room, (-room[at], at))
                heapq.heappush(by_cost, (cost[at], at))
    return pieces


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, lower_case: bool = False, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece with its ids as little-endian unsigned 32-bit integers.

    ``start`` counts the document's ids before the piece, ``offset`` those of the sequence.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(tokenizer, lower_case)
        end = np.array([end_id], dtype="<u4").tobytes()
        context = TaskContext.get()
        next_sequence = (context.partitionId() if context else 0) << _ROW_BITS
        held: list[tuple[int | None, bytes]] = []
        tokens = 0

        def block() -> pa.RecordBatch:
            nonlocal next_sequence
            sizes = [len(ids) // 4 for _, ids in held]
            pieces = pack(sizes, capacity)
            columns = [
                pa.array([held[d][0] for d, *_ in pieces], pa.int64()),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([held[d][1][4 * s : 4 * (s + n)] for d, s, n, *_ in pieces], pa.binary()),
                pa.array([sizes[p[0]] for p in pieces], pa.int64()),
                pa.array([next_sequence + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
            ]
            next_sequence += 1 + max(p[3] for p in pieces)
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for chunk in text_chunks(batches, limit=4 << 20):
            for doc, ids in zip(chunk.column("doc_id").to_pylist(), work.encode(chunk.column("text").to_pylist())):
                held.append((doc, ids + end))
                tokens += len(ids) // 4 + 1
                if tokens >= BLOCK_TOKENS:
                    yield block()
                    held, tokens = [], 0
        if held:
            yield block()

    return docs.select("doc_id", utf8()).mapInArrow(run, SCHEMA)

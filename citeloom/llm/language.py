"""Language of documents as a mixture over words, by expectation-maximisation.

A language is known by its byte trigrams, counted over all training documents in ``BUCKETS``
hashed cells. A word's likelihood under a language is that of its trigrams. A document is a
mixture: each word comes from one of its languages, in proportions that EM estimates. The sets
of the one, two and up to ``MAX_SET`` languages of largest proportion are fitted again on their
own, and the one of the highest likelihood less ``PENALTY`` times the logarithm of the number
of words for every further language is selected. The prediction is its most frequent language,
the score that language's proportion before the selection.

Learning reads texts and their non-null languages, one scan with sums per task; predicting
reads texts alone. A document is worked on as its different words with their numbers, so a very
long one stays small, and batches get smaller with the number of languages.

All languages are fitted together, whatever their number. A round of EM passes twice over the words'
likelihoods, in blocks of ``BLOCK`` languages: once for the sum over all languages, once for the new
proportions. Likelihoods that fit ``HELD_BYTES`` are kept between the passes, others are worked out
again; neither changes the result. A task holds one block of the model at a time.

Cases: null texts, and texts without a letter, are ``und`` with score 0, and so is every
document if nothing could be learned; equal texts get equal results; a null id is kept; other
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from citeloom.llm.common import text_chunks, utf8

BUCKETS = 1 << 15
SMOOTHING = 0.5
ROUNDS = 12
MAX_SET = 3
PENALTY = 4.0
#: Languages of a block. Bounds what a task holds of the model.
BLOCK = 200
#: Likelihoods a task keeps between the passes of EM.
HELD_BYTES = 64 << 20
UNKNOWN = "und"

_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace")))


def _cells(letters: np.ndarray) -> np.ndarray:
    """The cell of the trigram around every byte but the first and last."""
    x = letters.astype(np.uint32)
    gram = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return (gram * np.uint32(2654435761)) >> np.uint32(32 - 15)


def trigram_counts(texts: Iterable[bytes]) -> np.ndarray:
    letters = np.frombuffer(b" " + b" ".join(t.translate(_LETTERS) for t in texts) + b" ", np.uint8)
    if len(letters) < 3:
        return np.zeros(BUCKETS, np.int64)
    return np.bincount(_cells(letters)[letters[1:-1] != 0x20], minlength=BUCKETS)


class Model:
    """Log-likelihoods of trigram cells per language: at most BLOCK times BUCKETS numbers."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        self.log = np.log((counts + SMOOTHING) / (total + SMOOTHING * BUCKETS)).T.astype(np.float32).copy() if languages else np.zeros((BUCKETS, 0), np.float32)

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood of each word under each language."""
        letters = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        inside = letters[1:-1] != 0x20
        scores = self.log[_cells(letters)[inside]]
        return np.add.reduceat(scores, np.concatenate(([0], np.cumsum(lengths)[:-1])), axis=0)

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float, str]]:
        """(language, score, languages of the selected set by proportion) of each text."""
        return predict_by([lambda: self], self.languages, texts)


class Blocks:
    """One model for every BLOCK languages, in order; kept as broadcasts and loaded one at a time."""

    def __init__(self, languages: list[str], models: list[Broadcast]):
        self.languages, self.models = languages, models

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float, str]]:
        return predict_by([lambda m=m: _loaded(m) for m in self.models], self.languages, texts)


def _loaded(model: Broadcast) -> Model:
    value = model.value
    # The broadcast would keep every block it has been asked for.
    if "_value" in vars(model) and "_path" in vars(model):
        del model._value
    return value


class _Likelihoods:
    """Likelihoods of the different words of a batch's documents, relative to a word's likeliest language, block by block."""

    def __init__(self, blocks: list[Callable[[], Model]], words: list[bytes], word: np.ndarray):
        self.blocks, self.words, self.word = blocks, words, word
        self.top = np.full(len(words), -np.inf, np.float32)
        self.count = 0
        for block in blocks:
            scores = block().word_scores(words).astype(np.float32)
            self.top, self.count = np.maximum(self.top, scores.max(axis=1)), self.count + scores.shape[1]
        self.held = list(self._worked_out()) if len(word) * self.count * 4 <= HELD_BYTES else None

    def _worked_out(self) -> Iterator[np.ndarray]:
        for block in self.blocks:
            scores = block().word_scores(self.words).astype(np.float32)
            yield np.maximum(np.exp(scores - self.top[:, None]), 1e-12)[self.word]

    def __iter__(self) -> Iterator[tuple[slice, np.ndarray]]:
        first = 0
        for part in self._worked_out() if self.held is None else self.held:
            yield slice(first, first + part.shape[1]), part
            first += part.shape[1]


def _fit(
    likely: Iterable[tuple[slice, np.ndarray]], doc: np.ndarray, starts: np.ndarray, number: np.ndarray, allowed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions per document within ``allowed`` languages, and the log-likelihood (less a constant).

    ``doc`` and ``number`` are those of each different word of a document; ``starts`` its first word.
    """
    share = (allowed / allowed.sum(axis=1, keepdims=True)).astype(np.float32)
    sizes = np.add.reduceat(number, starts)[:, None]

    def sums() -> np.ndarray:
        out = np.zeros(len(doc), np.float32)
        for columns, part in likely:
            out += (part * share[doc, columns]).sum(axis=1)
        return np.maximum(out, 1e-30)

    for _ in range(ROUNDS):
        weight = (number / sums())[:, None].astype(np.float32)
        new = np.empty_like(share)
        for columns, part in likely:
            new[:, columns] = np.add.reduceat(part * weight, starts, axis=0)
        share = (new * share / sizes).astype(np.float32)
    return share, np.add.reduceat(np.log(sums()) * number, starts)


def predict_by(blocks: list[Callable[[], Model]], languages: list[str], texts: list[bytes | None]) -> list[tuple[str, float, str]]:
    """(language, score, languages of the selected set by proportion) of each text, by models that follow each other in ``languages``."""
    out: list[tuple[str, float, str]] = [(UNKNOWN, 0.0, "")] * len(texts)
    place: dict[bytes, int] = {}
    counted = []
    for t in texts:
        words = Counter(t.translate(_LETTERS).split()) if has_letter(t) else {}
        counted.append((np.array([place.setdefault(w, len(place)) for w in words], np.int64), np.array(list(words.values()), np.float64)))
    known = [i for i, (w, _) in enumerate(counted) if len(w)]
    if not known or not languages:
        return out
    kinds = np.array([len(counted[i][0]) for i in known], dtype=np.int64)
    starts, doc = np.cumsum(kinds) - kinds, np.repeat(np.arange(len(known)), kinds)
    number = np.concatenate([counted[i][1] for i in known])
    likely = _Likelihoods(blocks, list(place), np.concatenate([counted[i][0] for i in known]))
    count = likely.count
    full, ceiling = _fit(likely, doc, starts, number, np.ones((len(known), count), np.float32))
    order = np.argsort(-full, axis=1, kind="stable")[:, : min(MAX_SET, count)]
    # The likelihoods of a document's leading languages only.
    leading = np.empty((len(doc), order.shape[1]), np.float32)
    for columns, part in likely:
        for rank in range(order.shape[1]):
            of = order[doc, rank] - columns.start
            inside = np.flatnonzero((of >= 0) & (of < part.shape[1]))
            leading[inside, rank] = part[inside, of[inside]]
    chosen = np.zeros((len(known), order.shape[1]), np.float32)
    chosen[:, 0] = 1.0
    best = np.add.reduceat(np.log(leading[:, 0]) * number, starts)
    # No set is likelier than all languages together, so only these may have several.
    price = PENALTY * np.log(np.add.reduceat(number, starts) + 1)
    mixed = np.flatnonzero(ceiling - best > price)
    if len(mixed):
        words_of = np.concatenate([np.arange(starts[d], starts[d] + kinds[d]) for d in mixed])
        part = [(slice(0, order.shape[1]), leading[words_of])]
        part_starts, part_doc = np.cumsum(kinds[mixed]) - kinds[mixed], np.repeat(np.arange(len(mixed)), kinds[mixed])
        for k in range(2, order.shape[1] + 1):
            allowed = np.zeros((len(mixed), order.shape[1]), np.float32)
            allowed[:, :k] = 1.0
            share, likelihood = _fit(part, part_doc, part_starts, number[words_of], allowed)
            likelihood = likelihood - (k - 1) * price[mixed]
            better = likelihood > best[mixed]
            best[mixed[better]], chosen[mixed[better]] = likelihood[better], share[better]
    for row, i in enumerate(known):
        ranked = [j for j in np.argsort(-chosen[row], kind="stable").tolist() if chosen[row, j] > 0]
        names = [languages[order[row, j]] for j in ranked]
        out[i] = (names[0], float(min(1.0, full[row, order[row, ranked[0]]])), ",".join(names))
    return out


def learn(docs: DataFrame) -> Model | Blocks:
    """A model of the languages in ``docs`` (text, lang); rows without either teach nothing."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, cells in sums.items():
                used = np.flatnonzero(cells)
                rows = (np.append(used, -1), np.append(cells[used], seen[lang]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows[0])), pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64())], names=["lang", "cell", "count"])
            sums.clear(), seen.clear()

        for chunk in text_chunks(batches):
            groups: dict[str, list[bytes]] = {}
            for lang, text in zip(chunk.column("lang").to_pylist(), chunk.column("text").to_pylist()):
                groups.setdefault(lang, []).append(text)
            for lang, texts in groups.items():
                sums[lang] = sums.get(lang, 0) + trigram_counts(texts)
                seen[lang] = seen.get(lang, 0) + len(texts)
            if len(sums) > BLOCK:
                yield from flush()
        yield from flush()

    # The cell -1 holds the number of documents.
    counted = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", utf8()).mapInArrow(count, "lang string, cell int, count bigint")
    summed = counted.groupBy("lang", "cell").agg(F.sum("count").alias("count")).persist()
    try:
        languages = sorted(r[0] for r in summed.filter("cell = -1").select("lang").collect())
        parts = [languages[k : k + BLOCK] for k in range(0, max(1, len(languages)), BLOCK)]
        packed = F.collect_list(F.struct("cell", "count"))
        # In the order of the languages, so that one block is filled after the other.
        rows = summed.filter("cell >= 0").groupBy("lang").agg(packed).orderBy("lang").toLocalIterator()
        row = next(rows, None)
        models: list = []
        for part in parts:
            counts = np.zeros((len(part), BUCKETS), dtype=np.int64)
            while row is not None and row[0] <= part[-1]:
                counts[part.index(row[0]), [c[0] for c in row[1]]] = [c[1] for c in row[1]]
                row = next(rows, None)
            model = Model(part, counts)
            models.append(model if len(parts) == 1 else docs.sparkSession.sparkContext.broadcast(model))
    finally:
        summed.unpersist()
    return models[0] if len(parts) == 1 else Blocks(languages, models)


def predict_languages(docs: DataFrame, model: Model | Blocks) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for chunk in text_chunks(batches, limit=max(1 << 16, (8 << 20) // max(4, min(BLOCK, len(own.languages))))):
            found = own.predict(chunk.column("text").to_pylist())
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.string())],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    return docs.select("doc_id", utf8()).mapInArrow(run, "doc_id bigint, lang_pred string, score double, languages string")

"""Quality rules by divergence from language references.

A reference holds, for one language, the shares of character classes in all its documents and
the shares of its ``COMMON_WORDS`` most frequent short words among all words. Both are counted
over every document with that language and grow with nothing but the number of languages. A
document is compared with every reference by the Jensen-Shannon distance (base 2, from 0 to 1)
of both histograms and the nearest reference counts, so a wrong language tag does no harm.

A document is rejected if it fails the base rules, or if it is long enough for the histogram
and its distance from all references is over the limit. Short documents are not judged by it.
The limit for words is a share of the distance that a text without a single common word has
from the same reference. A reference judges by words only where common words are to be expected:
they make up ``MIN_COMMON_SHARE`` of its words and ``MIN_EXPECTED`` of the document's. A document
whose characters fit a reference that cannot judge it is not judged by words at all.

Cases: null and empty texts have no words and fail the base rule; documents without a language
do not enter a reference but are judged; without any reference only the base rules count;
equal rows get equal results; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from citeloom.llm.common import mix64, text_chunks, utf8
from citeloom.session import stage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Words of a reference, and the bytes such a word has at most.
COMMON_WORDS = 64
COMMON_WORD_BYTES = 8
#: References a document is compared with at once.
BLOCK = 1024
#: Characters and words a document needs to be judged by each histogram.
MIN_CHARACTERS = 200
MIN_COMMON = 60
MAX_CHARACTER_DISTANCE = 0.18
#: Of the distance without common words, what a document may reach.
MAX_WORD_SHARE = 0.95
MIN_COMMON_SHARE = 0.15
MIN_EXPECTED = 20
#: Entries of a task's word counts that are held before they are handed on.
HELD_WORDS = 300_000

_SPACE = b" \t\n\r\x0b\x0c"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def _classes() -> np.ndarray:
    """The class of the character that begins with each byte; 0 for what is not counted.

    Digits and the marks of addresses and assignments do not count: numbers, links and keys
    say nothing about the running text.
    """
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", " ", "\t\n\r\x0b\x0c", ".,;:", "!", "?", "'\"()-", *"#*$%&|<>"]
    table = np.zeros(256, dtype=np.uint8)
    for number, group in enumerate(groups, 1):
        for c in group:
            table[ord(c)] = number
    table[0xC2:0xC4] = len(groups) + 1
    table[0xC4:] = len(groups) + 2
    return table


CLASS_OF_BYTE = _classes()
N_CLASSES = int(CLASS_OF_BYTE.max()) + 1


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    repeated = 0
    count = len(words) - WINDOW + 1
    if count > 1:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        rolled = hashes[:count].copy()
        for k in range(1, WINDOW):
            rolled = mix64(rolled * _STEP + hashes[k : count + k])
        order = np.argsort(rolled, kind="stable")
        equal = rolled[order[1:]] == rolled[order[:-1]]
        if equal.any():
            starts = np.zeros(count, dtype=bool)
            starts[order[1:][equal]] = True
            starts[order[:-1][equal]] = True
            change = np.zeros(len(words) + 1, dtype=np.int64)
            change[:count] += starts
            change[WINDOW : WINDOW + count] -= starts
            repeated = int((np.cumsum(change[:-1]) > 0).sum())
    return (
        len(words),
        len(text.translate(None, _SPACE + _CONTINUATION)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
    )


def character_counts(text: bytes | None) -> np.ndarray:
    counts = np.bincount(CLASS_OF_BYTE[np.frombuffer(text or b"", np.uint8)], minlength=N_CLASSES)
    counts[0] = 0
    return counts


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-case (A-Z) words of letters and non-ASCII characters."""
    return (text or b"").translate(_LETTERS).split(b" ") if text else []


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of ``p`` to every row of ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=-1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=-1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def language_references(docs: DataFrame) -> DataFrame:
    """(lang, kind, name, count): character classes, all words and common words per language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}
        totals: Counter = Counter()
        documents: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(lang, "word", word.decode("utf-8", "replace"), n) for lang, words in held.items() for word, n in words.items()]
            rows += [(lang, "class", str(c), int(n)) for lang, counts in classes.items() for c, n in enumerate(counts) if n]
            rows += [(lang, "words", "", n) for lang, n in totals.items()] + [(lang, "documents", "", n) for lang, n in documents.items()]
            held.clear(), classes.clear(), totals.clear(), documents.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "kind", "name", "count"])

        for chunk in text_chunks(batches):
            for lang, text in zip(chunk.column("lang").to_pylist(), chunk.column("text").to_pylist()):
                words = [w for w in plain_words(text) if w]
                held.setdefault(lang, Counter()).update([w for w in words if len(w) <= COMMON_WORD_BYTES])
                classes[lang] = classes.get(lang, 0) + character_counts(text)
                totals[lang] += len(words)
                documents[lang] += 1
            if sum(map(len, held.values())) + N_CLASSES * len(classes) > HELD_WORDS:
                yield from flush()
        yield from flush()

    counted = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", utf8()).mapInArrow(count, "lang string, kind string, name string, count bigint")
    summed = stage(counted.groupBy("lang", "kind", "name").agg(F.sum("count").alias("count")), "references")
    best = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("count"), "name"))
    common = summed.filter("kind = 'word'").withColumn("_place", best).filter(F.col("_place") <= COMMON_WORDS).drop("_place")
    return common.unionByName(summed.filter("kind NOT IN ('word', 'documents')"))


class References:
    """The references as arrays: per language COMMON_WORDS + 1 shares of words, as many places, and N_CLASSES shares."""

    def __init__(self, rows: Iterable[tuple[str, str, str, int]]):
        by_lang: dict[str, dict] = {}
        for lang, kind, name, n in sorted(map(tuple, rows)):
            of = by_lang.setdefault(lang, {"word": {}, "class": np.zeros(N_CLASSES), "words": 0})
            if kind == "word":
                of["word"][name.encode()] = n
            elif kind == "class":
                of["class"][int(name)] = n
            elif kind == "words":
                of["words"] = n
        self.place: dict[bytes, int] = {}
        for of in by_lang.values():
            for word in of["word"]:
                self.place.setdefault(word, len(self.place))
        usable = [of for of in by_lang.values() if of["words"] and of["class"].sum()]
        self.classes = np.array([of["class"] / of["class"].sum() for of in usable]).reshape(len(usable), N_CLASSES)
        # Shares of the language's own common words, and their places; the last column is everything else.
        self.words = np.zeros((len(usable), COMMON_WORDS + 1))
        # Where a language has fewer words, the place after the last one, which no text has.
        self.own = np.full((len(usable), COMMON_WORDS), len(self.place), dtype=np.int32)
        for row, of in enumerate(usable):
            for k, (word, n) in enumerate(of["word"].items()):
                self.words[row, k] = n / of["words"]
                self.own[row, k] = self.place[word]
            self.words[row, -1] = max(0.0, 1.0 - self.words[row, :-1].sum())
        without = np.zeros(COMMON_WORDS + 1)
        without[-1] = 1.0
        self.without = distance(without, self.words)
        self.common = 1.0 - self.words[:, -1]

    def _far(self, seen: np.ndarray) -> np.ndarray:
        """The distance of a text with shares ``seen`` of all places from the words of every reference."""
        far = []
        for begin in range(0, len(self.words), BLOCK):
            own = seen[self.own[begin : begin + BLOCK]]
            shares = np.concatenate([own, np.maximum(0.0, 1.0 - own.sum(axis=1, keepdims=True))], axis=1)
            far.append(distance(shares, self.words[begin : begin + BLOCK]))
        return np.concatenate(far)

    def distances(self, text: bytes | None) -> tuple[float | None, float | None, bool]:
        """The distances from the nearest reference, None where the text is too short or there is none, and whether its words are strange."""
        if not len(self.classes):
            return None, None, False
        counts = character_counts(text)
        characters, words, strange = None, None, False
        if counts.sum() >= MIN_CHARACTERS:
            characters = float(distance(counts / counts.sum(), self.classes).min())
        found = [self.place.get(w, -1) for w in plain_words(text) if w]
        if len(found) >= MIN_COMMON:
            far = self._far(np.bincount(np.array(found) + 1, minlength=len(self.place) + 2)[1:] / len(found))
            words = float(far.min())
            judges = (self.common >= MIN_COMMON_SHARE) & (self.common * len(found) >= MIN_EXPECTED)
            strange = bool(judges.any()) and bool((far[judges] > MAX_WORD_SHARE * self.without[judges]).all())
            if strange and not judges.all():
                strange = float(distance(counts / counts.sum(), self.classes[~judges]).min()) > MAX_CHARACTER_DISTANCE
        return characters, words, strange


def judge(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs`` its counts, distances and verdict, after the columns named in ``keep``."""
    keep = ["doc_id"] if keep is None else keep
    references = docs.sparkSession.sparkContext.broadcast(References(language_references(docs).collect()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        against = references.value
        for chunk in text_chunks(batches, "_text"):
            texts = chunk.column("_text").to_pylist()
            base = [base_counts(t) for t in texts]
            far = [against.distances(t) for t in texts]
            failed = [b[0] < MIN_WORDS or 100 * b[4] > MAX_REPEAT_PERCENT * b[0] for b in base]
            kept = [
                not f and (c is None or c <= MAX_CHARACTER_DISTANCE) and not strange for f, (c, _, strange) in zip(failed, far)
            ]
            new = [pa.array(list(column), pa.int64()) for column in zip(*base)]
            new += [pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array([c for c, _, _ in far], pa.float64()), pa.array([w for _, w, _ in far], pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(f"_in_{i}") for i in range(len(keep))] + new,
                names=[f"_in_{i}" for i in range(len(keep))] + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "character_distance", "word_distance"],
            )

    given = docs.select(*[docs[c].alias(f"_in_{i}") for i, c in enumerate(keep)], F.col("text").cast("binary").alias("_text"))
    kinds = ", ".join(f"_in_{i} {given.schema[f'_in_{i}'].dataType.simpleString()}" for i in range(len(keep)))
    made = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, character_distance double, word_distance double"
    out = given.mapInArrow(run, f"{kinds}, {made}")
    return out.withColumnsRenamed({f"_in_{i}": c for i, c in enumerate(keep)})


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    verdict = judge(docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)], F.col("text"), F.col("lang")), [f"_c{i}" for i in range(len(docs.columns))])
    return verdict.filter("kept").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])

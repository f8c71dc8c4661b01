"""Token ids of whole texts with the tokenizers library, one part of a text at a time.

The vocabularies used here let no token reach from a character into the white space after it,
nor from a letter to an ASCII mark. A text may be cut there and the ids of the parts put
together. Most parts are frequent: a Python worker encodes a part when it first meets it and
looks it up later, which gives the same ids several times faster.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

#: Encoded parts a Python worker keeps; when they are that many, those not used lately go first.
CACHE_PARTS = 1_000_000
#: Longer parts are encoded but not kept.
CACHE_PART_BYTES = 48

_SPACE = rb" \t\n\r\x0b\x0c"
# Letters that both vocabularies class as letters: ASCII and Latin-1.
_LETTERS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
_STOP = rb"(?=[" + _SPACE + rb"!-/:-@\[-`{-~]|\Z)"
_REST = rb"[^" + _SPACE + rb"]+"
# A word of letters up to an ASCII mark or white space, else all up to the next white space.
_SPACED_PARTS = re.compile(rb"(?:(?<![" + _SPACE + rb"]) |^|\n)" + _LETTERS + _STOP + rb"|[" + _SPACE + rb"]*" + _REST + rb"|[" + _SPACE + rb"]+")
_PARTS = re.compile(rb"(?<![^" + _SPACE + rb"])" + _LETTERS + _STOP + rb"|" + _REST)
_PLAIN_WORD = re.compile(rb" ?" + _LETTERS)
# Classes of bytes by which texts of ASCII and Latin-1 letters are cut as a whole buffer: white space, ASCII
# marks, and bytes at which a text is cut by the patterns above instead.
_IS_SPACE, _IS_MARK, _IS_OTHER, _IS_WIDE_SPACE = (np.zeros(256, bool) for _ in range(4))
_IS_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_IS_WIDE_SPACE[list(b"\t\r\x0b\x0c")] = True
_IS_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_IS_OTHER[[*range(0x1C, 0x20), 0xC2, *range(0xC4, 0x100)]] = True
# White space outside ASCII and separators on whose class programs differ; such a text is encoded as a whole.
_OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xef\xbb\xbf")


class PartEncoder:
    """Ids of texts as unsigned 32-bit integers.

    ``lower_case``: the vocabulary lower-cases and drops white space; otherwise white space
    belongs to the token after it.

    The parts of all texts of a call are looked up together: the texts are laid out in one buffer, the
    different parts are found by dictionary encoding, and the ids of all parts are gathered from
    those of the different ones.
    """

    def __init__(self, path: str, lower_case: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # For a word of letters, which both vocabularies split from the text as it is.
        self.word_tokenizer = Tokenizer(self.tokenizer.model)
        self.word_tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.lower_case = lower_case
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _cut(self, text: bytes) -> list[bytes]:
        """The parts of a text by patterns."""
        if self.lower_case:
            # A special token is one in its own case only.
            return _PARTS.findall(text if b"<|" in text else text.lower())
        return [text] if _OTHER_SPACE.search(text) else _SPACED_PARTS.findall(text)

    def _odd(self, data: np.ndarray) -> np.ndarray:
        """Places at which a text is not cut by the classes of its bytes."""
        odd = _IS_OTHER[data]
        after = data[1:]
        odd[:-1] |= (data[:-1] == 0xC3) & ((after == 0x97) | (after == 0xB7))
        odd[:-1] |= (data[:-1] == 0x3C) & (after == 0x7C)
        if not self.lower_case:
            plain = _IS_SPACE[data]
            odd |= _IS_WIDE_SPACE[data]
            odd[:-1] |= plain[:-1] & plain[1:]
        return np.flatnonzero(odd)

    def _parts(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """A buffer of all parts, where they begin, and where those of each text begin (and the last end)."""
        ends = np.cumsum([len(t) for t in texts])
        data = b"".join(texts)
        odd = np.unique(np.searchsorted(ends, self._odd(np.frombuffer(data, np.uint8)), "right")).tolist()
        cut = {k: self._cut(texts[k]) for k in odd}
        if cut:
            texts = [b"".join(cut[k]) if k in cut else t for k, t in enumerate(texts)]
        sizes = np.array([len(t) for t in texts])
        begins = np.cumsum(sizes) - sizes
        if self.lower_case:
            texts = [t if k in cut else t.lower() for k, t in enumerate(texts)]
        data = b"".join(texts)
        view = np.frombuffer(data, np.uint8)
        space, mark = _IS_SPACE[view], _IS_MARK[view]
        first = space.copy()
        # A run of marks begins a part unless a space does before it.
        alone = mark[1:] & ~mark[:-1]
        first[1:] |= alone & (view[:-1] != 0x20)
        for k, parts in cut.items():
            at = begins[k]
            first[at : at + sizes[k]] = False
            if parts:
                first[at + np.cumsum([0] + [len(p) for p in parts[:-1]])] = True
        first[begins[sizes > 0]] = True
        return data, np.flatnonzero(first), np.append(begins, len(data))

    def _encode(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Ids of different parts."""
        words = [p for p in parts if _PLAIN_WORD.fullmatch(p)]
        plain = set(words)
        others = [p for p in parts if p not in plain]
        ids = {}
        if words:
            # All words in one call, as words of one text; each id tells its word.
            found = self.word_tokenizer.encode([t.lower() if self.lower_case else t for t in (w.decode() for w in words)], is_pretokenized=True, add_special_tokens=False)
            values = np.array(found.ids, "<u4").tobytes()
            ends = np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(words)) * 4).tolist()
            ids = {w: values[begin:end] for w, begin, end in zip(words, [0, *ends], ends)}
        for part, found in zip(others, self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in others], add_special_tokens=False)):
            ids[part] = array("I", found.ids).tobytes()
        return ids

    def _ids_of(self, parts: list[bytes]) -> list[bytes]:
        """The ids of different parts."""
        if len(self.recent) > CACHE_PARTS // 2:
            self.older, self.recent = self.recent, {}
        known, older = self.recent, self.older
        new = []
        for part in parts:
            if part not in known:
                if part in older:
                    known[part] = older[part]
                else:
                    new.append(part)
        long: dict[bytes, bytes] = {}
        for begin in range(0, len(new), 20_000):
            some = new[begin : begin + 20_000]
            bare = [p.strip() for p in some] if self.lower_case else some
            ids = self._encode([*dict.fromkeys(bare)])
            for part, own in zip(some, bare):
                (known if len(part) <= CACHE_PART_BYTES else long)[part] = ids[own]
        if long:
            return [known[p] if p in known else long[p] for p in parts]
        return list(map(known.__getitem__, parts))

    def encode_flat(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where those of each text begin (and the last end)."""
        filled = [k for k, t in enumerate(texts) if t]
        if not filled:
            return np.empty(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        data, begins, bounds = self._parts([texts[k] for k in filled])
        offsets = np.append(begins, len(data)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        _, places, kinds = coded.dictionary.buffers()
        places, kinds = np.frombuffer(places, np.int64)[: len(coded.dictionary) + 1].tolist(), kinds.to_pybytes()
        ids = self._ids_of([kinds[a:b] for a, b in zip(places, places[1:])])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        values, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        kind = coded.indices.to_numpy()
        counts = sizes[kind]
        before = np.concatenate([[0], np.cumsum(counts)])
        flat = values[np.repeat(starts[kind] - before[:-1], counts) + np.arange(before[-1])]
        of_text = np.zeros(len(texts), np.int64)
        of_text[filled] = np.diff(before[np.searchsorted(begins, bounds)])
        return flat, np.concatenate([[0], np.cumsum(of_text)])

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text in bytes, in little-endian order; of null as of an empty text."""
        flat, bounds = self.encode_flat(texts)
        data, places = flat.tobytes(), (bounds * 4).tolist()
        return [data[a:b] for a, b in zip(places, places[1:])]


_ENCODERS: dict[tuple[str, bool], PartEncoder] = {}


def encoder(path: str, lower_case: bool) -> PartEncoder:
    """The encoder of this Python worker; later tasks on the worker find its parts encoded."""
    key = (path, lower_case)
    if key not in _ENCODERS:
        _ENCODERS[key] = PartEncoder(path, lower_case)
    return _ENCODERS[key]

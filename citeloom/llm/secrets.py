"""Secret scan: patterns, and a character network over every candidate in its context.

Base spans come from three patterns. Candidates are those spans and all runs of ``MIN_RUN`` or
more key characters that hold a digit, change between small and capital letters like no word does, or
follow a word that announces a key. A candidate is shown to a small convolutional network as
windows of fixed layout: ``BEFORE`` characters in front of it, ``INSIDE`` of its own and ``AFTER``
behind it; a longer candidate has a window for every stretch of it, and counts as its likeliest. The network is
trained in numpy on labelled findings, its scores are calibrated on findings kept apart (logistic
calibration), and the threshold of each shape of candidate is one half, or less where only that finds ``RECALL`` of
the kept-apart secrets of that shape that the patterns do not know. Candidates over their threshold become
spans of the kind ``model``, unless they touch a base span; base spans stay whatever their score.

Labelled findings: every different window of the corpus with the label of the base patterns, and findings
built around their contexts from the formats below, which the patterns do not know, ``MADE`` for each
block of ``BLOCK`` windows. Candidates of the corpus that no pattern knows but that look like
a key, or are announced as one, have no label and teach nothing: they may be keys. Without any finding in the
corpus only the built ones are used. Scoring covers every candidate of every document.

A corpus of one block is trained on in one place. More blocks are dealt out by the hash of the window, and training takes
``ROUNDS`` rounds: every block fits the common network to its findings for an epoch, and the weighted
mean of the blocks' networks is the next common one. Scores for the calibration and the thresholds are counted over
all blocks, to the nearest 1/``CELLS``.

Cases: a null text is an empty one; equal rows get equal results; a null id is kept; other
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from citeloom.llm.common import text_chunks, utf8
from citeloom.session import stage

MIN_RUN = 12
BEFORE, INSIDE, AFTER = 24, 40, 8
WINDOW = BEFORE + INSIDE + AFTER
#: Characters between the windows of a long candidate.
STRIDE = 28
#: Windows of a block, rounds over the blocks, and cells of a unit of score.
BLOCK = 6000
ROUNDS = 10
CELLS = 64
MADE = 8000
RECALL = 0.98
KINDS = ("assign", "access", "hex")

# The base patterns.
_ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CUES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
_RUN_BYTES = re.compile(rb"[A-Za-z0-9+/_.=-]{%d,}" % MIN_RUN)
_DIGIT = re.compile(r"[0-9]")
# Small letter, then a capital, in two places: no word of prose, few names in programs.
_MIXED = re.compile(r"[a-z0-9][A-Z].*[a-z0-9][A-Z]")
# What announces a key directly before it.
_ANNOUNCED = re.compile(r"(?:key|token|secret|passw(?:or)?d|auth\w*|bearer|credentials?)[\"']?\s*[:=]?\s*[\"']?\Z", re.IGNORECASE)
_HEX_BYTES = bytes(0x68 if chr(c) in "0123456789abcdef" else 0x20 for c in range(256))
_CODE = np.array([0 if c == 0 else c - 31 if 32 <= c < 127 else 96 if c < 127 else 97 for c in range(128)], dtype=np.uint8)
N_CODES = 98

# Formats of keys (prefix, alphabet, length) and of harmless strings with digits.
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
KEY_FORMATS = [
    ("ghp_", _UPPER + _LOWER + _DIGITS, 36),
    ("xoxb-", _DIGITS + _LOWER, 44),
    ("sk-", _UPPER + _LOWER + _DIGITS, 44),
    ("AIza", _UPPER + _LOWER + _DIGITS + "_-", 35),
    ("eyJ", _UPPER + _LOWER + _DIGITS + "_-", 80),
    ("", _UPPER + _LOWER + _DIGITS + "+/", 40),
    ("", "0123456789ABCDEF", 40),
    ("", _UPPER + _LOWER + _DIGITS, 32),
]
KEY_ALPHABETS = [_UPPER + _LOWER + _DIGITS, _UPPER + _LOWER + _DIGITS + "_-", _LOWER + _DIGITS, _UPPER + _DIGITS]
HARMLESS_FORMATS = [
    "20dd-dd-ddTdd:dd:dd",
    "dddddddddddddddd",
    "ddd.ddd.ddd.ddd",
    "d.dd.d-rcd.postd",
    "lllll-lllllll-dd",
    "lll/llllll/lllll_d.ll",
    "llllllll.dd.lllll.lll",
    "ddd-dddddddddd",
    "Llllllllllllldd",
    "llllllllllllllld.",
    "ISO-dddd-d.dddd",
    "dddd/dddd/dddd.dd",
    "lllLlllllLlllll",
    "LllllLlllllLlll",
    "Llll/Llllll/Lllll.llll",
    "Llllll-Llllll-Llll",
    "LLLL_LLLLLL_dd",
    "LLLLLLLLLL-dddd",
    "llll_llll_LLLL_dd",
    "llll://lll.lllllll.lll/llll/dddd",
    "lllll.lllll@lllll.lll",
    "dddd-dd-dd_llllll_llllll.lll",
    "LLdddddddddddddd",
    "lll=dddd_llll=ddd",
]
CUES = ["key = ", "bearer ", "credentials: ", "auth=", "private key ", "Authorization: ", ""]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, in order."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _may_have_base(text: bytes) -> bool:
    lower = text.lower()
    return any(c in lower for c in _CUES) or b"AKIA" in text or b"h" * 24 in text.translate(_HEX_BYTES)


def _codes(shown: str) -> bytes:
    return _CODE[np.minimum(np.array([ord(c) for c in shown]), 127)].tobytes()


def windows(text: str, start: int, end: int) -> bytes:
    """Character codes around and inside a candidate, padded with 0: one window, or one for every stretch of a long one."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
    after = text[end : end + AFTER].ljust(AFTER, "\0")
    last = max(start, end - INSIDE)
    places = [*range(start, last, STRIDE), last]
    return b"".join(_codes(before + text[k : min(end, k + INSIDE)].ljust(INSIDE, "\0") + after) for k in places)


def shape(text: str) -> int:
    """0: digits and marks only, 1: letters of one case and digits, 2: of both cases."""
    return 0 if not re.search("[A-Za-z]", text) else 2 if re.search("[A-Z]", text) and re.search("[a-z]", text) else 1


def looks_like_key(own: str, before: str) -> bool:
    """Whether a run outside the patterns may well be a key: announced, or long and as varied as drawn characters."""
    return bool(_ANNOUNCED.search(before)) or (len(own) >= 20 and shape(own) > 0 and len(set(own)) >= 14 and not re.search("[a-z]{7}|[A-Z]{7}", own))


def candidates(text: bytes | None) -> list[tuple[int, int, str, int, bytes, bool]]:
    """(start, end, kind or "", shape, windows, has a label) of base spans and of runs that touch none."""
    if not text:
        return []
    # The cheap tests spare most texts the patterns.
    base, runs = _may_have_base(text), bool(_RUN_BYTES.search(text))
    if not base and not runs:
        return []
    decoded = text.decode("utf-8", "replace")
    spans = base_spans(decoded) if base else []
    found = [(s, e, kind, True) for s, e, kind in spans]
    if runs:
        reach = sorted((s, e) for s, e, _ in spans)
        at = 0
        for m in _RUN.finditer(decoded):
            own, before = m.group(), decoded[max(0, m.start() - BEFORE) : m.start()]
            if not (_DIGIT.search(own) or _MIXED.search(own) or _ANNOUNCED.search(before)):
                continue
            while at < len(reach) and reach[at][1] <= m.start():
                at += 1
            if not any(s < m.end() and e > m.start() for s, e in reach[at : at + 3]):
                found.append((m.start(), m.end(), "", not looks_like_key(own, before)))
    return [(s, e, kind, shape(decoded[s:e]), windows(decoded, s, e), labelled) for s, e, kind, labelled in found]


class Network:
    """Embedding, one convolution, pooling per part of the window, one hidden layer, one output."""

    WIDTH, EMBED, FILTERS, HIDDEN = 5, 8, 24, 16
    #: Convolution places of each part.
    PARTS = ((0, BEFORE - 4), (BEFORE, BEFORE + INSIDE - 4), (BEFORE + INSIDE - 4, WINDOW - 4))

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *size: rng.normal(0, 1 / np.sqrt(size[0]), size).astype(np.float32)
        self.p = {
            "embed": rng.normal(0, 0.5, (N_CODES, self.EMBED)).astype(np.float32),
            "conv": draw(self.WIDTH * self.EMBED, self.FILTERS),
            "conv_b": np.zeros(self.FILTERS, np.float32),
            "hidden": draw(4 * self.FILTERS, self.HIDDEN),
            "hidden_b": np.zeros(self.HIDDEN, np.float32),
            "out": draw(self.HIDDEN, 1),
            "out_b": np.zeros(1, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0
        self.thresholds = [1.1, 1.1, 1.1]

    def _forward(self, x: np.ndarray) -> tuple:
        p, n = self.p, len(x)
        e = p["embed"][x]
        places = WINDOW - self.WIDTH + 1
        columns = np.concatenate([e[:, k : k + places] for k in range(self.WIDTH)], axis=2)
        c = np.maximum(columns @ p["conv"] + p["conv_b"], 0)
        best = [c[:, a:b].argmax(axis=1) + a for a, b in self.PARTS]
        rows = np.arange(n)[:, None]
        pooled = [c[rows, at, np.arange(self.FILTERS)] for at in best]
        a, b = self.PARTS[1]
        features = np.concatenate([*pooled, c[:, a:b].mean(axis=1)], axis=1)
        h = np.maximum(features @ p["hidden"] + p["hidden_b"], 0)
        return (h @ p["out"] + p["out_b"])[:, 0], (x, columns, c, best, features, h)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[k : k + 512])[0] for k in range(0, len(x), 512)] or [np.zeros(0, np.float32)])

    def _calibrated(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * scores + self.shift, -50, 50)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._calibrated(self.logits(x))

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        z, (x, columns, c, best, features, h) = self._forward(x)
        dz = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(x)).astype(np.float32)[:, None]
        g = {"out": h.T @ dz, "out_b": dz.sum(0)}
        dh = (dz @ p["out"].T) * (h > 0)
        g["hidden"], g["hidden_b"] = features.T @ dh, dh.sum(0)
        df = dh @ p["hidden"].T
        dc = np.zeros_like(c)
        rows, f = np.arange(len(x))[:, None], self.FILTERS
        for k, at in enumerate(best):
            dc[rows, at, np.arange(f)] += df[:, k * f : (k + 1) * f]
        a, b = self.PARTS[1]
        dc[:, a:b] += df[:, None, 3 * f :] / (b - a)
        dc *= c > 0
        flat = dc.reshape(-1, f)
        g["conv"], g["conv_b"] = columns.reshape(len(flat), -1).T @ flat, flat.sum(0)
        back = (flat @ p["conv"].T).reshape(len(x), -1, self.WIDTH, self.EMBED)
        g["embed"] = np.zeros_like(p["embed"])
        for k in range(self.WIDTH):
            np.add.at(g["embed"], x[:, k : k + back.shape[1]], back[:, :, k])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 128, rate: float = 0.01, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            slower = rate * (1 - 0.9 * epoch / epochs)
            order = rng.permutation(len(x))
            for k in range(0, len(x), batch):
                step += 1
                for name, g in self._gradients(x[order[k : k + batch]], y[order[k : k + batch]]).items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    self.p[name] -= slower * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def set_vector(self, numbers: np.ndarray) -> None:
        at = 0
        for name, v in self.p.items():
            self.p[name] = np.asarray(numbers[at : at + v.size], np.float32).reshape(v.shape)
            at += v.size

    def calibrate(self, x: np.ndarray, y: np.ndarray, shapes: np.ndarray, known: np.ndarray, recall: float = RECALL) -> None:
        self.calibrate_scores(self.logits(x), y, shapes, known, np.ones(len(x)), recall)

    def calibrate_scores(self, scores: np.ndarray, y: np.ndarray, shapes: np.ndarray, known: np.ndarray, n: np.ndarray, recall: float = RECALL) -> None:
        """Fit scale and shift on findings kept apart, ``n`` of each score, then the threshold of each shape.

        Secrets that the patterns know (``known``) stay whatever their score, so thresholds are held to the others.
        """
        z = np.clip(scores.astype(np.float64), -30, 30)
        # Targets moved off 0 and 1 by the number of findings keep the scale finite.
        positive, negative = (n * y).sum(), (n * (1 - y)).sum()
        t = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
        a, b = 1.0, 0.0
        for _ in range(100):
            q = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
            w = n * q * (1 - q)
            # A weak pull towards the raw scores keeps separable findings from an endless slope.
            gradient = np.array([(n * (q - t) * z).sum() + a - 1.0, (n * (q - t)).sum() + b])
            curve = np.array([[(w * z * z).sum() + 1.0, (w * z).sum()], [(w * z).sum(), w.sum() + 1.0]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(curve, gradient), -0.5, 0.5)
        self.scale, self.shift = float(a), float(b)
        prob = self._calibrated(scores)
        for s in range(3):
            of = (y > 0) & (shapes == s) & ~known
            order = np.argsort(prob[of], kind="stable")
            upto = np.cumsum(n[of][order])
            # Shapes without a kept-apart secret have no threshold they could be held to.
            self.thresholds[s] = min(0.5, float(prob[of][order][np.searchsorted(upto, int((1 - recall) * upto[-1]), side="right")])) if len(upto) else 1.1


def built_findings(contexts: list[bytes], count: int = MADE, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, labels and shapes: keys and harmless strings in the given windows' surroundings."""
    rng = np.random.default_rng(seed)
    pick = lambda alphabet, n: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))
    code = lambda s: _CODE[np.minimum(np.array([ord(c) for c in s], dtype=np.int64), 127)] if s else np.zeros(0, np.uint8)
    windows, labels, shapes = [], [], []
    for k in range(count):
        # Contexts of the corpus, and blank ones: spaces, or the ends of the text.
        if contexts and rng.random() < 0.75:
            at = np.frombuffer(contexts[int(rng.integers(len(contexts)))], np.uint8).copy()
        else:
            at = np.full(WINDOW, rng.integers(2), np.uint8)
        secret = k % 2 == 0
        if secret:
            prefix, alphabet, length = KEY_FORMATS[int(rng.integers(len(KEY_FORMATS)))]
            if k % 4 == 0:
                # A format of no known service: some letters and a mark, then drawn characters.
                prefix = pick(_LOWER, int(rng.integers(2, 8))) + pick("-_.", 1) if rng.random() < 0.7 else ""
                alphabet, length = KEY_ALPHABETS[int(rng.integers(len(KEY_ALPHABETS)))], 18 + int(46 * rng.random() ** 2)
            own = prefix + pick(alphabet, length)
            cue = CUES[int(rng.integers(len(CUES)))]
        else:
            pattern = HARMLESS_FORMATS[int(rng.integers(len(HARMLESS_FORMATS)))]
            own = "".join({"d": lambda: pick(_DIGITS, 1), "l": lambda: pick(_LOWER, 1), "L": lambda: pick(_UPPER, 1)}.get(c, lambda c=c: c)() for c in pattern)
            cue = ""
        if cue:
            at[:BEFORE] = np.concatenate([at[:BEFORE], code(cue)])[-BEFORE:]
        from_ = int(rng.integers(max(0, len(own) - INSIDE) + 1))
        shown = own[from_ : from_ + INSIDE]
        at[BEFORE : BEFORE + INSIDE] = 0
        at[BEFORE : BEFORE + len(shown)] = code(shown)
        windows.append(at), labels.append(float(secret)), shapes.append(shape(own))
    return np.array(windows).reshape(-1, WINDOW), np.array(labels), np.array(shapes)


def labelled_rows(findings: Iterable[tuple[bytes, float, int]], seed: int = 0) -> tuple[np.ndarray, ...]:
    """Windows, labels, shapes, whether from the corpus, and whether kept apart, of findings and of those built around them."""
    findings = list(findings)
    plain = [w for w, label, _ in findings if not label] or [w for w, _, _ in findings]
    x, y, s = built_findings(plain, seed=seed)
    known = np.repeat([False, True], [len(x), len(findings)])
    if findings:
        x = np.concatenate([x, np.array([np.frombuffer(w, np.uint8) for w, _, _ in findings])])
        y = np.concatenate([y, [label for _, label, _ in findings]])
        s = np.concatenate([s, [sh for _, _, sh in findings]])
    order = np.random.default_rng(1).permutation(len(x))
    return x[order], y[order], s[order], known[order], np.arange(len(x)) % 4 == 3


def train(findings: Iterable[tuple[bytes, float, int]]) -> Network:
    """A calibrated network from labelled findings (window, label, shape); every fourth calibrates."""
    x, y, s, known, apart = labelled_rows(findings)
    network = Network()
    network.fit(x[~apart], y[~apart])
    network.calibrate(x[apart], y[apart], s[apart], known[apart])
    return network


def finding_blocks(each: DataFrame, blocks: int) -> DataFrame:
    """One row per block of findings (window, label, shape) with its ``labelled_rows``, and how many come from the corpus."""

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        found = sorted(zip(*(table.column(c).to_pylist() for c in ("window", "label", "shape"))))
        x, y, s, known, apart = labelled_rows(found, seed=block)
        packed = [v.astype(np.uint8).tobytes() for v in (x, y, s, known, apart)]
        return pa.table({"block": pa.array([block], pa.int64()), "n": pa.array([len(found)], pa.int64()), **{c: pa.array([v], pa.binary()) for c, v in zip("xyska", packed)}})

    # A stated number of partitions, as run-time merging would bring small blocks into one task.
    dealt = each.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks))).repartition(blocks, "block")
    return dealt.groupBy("block").applyInArrow(gather, "block bigint, n bigint, x binary, y binary, s binary, k binary, a binary")


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Block, windows, labels, shapes, from the corpus, kept apart."""
    for batch in batches:
        for block, *packed in zip(*(batch.column(c).to_pylist() for c in ("block", *"xyska"))):
            x, y, s, known, apart = (np.frombuffer(v, np.uint8) for v in packed)
            yield block, x.reshape(-1, WINDOW), y.astype(np.float64), s, known > 0, apart > 0


def train_blocks(rows: DataFrame) -> Network:
    """A calibrated network from all blocks of ``finding_blocks``, one after the other in a task."""
    context, network = rows.sparkSession.sparkContext, Network()
    for turn in range(ROUNDS):
        common = context.broadcast(network.vector())
        rate = 0.01 * (1 - 0.9 * turn / ROUNDS)

        def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, x, y, _, _, apart in _unpacked(batches):
                own = Network()
                own.set_vector(common.value)
                own.fit(x[~apart], y[~apart], epochs=1, rate=rate, seed=block * ROUNDS + turn)
                numbers = own.vector().astype(np.float64) * (~apart).sum()
                yield pa.RecordBatch.from_arrays([pa.array([int((~apart).sum())], pa.int64()), pa.array([numbers.tolist()], pa.list_(pa.float64()))], names=["n", "numbers"])

        fitted = rows.mapInArrow(fit, "n bigint, numbers array<double>").select("n", F.posexplode("numbers").alias("at", "v"))
        # Rounded, as the last digits of a sum depend on the order of addition.
        mean = fitted.groupBy("at").agg(F.round(F.sum("v") / F.sum("n"), 7).alias("v")).orderBy("at").collect()
        network.set_vector(np.array([r["v"] for r in mean]))
        common.destroy()
    final = context.broadcast(network)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, y, s, known, apart in _unpacked(batches):
            cell = np.rint(np.clip(final.value.logits(x[apart]).astype(np.float64), -30, 30) * CELLS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(y[apart]), pa.array(s[apart].astype(np.int32)), pa.array(known[apart])], names=["cell", "y", "s", "known"])

    scored = rows.mapInArrow(score, "cell bigint, y double, s int, known boolean")
    cells = scored.groupBy("cell", "y", "s", "known").agg(F.count(F.lit(1)).alias("n")).orderBy("cell", "y", "s", "known").collect()
    z, y, s, known, n = (np.array(c) for c in zip(*cells))
    network.calibrate_scores(z / CELLS, y, s, known, n.astype(np.float64))
    return network


def learn(each: DataFrame) -> Network:
    """A network from all findings (window, label, shape) of a corpus; equal ones count once."""
    each = stage(each.distinct(), "findings")
    blocks = -(-each.count() // BLOCK)
    if blocks <= 1:
        ordered = each.orderBy(F.xxhash64("window"), "window", "label").collect()
        return train((bytes(r[0]), r[1], r[2]) for r in ordered)
    return train_blocks(stage(finding_blocks(each, blocks), "blocks"))


_CANDIDATE = "array<struct<start:bigint,end:bigint,kind:string,shape:int,windows:binary,labelled:boolean>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of base kinds, the digest of base spans, all spans and the highest score."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("shape", pa.int32()), ("windows", pa.binary()), ("labelled", pa.bool_())]))
        for chunk in text_chunks(batches):
            found = [[dict(zip(("start", "end", "kind", "shape", "windows", "labelled"), c)) for c in candidates(t)] for t in chunk.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])

    found = stage(docs.select("doc_id", utf8()).mapInArrow(collect, f"doc_id bigint, found {_CANDIDATE}"), "candidates")
    first = F.substring("c.windows", 1, WINDOW).alias("window")
    each = found.select(F.explode("found").alias("c")).filter("c.labelled").select(first, (F.col("c.kind") != "").cast("double").alias("label"), "c.shape")
    network = docs.sparkSession.sparkContext.broadcast(learn(each))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network.value
        for batch in batches:
            rows = batch.column("found").to_pylist()
            flat = [c for r in rows for c in r]
            probs = net.probability(np.frombuffer(b"".join(c["windows"] for c in flat), np.uint8).reshape(-1, WINDOW)) if flat else []
            if flat:  # a candidate counts as its likeliest window
                counts = np.array([len(c["windows"]) // WINDOW for c in flat])
                probs = np.maximum.reduceat(probs, np.cumsum(counts) - counts)
            at, out = 0, []
            for r in rows:
                own = probs[at : at + len(r)]
                at += len(r)
                base = [(c["start"], KINDS.index(c["kind"]), c["end"], c["kind"]) for c in r if c["kind"]]
                more = [(c["start"], len(KINDS), c["end"], "model") for c, q in zip(r, own) if not c["kind"] and q >= net.thresholds[c["shape"]]]
                text = lambda spans: ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))
                kinds = [b[3] for b in base]
                out.append((*[kinds.count(k) for k in KINDS], hashlib.sha256(text(base).encode()).hexdigest(), text(base + more), len(more), max(map(float, own), default=0.0)))
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(list(c), t) for c, t in zip(columns, types)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model", "top_score"],
            )

    return found.mapInArrow(score, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_model bigint, top_score double")

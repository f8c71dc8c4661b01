"""The contracts of the operators in plain Python, for small tables."""

import collections
import hashlib
import re
import zlib

import numpy as np

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def secrets(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 6:
            spans.append((m.start(), 0, m.end(), "assign"))
    for rank, (kind, pattern, least) in enumerate([("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)], 1):
        spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    kinds = [s[3] for s in spans]
    return (*[kinds.count(k) for k in ("assign", "access", "hex")], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))))


def quality(text):
    words = SPACE_WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE_WORD.search(x)]
    seen = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    repeated = {k + j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed


def token_rows(rows, tokenizer, end):
    """(doc_id, start, n_tokens, crc) in ascending order of id."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def shingles(text):
    words = SPACE_WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def components(rows):
    """doc_id to smallest reachable doc_id; rows of one id are one document."""
    ids = [d for d, _ in rows]
    up = {d: d for d in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    for k, (d, s) in enumerate(sets):
        for e, r in sets[:k]:
            if s and r and 100 * len(s & r) >= 75 * len(s | r):
                a, b = root(d), root(e)
                up[max(a, b)] = min(a, b)
    return {d: root(d) for d in ids}


def contamination(rows, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = LETTER_WORD.findall(lower(text))
        for k in range(max(1, len(words) - 9)):
            if words:
                windows[tuple(words[k : k + 10])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        words = LETTER_WORD.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(words[k : k + size])]
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def line_units(text):
    lines = (text or "").split("\n") if text is not None else []
    units = []
    for line in lines:
        if line.strip(" \t\n\r\f\v") or not units:
            if units and not units[-1].strip(" \t\n\r\f\v"):
                units[-1] += "\n" + line
            else:
                units.append(line)
        else:
            units[-1] += "\n" + line
    return [u for u in units if u.strip(" \t\n\r\f\v")]


def line_dedup(rows, run=3):
    """doc_id to (number of units, deleted places, text left), for distinct ids in order."""
    first, out = {}, {}
    for doc, text in sorted(rows):
        units = line_units(text)
        bodies = [u.strip(" \t\n\r\f\v") for u in units]
        gone = set()
        for k in range(len(units) - run + 1):
            at = first.setdefault(tuple(bodies[k : k + run]), (doc, k))
            if at[0] != doc or k >= at[1] + run:
                gone |= set(range(k, k + run))
        out[doc] = (len(units), sorted(gone), "\n".join(u for k, u in enumerate(units) if k not in gone) if gone else text)
    return out


def passage_dedup(rows, words=50):
    """As line_dedup, with runs of one and two units that hold ``words`` words."""
    first, out = {}, {}
    for doc, text in sorted(rows):
        units = line_units(text)
        bodies = [u.strip(" \t\n\r\f\v") for u in units]
        gone = set()
        for size in (1, 2, 3):
            for k in range(len(units) - size + 1):
                own = tuple(bodies[k : k + size])
                if size < 3 and sum(len(SPACE_WORD.findall(b)) for b in own) < words:
                    continue
                at = first.setdefault(own, (doc, k))
                if at[0] != doc or k >= at[1] + size:
                    gone |= set(range(k, k + size))
        out[doc] = (len(units), sorted(gone), "\n".join(u for k, u in enumerate(units) if k not in gone) if gone else text)
    return out


def repeated_strings(rows, span=50):
    texts = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for doc, text in texts:
        for k in range(len(text) - span + 1):
            if doc is not None:
                first[text[k : k + span]] = min(first.get(text[k : k + span], doc), doc)
    out = []
    for doc, text in texts:
        gone = bytearray(len(text))
        for k in range(len(text) - span + 1):
            if doc is not None and first[text[k : k + span]] < doc:
                gone[k : k + span] = b"\1" * span
        out.append((doc, len(text), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), sha(bytes(c for c, g in zip(text, gone) if not g))))
    return out


PHRASES = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}


def licenses(text):
    words = LETTER_WORD.findall(lower(text))
    at, labels = [], set()
    for label, phrase in PHRASES.items():
        for k in range(len(words) - len(phrase) + 1):
            if words[k : k + len(phrase)] == phrase:
                at.append(k)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def runs(words, exponent=4, least=6):
    """(start, length, period) of the maximal periodic stretches, by start and period."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            begin = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            length = k + q - begin
            own = words[begin : begin + length]
            if length >= max(least, exponent * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                out.add((begin, length, q))
    return sorted(out)


def collapsed(words, found):
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def planted_words(doc, text):
    words = SPACE_WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_runs(doc, text):
    words = planted_words(doc, text)
    found = runs(words)
    start, length, q = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return doc, len(found), start, length, q, None if q is None else 1000 * length // q, sha(listed), sha(collapsed(words, found))


def whitening(rows, components=8):
    """(vec_id, n, deviation) of the vectors that count, and the whitened ones up to their signs."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    lengths = collections.Counter(len(v) for _, v in kept)
    if not kept:
        return [], None, None
    length = max(lengths, key=lambda k: (lengths[k], k))
    kept = [(i, [int(np.floor(1024 * float(c))) + 100000 for c in v]) for i, v in kept if len(v) == length]
    n = len(kept)
    sums = [sum(v[k] for _, v in kept) for k in range(length)]
    x = np.array([v for _, v in kept], float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(x.T @ x / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    exact = [(i, n, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in kept]
    return exact, (x @ vectors) / np.sqrt(values), values / np.trace(x.T @ x / n)


def smallest_capacity(sizes, shards):
    """The least bytes a contiguous partition of groups needs in its largest shard."""
    def fits(capacity):
        used, at = 1, 0
        for size in sizes:
            if at + size > capacity:
                used, at = used + 1, 0
            at += size
        return used <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def language(text, model, rounds, most, penalty):
    """(language, score, selected languages) by the mixture over words, word by word; None without a letter."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0, ""
    letters = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text.encode())
    likely, count = [], len(model.languages)
    for word in letters.split():
        padded = b" " + word + b" "
        cells = [((padded[k] << 16 | padded[k + 1] << 8 | padded[k + 2]) * 2654435761 % 2**32) >> 17 for k in range(len(padded) - 2)]
        scores = [sum(float(model.log[c, j]) for c in cells) for j in range(count)]
        likely.append([max(np.exp(x - max(scores)), 1e-12) for x in scores])

    def fit(languages):
        share = {j: 1 / len(languages) for j in languages}
        for _ in range(rounds):
            new = dict.fromkeys(languages, 0.0)
            for p in likely:
                z = sum(p[j] * share[j] for j in languages)
                for j in languages:
                    new[j] += p[j] * share[j] / z / len(likely)
            share = new
        return share, sum(np.log(sum(p[j] * share[j] for j in languages)) for p in likely)

    full, ceiling = fit(range(count))
    order = sorted(range(count), key=lambda j: -full[j])
    chosen, best = {order[0]: 1.0}, sum(np.log(p[order[0]]) for p in likely)
    price = penalty * np.log(len(likely) + 1)
    if ceiling - best > price:
        for k in range(2, min(most, count) + 1):
            share, value = fit(order[:k])
            if value - (k - 1) * price > best:
                chosen, best = share, value - (k - 1) * price
    ranked = sorted(chosen, key=lambda j: (-chosen[j], order.index(j)))
    return model.languages[ranked[0]], full[ranked[0]], ",".join(model.languages[j] for j in ranked)

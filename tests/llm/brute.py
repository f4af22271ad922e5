"""Plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, n=5):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def join_components(rows):
    """(n_shingles, component) of each (doc_id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(k for x in s for k in by[x] if k < i)
        for k, both in common.items():
            if 100 * both >= 80 * (len(s) + len(sets[k]) - both):
                parent[root(i)] = root(k)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def removed_words(texts, window=35):
    """Words, number removed and words kept of each text."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def water_filling(sizes, weights, share, most):
    """Targets of sources given in order."""
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    target = [0.0] * len(sizes)
    while open_:
        total = sum(weights[i % len(weights)] for i in open_)
        over = [i for i in open_ if left * weights[i % len(weights)] / total > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = left * weights[i % len(weights)] / total
            break
        for i in over:
            target[i] = most * sizes[i]
            left -= target[i]
            open_.remove(i)
    return target


def ppm_log10(training, text, order):
    """Code length of a text by method C with exclusion, from dictionaries of contexts."""
    import math

    contexts = defaultdict(Counter)
    for t in training:
        data = b"\0" * order + (t or "").encode() + b"\xff"
        for i in range(order, len(data)):
            for k in range(order + 1):
                contexts[data[i - k : i]][data[i]] += 1
    data = b"\0" * order + (text or "").encode() + b"\xff"
    total = 0.0
    for i in range(order, len(data)):
        hidden, done = set(), False
        for k in range(order, -1, -1):
            seen = contexts.get(data[i - k : i])
            if not seen:
                continue
            free = {s: n for s, n in seen.items() if s not in hidden}
            room = sum(free.values()) + len(free)
            if data[i] in free:
                total += math.log10(free[data[i]] / room)
                done = True
                break
            if room:
                total += math.log10(len(free) / room)
            hidden = set(seen)
        if not done:
            total -= math.log10(257 - len(contexts.get(b"", {})))
    return total


def word_runs(words, least=6, times=4):
    """(start, length, period) of all runs, by start and period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, k, q) for (s, k), q in found.items())


def planted(doc_id, words):
    import zlib

    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def run_digest(doc_id, text):
    """The row of op11 for a document."""
    import hashlib

    words = planted(doc_id, WORD.findall(text or ""))
    runs = word_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )

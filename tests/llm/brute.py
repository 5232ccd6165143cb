"""Brute-force versions of the operators, in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    words = BLANK_WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_duplicates(rows):
    """rows: (doc_id, text) with ids of their own.  doc_id -> (n_shingles, component_id)."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_shingle = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].add(i)
    for i, s in sets.items():
        shared = Counter(j for x in s for j in by_shingle[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def long_repeats(texts, length=400):
    """For every text: bytes, removed, runs, digest of the rest."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(texts, items, window=10):
    """For every text: words, words hit, items found, digest of the items."""
    windows = defaultdict(set)
    for item_id, text in items:
        words = WORDS.findall((text or "").translate(LOWER))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[i : i + window])].add(item_id)
    sizes = sorted({len(w) for w in windows})
    out = []
    for text in texts:
        words = WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                ids = windows.get(tuple(words[i : i + size]))
                if ids:
                    found |= ids
                    hit |= set(range(i, i + size))
        named = sorted(str(i) for i in found if i is not None)
        out.append((len(words), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return out


SECRET = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def secrets(text):
    """(n_assign, n_access, n_hex, digest) of a text."""
    spans = [(m.start(), k, kind, m.end()) for k, (kind, (p, keep)) in enumerate(SECRET.items()) for m in p.finditer(text or "") if keep(m)]
    counts = Counter(kind for _, _, kind, _ in spans)
    line = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
    return (counts["assign"], counts["access"], counts["hex"], hashlib.sha256(line.encode()).hexdigest())


def licenses(text):
    """(n_words, n_base, first, last, labels) of the base phrases."""
    words = WORDS.findall((text or "").translate(LOWER))
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    places, labels = [], set()
    for phrase, label in phrases.items():
        wanted = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def targets(sizes, weights=(1, 2, 3), cap=3):
    """Target words per source by sharing excess again and again.  sizes: in order of the sources."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_ and left > 0:
        whole = sum(weight[i] for i in open_)
        full = {i for i in open_ if left * weight[i] / whole > cap * sizes[i] + 1e-9}
        if not full:
            for i in open_:
                out[i] = left * weight[i] / whole
            break
        for i in full:
            out[i] = float(cap * sizes[i])
            left -= out[i]
        open_ -= full
    return out

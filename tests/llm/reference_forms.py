"""Plain Python forms of what the operators compute, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import log10
from zlib import crc32

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced_words(text):
    return SPACED.findall((text or "").translate(LOWER))


def plain_words(text):
    return PLAIN.findall((text or "").translate(LOWER))


def fold(doc_id, n):
    return crc32(str(doc_id).encode()) % n


def shingle_set(text, size=3):
    words = spaced_words(text)
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def jaccard_components(rows, percent=90, size=3):
    """{row number: (set size, component)} by comparing every pair that shares a shingle."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g]}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in s:
            holders[g].append(i)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        members[find(i)].append(doc_id)
    return [
        (doc_id, len(sets[i]), min(members[find(i)]) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)
    ]


def contamination(docs, items, window=13):
    """(doc_id, words, hit, items, contaminated) by looking for every window everywhere."""
    windows = defaultdict(set)
    for item_id, text in items:
        words = plain_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i : i + size])].add(item_id)
    out = []
    for doc_id, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                items_ = windows.get(tuple(words[i : i + size]))
                if items_:
                    hit.update(range(i, i + size))
                    found |= items_
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), names, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def base_scores(rows, folds=5):
    """(doc_id, tokens, known, train tokens, base score) of each row."""
    tokens = [(doc_id, [*spaced_words(text), None]) for doc_id, text in rows]
    counts = Counter()
    for doc_id, words in tokens:
        if doc_id is not None and fold(doc_id, folds) != 1:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return [
        (d, len(w), sum(counts[x] > 0 for x in w), n, sum(log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        for d, w in tokens
    ]

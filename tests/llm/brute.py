"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile("[^ \t-\r]+")


def passages(docs, width=35):
    """(doc_id, n_words, n_removed, kept_sha256)"""
    split = [WORD.findall(t or "") for _, t in docs]
    seen = collections.Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(docs, split):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def classes(docs):
    """(doc_id, n_shingles, component_id)"""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(k)] = find(j)
        for x in s:
            holders[x].append(k)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return [(d, len(sets[k]), least.get(find(k)) if sets[k] else d) for k, (d, _) in enumerate(docs)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = [i]
        for j, y in enumerate(b, 1):
            left.append(min(row[j] + 1, left[-1] + 1, row[j - 1] + (x != y)))
        row = left
    return row[-1]


def closest_passage(item, text):
    """Least edit distance of the item to any passage of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        left = [i]
        for j, y in enumerate(text, 1):
            left.append(min(row[j] + 1, left[-1] + 1, row[j - 1] + (x != y)))
        row = left
    return min(row)


def components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}

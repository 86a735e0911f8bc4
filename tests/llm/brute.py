"""Plain versions of the operators."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def utf8(text):
    return (text or "").encode()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def substrings(rows, length=13):
    """Per row (doc_id, words, removed, sha of the kept words)."""
    first = {}
    for d, t in rows:
        w = WORD.findall(utf8(t))
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, 2**63), 2**63 if d is None else d)
    out = []
    for d, t in rows:
        w = WORD.findall(utf8(t))
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < (2**63 if d is None else d):
                gone[i : i + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), sum(gone), sha(b" ".join(kept))))
    return sorted(out, key=str)


def bytes_repeated(rows, length=200):
    places = Counter()
    for _, t in rows:
        b = utf8(t)
        places.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = utf8(t)
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if places[b[i : i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge[: len(b)]) > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, sha(kept)))
    return sorted(out, key=str)


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def shingle_set(text, size=5):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in utf8(text))
    w = WORD.findall(lower)
    if 0 < len(w) < size:
        return {tuple(w)}
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near_duplicates(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    having = defaultdict(list)
    for d in sorted(sets):
        for s in sets[d]:
            having[s].append(d)
    common = Counter()
    for ids in having.values():
        common.update((a, b) for k, b in enumerate(ids) for a in ids[:k])
    groups = Groups(sets)
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            groups.link(a, b)
    return {d: (len(sets[d]), groups.root(d)) for d in sets}


def near_vectors(rows, cosine=0.98):
    fine = [
        (i, np.array(v, float), label)
        for i, v, label in rows
        if label is not None
        and v
        and all(x is not None and np.isfinite(x) for x in v)
        and any(v)
    ]
    groups, links = Groups([i for i, _, _ in rows]), Counter()
    for k, (i, v, label) in enumerate(fine):
        for j, w, other in fine[:k]:
            if label == other and len(v) == len(w):
                if v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= cosine:
                    groups.link(i, j)
                    links.update([i, j])
    return {i: (links[i], groups.root(i)) for i, _, _ in rows}

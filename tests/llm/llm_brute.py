"""Brute-force versions, by the definitions, that several test modules compare with."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def repeats(texts, length):
    """(bytes, removed, runs, rest) of each text, by the definition."""
    seen, out = set(), []
    for raw in texts:
        edges = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                edges[p] += 1
                edges[p + length] -= 1
            seen.add(w)
        cover = np.cumsum(edges[:-1]) > 0
        runs = int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum())
        out.append((len(raw), int(cover.sum()), runs, np.frombuffer(raw, np.uint8)[~cover].tobytes()))
    return out


def shingle_set(text):
    w = re.findall("[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def hits(docs, items, window=10):
    pattern = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item, text in items:
        w = re.findall(pattern, lower(text or ""))
        m = min(window, len(w))
        for a in range(len(w) - m + 1 if m and item is not None else 0):
            windows[tuple(w[a : a + m])].add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = re.findall(pattern, lower(text or "")), set(), set()
        for m in {len(x) for x in windows}:
            for a in range(len(w) - m + 1):
                if tuple(w[a : a + m]) in windows:
                    found |= windows[tuple(w[a : a + m])]
                    hit.update(range(a, a + m))
        out[doc] = (len(w), len(hit), sorted(found))
    return out

"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def suffix_dedup(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if d is not None:
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i:i + length]] < d:
                hit[i:i + length] = b"\1" * length
        kept = bytes(x for x, h in zip(b, hit) if not h)
        spans = sum(1 for i, h in enumerate(hit) if h and (i == 0 or not hit[i - 1]))
        out.append((d, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def jaccard(rows, size=5, percent=75):
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None \
                    and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)]
        out.append((d, len(sets[i]), d if d is None or not sets[i] else min(same)))
    return out


def decontaminate(rows, items, size=13):
    windows = set()
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - size + 1) if w else 0):
            windows.add((item, tuple(w[s:s + size])))
    out = []
    for d, text in rows:
        w, hit, found = words(text), set(), set()
        for item, x in windows:
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s:s + len(x)]) == x:
                    hit.update(range(s, s + len(x)))
                    found.add(item)
        ids = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def licenses(text, phrases):
    w, places, labels = words(text), [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))

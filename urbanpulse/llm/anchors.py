"""Anchors of byte strings: positions chosen by content, such that every window
of LENGTH bytes holds one, and equal windows hold equal ones at equal places.

The anchors of a text are its minimizers: the positions whose K-byte gram has
the least hash in some window."""

from __future__ import annotations

import numpy as np

LENGTH = 50
K = 20
GRAMS = LENGTH - K + 1
CHUNK = 1 << 19

_random = np.random.default_rng(50)
_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93 | 5)
_NONE = np.uint64(2**64 - 1)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_MOST = 2 * CHUNK
_UP, _DOWN = _powers(int(_BASE), _MOST), _powers(pow(int(_BASE), -1, 2**64), _MOST)


def gram_hashes(a: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position on."""
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[a] * _UP[:len(a)], out=total[1:])
    h = (total[k:] - total[:-k]) * _DOWN[:len(a) - k + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """f (minimum or maximum) of each ``width`` consecutive numbers."""
    have = 1
    while have * 2 <= width:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def _chunk_anchors(a: np.ndarray, forbidden: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = gram_hashes(a, K)
    h[forbidden] = _NONE
    low = _sliding(np.minimum, h, GRAMS)
    edge = np.zeros(GRAMS - 1, dtype=np.uint64)
    chosen = np.flatnonzero((_sliding(np.maximum, np.concatenate((edge, low, edge)), GRAMS) == h) & (h != _NONE))
    return chosen, h[chosen]


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text number, position and gram hash of every anchor, by text and
    position.  Texts under LENGTH bytes have none."""
    out: list[tuple] = []
    group: list[tuple[int, int, bytes]] = []
    held = 0

    def flush():
        nonlocal group, held
        if not group:
            return
        size = np.array([len(p) for _, _, p in group])
        a = np.frombuffer(b"".join(p for _, _, p in group), dtype=np.uint8)
        stop = np.cumsum(size)
        # grams that run over the end of their piece don't count
        over = (stop[:-1, None] - np.arange(1, K)[None]).ravel()
        at, h = _chunk_anchors(a, over[over <= len(a) - K])
        piece = np.searchsorted(stop, at, side="right")
        owner, offset = np.array([g[0] for g in group]), np.array([g[1] for g in group])
        out.append((owner[piece], at - (stop - size)[piece] + offset[piece], h))
        group, held = [], 0

    for i, text in enumerate(texts):
        for s in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
            piece = text[s:s + CHUNK + LENGTH - 1]
            if len(piece) >= LENGTH:
                group.append((i, s, piece))
                held += len(piece)
            if held >= CHUNK:
                flush()
    flush()
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner, at, h = (np.concatenate(c) for c in zip(*out))
    # neighbouring chunks of one text may both find an anchor
    order = np.lexsort((at, owner))
    owner, at, h = owner[order], at[order], h[order]
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1])))
    return owner[new], at[new], h[new]

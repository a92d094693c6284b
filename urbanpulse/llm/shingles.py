"""Hashed word shingles of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True

_random = np.random.default_rng(20240607)
_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 4 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, CHUNK + 1), _powers(_INVERSE, CHUNK + 1)


def _chunk_words(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a short byte array."""
    blank = _BLANK[a]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    up, down = (_UP, _DOWN) if len(a) <= CHUNK else (_powers(_BASE, len(a) + 1), _powers(_INVERSE, len(a) + 1))
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[a] * up[:len(a)], out=total[1:])
    return start, mix((total[stop] - total[start]) * down[start])


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word, in order; ASCII letters count as lower case,
    words are parted by blanks and the controls 9 to 13."""
    data = data.translate(_LOWER)
    if len(data) <= CHUNK:
        return _chunk_words(np.frombuffer(data, dtype=np.uint8))[1]
    a, out, at = np.frombuffer(data, dtype=np.uint8), [], 0
    while at < len(a):
        stop = min(at + CHUNK, len(a))
        if stop < len(a):  # cut after the last blank; a longer word stays whole
            blanks = np.flatnonzero(_BLANK[a[at:stop]])
            if len(blanks):
                stop = at + int(blanks[-1]) + 1
            else:
                later = np.flatnonzero(_BLANK[a[stop:]])
                stop = stop + int(later[0]) + 1 if len(later) else len(a)
        out.append(_chunk_words(a[at:stop])[1])
        at = stop
    return np.concatenate(out)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per shingle, in order of place; fewer words than ``size`` are
    one shingle, no words none."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        h += words[k:k + n] * _PLACE[k % 64]
    return mix(h)


def shingle_set(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's UTF-8 bytes."""
    return np.unique(shingle_hashes(word_hashes(data), size))

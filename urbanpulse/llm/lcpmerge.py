"""Merging sorted runs of byte strings with a loser tree that knows prefixes.

Every head of a run carries the length of the prefix it shares with the string
given out last.  Of two heads the one with the longer shared prefix is the
smaller, without a look at any byte; only heads with equally long shared
prefixes are compared, from that length on.  What the loser then shares with
the winner is noted, so no byte of a known prefix is compared again.
"""

from __future__ import annotations

import numpy as np


def front_code(rows: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Of a sorted run: length shared with the string before, and the rest of
    every string, joined."""
    shared, rest, last = np.zeros(len(rows), dtype=np.uint8), [], b""
    for i, row in enumerate(rows):
        n = common(last, row, 0)
        shared[i] = n
        rest.append(row[n:])
        last = row
    return shared, b"".join(rest)


def front_decode(shared: np.ndarray, size: np.ndarray, rest: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for n, total in zip(shared.tolist(), size.tolist()):
        stop = at + total - n
        last = last[:n] + rest[at:stop]
        at = stop
        out.append(last)
    return out


def common(x: bytes, y: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    most = min(len(x), len(y))
    n = known
    while n < most:
        a, b = x[n:n + 16], y[n:n + 16]
        if a != b:
            size = min(len(a), len(b))
            differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
            return n + size - (differ.bit_length() + 7) // 8
        n += len(a)
    return most


def merge(runs: list[list[bytes]], shared: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """run, place in the run, and length shared with the string before, in the
    order of all strings (equal ones by run).  ``shared``: as front_code gives."""
    k = len(runs)
    total = sum(map(len, runs))
    out_run, out_at, out_lcp = [0] * total, [0] * total, [0] * total
    if not total:
        return np.array(out_run), np.array(out_at), np.array(out_lcp)
    width = 1
    while width < k:
        width *= 2
    head: list[bytes | None] = [r[0] if r else None for r in runs] + [None] * (width - k)
    length = [0 if h is not None else -1 for h in head]  # -1: exhausted
    place = [0] * width
    loser = [-1] * width

    def play(x: int, y: int) -> tuple[int, int]:
        """winner, loser of two runs; notes what the loser shares with the
        winner."""
        a, b = length[x], length[y]
        if a != b:
            return (x, y) if a > b else (y, x)
        if a < 0:
            return x, y
        p, q = head[x], head[y]
        n = common(p, q, a)
        if n == len(p):  # p is a prefix of q; equal strings: the first run wins
            if n == len(q) and y < x:
                x, y = y, x
        elif n == len(q) or p[n] > q[n]:
            x, y = y, x
        length[y] = n
        return x, y

    winner = list(range(width))
    level = winner
    node = width
    while len(level) > 1:
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            w, lost = play(level[i], level[i + 1])
            loser[node + i // 2] = lost
            up.append(w)
        level = up
    best = level[0]
    for i in range(total):
        at = place[best]
        out_run[i], out_at[i], out_lcp[i] = best, at, length[best]
        at += 1
        place[best] = at
        if at < len(runs[best]):
            head[best], length[best] = runs[best][at], shared[best][at]
        else:
            head[best], length[best] = None, -1
        x, node = best, (width + best) // 2
        while node:
            y = loser[node]
            a, b = length[x], length[y]
            if a > b:
                pass
            elif a < b:
                loser[node], x = x, y
            elif a >= 0:
                x, loser[node] = play(x, y)
            node //= 2
        best = x
    return np.array(out_run), np.array(out_at), np.array(out_lcp)

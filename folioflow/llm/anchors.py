"""Windows of a sequence, dealt to winnowed anchors.

A window's anchor is its first k-gram of least hash, so equal windows have equal
anchors at equal places. Consecutive windows with the same anchor make one run:
runs, not windows, are what documents exchange, about one in eleven words or one
in thirty-five bytes. Sequences are numpy arrays of 64-bit item hashes.
"""

from __future__ import annotations

import numpy as np

#: Windows of a piece: positions must fit the low bits of the compared keys.
PIECE_BITS = 21
PIECE = 1 << 20


def _window_min(keys: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values, by doubling."""
    out, have = keys, 1
    while have * 2 <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = n - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(grams: np.ndarray, first: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of all rows: (row, first window, windows, anchor), positions in the joined sequence.

    grams: the hash of the k-gram that starts at each item (k - 1 fewer than
    items, or none). first: each row's first item (n + 1 values)."""
    w = window - k + 1
    total = int(first[-1])
    found = []
    for lo in range(0, max(total - window + 1, 0), PIECE):
        hi = min(lo + PIECE, total - window + 1)
        part = grams[lo : hi + w - 1]
        keys = (part >> np.uint64(PIECE_BITS) << np.uint64(PIECE_BITS)) | np.arange(len(part), dtype=np.uint64)
        at = (_window_min(keys, w) & np.uint64((1 << PIECE_BITS) - 1)).astype(np.int64) + lo
        start = np.arange(lo, hi)
        row = np.searchsorted(first, start, "right") - 1
        inside = start + window <= first[row + 1]
        start, at, row = start[inside], at[inside], row[inside]
        if not len(start):
            continue
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]))
        found.append((row[new], start[new], np.diff(np.append(new, len(start))), at[new]))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))


def covered(starts: np.ndarray, counts: np.ndarray, window: int, total: int) -> np.ndarray:
    """Whether each of total items lies in one of the windows starts .. starts + counts - 1."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + counts - 1 + window, -1)
    return np.cumsum(change[:-1]) > 0

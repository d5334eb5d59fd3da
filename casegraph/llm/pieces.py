"""A growing table of text pieces by 64-bit hash, kept by each Python worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Pieces that a table may hold before it starts afresh (a cache, so results don't depend on it).
MOST_PIECES = 600_000

_TABLES: dict = {}


def worker_cache(key, make: Callable):
    """An object made once in each Python worker."""
    if key not in _TABLES:
        _TABLES[key] = make()
    return _TABLES[key]


class PieceTable:
    """Maps the hash of a piece to a row number; the owner keeps arrays by that number."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.rows = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For spans' hashes: the distinct ones' inverse, their rows (-1: new) and a first span of each."""
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        row = np.full(len(unique), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
            hit = self.keys[at] == unique
            row[hit] = self.rows[at[hit]]
        return inverse, row, first

    def add(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(hashes)
        at = np.searchsorted(self.keys, hashes[order])
        self.keys = np.insert(self.keys, at, hashes[order])
        self.rows = np.insert(self.rows, at, rows[order])

"""Ids of text units, found again by the units' 64-bit hashes."""

from __future__ import annotations

import numpy as np


class UnitIds:
    """A growing table from hashes to lists of ids, all in flat arrays.

    When it would hold more than ``limit`` units it starts anew, so its memory
    is bounded whatever the number of different units.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes, places below
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Which of the distinct sorted keys are not held; makes room for them."""
        if len(self.keys) + len(keys) > self.limit:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        return new

    def add(self, keys: np.ndarray, order: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Enter sorted new keys; ``ids`` and ``sizes`` come in the order ``order`` of the keys."""
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(need, np.uint32)))
        self.ids[self.used:need] = ids
        rows = len(self.size) + np.argsort(order)
        self.begin = np.concatenate((self.begin, self.used + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.rows = np.insert(self.keys, at, keys), np.insert(self.rows, at, rows)
        self.used = need

    def gather(self, keys: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``keys[which]`` in a row, and where each unit's begin, with the end."""
        rows = self.rows[np.searchsorted(self.keys, keys)][which]
        sizes = self.size[rows]
        total = np.concatenate(([0], np.cumsum(sizes)))
        return self.ids[np.repeat(self.begin[rows] - total[:-1], sizes) + np.arange(total[-1])], total

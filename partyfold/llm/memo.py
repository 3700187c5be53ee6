"""What a worker process has already worked out for some strings, by their hashes."""

from __future__ import annotations

import numpy as np

from partyfold.llm.words import U64


def slices(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices of `values` that begin at `first`, one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(first - ends + size, size) + np.arange(total)]


class Memo:
    """Lists of ids for hashes. Forgets everything when it holds more than `remember` of them."""

    def __init__(self, remember: int, kind: type = np.int32):
        self._remember, self._kind = remember, kind
        self._forget()

    def _forget(self) -> None:
        self._keys, self._ids = np.zeros(0, U64), np.zeros(0, self._kind)
        self._first, self._size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self._keys)

    def missing(self, distinct: np.ndarray) -> np.ndarray:
        """Which of the sorted hashes are new. Call it before `learn`, and that before `lists`."""
        if len(self._keys) > self._remember:
            self._forget()
        if not len(self._keys):
            return np.ones(len(distinct), bool)
        at = np.minimum(np.searchsorted(self._keys, distinct), len(self._keys) - 1)
        return self._keys[at] != distinct

    def learn(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Add new sorted hashes; `ids` has their lists one after another."""
        at = np.searchsorted(self._keys, keys)
        first = len(self._ids) + np.cumsum(size) - size
        self._ids = np.concatenate([self._ids, ids.astype(self._kind)])
        self._keys = np.insert(self._keys, at, keys)
        self._first, self._size = np.insert(self._first, at, first), np.insert(self._size, at, size)

    def lists(self, distinct: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of `distinct[which]`, one after another, and where each begins and the last ends."""
        place = np.searchsorted(self._keys, distinct)[which]
        size = self._size[place]
        return slices(self._ids, self._first[place], size), np.concatenate([[0], np.cumsum(size)])

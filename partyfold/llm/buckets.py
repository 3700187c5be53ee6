"""Hash buckets, and hashes packed into bytes for the way there."""

from __future__ import annotations

import numpy as np

from partyfold.llm.words import U64


class Buckets:
    """Hash buckets and the form in which hashes of a bucket are stored."""

    def __init__(self, count: int):
        self.count = count

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return (((hashes >> U64(32)) * U64(self.count)) >> U64(32)).astype(np.int64)

    def pack(self, hashes: np.ndarray) -> bytes:
        return hashes.astype("<u8").tobytes()

    def unpack(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, "<u8").astype(U64)

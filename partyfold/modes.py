"""Load modes."""

from __future__ import annotations

from partyfold import fixed


def check_mode(mode: str) -> str:
    if mode not in (fixed.FULL, fixed.DELTA):
        raise ValueError(f"load mode must be {fixed.FULL!r} or {fixed.DELTA!r}, not {mode!r}")
    return mode

"""Gaps: keys that a source has and a target lacks (our definition)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from partyfold.operators.joins import Spread, unmatched_rows


def gap_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], spread: Spread | None = None
) -> DataFrame:
    """Source rows whose key is missing from the target; null keys count as equal."""
    return unmatched_rows(source, target, keys, null_safe=True, spread=spread)


def gap_adjust(
    target: DataFrame, source: DataFrame, keys: Sequence[str], spread: Spread | None = None
) -> DataFrame:
    """The target with the gap rows appended. Adjusting twice changes nothing."""
    return target.unionByName(gap_rows(source, target, keys, spread))

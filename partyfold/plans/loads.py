"""Load modes: what a full and what a delta run does."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from partyfold import fixed
from partyfold.modes import check_mode
from partyfold.operators import Spread, delta_keys, delta_restrict, unmatched_rows


def runs_whole_history(mode: str) -> bool:
    """Control figures and the branch of manual movements look at all days; delta runs leave them out."""
    return check_mode(mode) != fixed.DELTA


def loaded_table(
    mode: str,
    base: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    reference: date,
    days: int,
    date_format: str | None = None,
    spread: Spread | None = None,
) -> DataFrame:
    """The table after a load. A full load is the source as it is.

    A delta load takes all source rows of the keys that changed in the `days` days before
    `reference` and lets them replace the base rows of the same keys. Both sides are cut by the same
    small set of keys; the rows of the delta are computed once.
    """
    if check_mode(mode) == fixed.FULL:
        return source
    changed = delta_keys(source, keys, changed_at, reference, days, date_format=date_format)
    kept = unmatched_rows(base, changed, keys, null_safe=True, spread=spread)
    return kept.unionByName(delta_restrict(source, changed, keys, spread))

"""What changed between two snapshots of a table that has no date column (our definition).

Snapshots are compared by key. A key stands for all rows that have it, so tables with
several rows per key are compared as bags, and null is a key like any other. Only keys
and fingerprints of rows are shuffled, combined on the map side: a key that holds a third of the rows
sends one row per input partition. Rows themselves are read for the changed keys only.

Fingerprints ignore the order of rows and columns; see `functions.row_fingerprint`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyfold import fixed
from partyfold.columns import actual_names
from partyfold.functions.fingerprint import PIECES, row_fingerprint
from partyfold.operators.joins import Spread, join_one, unmatched_rows

_SIDE = "__side"


def _check(old: DataFrame, new: DataFrame, change: str) -> None:
    kinds = [{f.name.lower(): f.dataType for f in df.schema.fields} for df in (old, new)]
    if kinds[0] != kinds[1]:
        raise ValueError("the snapshots differ in columns or types")
    if change.lower() in kinds[0]:
        raise ValueError(f"column {change!r} exists already")


def sided(old: DataFrame, new: DataFrame, keys: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Keys, carried columns and fingerprints of both tables; `__side` is -1 for the old rows and 1 for the new ones."""
    keys = actual_names(old, keys)
    others = sorted((c for c in old.columns if c not in keys), key=str.lower)

    def rows(df: DataFrame, side: int) -> DataFrame:
        taken = [*keys, *carried]
        own = [F.col(f"`{name}`").alias(key) for name, key in zip(actual_names(df, taken), taken)]
        return df.select(*own, F.lit(side).alias(_SIDE), *row_fingerprint(df, others))

    return rows(old, -1).unionAll(rows(new, 1))


def differing_groups(rows: DataFrame, keys: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """Of `sided` rows the groups whose two sides differ, with `old_rows`, `new_rows` and more aggregates."""
    sums = [F.sum(F.col(p) * F.col(_SIDE)).alias(p) for p in PIECES]
    groups = rows.groupBy(*keys).agg(
        F.count_if(F.col(_SIDE) < 0).alias("old_rows"), F.count_if(F.col(_SIDE) > 0).alias("new_rows"), *sums, *more
    )
    differ = reduce(or_, [F.col(p) != 0 for p in PIECES], F.col("old_rows") != F.col("new_rows"))
    return groups.where(differ).drop(*PIECES)


def changed_keys(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    change: str = fixed.CHANGE_COLUMN,
    smallest: Sequence[str] = (),
) -> DataFrame:
    """Keys whose rows differ, with the kind of change: insert, update or delete.

    Of the columns `smallest`, each one's smallest value in the key's new rows comes along; null is no value.
    """
    _check(old, new, change)
    keys, smallest = actual_names(old, keys), actual_names(old, smallest)
    kind = (
        F.when(F.col("__old") == 0, fixed.INSERT).when(F.col("__new") == 0, fixed.DELETE).otherwise(fixed.UPDATE)
    )
    least = [F.min(F.when(F.col(_SIDE) > 0, F.col(f"`{c}`"))).alias(c) for c in smallest]
    groups = differing_groups(sided(old, new, keys, smallest), keys, least)
    counts = [F.col("old_rows").alias("__old"), F.col("new_rows").alias("__new")]
    values = [F.col(f"`{c}`") for c in smallest]
    return groups.select(*keys, *counts, *values).select(*keys, kind.alias(change), *values)


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    change: str = fixed.CHANGE_COLUMN,
    spread: Spread | None = None,
    changed: DataFrame | None = None,
) -> DataFrame:
    """The rows that turn the old snapshot into the new one, and the kind of change.

    Of inserted and updated keys all new rows, of deleted keys one row that holds the key
    and nulls. `apply_diff` replays it. `changed` takes the result of `changed_keys` where it has been written already.
    """
    changed = changed_keys(old, new, keys, change) if changed is None else changed
    keys = actual_names(new, keys)
    there = changed.where(F.col(change) != fixed.DELETE)
    rows = join_one(new, there, keys, actual_names(there, keys), "inner", null_safe=True, spread=spread)
    gone = changed.where(F.col(change) == fixed.DELETE)
    return rows.unionByName(gone, allowMissingColumns=True)


def apply_diff(
    old: DataFrame,
    diff: DataFrame,
    keys: Sequence[str],
    change: str = fixed.CHANGE_COLUMN,
    spread: Spread | None = None,
) -> DataFrame:
    """The old snapshot with a diff replayed; replaying it twice changes nothing more."""
    kept = unmatched_rows(old, diff, keys, null_safe=True, spread=spread)
    return kept.unionByName(diff.where(F.col(change) != fixed.DELETE).drop(change))

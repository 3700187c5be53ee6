"""Distinct rows, one row per key, row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partyfold.columns import actual_names

_RANK = "__rank"


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def _has_map(kind: str) -> bool:
    return "map<" in kind or "variant" in kind


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all there."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the smallest one, nulls first.

    Rows compare by the `order` columns, then by the remaining columns from left to
    right, so the survivor depends on the data only and never on the order of arrival.
    Columns with maps have no order; they come last, by their JSON.

    Spark keeps only the first row of each key before the shuffle and again after it
    (a partial and a final group limit under the window). A key that holds a third of the
    table therefore sends one row per input partition, and no task sees all of its rows.
    """
    keys = actual_names(df, keys)
    leading = [c for c in actual_names(df, order or []) if c not in keys]
    payload = leading + [c for c in df.columns if c not in keys and c not in leading]
    if not payload:
        return df.select(*keys).distinct()
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    orderable = [c for c in payload if not _has_map(kinds[c])]
    others = [c for c in payload if _has_map(kinds[c])]
    last = [F.xxhash64(F.to_json(F.struct(*others))), F.to_json(F.struct(*others))] if others else []
    smallest_first = Window.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_first() for c in orderable], *last
    )
    ranked = df.withColumn(_RANK, F.row_number().over(smallest_first))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))

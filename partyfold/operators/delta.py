"""Delta loads: which keys changed, rows of those keys, and applying them (our definitions)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold import fixed
from partyfold.columns import actual_names
from partyfold.modes import check_mode
from partyfold.operators.dedup import distinct_rows, with_keys
from partyfold.operators.joins import Spread, matched_rows, unmatched_rows

_STAMPS = (T.DateType, T.TimestampType, T.TimestampNTZType)
# Text dates sort like dates only if year, month and day stand in this order, zero-padded.
TEXT_FORMATS = {"yyyyMMdd": "%Y%m%d", "yyyy-MM-dd": "%Y-%m-%d", "yyyy/MM/dd": "%Y/%m/%d"}


def in_days(
    df: DataFrame, column: str, first: date, after: date, date_format: str | None = None
) -> DataFrame:
    """Rows with `first <= column < after`.

    The column is a date or timestamp, or text with its `date_format`. The bounds take the
    column's own type, so the comparison reaches the file scan instead of a cast of every value.
    """
    [column] = actual_names(df, [column])
    kind = df.schema[column].dataType
    if isinstance(kind, _STAMPS):
        bounds = [F.lit(d.isoformat()).cast(kind) for d in (first, after)]
    elif isinstance(kind, T.StringType):
        if date_format not in TEXT_FORMATS:
            raise ValueError(
                f"{column} is text: state its date_format, one of {sorted(TEXT_FORMATS)}"
            )
        bounds = [F.lit(d.strftime(TEXT_FORMATS[date_format])) for d in (first, after)]
    else:
        raise ValueError(f"{column} is {kind.simpleString()}, not a date, a timestamp or text")
    return df.where((F.col(column) >= bounds[0]) & (F.col(column) < bounds[1]))


def delta_keys(
    df: DataFrame,
    keys: Sequence[str],
    changed_at: str,
    reference: date,
    days: int,
    mode: str = fixed.DELTA,
    date_format: str | None = None,
) -> DataFrame:
    """Distinct keys changed in the `days` days before `reference`; in full mode, all keys."""
    if check_mode(mode) == fixed.DELTA:
        since = reference - timedelta(days=days)
        df = in_days(df, changed_at, since, reference, date_format)
    return distinct_rows(with_keys(df, keys), keys)


def delta_restrict(
    table: DataFrame, changed: DataFrame, keys: Sequence[str], spread: Spread | None = None
) -> DataFrame:
    """Rows of the changed keys."""
    return matched_rows(table, changed, keys, spread=spread)


def delta_upsert(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], spread: Spread | None = None
) -> DataFrame:
    """Base rows whose key is not in the delta, plus the delta.

    Null keys count as equal here, so that applying a delta twice changes nothing. Write
    the result with `overwrite_dataset`, which may replace a table that it reads.
    """
    kept = unmatched_rows(base, delta, keys, null_safe=True, spread=spread)
    return kept.unionByName(delta)

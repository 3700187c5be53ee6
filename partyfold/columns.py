"""Column names are matched without regard to case, as Spark does by default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def actual_names(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names as the table spells them."""
    spelling = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in spelling]
    if missing:
        raise ValueError(f"no such columns: {missing}; the table has {df.columns}")
    return [spelling[n.lower()] for n in names]

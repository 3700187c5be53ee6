"""Bag union of tables of the same grain."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(tables: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """All rows of all tables, matched by column name, with the table's name as a tag.

    Columns missing from a table are null there (our definition). Nothing is shuffled.
    """
    if not tables:
        raise ValueError("nothing to unite")
    taken = [name for name, df in tables.items() if tag.lower() in map(str.lower, df.columns)]
    if taken:
        raise ValueError(f"column {tag!r} exists already in {taken}")
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)

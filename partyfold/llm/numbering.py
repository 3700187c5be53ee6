"""Consecutive numbers for the rows of a table in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partyfold.llm.storage import written

_LOW_BITS = 33  # of an increasing id, those that count rows inside a partition


def numbered(df: DataFrame, order: Sequence[str], name: str = "number") -> DataFrame:
    """The rows with their place in the order of the columns, from 0.

    The order must tell all rows apart. Rows are dealt into ranges, numbered inside them and moved
    by the rows of the ranges before, so that no task sees more than a range. The ranges are written
    first: a range drawn again after a lost executor could be another one.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    there = written(ranged.withColumn("__id", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("__id", _LOW_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = there.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows")).select(
        "__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    place = F.col("__offset") + F.col("__id").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return there.withColumn("__part", part).join(F.broadcast(offsets), "__part").select(
        *df.columns, place.alias(name)
    )

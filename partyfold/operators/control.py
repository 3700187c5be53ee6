"""Control figures: counts and sums of two tables, side by side (our definition)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold.operators.delta import in_days

_DIGITS = 38
_WHOLE_NUMBERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


@dataclass(frozen=True)
class FigureSource:
    """A table with its date column, its amount and the expressions it is grouped by.

    `date_format` is needed where the date column is text.
    """

    df: DataFrame
    date_column: str
    amount: Column
    groups: Mapping[str, Column]
    date_format: str | None = None


def _own_type(source: FigureSource) -> T.DecimalType:
    kind = source.df.select(source.amount.alias("amount")).schema["amount"].dataType
    if isinstance(kind, T.DecimalType):
        return kind
    if type(kind) in _WHOLE_NUMBERS:
        return T.DecimalType(_WHOLE_NUMBERS[type(kind)], 0)
    raise ValueError(f"state the amount_type of {kind.simpleString()} amounts, as a decimal")


def _common_type(left: T.DecimalType, right: T.DecimalType) -> T.DecimalType:
    """The decimal that holds every value of both."""
    scale = max(left.scale, right.scale)
    digits = scale + max(left.precision - left.scale, right.precision - right.scale)
    if digits > _DIGITS:
        raise ValueError(f"no decimal holds all of {left.simpleString()} and {right.simpleString()}")
    return T.DecimalType(digits, scale)


def control_figures(
    left: FigureSource,
    right: FigureSource,
    first: date,
    last: date,
    amount_type: T.DecimalType | None = None,
) -> DataFrame:
    """Rows and amounts per group within `first..last`, both days included.

    Amounts are summed in a decimal that holds those of both sides, with all their digits;
    for floats it has to be stated. An amount or a sum that does not fit is an error and
    never a zero or a null.

    A group found on one side only shows zero rows and a zero amount on the other; null is
    a group like any other. Both tables go through one aggregation, combined on the map
    side, so the figures of a hot group arrive as one row per input partition and no join
    is needed to put the sides next to each other. Sums of decimals do not depend on the
    order of the rows.
    """
    if list(left.groups) != list(right.groups):
        raise ValueError("both sides need the same group names in the same order")
    groups = list(left.groups)
    after = last + timedelta(days=1)
    kind = amount_type or _common_type(_own_type(left), _own_type(right))

    def checked(value: Column, expected: Column, what: str) -> Column:
        problem = F.raise_error(f"{what} does not fit {kind.simpleString()}").cast(kind)
        return F.when(expected & value.isNull(), problem).otherwise(value)

    def rows(source: FigureSource, is_left: bool) -> DataFrame:
        amount = checked(source.amount.try_cast(kind), source.amount.isNotNull(), "an amount")
        return in_days(source.df, source.date_column, first, after, source.date_format).select(
            *[expression.alias(name) for name, expression in source.groups.items()],
            F.lit(is_left).alias("__left"),
            amount.alias("__amount"),
        )

    on_left, on_right = F.col("__left"), ~F.col("__left")

    def total(side: Column) -> Column:
        own = F.when(side, F.col("__amount"))
        found = F.count(own)
        return F.when(found == 0, F.lit(0)).otherwise(
            checked(F.try_sum(own), found > 0, "a sum of amounts")
        )

    figures = (
        rows(left, True)
        .unionAll(rows(right, False))
        .groupBy(*groups)
        .agg(
            F.count_if(on_left).alias("left_rows"),
            F.count_if(on_right).alias("right_rows"),
            total(on_left).alias("left_amount"),
            total(on_right).alias("right_amount"),
        )
    )
    difference = F.try_subtract("left_amount", "right_amount")
    return figures.select(
        *groups,
        "left_rows",
        "right_rows",
        (F.col("left_rows") - F.col("right_rows")).alias("rows_difference"),
        "left_amount",
        "right_amount",
        F.coalesce(
            difference, F.raise_error("a difference of amounts does not fit a decimal").cast(kind)
        ).alias("amount_difference"),
    )

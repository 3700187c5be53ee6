"""Control figures kept by day (our definition).

A store has the rows and the amount of each group and day, in folders by month. They are partial sums, so any
closed range of days is answered by adding them up, without a look at the tables they come from, and
a change of some days means that these days are counted again and the folders of their months written anew.
The store grows with days and groups, not with rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold.operators.control import FigureSource
from partyfold.operators.delta import TEXT_FORMATS, in_days
from partyfold.sources import apply_to_partitions, read_dataset, write_partitions

DAY, MONTH, ROWS, AMOUNT = "day", "month", "rows", "amount"


def _sum(value: Column, kind: T.DecimalType, what: str) -> Column:
    found = F.count(value)
    total = F.try_sum(value).try_cast(kind)
    problem = F.raise_error(f"{what} does not fit {kind.simpleString()}").cast(kind)
    return F.when(found == 0, F.lit(0).cast(kind)).when(total.isNull(), problem).otherwise(total)


def daily_figures(source: FigureSource, amount_type: T.DecimalType) -> DataFrame:
    """Rows and amount of each group and day; rows without a day are in no range and left out."""
    taken = {DAY, MONTH, ROWS, AMOUNT} & {g.lower() for g in source.groups}
    if taken:
        raise ValueError(f"names of the store's own: {sorted(taken)}")
    stamp = F.col(source.date_column)
    if isinstance(source.df.schema[source.date_column].dataType, T.StringType):
        if source.date_format not in TEXT_FORMATS:
            raise ValueError(f"{source.date_column} is text: state its date_format")
        stamp = F.to_date(stamp, source.date_format)
    amount = source.amount.try_cast(amount_type)
    misfit = F.raise_error(f"an amount does not fit {amount_type.simpleString()}").cast(amount_type)
    rows = source.df.select(
        *[expression.alias(name) for name, expression in source.groups.items()],
        stamp.cast("date").alias(DAY),
        F.when(source.amount.isNotNull() & amount.isNull(), misfit).otherwise(amount).alias(AMOUNT),
    )
    return rows.where(F.col(DAY).isNotNull()).groupBy(*source.groups, DAY).agg(
        F.count("*").alias(ROWS), _sum(F.col(AMOUNT), amount_type, "a sum of a day").alias(AMOUNT)
    ).withColumn(MONTH, F.trunc(DAY, "month"))


def store_figures(source: FigureSource, path: str, amount_type: T.DecimalType) -> DataFrame:
    """The figures of all days, counted once."""
    return write_partitions(daily_figures(source, amount_type), path, [MONTH])


def refresh_figures(source: FigureSource, path: str, days: Sequence[date]) -> DataFrame:
    """Count some days again, from the table as it is now. Of the table only these days are read.

    A day that has no rows any more has no figures any more.
    """
    spark = source.df.sparkSession
    kind = read_dataset(spark, path).schema[AMOUNT].dataType
    if not days:
        return read_dataset(spark, path)
    bounds = (min(days), max(days) + timedelta(days=1))
    within = in_days(source.df, source.date_column, *bounds, source.date_format)
    near = FigureSource(within, source.date_column, source.amount, source.groups, source.date_format)
    changed = spark.createDataFrame([(d,) for d in sorted(set(days))], f"{DAY} date")
    fresh = daily_figures(near, kind).where(F.col(DAY).isin(list(days)))
    return apply_to_partitions(path, fresh, [DAY], deleted=changed)


def kept_figures(spark: SparkSession, left: str, right: str, first: date, last: date) -> DataFrame:
    """What `control_figures` says of two tables within `first..last`, from their stores."""
    stores = [read_dataset(spark, path) for path in (left, right)]
    kinds = [s.schema[AMOUNT].dataType for s in stores]
    groups = [c for c in stores[0].columns if c not in (DAY, MONTH, ROWS, AMOUNT)]
    if kinds[0] != kinds[1] or groups != [c for c in stores[1].columns if c not in (DAY, MONTH, ROWS, AMOUNT)]:
        raise ValueError("the stores differ in groups or in the type of their amounts")
    kind = kinds[0]

    def rows(store: DataFrame, is_left: bool) -> DataFrame:
        months = F.col(MONTH).between(F.lit(first.replace(day=1)), F.lit(last))  # only their folders are read
        inside = store.where(months & F.col(DAY).between(F.lit(first), F.lit(last)))
        return inside.select(*groups, ROWS, AMOUNT, F.lit(is_left).alias("__left"))

    on_left = F.col("__left")
    own = {"left": on_left, "right": ~on_left}
    figures = rows(stores[0], True).unionAll(rows(stores[1], False)).groupBy(*groups).agg(
        *[F.coalesce(F.sum(F.when(side, F.col(ROWS))), F.lit(0)).alias(f"{n}_rows") for n, side in own.items()],
        *[_sum(F.when(side, F.col(AMOUNT)), kind, "a sum of amounts").alias(f"{n}_amount") for n, side in own.items()],
    )
    difference = F.try_subtract("left_amount", "right_amount").try_cast(kind)
    problem = F.raise_error("a difference of amounts does not fit a decimal").cast(kind)
    return figures.select(
        *groups, "left_rows", "right_rows", (F.col("left_rows") - F.col("right_rows")).alias("rows_difference"),
        "left_amount", "right_amount", F.coalesce(difference, problem).alias("amount_difference"),
    )

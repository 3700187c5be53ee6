"""Loads that keep rows that do not fit apart from the others (our definition).

One pass casts every row to the wanted types and writes it into one version, in one of two columns:
accepted rows with the wanted schema, rejected ones as they came, with the columns that did not fit and why.
Both become visible in one step, and a reader of one of them reads its columns only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold.columns import actual_names
from partyfold.sources.tables import PARQUET, current_path, overwrite_dataset

_FITS = "__fits"
PROBLEMS = "problems"
MISSING = "missing"
MISFIT = "does not fit"


@dataclass(frozen=True)
class CheckedLoad:
    """What came of a load. The counts are those the load itself made while it wrote."""

    accepted: DataFrame
    rejected: DataFrame
    accepted_rows: int
    rejected_rows: int


def cast_or_null(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """The value in the wanted type, null where it does not fit; a decimal that would be rounded does not fit."""
    cast = value.try_cast(wanted)
    if isinstance(wanted, T.DecimalType) and isinstance(given, (T.StringType, T.DecimalType)):
        return F.when(cast == value.try_cast(T.DecimalType(38, 18)), cast)
    if isinstance(wanted, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) and isinstance(
        given, (T.FloatType, T.DoubleType, T.DecimalType)
    ):
        return F.when(cast.cast(given) == value, cast)
    return cast


def problems(df: DataFrame, wanted: T.StructType) -> Column:
    """The columns of a row that do not fit, with the value as text and the reason; empty if all fit."""
    names = actual_names(df, wanted.fieldNames())
    found = []
    for name, field in zip(names, wanted.fields):
        value = F.col(f"`{name}`")
        misfit = value.isNotNull() & cast_or_null(value, df.schema[name].dataType, field.dataType).isNull()
        reason = F.when(misfit, F.lit(f"{MISFIT} {field.dataType.simpleString()}"))
        if not field.nullable:
            reason = F.when(value.isNull(), F.lit(MISSING)).otherwise(reason)
        entry = F.struct(
            F.lit(field.name).alias("column"), value.cast("string").alias("value"), reason.alias("reason")
        )
        found.append(F.when(reason.isNotNull(), entry))
    return F.filter(F.array(*found), lambda p: p.isNotNull())


def checked_load(df: DataFrame, path: str, wanted: T.StructType, fmt: str = PARQUET) -> CheckedLoad:
    """Replace a dataset by the rows that fit the wanted schema; the others are kept beside them.

    Every row of `df` is in exactly one of the two, repeated rows too. Columns that the schema does not name
    are left out of the accepted rows and kept in the rejected ones. Types come back as stated, dates, timestamps and
    decimals too, or the load fails and leaves the old version. Readers of the dataset itself get both
    parts; use `read_accepted` and `read_rejected`.
    """
    spark, seen = df.sparkSession, Observation()
    taken = {c.lower() for c in df.columns} & {PROBLEMS, _FITS}
    if taken:
        raise ValueError(f"columns of the load's own: {sorted(taken)}")
    names = actual_names(df, wanted.fieldNames())
    found = df.withColumn(PROBLEMS, problems(df, wanted)).withColumn(_FITS, F.size(PROBLEMS) == 0)
    fits = F.col(_FITS)
    cast = F.struct(*[
        cast_or_null(F.col(f"`{n}`"), df.schema[n].dataType, f.dataType).alias(f.name) for n, f in zip(names, wanted.fields)
    ])
    as_given = F.struct(*[F.col(f"`{c}`") for c in df.columns], PROBLEMS)
    split = found.observe(
        seen, F.count_if(fits).alias("accepted"), F.count_if(~fits).alias("rejected")
    ).select(fits.alias("accepted"), F.when(fits, cast).alias("row"), F.when(~fits, as_given).alias("refused"))

    def check(where: str) -> None:
        stored = spark.read.format(fmt).load(where).schema["row"].dataType
        kinds = [(f.name, f.dataType) for f in stored.fields]
        if kinds != [(f.name, f.dataType) for f in wanted.fields]:
            raise TypeError(f"the load changed the schema: {stored.simpleString()}")

    overwrite_dataset(split, path, fmt, check=check)
    return CheckedLoad(
        read_accepted(spark, path, fmt), read_rejected(spark, path, fmt),
        seen.get["accepted"], seen.get["rejected"],
    )


def read_accepted(spark, path: str, fmt: str = PARQUET) -> DataFrame:
    return _part(spark, path, fmt, True, "row")


def read_rejected(spark, path: str, fmt: str = PARQUET) -> DataFrame:
    """The rows that did not fit, as they came, and their `problems`."""
    return _part(spark, path, fmt, False, "refused")


def _part(spark, path: str, fmt: str, accepted: bool, column: str) -> DataFrame:
    whole = spark.read.format(fmt).load(current_path(spark, path))
    return whole.where(F.col("accepted") == F.lit(accepted)).select(f"{column}.*")

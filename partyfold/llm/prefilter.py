"""Joins of wide rows with a set of ids of which they hold few.

The ids are hashed into a bitmap of fixed size, at most 256 rows of 4 KiB, which is
broadcast whatever the number of ids. Rows whose bit is not set are not in the set and never meet
the join; only the others are shuffled. With so many ids that every bit is set, all rows are, as in a plain join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 1 << 23  # 256 bitmaps of the size that bitmap_construct_agg makes


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(_BITS))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _split(rows: DataFrame, key: str, ids: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may have an id of the set, and those that have none."""
    number, bits, flag = (free_name(rows, name) for name in ("__bitmap", "__bits", "__maybe"))
    place = _place(F.col(id_column).cast("bigint"))
    bitmap = (
        ids.where(F.col(id_column).isNotNull())
        .groupBy(F.bitmap_bucket_number(place).alias(number))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bits))
    )
    own = _place(F.col(key).cast("bigint"))
    bit = F.bitmap_bit_position(own)
    joined = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(own) == F.col(number), "left")
    byte = F.conv(F.hex(F.substring(bits, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    maybe = F.when(F.col(key).isNull(), False).otherwise(is_set)
    flagged = joined.withColumn(flag, maybe)
    return (
        flagged.where(F.col(flag)).select(*rows.columns),
        flagged.where(~F.col(flag)).select(*rows.columns),
    )


def with_ids(rows: DataFrame, key: str, ids: DataFrame, id_column: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is an id of the set; with `how` inner, the other columns of `ids` too."""
    own = free_name(rows, "__id")
    ids = ids.withColumnRenamed(id_column, own)
    maybe, _ = _split(rows, key, ids, own)
    return maybe.join(ids, F.col(key) == F.col(own), how).drop(own)


def without_ids(rows: DataFrame, key: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows whose key is no id of the set, null keys among them."""
    own = free_name(rows, "__id")
    ids = ids.withColumnRenamed(id_column, own)
    maybe, never = _split(rows, key, ids, own)
    return never.unionAll(maybe.join(ids, F.col(key) == F.col(own), "left_anti"))

"""Fingerprints of rows that add up, in any order, to fingerprints of groups of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold.columns import actual_names

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_PIECE_BITS = 24
#: Names of the pieces that `row_fingerprint` gives.
PIECES = ("__print_0", "__print_1", "__print_2", "__print_3")


def row_fingerprint(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Four numbers of 24 bits for each row, named `PIECES`.

    Nulls count, also inside arrays, maps and structs: Spark's hash passes over them, so a
    flag goes with each column and nested values are hashed as JSON. Sums of a piece over 2**39 rows fit a
    bigint, so groups are compared by plain sums that combine on the map side. Rows or groups that differ
    have equal prints with a chance of about 2**-96. As in Spark, -0.0 equals 0.0 and NaN equals NaN.
    """
    parts: list[Column] = []
    for name in actual_names(df, columns):
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, _NESTED):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        parts += [value, F.col(f"`{name}`").isNull()]
    mask = F.lit((1 << _PIECE_BITS) - 1)
    pieces = []
    for seed in (1, 2):
        whole = F.xxhash64(F.lit(seed), *parts)
        pieces += [whole.bitwiseAND(mask), F.shiftrightunsigned(whole, 64 - _PIECE_BITS)]
    return [piece.alias(name) for piece, name in zip(pieces, PIECES)]

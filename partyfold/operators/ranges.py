"""Runs of missing numbers inside a key, such as the versions that a policy lacks (our definition).

The numbers of a key are cut into blocks of 2**bits numbers. The distinct numbers of a block are
gathered, combined on the map side, and the runs between them read off. A block then counts as one piece, from its
smallest to its largest number, and the pieces of a key are cut into blocks of blocks, until one block spans
all 64-bit numbers. So no row ever holds more than 2**bits pieces, also for a key
that holds a third of the rows, and missing numbers are only ever the two ends of a run.
The rows are read and shuffled once; the shuffle of a level serves its runs and the next level alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold.columns import actual_names

_WIDTH = 64
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_BLOCK, _PIECES, _RUN = "__block", "__pieces", "__run"


def missing_ranges(
    df: DataFrame, keys: Sequence[str], number: str, first: int | None = None, bits: int = 16
) -> DataFrame:
    """Keys with `first_missing`, `last_missing` and `missing`, one row for each run of missing numbers.

    Runs lie between two numbers of a key; with `first` also between it and a key's smallest
    number, where that is larger. Null keys are a key; rows without a number say nothing. `missing` is a
    decimal, as a run may be longer than a bigint counts.
    """
    if not 1 <= bits <= _WIDTH:
        raise ValueError("a block has 2**1 to 2**64 numbers")
    keys, [column] = actual_names(df, keys), actual_names(df, [number])
    if not isinstance(df.schema[column].dataType, _WHOLE):
        raise ValueError(f"{column} is {df.schema[column].dataType.simpleString()}, not a whole number")
    value = F.col(f"`{column}`").cast("bigint")
    there = df.where(value.isNotNull())
    pieces = there.select(*[F.col(f"`{k}`") for k in keys], F.struct(value.alias("low"), value.alias("high")).alias("__piece"))
    found = []
    for shift in [*range(bits, _WIDTH, bits), _WIDTH]:
        low = F.col("__piece")["low"]
        block = F.shiftright(low, shift) if shift < _WIDTH else F.lit(0).cast("bigint")
        blocks = pieces.withColumn(_BLOCK, block).groupBy(*keys, _BLOCK).agg(
            F.array_sort(F.collect_set("__piece")).alias(_PIECES)
        )
        pairs = F.zip_with(
            F.slice(_PIECES, F.lit(1), F.size(_PIECES) - 1),
            F.slice(_PIECES, F.lit(2), F.size(_PIECES) - 1),
            lambda a, b: F.struct((a["high"] + 1).alias("first_missing"), (b["low"] - 1).alias("last_missing")),
        )
        runs = F.filter(pairs, lambda r: r["first_missing"] <= r["last_missing"])
        found.append(blocks.select(*keys, F.explode(runs).alias(_RUN)).select(*keys, f"{_RUN}.*"))
        ends = F.struct(F.element_at(_PIECES, 1)["low"].alias("low"), F.element_at(_PIECES, -1)["high"].alias("high"))
        pieces = blocks.select(*keys, ends.alias("__piece"))
    if first is not None:
        lowest = F.col("__piece")["low"]
        start = F.lit(first).cast("bigint")
        late = pieces.where(lowest > start)
        found.append(late.select(*keys, start.alias("first_missing"), (lowest - 1).alias("last_missing")))
    wide = [F.col(c).cast("decimal(20,0)") for c in ("first_missing", "last_missing")]
    return reduce(DataFrame.unionAll, found).withColumn("missing", (wide[1] - wide[0] + 1).cast("decimal(20,0)"))

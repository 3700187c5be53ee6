"""Joins of a large table with a table that holds at most one row per key.

Plain equi-joins unless told otherwise: filters and column pruning pass through them, and
Spark broadcasts a right side that it knows or has measured to be small, where no key can be hot. No
side is marked for broadcast.

For two large sides, `Spread` keeps a key that holds a third of the left side from ending
up in one task:

1. The left keys are hashed into `buckets` buckets and the buckets are counted, combined
   on the map side. The result is one row with a number for each bucket, used as a scalar subquery.
2. What a bucket has beyond twice the average is dealt to as many salts as it has times `rows_per_task`.
   There is no upper limit.
3. Left rows take one of the salts of their bucket, right rows are repeated once for each,
   and the join is on the key and the salt.

The salt is a hash of the key and the columns `by` names, so it is the same whenever a task is run, it
needs no column besides these, and filters and column pruning pass through it as well. Rows
of one key that are alike in those columns stay together: name columns that tell them apart.

Right rows grow by those of the hot buckets only; more buckets leave fewer innocent keys in
them. Adaptive execution alone would not do: it looks at compressed bytes, and the rows of
a hot key, being so alike, compress to much less than their number suggests; and it
does not split a join that an aggregation feeds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyfold.columns import actual_names
from partyfold.operators.dedup import distinct_rows, with_keys

_BUCKET = "__bucket"
_SALTS = "__salts"
_SALT = "__salt"
_RIGHT_SALT = "__right_salt"
_RIGHT_KEY = "__right_key_"


@dataclass(frozen=True)
class Spread:
    """How to deal out hot keys.

    `by`: left columns that tell the rows of a key apart. `counted`: a table with about the same
    keys that is cheaper to compute than the left side. `rows_per_task`: how many rows of a
    hot bucket one salt takes. `buckets`: numbers in the scalar subquery.
    """

    by: Sequence[str]
    counted: DataFrame | None = None
    rows_per_task: int = 1_000_000
    buckets: int = 16_384

    def __post_init__(self) -> None:
        if not self.by or self.rows_per_task < 1 or self.buckets < 1:
            raise ValueError("give columns to spread by, and at least one row and bucket")


def _bucket(keys: Sequence[str], spread: Spread) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(spread.buckets)).cast("int")


def _salts_per_bucket(df: DataFrame, keys: Sequence[str], spread: Spread) -> DataFrame:
    """One row with the number of salts of every bucket, as an array."""
    present = df.select(_bucket(keys, spread).alias(_BUCKET), F.lit(1).alias("n"))
    every = df.sparkSession.range(spread.buckets).select(F.col("id").cast("int"), F.lit(0))
    counted = present.unionAll(every).groupBy(_BUCKET).agg(F.sum("n").alias("n"))
    counts = counted.agg(
        F.avg("n").alias("average"),
        F.array_sort(F.collect_list(F.struct(_BUCKET, "n"))).alias("buckets"),
    )
    rows, ordinary = F.lit(spread.rows_per_task), F.col("average") * 2
    salts = F.transform(
        "buckets",
        lambda b: F.when(b["n"] <= F.greatest(ordinary, rows), 1).otherwise(F.ceil(b["n"] / rows)),
    )
    return counts.select(salts.cast("array<int>").alias(_SALTS))


def _salt_count(salts: DataFrame, keys: Sequence[str], spread: Spread) -> Column:
    return F.get(salts.scalar(), _bucket(keys, spread))


def _take_one_salt(
    df: DataFrame, salts: DataFrame, keys: Sequence[str], spread: Spread
) -> DataFrame:
    """Each row with one of the salts of its bucket."""
    row_hash = F.xxhash64(*keys, *actual_names(df, spread.by))
    salt = F.pmod(row_hash, _salt_count(salts, keys, spread)).cast("int")
    return df.select(*df.columns, salt.alias(_SALT))


def _repeat_for_salts(
    df: DataFrame, salts: DataFrame, keys: Sequence[str], spread: Spread
) -> DataFrame:
    """Each row once for every salt of its bucket."""
    all_salts = F.explode(F.sequence(F.lit(0), _salt_count(salts, keys, spread) - 1))
    return df.select(*df.columns, all_salts.alias(_RIGHT_SALT))


def join_one(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    how: str,
    null_safe: bool = False,
    spread: Spread | None = None,
) -> DataFrame:
    """Join with a right side of one row per key; its other columns come along."""
    if len(left_keys) != len(right_keys) or not left_keys:
        raise ValueError("give the same number of keys, at least one, for both sides")
    left_keys, right_keys = actual_names(left, left_keys), actual_names(right, right_keys)
    payload = [c for c in right.columns if c not in right_keys]
    clash = {c.lower() for c in payload} & {c.lower() for c in left.columns}
    if how in ("left", "inner") and clash:
        raise ValueError(f"columns on both sides of the join: {sorted(clash)}")
    for a, b in zip(left_keys, right_keys):
        if left.schema[a].dataType != right.schema[b].dataType:
            raise ValueError(f"keys {a} and {b} differ in type, cast one of them")

    aliases = [f"{_RIGHT_KEY}{i}" for i in range(len(right_keys))]
    right = right.select(*[F.col(k).alias(a) for k, a in zip(right_keys, aliases)], *payload)
    pairs = [(F.col(key), F.col(alias)) for key, alias in zip(left_keys, aliases)]
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    if spread is not None:
        counted = left if spread.counted is None else spread.counted
        salts = _salts_per_bucket(counted, left_keys, spread)
        left = _take_one_salt(left, salts, left_keys, spread)
        right = _repeat_for_salts(right, salts, aliases, spread)
        # Keys first: the salt is nearly always zero and would make a slow first sort column.
        same.append(F.col(_SALT) == F.col(_RIGHT_SALT))
    return left.join(right, reduce(and_, same), how).drop(_SALT, _RIGHT_SALT, *aliases)


def left_join_one(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    spread: Spread | None = None,
) -> DataFrame:
    """Left outer join with a table that has one row per key; keeps every left row once.

    Keys are compared as they are: `'K '` does not match `'K'`, null matches nothing.
    Reduce the right side with `first_per_key` first.
    """
    return join_one(left, right, left_keys, right_keys, "left", spread=spread)


def matched_rows(
    table: DataFrame,
    key_table: DataFrame,
    keys: Sequence[str],
    key_table_keys: Sequence[str] | None = None,
    spread: Spread | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Rows of `table` whose key occurs in `key_table` (our definition).

    A null key occurs nowhere, unless `null_safe` asks for null to equal null.
    """
    other = actual_names(key_table, key_table_keys or keys)
    rows = key_table if null_safe else with_keys(key_table, other)
    present = distinct_rows(rows, other)
    return join_one(table, present, keys, other, "left_semi", null_safe, spread)


def unmatched_rows(
    table: DataFrame,
    key_table: DataFrame,
    keys: Sequence[str],
    key_table_keys: Sequence[str] | None = None,
    null_safe: bool = False,
    spread: Spread | None = None,
) -> DataFrame:
    """Rows of `table` whose key does not occur in `key_table` (our definition).

    A null key occurs nowhere, unless `null_safe` asks for null to equal null.
    """
    other = actual_names(key_table, key_table_keys or keys)
    rows = key_table if null_safe else with_keys(key_table, other)
    present = distinct_rows(rows, other)
    return join_one(table, present, keys, other, "left_anti", null_safe, spread)


def chain_fanout(
    left: DataFrame, left_key: str, rights: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    """Rows that a chain of left joins on one key would make, per key, without making them.

    Counts per key are combined on the map side and multiplied; a right side that lacks
    the key counts as one row. A chain is worth reducing first where the numbers are high.
    Products are decimals of 38 digits; one that is longer still is an error.
    """
    [key] = actual_names(left, [left_key])
    counted = left.select(F.col(key), F.lit(0).alias("__side"))
    for side, (right, right_key) in enumerate(rights, start=1):
        keys = right.select(F.col(right_key).alias(key), F.lit(side).alias("__side"))
        counted = counted.unionAll(with_keys(keys, [key]))
    sides = range(len(rights) + 1)
    per_key = counted.groupBy(key).agg(
        *[F.count_if(F.col("__side") == side).alias(f"__rows_{side}") for side in sides]
    )

    def wide(rows: Column) -> Column:
        return rows.cast("decimal(19,0)")

    product = wide(F.col("__rows_0")).cast("decimal(38,0)")
    for side in sides[1:]:
        times = F.greatest(F.col(f"__rows_{side}"), F.lit(1))
        exact = (product * wide(times)).cast("decimal(38,0)")
        product = F.coalesce(exact, F.raise_error("more than 38 digits of joined rows").cast("decimal(38,0)"))
    return per_key.where(F.col("__rows_0") > 0).select(key, product.alias("joined_rows"))

"""Which keys stand behind a difference of two tables (our definition).

Keys are hashed to 64 bits, and the hashes are a tree of ranges: 2**bits ranges, each of
2**bits ranges, and so on. At each level both tables are summed up by range, counts and fingerprints that
do not depend on the order of rows, and only ranges whose sides differ are descended into. That is one row
for each range and input partition, whatever the tables hold. In the ranges that are left the rows are
compared by key; only their keys and fingerprints are shuffled. If very many ranges differ the
descent ends early, as there is little left to leave out; the result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.columns import actual_names
from partyfold.operators.snapshots import differing_groups, sided

_HASH, _RANGE = "__hash", "__range"


def differing_ranges(rows: DataFrame, levels: int, bits: int, most: int) -> tuple[list[int], int]:
    """The ranges of the lowest level reached whose sides differ, and that level.

    `rows` has `__hash`, and sides and prints as `operators.snapshots.sided` gives them. At most `most` + 1
    numbers reach the driver from a level.
    """
    found, level = [0], 0
    while level < levels:
        within = rows if level == 0 else rows.where(_in_ranges(found, level * bits))
        ranges = within.withColumn(_RANGE, F.shiftrightunsigned(_HASH, 64 - (level + 1) * bits))
        differ = differing_groups(ranges, [_RANGE]).select(_RANGE).limit(most + 1).collect()
        if len(differ) > most:
            break
        found, level = sorted(r[_RANGE] for r in differ), level + 1
        if not found:
            break
    return found, level


def _in_ranges(ranges: Sequence[int], bits: int):
    return F.shiftrightunsigned(_HASH, 64 - bits).isin(list(ranges))


def differing_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], levels: int = 2, bits: int = 12, most: int = 4096
) -> DataFrame:
    """Keys whose rows differ, with `left_rows` and `right_rows`.

    A key stands for all rows that have it, as in `changed_keys`; null is a key. The tables need the same columns, in any order.
    `levels` levels of `bits` bits each are descended, as long as at most `most` ranges differ. The levels run when this is
    called, one pass over both tables each.
    """
    if levels < 0 or bits < 1 or levels * bits > 62 or most < 1:
        raise ValueError("levels of bits, 62 bits at most, and at least one range to go into")
    kinds = [{f.name.lower(): f.dataType for f in df.schema.fields} for df in (left, right)]
    if kinds[0] != kinds[1]:
        raise ValueError("the tables differ in columns or types")
    keys = actual_names(left, keys)
    nulls = [F.col(f"`{k}`").isNull() for k in keys]
    rows = sided(left, right, keys).withColumn(_HASH, F.xxhash64(*[F.col(f"`{k}`") for k in keys], *nulls))
    ranges, level = differing_ranges(rows, levels, bits, most)
    if level:
        rows = rows.where(_in_ranges(ranges, level * bits)) if ranges else rows.limit(0)
    return differing_groups(rows, keys).withColumnsRenamed({"old_rows": "left_rows", "new_rows": "right_rows"})

"""Table operators: DataFrames in, one lazy DataFrame out."""

from partyfold.operators.control import FigureSource, control_figures
from partyfold.operators.dedup import distinct_rows, first_per_key, row_count
from partyfold.operators.delta import delta_keys, delta_restrict, delta_upsert
from partyfold.operators.differences import differing_keys
from partyfold.operators.gaps import gap_adjust, gap_rows
from partyfold.operators.joins import (
    Spread,
    chain_fanout,
    left_join_one,
    matched_rows,
    unmatched_rows,
)
from partyfold.operators.products import keep_products
from partyfold.operators.ranges import missing_ranges
from partyfold.operators.snapshots import apply_diff, changed_keys, snapshot_diff
from partyfold.operators.union import union_all

__all__ = [
    "FigureSource",
    "Spread",
    "apply_diff",
    "chain_fanout",
    "changed_keys",
    "control_figures",
    "delta_keys",
    "delta_restrict",
    "delta_upsert",
    "differing_keys",
    "distinct_rows",
    "first_per_key",
    "gap_adjust",
    "gap_rows",
    "keep_products",
    "left_join_one",
    "matched_rows",
    "missing_ranges",
    "row_count",
    "snapshot_diff",
    "union_all",
    "unmatched_rows",
]

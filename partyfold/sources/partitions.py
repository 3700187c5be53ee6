"""Loads that replace only the partitions they touch (our definition).

The dataset is a list of folders (`sources.folders`). A load finds the partitions that hold a row
of its keys, or will hold one of its rows, writes these anew, and then lets the pointer name a list in which
the new folders stand in place of the old ones. Folders of other partitions are neither read as
rows nor written. Until the pointer changes, in one step, readers see the table as it was.

The folders of the list before stay for readers that are at work, and those of pinned lists; others go.
One job at a time may change a dataset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from partyfold.columns import actual_names
from partyfold.operators.dedup import distinct_rows
from partyfold.operators.joins import Spread, join_one, matched_rows, unmatched_rows
from partyfold.sources.files import Files, scratch
from partyfold.sources.folders import (
    LIST_PREFIX,
    FolderList,
    all_folders,
    folder_values,
    read_list,
    scan_folders,
    write_folders,
    write_list,
)
from partyfold.sources.tables import PARQUET, POINTER, read_dataset, remove_unnamed, still_named


def _publish(df: DataFrame, base: str, content: FolderList, fresh: Sequence[str]) -> None:
    """Point to a list; the folders `fresh` go again if that fails."""
    spark = df.sparkSession
    files = Files(spark)
    pointer = f"{base}/{POINTER}"
    before = files.read_text(pointer) if files.exists(pointer) else None
    plain = [] if before is not None else [n for n, _ in files.list(base) if "=" not in n]
    try:
        name = write_list(spark, base, content)
        files.replace_text(pointer, name)
    except BaseException:
        for folder in fresh:
            files.remove(f"{base}/{folder}")
        raise
    named = still_named(spark, base, name, before)
    remove_unnamed(spark, base, {*named, *plain}, folders=False)
    used = set()
    for other in named:
        if other.startswith(LIST_PREFIX):
            used |= set(read_list(spark, base, other).folders)
    for folder in all_folders(spark, base, len(content.by)):
        if folder not in used:
            files.remove(f"{base}/{folder}")


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = PARQUET, compression: str = "snappy"
) -> DataFrame:
    """Replace the whole dataset by `df`, one or more files for each value of `by`."""
    base, by = path.rstrip("/"), actual_names(df, by)
    fresh = write_folders(df, base, by, fmt, compression)
    _publish(df, base, FolderList(df.schema, by, fresh), fresh)
    return read_dataset(df.sparkSession, path, fmt)


def touched_folders(
    path: str, delta: DataFrame, keys: Sequence[str], deleted: DataFrame | None = None, fmt: str = PARQUET,
    spread: Spread | None = None,
) -> list[str]:
    """The folders that hold a row of the keys, or lie in a partition of a new row.

    Of the dataset only the columns of keys and partitions are read. One name for each touched folder reaches the driver.
    """
    spark = delta.sparkSession
    base = path.rstrip("/")
    content = _current_list(delta, base)
    whole = scan_folders(spark, base, content, fmt)
    keys, by = actual_names(whole, keys), list(content.by)
    changed = _all_keys(delta, deleted, keys)
    needed = [*keys, *by, *(actual_names(whole, spread.by) if spread else [])]
    rows = matched_rows(whole.select(*dict.fromkeys(needed)), changed, keys, spread=spread, null_safe=True)
    values = distinct_rows(rows.select(*by).unionByName(delta.select(*by)))
    found = join_one(folder_values(spark, content), values, by, by, "left_semi", null_safe=True)
    return sorted(r["__folder"] for r in found.select("__folder").collect())


def _all_keys(delta: DataFrame, deleted: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    rows = delta.select(*keys)
    return distinct_rows(rows if deleted is None else rows.unionByName(deleted.select(*keys)))


def _current_list(df: DataFrame, base: str) -> FolderList:
    pointer = Files(df.sparkSession).read_text(f"{base}/{POINTER}")
    if not pointer.startswith(LIST_PREFIX):
        raise ValueError(f"{base} has no list of folders; write it with write_partitions")
    return read_list(df.sparkSession, base, pointer)


def apply_to_partitions(
    path: str,
    delta: DataFrame,
    keys: Sequence[str],
    deleted: DataFrame | None = None,
    fmt: str = PARQUET,
    compression: str = "snappy",
    spread: Spread | None = None,
) -> DataFrame:
    """Apply a delta as `delta_upsert` does, and remove the keys of `deleted`, in touched partitions only.

    A key's new rows may lie in another partition than its old ones. Null keys count as equal.
    """
    spark, base = delta.sparkSession, path.rstrip("/")
    content = _current_list(delta, base)
    names = content.schema.fieldNames()
    if {c.lower() for c in delta.columns} != {c.lower() for c in names}:
        raise ValueError(f"the delta has columns {delta.columns}, the dataset {names}")
    with scratch(spark) as folder:  # the delta and its keys are used several times
        casts = [delta[own].cast(content.schema[n].dataType).alias(n) for n, own in zip(names, actual_names(delta, names))]
        delta.select(*casts).write.parquet(f"{folder}/rows")
        rows = spark.read.schema(content.schema).parquet(f"{folder}/rows")
        _all_keys(rows, deleted, keys).write.parquet(f"{folder}/keys")
        changed = spark.read.parquet(f"{folder}/keys")
        touched = touched_folders(path, rows, keys, changed, fmt, spread)
        old = scan_folders(spark, base, FolderList(content.schema, content.by, touched), fmt)
        kept = unmatched_rows(old, changed, keys, null_safe=True, spread=spread)
        fresh = write_folders(kept.unionByName(rows), base, content.by, fmt, compression)
    untouched = [f for f in content.folders if f not in set(touched)]
    _publish(delta, base, FolderList(content.schema, content.by, [*untouched, *fresh]), fresh)
    return read_dataset(spark, path, fmt)

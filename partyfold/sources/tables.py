"""Reading, replacing, copying and backing up table datasets.

A table lives at `<root>/<table>/data`. The format is a parameter: Parquet unless told
otherwise; `avro` works wherever the Avro source is deployed.

A dataset is replaced by writing a new version into a folder of its own beside the old one
and then pointing to it: the file `_current` in the dataset's folder names the version. The
pointer changes in one step, so readers find the old version or the new one, a
failed job leaves the old one as it was, and the result may be computed from the dataset
that it replaces. The version before stays for readers that are at work; older ones go, but for
those that a pin names. A folder without a pointer is a plain dataset and is read as it is.
The pointer may also name a list of folders, see `sources.partitions`.

One job at a time may replace a dataset.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from partyfold import fixed
from partyfold.columns import actual_names
from partyfold.modes import check_mode
from partyfold.sources.files import Files
from partyfold.sources.folders import LIST_PREFIX, read_list, scan_folders

PARQUET = "parquet"
POINTER = "_current"
_VERSION = "version-"
_PIN = "_pin-"


def table_path(root: str, table: str, part: str = fixed.DATA_DIR) -> str:
    return f"{root.rstrip('/')}/{table}/{part}"


def require_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The expected columns in the expected order; an error if one is missing or differs.

    Names are compared without case and come out as expected; nullability is not compared.
    """
    return require_types(df, {f.name: f.dataType for f in expected.fields})


def require_types(df: DataFrame, expected: Mapping[str, T.DataType | None]) -> DataFrame:
    """The same for columns given by name; None stands for any type."""
    found = {f.name.lower(): f for f in df.schema.fields}
    problems = []
    for name, kind in expected.items():
        actual = found.get(name.lower())
        if actual is None:
            problems.append(f"{name} is missing")
        elif kind is not None and actual.dataType != kind:
            problems.append(
                f"{name} is {actual.dataType.simpleString()}, expected {kind.simpleString()}"
            )
    if problems:
        raise ValueError("unexpected schema: " + "; ".join(problems))
    return df.select(*[df[found[name.lower()].name].alias(name) for name in expected])


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the dataset's files now."""
    base = path.rstrip("/")
    if any(c in base for c in "*?[{"):
        return path
    files = Files(spark)
    pointer = f"{base}/{POINTER}"
    return f"{base}/{files.read_text(pointer)}" if files.exists(pointer) else path


def read_dataset(
    spark: SparkSession, path: str, fmt: str = PARQUET, expected: T.StructType | None = None
) -> DataFrame:
    """A lazy scan of a dataset, of any number of files.

    A path without data files is an error and never an empty table: the schema always
    comes from the files and is only then compared with the expected one.
    """
    df = _scan(spark, current_path(spark, path), fmt)
    return df if expected is None else require_columns(df, expected)


def _scan(spark: SparkSession, where: str, fmt: str) -> DataFrame:
    base, _, name = where.rpartition("/")
    if name.startswith(LIST_PREFIX):
        return scan_folders(spark, base, read_list(spark, base, name), fmt)
    return spark.read.format(fmt).load(where)


def read_whole(spark: SparkSession, path: str, fmt: str = PARQUET) -> DataFrame:
    """A scan with every column of every file; partition columns stay the text they are in paths.

    The columns come from the files, and the scan is then told its schema, with the partition columns as text.
    """
    where = current_path(spark, path)
    if where.rpartition("/")[2].startswith(LIST_PREFIX):
        return _scan(spark, where, fmt)
    found = spark.read.format(fmt).option("mergeSchema", "true").load(where)
    folders = {c.lower() for c in partition_columns(spark, path)}
    if not folders:
        return found
    stated = [
        T.StructField(f.name, T.StringType() if f.name.lower() in folders else f.dataType, True)
        for f in found.schema.fields
    ]
    return spark.read.schema(T.StructType(stated)).format(fmt).load(where)


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    fmt: str = PARQUET,
    expected: T.StructType | None = None,
    part: str = fixed.DATA_DIR,
) -> DataFrame:
    return read_dataset(spark, table_path(root, table, part), fmt, expected)


def overwrite_dataset(
    df: DataFrame,
    path: str,
    fmt: str = PARQUET,
    compression: str = "snappy",
    partition_by: Sequence[str] = (),
    check: Callable[[str], None] | None = None,
) -> None:
    """Replace the whole dataset by `df`, which may read from it.

    `check` gets the new version's folder before anyone is pointed to it; its error leaves the old version.
    """
    files = Files(df.sparkSession)
    base = path.rstrip("/")
    before = files.read_text(f"{base}/{POINTER}") if files.exists(f"{base}/{POINTER}") else None
    plain = [] if before is not None else files.list(base)
    version = f"{_VERSION}{uuid.uuid4().hex}"
    writer = df.write.format(fmt).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(f"{base}/{version}")
        if check is not None:
            check(f"{base}/{version}")
        files.replace_text(f"{base}/{POINTER}", version)
    except BaseException:
        files.remove(f"{base}/{version}")
        if before is None and not plain:
            files.remove(base)
        raise
    named = still_named(df.sparkSession, base, version, before)
    has_lists = any(name.startswith(LIST_PREFIX) for name in named)
    remove_unnamed(df.sparkSession, base, {*named, *(name for name, _ in plain)}, folders=not has_lists)


def still_named(spark: SparkSession, base: str, *versions: str | None) -> set[str]:
    """The given versions and those that pins name."""
    return {v for v in versions if v is not None} | set(pinned_versions(spark, base))


def remove_unnamed(spark: SparkSession, base: str, named: set[str], folders: bool = True) -> None:
    """Remove what no pointer and no pin names; with `folders` off, folders of partitions stay."""
    files = Files(spark)
    for name, _ in files.list(base):
        is_folder = "=" in name and not folders
        if name != POINTER and not name.startswith(_PIN) and name not in named and not is_folder:
            files.remove(f"{base}/{name}")


def _pin_path(path: str, name: str) -> str:
    if not name or "/" in name:
        raise ValueError(f"{name!r} is no name for a pin")
    return f"{path.rstrip('/')}/{_PIN}{name}"


def pin_version(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A snapshot that copies nothing: the present version gets a name and stays until the name goes.

    Pinning again under the same name moves the name. A dataset without versions has nothing to name.
    """
    files = Files(spark)
    pointer = f"{path.rstrip('/')}/{POINTER}"
    if not files.exists(pointer):
        raise ValueError(f"{path} has no versions; write it with overwrite_dataset")
    files.replace_text(_pin_path(path, name), files.read_text(pointer))
    return read_pinned(spark, path, name)


def read_pinned(spark: SparkSession, path: str, name: str, fmt: str = PARQUET) -> DataFrame:
    version = Files(spark).read_text(_pin_path(path, name))
    return _scan(spark, f"{path.rstrip('/')}/{version}", fmt)


def unpin_version(spark: SparkSession, path: str, name: str) -> None:
    """Take a name away. The version goes with the next replacement, unless another name holds it."""
    Files(spark).remove(_pin_path(path, name))


def pinned_versions(spark: SparkSession, path: str) -> Counter:
    """How many pins name each version."""
    files, base = Files(spark), path.rstrip("/")
    names = [name for name, _ in files.list(base) if name.startswith(_PIN)]
    return Counter(files.read_text(f"{base}/{name}") for name in names)


def replace_load(
    df: DataFrame, path: str, table: str | None = None, fmt: str = PARQUET
) -> DataFrame:
    """Replace a warehouse table by a dataset, all types kept, and return what was stored.

    With a table name the catalog's table is then pointed to the version that was written, so it
    shows its old rows until all new ones are there, and keeps them if the load fails. Dates,
    timestamps and decimals must come back as they went in, or the load fails and leaves the old rows.
    """
    spark = df.sparkSession

    def check(where: str) -> None:
        stored = spark.read.format(fmt).load(where)
        changed = [
            f"{sent.name}: {sent.dataType.simpleString()} became {kept.dataType.simpleString()}"
            for sent, kept in zip(df.schema.fields, stored.schema.fields)
            if sent.dataType != kept.dataType
        ]
        if changed or df.columns != stored.columns:
            raise TypeError(f"the load changed the schema: {changed or stored.columns}")

    overwrite_dataset(df, path, fmt, check=check)
    stored = read_dataset(spark, path, fmt)
    if table is None:
        return stored
    _point_table(spark, table, current_path(spark, path), fmt, stored.schema)
    return spark.table(table)


def _point_table(spark: SparkSession, table: str, where: str, fmt: str, schema: T.StructType) -> None:
    """Let a table of the catalog show the files of a folder."""
    kinds = lambda s: [(f.name.lower(), f.dataType) for f in s.fields]
    name = ".".join(f"`{part.strip('`')}`" for part in table.split("."))
    if spark.catalog.tableExists(table):
        if kinds(spark.table(table).schema) == kinds(schema):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(table, path=where, source=fmt, schema=schema)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that a dataset keeps in the names of its folders, outermost first."""
    files, where, found = Files(spark), current_path(spark, path), []
    base, _, name = where.rpartition("/")
    if name.startswith(LIST_PREFIX):
        return list(read_list(spark, base, name).by)
    while True:
        folders = [n for n, is_dir in files.list(where) if is_dir and n[0] not in "._" and "=" in n]
        if not folders:
            return found
        found.append(folders[0].partition("=")[0])
        where = f"{where}/{folders[0]}"


def copy_dataset(
    spark: SparkSession, source: str, target: str, fmt: str = PARQUET
) -> DataFrame:
    """Refresh a working copy: the dataset takes the place of the old copy.

    Columns that only some files have, and codes in folder names, come along; the copy is
    laid out in the same folders. A copy whose columns differ from the source's is an error.
    """
    folders = partition_columns(spark, source)
    df = read_whole(spark, source, fmt)
    overwrite_dataset(df, target, fmt, partition_by=actual_names(df, folders))
    copy = read_whole(spark, target, fmt)
    if [(f.name, f.dataType) for f in copy.schema] != [(f.name, f.dataType) for f in df.schema]:
        raise TypeError(f"the copy differs: {copy.schema.simpleString()}, not {df.schema.simpleString()}")
    return copy


def snapshot(spark: SparkSession, root: str, table: str, fmt: str = PARQUET) -> DataFrame:
    """Copy a table's data to its snapshot folder, replacing the previous snapshot."""
    return copy_dataset(
        spark, table_path(root, table), table_path(root, table, fixed.SNAPSHOT_DIR), fmt
    )


def adjust_after_snapshot(
    spark: SparkSession,
    root: str,
    table: str,
    adjust: Callable[[DataFrame], DataFrame],
    fmt: str = PARQUET,
) -> DataFrame:
    """Take a snapshot, then replace the table by its adjusted self.

    If the adjustment fails, the table is as it was.
    """
    path = table_path(root, table)
    folders = partition_columns(spark, path)
    adjusted = adjust(snapshot(spark, root, table, fmt))
    overwrite_dataset(adjusted, path, fmt, partition_by=actual_names(adjusted, folders))
    return read_whole(spark, path, fmt)


def adjust_after_pin(
    spark: SparkSession,
    root: str,
    table: str,
    adjust: Callable[[DataFrame], DataFrame],
    name: str = fixed.SNAPSHOT_DIR,
    fmt: str = PARQUET,
) -> DataFrame:
    """The same with a pinned version for a snapshot: no row is copied. `read_pinned` reads it."""
    path = table_path(root, table)
    folders = partition_columns(spark, path)
    adjusted = adjust(pin_version(spark, path, name))
    overwrite_dataset(adjusted, path, fmt, partition_by=actual_names(adjusted, folders))
    return read_dataset(spark, path, fmt)


def layer_datasets(spark: SparkSession, layer: str) -> list[str]:
    """Paths of all datasets under a layer, at any depth, relative to it.

    A folder is a dataset if it has a pointer, files, or folders named after partitions.
    """
    files, base, found = Files(spark), layer.rstrip("/"), []

    def walk(relative: str) -> None:
        inside = files.list(f"{base}/{relative}" if relative else base)
        shown = [(n, is_dir) for n, is_dir in inside if n[0] not in "._"]
        if any(n == POINTER for n, _ in inside) or any(not d or "=" in n for n, d in shown):
            found.append(relative)
            return
        for name, _ in shown:
            walk(f"{relative}/{name}" if relative else name)

    walk("")
    return [relative for relative in found if relative]


def _swap(files: Files, fresh: str, target: str) -> None:
    """Put a folder in the place of another; if that fails, the other is where it was."""
    aside = f"{target}-before-{uuid.uuid4().hex}"
    replaced = files.exists(target)
    if replaced:
        files.rename(target, aside)
    try:
        files.rename(fresh, target)
    except BaseException:
        if replaced:
            files.rename(aside, target)
        raise
    if replaced:
        files.remove(aside)


def backup_layer(
    spark: SparkSession, layer: str, mode: str, day: date, fmt: str = PARQUET, jobs: int = 4
) -> Mapping[str, DataFrame]:
    """Copy all datasets of a layer to a folder named after the layer, the load mode and the day.

    The layer itself says what it holds: snapshots and nested folders come along. The copies are
    made under another name, and the folder gets its own when all are there. An earlier backup of the day
    steps aside first and comes back if the new one cannot take its place, so one of
    them is there whatever fails. A few datasets are copied at a time, so that the last tasks of one do not leave
    the cluster idle.
    """
    name = layer.rstrip("/")
    target = fixed.BACKUP_NAME.format(
        layer=name, mode=check_mode(mode), date=day.strftime("%Y%m%d")
    )
    files = Files(spark)
    datasets = layer_datasets(spark, name)
    if not datasets:
        raise ValueError(f"nothing to back up under {name}")
    staging = f"{target}-unfinished-{uuid.uuid4().hex}"
    try:
        with ThreadPoolExecutor(max_workers=jobs) as pool:
            list(
                pool.map(
                    lambda d: copy_dataset(spark, f"{name}/{d}", f"{staging}/{d}", fmt), datasets
                )
            )
        _swap(files, staging, target)
    except BaseException:
        files.remove(staging)
        raise
    return {d: read_whole(spark, f"{target}/{d}", fmt) for d in datasets}

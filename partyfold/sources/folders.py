"""Datasets that are a list of folders, one or more for each partition.

The pointer of such a dataset names a list: a small file `_folders-<id>` beside the data with the schema,
the partition columns and the folders. A folder is `<column>=<value>/.../__version=<id>`, so folders of
several loads lie side by side and a load can replace some and leave the others as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold.sources.files import Files

LIST_PREFIX = "_folders-"
VERSION_COLUMN = "__version"
_MISSING = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class FolderList:
    """What a dataset consists of. The schema has the partition columns where the table has them."""

    schema: T.StructType
    by: Sequence[str]
    folders: Sequence[str]

    def text(self) -> str:
        return json.dumps(
            {"schema": self.schema.jsonValue(), "by": list(self.by), "folders": list(self.folders)}, indent=1
        )


def read_list(spark: SparkSession, base: str, name: str) -> FolderList:
    content = json.loads(Files(spark).read_text(f"{base}/{name}"))
    schema = T.StructType.fromJson(content["schema"])
    return FolderList(schema, content["by"], content["folders"])


def write_list(spark: SparkSession, base: str, content: FolderList) -> str:
    """Write a list under a new name and return the name."""
    name = f"{LIST_PREFIX}{uuid.uuid4().hex}"
    Files(spark).replace_text(f"{base}/{name}", content.text())
    return name


def scan_folders(spark: SparkSession, base: str, content: FolderList, fmt: str) -> DataFrame:
    """All rows of the folders. The schema is stated, so codes in folder names stay what they are."""
    names = content.schema.fieldNames()
    if not content.folders:
        return spark.createDataFrame([], content.schema)
    schema = T.StructType([*content.schema.fields, T.StructField(VERSION_COLUMN, T.StringType())])
    paths = [f"{base}/{folder}" for folder in content.folders]
    return spark.read.schema(schema).format(fmt).option("basePath", base).load(paths).select(*names)


def folder_values(spark: SparkSession, content: FolderList) -> DataFrame:
    """The folders, as `__folder`, with the values of their partition columns."""

    def value(segment: str) -> str | None:
        text = segment.partition("=")[2]
        return None if text == _MISSING else unquote(text)

    rows = [(f, *[value(s) for s in f.split("/")[: len(content.by)]]) for f in content.folders]
    names = ["__folder", *content.by]
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    kinds = {n: content.schema[n].dataType for n in content.by}
    return spark.createDataFrame(rows, texts).withColumns({n: F.col(n).cast(k) for n, k in kinds.items()})


def write_folders(df: DataFrame, base: str, by: Sequence[str], fmt: str, compression: str) -> list[str]:
    """Write the rows into new folders and return these; nothing is left of a write that fails.

    The rebalance step gathers small partitions into few files and splits a hot one over many tasks.
    An empty text has no folder of its own and is an error.
    """
    files, version = Files(df.sparkSession), uuid.uuid4().hex
    refused = {
        c: F.when(F.col(c) == "", F.raise_error(f"an empty {c} has no folder").cast("string")).otherwise(F.col(c))
        for c in by
        if isinstance(df.schema[c].dataType, T.StringType)
    }
    rows = df.withColumns(refused) if refused else df
    leaves = "/".join(["*"] * len(by)) + f"/{VERSION_COLUMN}={version}"
    try:
        rows.hint("rebalance", *by).withColumn(VERSION_COLUMN, F.lit(version)).write.mode("append").format(fmt).option(
            "compression", compression
        ).partitionBy(*by, VERSION_COLUMN).save(base)
        return files.find(base, leaves)
    except BaseException:
        for folder in files.find(base, leaves):
            files.remove(f"{base}/{folder}")
        raise


def all_folders(spark: SparkSession, base: str, depth: int) -> list[str]:
    return Files(spark).find(base, "/".join(["*"] * depth) + f"/{VERSION_COLUMN}=*")

"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`, removed when this process ends.

    Where the setting is missing, as in tests, the folder lies in the warehouse. That is a folder of the
    driver's machine unless it was set, so on a cluster a missing setting is an error.
    """
    base = spark.conf.get(_SETTING, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session has ended; the cluster's own cleaning is left
        pass


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a write within goes with it, instead of when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Workspace:
    """Intermediate tables of one computation. They go when it is done; its result is written elsewhere.

    The shuffle files of a table go as soon as it is written, so that those of several tables never add up.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._path, self._count = spark, shared_dir(spark), 0

    def written(self, df: DataFrame, name: str = "table") -> DataFrame:
        self._count += 1
        path = f"{self._path}/{self._count}-{name}"
        with _shuffles_removed(self._spark):
            df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.remove()

    def remove(self) -> None:
        _remove(self._spark, self._path)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows written to the shared folder and read again; cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""A place for the intermediate tables of queries."""

from __future__ import annotations

import atexit

from pyspark.sql import SparkSession

from partyfold import sources as io

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder, removed when this process ends.

    The results of queries are read from it lazily, so it cannot go earlier. A local session that
    names no shared folder gets one in its warehouse; on a cluster a missing setting is an error.
    """
    if spark.conf.get(_SETTING, None) is None and spark.sparkContext.master.startswith("local"):
        spark.conf.set(_SETTING, f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch")
    path = io.scratch_dir(spark)
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        io.Files(spark).remove(path)
    except Exception:  # the session has ended before the process
        pass

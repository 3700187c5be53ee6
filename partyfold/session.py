"""A session with the settings the jobs count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges partitions but never makes more than there were at first, so a
# large shuffle has to begin with many. Skewed joins depend on the two after it, which are Spark's defaults. The threshold is half
# of Spark's: one row of a hot party grows by 28 columns in the join, so its partition is
# worth splitting earlier.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
}


def session(app_name: str) -> SparkSession:
    """The session of the submitted application, or a new one.

    Settings that the application was submitted with stay as they are.
    """
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark

"""Product lists and datasets with one directory per product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partyfold.sources.tables import PARQUET, current_path, overwrite_dataset


def read_product_list(spark: SparkSession, path: str, name: str = "product") -> DataFrame:
    """Product codes of a text file with one dotted code per line.

    Dots are removed. Only line ends are stripped, so the last code is whole whether or
    not the file ends with a newline. Empty lines name no product.
    """
    code = F.replace(F.col("value"), F.lit("."), F.lit(""))
    return spark.read.text(path).select(code.alias(name)).where(F.col(name) != "")


def write_by_product(df: DataFrame, path: str, product: str, fmt: str = PARQUET) -> None:
    """One directory per product.

    The rebalance step gathers a small product into few files and splits a hot product
    over many tasks, where a repartition by product would put it all into one. A directory
    cannot tell an empty product from a missing one, so an empty one is an error; a missing one comes back as null.
    """
    code = F.col(product)
    refused = F.raise_error("an empty product has no directory").cast(df.schema[product].dataType)
    checked = df.withColumn(product, F.when(code == "", refused).otherwise(code))
    overwrite_dataset(checked.hint("rebalance", product), path, fmt, partition_by=[product])


def read_by_product(
    spark: SparkSession, path: str, like: DataFrame, fmt: str = PARQUET
) -> DataFrame:
    """All products merged again.

    The schema is stated, so that codes such as `0123` are not taken for numbers.
    """
    where = current_path(spark, path)
    return spark.read.schema(like.schema).format(fmt).load(where).select(*like.columns)

"""Tables of the catalog that lie in buckets by their keys, sorted inside (our definition).

Whatever groups, reduces or joins such a table by its bucket keys needs no shuffle of it, and two
tables in equally many buckets meet without one. Tables are registered in the catalog, as Spark keeps
the buckets there and not in the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from partyfold.columns import actual_names
from partyfold.sources.files import Files
from partyfold.sources.tables import PARQUET


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """The number of buckets of a table, and the keys."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    facts = {r["col_name"]: r["data_type"] for r in rows}
    if "Num Buckets" not in facts:
        raise ValueError(f"{table} is not in buckets")
    names = facts["Bucket Columns"].strip("[]")
    return int(facts["Num Buckets"]), [n.strip().strip("`") for n in names.split(",")]


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, fmt: str = PARQUET
) -> DataFrame:
    """Replace a table by `df` in buckets, in a folder of its own under `path`.

    The rows are dealt by the keys first, so a bucket is one file, or a few if its rows are many. A failed
    job leaves the table as it was; the folder of the version before goes once the table shows the new one.
    """
    spark, files, base = df.sparkSession, Files(df.sparkSession), path.rstrip("/")
    keys = actual_names(df, keys)
    where, fresh = f"{base}/version-{uuid.uuid4().hex}", f"{table}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
    before = [name for name, _ in files.list(base)]
    try:
        writer.option("path", where).saveAsTable(fresh)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        files.remove(where)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    for name in before:
        if name.startswith("version-"):
            files.remove(f"{base}/{name}")
    return spark.table(table)


def co_located(spark: SparkSession, tables: Sequence[str], keys: Sequence[str] | None = None) -> list[DataFrame]:
    """The tables, if they lie in equally many buckets by as many keys; unequal ones are refused.

    Spark would shuffle one side of a join of unequal ones and say nothing.
    """
    specs = {t: bucket_spec(spark, t) for t in tables}
    if len({(n, len(k)) for n, k in specs.values()}) > 1:
        raise ValueError(f"not in the same buckets: {specs}")
    for table, (_, own) in specs.items():
        if keys is not None and [k.lower() for k in own] != [k.lower() for k in keys]:
            raise ValueError(f"{table} is in buckets by {own}, not by {list(keys)}")
    return [spark.table(t) for t in tables]

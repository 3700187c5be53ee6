"""Compare a Spark result with a DuckDB result as bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# DuckDB type -> Spark type, for the types the queries return.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "DECIMAL(10,2)": "decimal(10,2)",
    "DECIMAL(12,2)": "decimal(12,2)",
    "DECIMAL(38,0)": "decimal(38,0)",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    expected = connection.sql(sql)
    wanted = {n: TYPES.get(str(t), str(t)) for n, t in zip(expected.columns, expected.types)}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if wanted != found:
        return [f"schema: expected {wanted}, found {found}"]
    names = sorted(wanted)
    order = ", ".join(f'"{n}"' for n in names)
    expected_rows = Counter(connection.sql(f"SELECT {order} FROM ({sql})").fetchall())
    rows = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if rows == expected_rows:
        return []
    missing, extra = expected_rows - rows, rows - expected_rows
    return [
        f"{expected_rows.total()} rows expected, {rows.total()} found",
        f"missing {missing.total()}: {list(missing)[:2]}",
        f"extra {extra.total()}: {list(extra)[:2]}",
    ]

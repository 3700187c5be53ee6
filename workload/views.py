"""Insurance-shaped inputs derived from whole test tables.

The test tables are clean, so the views give them the faults the operators deal with:
null, blank, tab-only and padded keys, duplicates, marks and tabs in names, and one party
that holds a third of all policy rows. No view leaves out a row. The expressions are SQL
that Spark and DuckDB read alike, so both engines start from the same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A null, two blanks, a tab, a hot party, or the supplier.
_POLICY_PARTY = """
    CASE WHEN l_discount = 0 THEN NULL
         WHEN l_tax = 0 THEN '  '
         WHEN l_tax = 0.08 AND l_discount = 0.1 THEN chr(9)
         WHEN l_returnflag = 'R' THEN '1'
         ELSE CAST(l_suppkey AS STRING) END
"""

# Keys of suppliers in debt carry a trailing space and match no policy.
_MASTER_KEY = """
    CASE WHEN s_acctbal < 0 THEN CAST(s_suppkey AS STRING) || ' '
         ELSE CAST(s_suppkey AS STRING) END
"""

_PERSON_CODE = """
    CASE WHEN s_nationkey < 5 THEN 'F' WHEN s_nationkey < 10 THEN 'f'
         WHEN s_nationkey < 15 THEN ' F' WHEN s_nationkey < 20 THEN 'M' ELSE NULL END
"""

# Fifteen customers share a key; keys ending in 7 carry a trailing space.
_CUSTOMER_GROUP = "CAST(CAST(floor(c_custkey / 15) AS BIGINT) AS STRING)"
_CONTACT_KEY = f"""
    CASE WHEN {_CUSTOMER_GROUP} LIKE '%7' THEN {_CUSTOMER_GROUP} || ' '
         ELSE {_CUSTOMER_GROUP} END
"""

VIEWS: dict[str, list[tuple[str, dict[str, str]]]] = {
    "policy_object": [
        (
            "lineitem",
            {
                "num_poliza": "l_orderkey",
                "num_version": "l_linenumber",
                "cve_filiacion": _POLICY_PARTY,
            },
        )
    ],
    "party_master": [
        (
            "supplier",
            {
                "cdfiliac": _MASTER_KEY,
                "cdrfc": "'RFC' || CAST(s_suppkey AS STRING)",
                "tcpefiju": _PERSON_CODE,
                "dnnomrzm": "s_name",
                "dnap1rzm": "chr(9) || 'Ap' || chr(9) || CAST(s_nationkey AS STRING) || ' '",
                "dnap2rzm": "CASE WHEN s_acctbal < 3000 THEN NULL ELSE 'Seg#undo#' END",
                "tscdc": "'T' || CAST(s_nationkey AS STRING)",
            },
        ),
        (
            "supplier",
            {
                "cdfiliac": _MASTER_KEY,
                "cdrfc": "CASE WHEN s_acctbal < 2000 THEN NULL "
                "WHEN s_acctbal < 4000 THEN 'DUP' ELSE 'ZUP' END",
                "tcpefiju": "'M'",
                "dnnomrzm": "'dup'",
                "dnap1rzm": "CAST(NULL AS STRING)",
                "dnap2rzm": "'x'",
                "tscdc": "'D'",
            },
        ),
    ],
    "contact_data": [
        (
            "customer",
            {
                "cve_filiacion": _CONTACT_KEY,
                "calle": "c_mktsegment",
                "numero": "CAST(c_custkey AS STRING)",
                "ref_adicional_domicilio": "CAST(NULL AS STRING)",
                "cvecolonia": "'C' || CAST(c_nationkey AS STRING)",
                "colonia": "c_mktsegment || ' ' || CAST(c_nationkey AS STRING)",
                "delegacion_o_municipio": "'M' || CAST(c_nationkey AS STRING)",
                "entidad_federativa": "CAST(c_nationkey AS STRING)",
                "codigo_postal": "lpad(CAST(c_nationkey AS STRING), 5, '0')",
                "codigo_pais": "'MX'",
                "correo_electronico": "lower(c_name) || '@example.com'",
                "tipo_comunicacion_1": "CASE WHEN c_acctbal < 0 THEN NULL ELSE 'CEL' END",
                "numero_prefijo_pais_1": "'52'",
                "numero_prefijo_celular_1": "'1'",
                "numero_prefijo_ciudad_1": "lpad(CAST(c_nationkey AS STRING), 3, '0')",
                "numero_telefono_1": "lpad(CAST(c_custkey AS STRING), 8, '5')",
                "numero_extension_telefono_1": "CAST(NULL AS STRING)",
                "tipo_comunicacion_2": "CASE WHEN c_acctbal < 5000 THEN NULL ELSE 'CASA' END",
                "numero_prefijo_pais_2": "'52'",
                "numero_prefijo_celular_2": "CAST(NULL AS STRING)",
                "numero_prefijo_ciudad_2": "lpad(CAST(c_nationkey AS STRING), 3, '0')",
                "numero_telefono_2": "lpad(CAST(c_custkey AS STRING), 8, '4')",
                "numero_extension_telefono_2": "lpad(CAST(c_nationkey AS STRING), 4, '0')",
            },
        )
    ],
}


# The inputs some days later: rows that went, changed and came. Conditions and expressions are over the views' columns.
LATER: dict[str, tuple[str, dict[str, str], str, dict[str, str]]] = {
    "policy_object": (
        "NOT (num_poliza % 50 = 3 AND num_version = 2)",
        {"cve_filiacion": "CASE WHEN num_poliza % 40 = 7 THEN '5' ELSE cve_filiacion END"},
        "num_poliza % 60 = 11",
        {"num_poliza": "-num_poliza"},
    ),
    "party_master": (
        "cdrfc IS NULL OR NOT (cdrfc = 'DUP' OR cdfiliac LIKE '%9')",
        {"dnnomrzm": "CASE WHEN cdfiliac LIKE '%4' THEN 'renamed' ELSE dnnomrzm END"},
        "cdfiliac LIKE '% '",
        {"cdfiliac": "trim(cdfiliac)"},
    ),
    "contact_data": (
        "numero NOT LIKE '%5'",
        {"calle": "CASE WHEN numero LIKE '%8' THEN NULL ELSE calle END"},
        "cve_filiacion LIKE '% '",
        {"cve_filiacion": "trim(cve_filiacion)"},
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame."""
    parts = [
        table(spark, sf_dir, source).selectExpr(
            *[f"{expression} AS {column}" for column, expression in columns.items()]
        )
        for source, columns in VIEWS[name]
    ]
    first, *others = parts
    for other in others:
        first = first.unionAll(other)
    return first


def _replaced(columns: dict[str, str], name: str) -> list[str]:
    names = VIEWS[name][0][1]
    return [f"{columns[c]} AS {c}" if c in columns else c for c in names]


def later(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as it is some days later."""
    kept, changed, copied, moved = LATER[name]
    before = view(spark, sf_dir, name)
    stayed = before.where(kept).selectExpr(*_replaced(changed, name))
    return stayed.unionAll(before.where(copied).selectExpr(*_replaced(moved, name)))


def later_sql(name: str) -> str:
    kept, changed, copied, moved = LATER[name]
    return (
        f"SELECT {', '.join(_replaced(changed, name))} FROM ({view_sql(name)}) WHERE {kept} "
        f"UNION ALL SELECT {', '.join(_replaced(moved, name))} FROM ({view_sql(name)}) WHERE {copied}"
    )


def view_sql(name: str) -> str:
    """A view as a SELECT."""
    return " UNION ALL ".join(
        "SELECT "
        + ", ".join(f"{expression} AS {column}" for column, expression in columns.items())
        + f" FROM {source}"
        for source, columns in VIEWS[name]
    )

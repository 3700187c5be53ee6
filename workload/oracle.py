"""SQL counterparts of the queries, for DuckDB over the same tables.

They say the same in the plainest way, without the reductions the Spark side makes: raw
joins with all their duplicates, `row_number()`, `EXISTS` and full outer joins.
"""

from __future__ import annotations

from partyfold import fixed
from workload.views import later_sql, view_sql

_WITH = (
    f"WITH policy_object AS ({view_sql('policy_object')}), "
    f"party_master AS ({view_sql('party_master')}), "
    f"contact_data AS ({view_sql('contact_data')}) "
)
_WITH_LATER = (
    f"WITH policy_object AS ({later_sql('policy_object')}), "
    f"party_master AS ({later_sql('party_master')}), "
    f"contact_data AS ({later_sql('contact_data')}) "
)
_CUSTOMERS_LATER = """later AS (
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_custkey % 4 = 1 THEN c_acctbal + 1
                    WHEN c_custkey % 4 <> 2 THEN c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 5 <> 0
        UNION ALL SELECT -c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 6 = 1)"""
_USABLE = "p.cve_filiacion IS NOT NULL AND trim(p.cve_filiacion) <> ''"


def _clean(column: str) -> str:
    return f"trim(replace(replace({column}, chr(9), ' '), '#', 'Ñ'))"


def _name(code: str, given: str, first: str, second: str) -> str:
    g, f, s = (f"coalesce({_clean(c)}, '')" for c in (given, first, second))
    return (
        f"CASE WHEN upper({code}) = 'F' THEN trim({g} || ' ' || {f} || ' ' || {s}) "
        f"ELSE trim({f} || ' ' || {s} || ' ' || {g}) END"
    )


def _label(code: str) -> str:
    return f"CASE WHEN trim({code}) = 'F' THEN 'Fisica' ELSE 'Moral' END"


def _smallest(columns: list[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def _insured(inputs: str = _WITH) -> str:
    order = _smallest(
        ["p.cve_filiacion"]
        + [f"m.{c}" for c in fixed.MASTER_COLUMNS]
        + [f"c.{c}" for c in fixed.CONTACT_COLUMNS]
    )
    contact = ", ".join(f"c.{c}" for c in fixed.CONTACT_COLUMNS)
    name = _name("m.tcpefiju", "m.dnnomrzm", "m.dnap1rzm", "m.dnap2rzm")
    return f"""{inputs}, ranked AS (
        SELECT p.num_poliza, p.num_version, p.cve_filiacion AS cve_asegurado,
               CAST(m.cdrfc AS CHAR(20)) AS rfc, m.tcpefiju AS tipo_participante,
               {_label('m.tcpefiju')} AS desc_tipo_persona,
               {_clean('m.dnnomrzm')} AS nombre,
               {_clean('m.dnap1rzm')} AS primer_apellido,
               {_clean('m.dnap2rzm')} AS segundo_apellido,
               {name} AS nombre_completo,
               CAST('ASEGURADO' AS CHAR(9)) AS ind_rol,
               {contact}, m.tscdc,
               row_number() OVER (
                   PARTITION BY p.num_poliza, p.num_version ORDER BY {order}) AS rank
        FROM policy_object p
        LEFT JOIN party_master m ON p.cve_filiacion = m.cdfiliac
        LEFT JOIN contact_data c ON p.cve_filiacion = c.cve_filiacion
        WHERE {_USABLE})
        SELECT * EXCLUDE (rank) FROM ranked WHERE rank = 1"""


def _join_one(view: str, key: str, carried: list[str], columns: list[str]) -> str:
    order = _smallest([c for c in columns])
    picked = ", ".join(f"r.{c}" for c in carried)
    return f"""{_WITH}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rank FROM {view})
        SELECT p.num_poliza, p.num_version, p.cve_filiacion, {picked}
        FROM policy_object p
        LEFT JOIN (SELECT * FROM ranked WHERE rank = 1) r ON p.cve_filiacion = r.{key}
        WHERE {_USABLE}"""


def _reduced_chain() -> str:
    def reduced(view: str, key: str, columns: list[str]) -> str:
        return (
            f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY "
            f"{_smallest(columns)}) AS rank FROM {view}) WHERE rank = 1)"
        )

    master = reduced("party_master", "cdfiliac", fixed.MASTER_COLUMNS)
    contact = reduced("contact_data", "cve_filiacion", fixed.CONTACT_COLUMNS)
    columns = [f"m.{c}" for c in fixed.MASTER_COLUMNS] + [f"c.{c}" for c in fixed.CONTACT_COLUMNS]
    return f"""{_WITH}
        SELECT p.num_poliza, p.num_version, p.cve_filiacion, {", ".join(columns)}
        FROM policy_object p
        LEFT JOIN {master} m ON p.cve_filiacion = m.cdfiliac
        LEFT JOIN {contact} c ON p.cve_filiacion = c.cve_filiacion
        WHERE {_USABLE}"""


_WITH_LINES = "EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"
_DAY = "ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-15'"

_CHANGES = """changes AS (
    SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN -1 - o_orderkey ELSE o_orderkey END
               AS o_orderkey,
           o_custkey, 'X' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders)"""

_LISTED = """p_brand IN (
    SELECT p_brand FROM part GROUP BY p_brand HAVING avg(p_size) >= 25.5)"""

_FIGURES = """{name} AS (
    SELECT CAST(year({date}) AS INTEGER) AS year, {status} AS status, count(*) AS n,
           sum(CAST({amount} AS DECIMAL(38,4))) AS s
    FROM {table}
    WHERE {date} >= TIMESTAMP '1996-01-01' AND {date} < TIMESTAMP '2001-01-01'
    GROUP BY ALL)"""
_LEFT_FIGURES = _FIGURES.format(
    name="a", date="o_orderdate", status="o_orderstatus", amount="o_totalprice", table="orders"
)
_RIGHT_FIGURES = _FIGURES.format(
    name="b", date="l_shipdate", status="l_linestatus", amount="l_extendedprice", table="lineitem"
)

_BESIDE = """
        SELECT coalesce(a.year, b.year) AS year, coalesce(a.status, b.status) AS status,
               coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
               coalesce(a.n, 0) - coalesce(b.n, 0) AS rows_difference,
               CAST(coalesce(a.s, 0) AS DOUBLE) AS left_amount,
               CAST(coalesce(b.s, 0) AS DOUBLE) AS right_amount,
               CAST(coalesce(a.s, 0) - coalesce(b.s, 0) AS DOUBLE) AS amount_difference
        FROM a FULL OUTER JOIN b
          ON a.year IS NOT DISTINCT FROM b.year AND a.status IS NOT DISTINCT FROM b.status"""
_CHANGED_FIGURES = _FIGURES.format(
    name="a", date="o_orderdate", amount="o_totalprice", table="orders",
    status="CASE WHEN CAST(o_orderdate AS DATE) IN (DATE '1997-03-01', DATE '1998-07-04') THEN 'X' ELSE o_orderstatus END",
)


def _runs(source: str, key: str, number: str, first: int, condition: str) -> str:
    return f"""WITH there AS (
            SELECT DISTINCT {key}, CAST({number} AS BIGINT) AS n FROM {source} WHERE {condition}
        ), neighbours AS (
            SELECT {key}, n, coalesce(lag(n) OVER (PARTITION BY {key} ORDER BY n), {first} - 1) AS before FROM there
        )
        SELECT {key}, before + 1 AS first_missing, n - 1 AS last_missing, n - before - 1 AS missing
        FROM neighbours WHERE n > before + 1"""


ORACLES: dict[str, str] = {
    "insured_flat": _insured(),
    "insured_job": _insured(),
    "insured_upkeep": _insured(_WITH_LATER),
    "scan_table": "SELECT * FROM orders",
    "overwrite_roundtrip": "SELECT * FROM supplier",
    "sql_on_views": """
        SELECT o.o_orderkey, o.o_orderpriority, c.c_name, c.c_mktsegment
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderpriority IS NOT NULL AND trim(o.o_orderpriority) <> ''""",
    "project_alias": """
        SELECT s_suppkey AS cve_asegurado, s_name AS nombre,
               s_nationkey AS entidad_federativa FROM supplier""",
    "role_literal": "SELECT s_suppkey, 'ASEGURADO' AS ind_rol FROM supplier",
    "filter_nonblank_key": f"{_WITH} SELECT p.* FROM policy_object p WHERE {_USABLE}",
    "join_left_master": _join_one(
        "party_master", "cdfiliac", fixed.MASTER_COLUMNS, fixed.MASTER_COLUMNS
    ),
    "join_left_contact": _join_one(
        "contact_data",
        "cve_filiacion",
        fixed.CONTACT_COLUMNS,
        fixed.CONTACT_COLUMNS,
    ),
    "reduced_chain": _reduced_chain(),
    "join_chain_fanout": f"""{_WITH}
        SELECT p.cve_filiacion, CAST(count(*) AS DECIMAL(38,0)) AS joined_rows
        FROM policy_object p
        LEFT JOIN party_master m ON p.cve_filiacion = m.cdfiliac
        LEFT JOIN contact_data c ON p.cve_filiacion = c.cve_filiacion
        WHERE {_USABLE} GROUP BY p.cve_filiacion""",
    "distinct_rows": "SELECT DISTINCT user_id, event_type FROM events",
    "dedup_policy_version": """
        SELECT * EXCLUDE (rank) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                         l_discount, l_tax, l_returnflag, l_linestatus) AS rank
            FROM lineitem) WHERE rank = 1""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "cast_char": """
        SELECT o_orderkey, CAST(o_orderkey AS CHAR(20)) AS key_text,
               CAST(o_orderpriority AS CHAR(9)) AS priority_text FROM orders""",
    "clean_text": f"""
        SELECT c_custkey,
               {_clean("(chr(9) || c_name || chr(9) || c_mktsegment || ' ')")} AS clean
        FROM customer""",
    "regex_replace": """
        SELECT c_custkey, regexp_replace(c_name || '#', '#', 'Ñ', 'g') AS repaired
        FROM customer""",
    "person_type": f"""{_WITH}
        SELECT cdfiliac, tcpefiju, {_label('tcpefiju')} AS desc_tipo_persona
        FROM party_master""",
    "full_name": f"""{_WITH}
        SELECT cdfiliac, tcpefiju,
               {_name('tcpefiju', 'dnnomrzm', 'dnap1rzm', 'dnap2rzm')} AS nombre_completo
        FROM party_master""",
    "replace_load_types": """
        SELECT event_id, ts, value,
               CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(10,2)) END AS amount,
               CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS day,
               CASE WHEN event_type <> 'error' THEN ts END AS seen
        FROM events""",
    "accepted_rows": """
        SELECT event_id, CAST(ts AS DATE) AS day, CAST(user_id AS DOUBLE) AS user_id FROM events
        WHERE event_id % 50 <> 0 AND event_id % 7 <> 0 AND event_id % 9 <> 0""",
    "rejected_rows": """
        WITH marked AS (
            SELECT *, event_id % 50 = 0 OR event_id % 7 = 0 OR event_id % 9 = 0 AS refused FROM events)
        SELECT CASE WHEN event_id % 50 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
               CASE WHEN event_id % 7 = 0 THEN 'soon' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS day,
               CAST(user_id AS VARCHAR) || CASE WHEN event_id % 9 = 0 THEN 'x' ELSE '' END AS user_id, event_type,
               concat_ws('; ', CASE WHEN event_id % 50 = 0 THEN 'event_id: missing' END,
                         CASE WHEN event_id % 7 = 0 THEN 'day: does not fit date' END,
                         CASE WHEN event_id % 9 = 0 THEN 'user_id: does not fit decimal(12,2)' END) AS problems,
               (SELECT count(*) FROM marked WHERE NOT refused) AS accepted_rows,
               (SELECT count(*) FROM marked WHERE refused) AS rejected_rows
        FROM marked WHERE refused""",
    "bucketed_versions": f"""{_WITH}
        SELECT num_poliza, num_version, cve_filiacion FROM (
            SELECT *, row_number() OVER (
                PARTITION BY num_poliza, num_version ORDER BY cve_filiacion NULLS FIRST) AS rank
            FROM policy_object) WHERE rank = 1""",
    "catalog_load": "SELECT *, CAST(o_totalprice AS DECIMAL(12,2)) AS priced FROM orders",
    "dataset_copy": "SELECT * FROM supplier",
    "snapshot_before_adjust": f"""
        SELECT o.*, 'data_bk' AS folder FROM orders o WHERE {_WITH_LINES}
        UNION ALL SELECT o.*, 'data' AS folder FROM orders o""",
    "product_copy": "SELECT * FROM part",
    "dated_backup": """
        WITH copies AS (
            SELECT *, 'supplier/data' AS dataset FROM supplier
            UNION ALL BY NAME SELECT *, 'party/part/data' AS dataset FROM part
            UNION ALL BY NAME SELECT *, 'party/customer/data' AS dataset FROM customer)
        SELECT *, 'modelled-respaldo-full-20240131' AS backup FROM copies""",
    "load_manifest": """
        SELECT DISTINCT event_type AS "table", 'full' AS tipo_carga,
               strftime(ts, '%Y%m%d') AS "date",
               base64(encode('{"table":"' || event_type || '","tipo_carga":"full","date":"'
                   || strftime(ts, '%Y%m%d') || '"}')) AS message
        FROM events""",
    "manifest_branches": """
        SELECT DISTINCT event_type AS "table", 'delta' AS tipo_carga,
               strftime(ts, '%Y%m%d') AS "date",
               base64(encode('{"table":"' || event_type || '","tipo_carga":"delta","date":"'
                   || strftime(ts, '%Y%m%d') || '"}')) AS message
        FROM events""",
    "load_full": f"WITH {_CHANGES} SELECT * FROM changes",
    "load_delta": f"""WITH {_CHANGES}, delta AS (
            SELECT * FROM changes WHERE o_orderkey IN (
                SELECT o_orderkey FROM changes
                WHERE o_orderdate >= TIMESTAMP '2001-07-01'
                  AND o_orderdate < TIMESTAMP '2001-07-15'))
        SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta)
        UNION ALL SELECT * FROM delta""",
    "product_partition": f"""
        SELECT p_brand, count(*) AS parts,
               CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
        FROM part WHERE {_LISTED} GROUP BY p_brand""",
    "product_directories": f"SELECT * FROM part WHERE {_LISTED}",
    "date_stamp": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS stamp,
               strftime(o_orderdate, '%d') AS day,
               strftime(o_orderdate, '%d') = '07' AS is_due FROM orders""",
    "union_all": """
        SELECT c_custkey AS party_key, c_name AS name, c_acctbal AS balance,
               c_mktsegment AS segment, 'customer' AS source FROM customer
        UNION ALL BY NAME
        SELECT s_name AS name, s_suppkey AS party_key, s_acctbal AS balance,
               'supplier' AS source FROM supplier""",
    "matched_rows": f"SELECT o.* FROM orders o WHERE {_WITH_LINES}",
    "unmatched_rows": f"SELECT o.* FROM orders o WHERE NOT {_WITH_LINES}",
    "spread_matched_rows": """
        SELECT l.* FROM lineitem l WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
    "delta_keys": f"SELECT DISTINCT user_id FROM events WHERE {_DAY}",
    "delta_keys_full": "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL",
    "delta_keys_text": f"SELECT DISTINCT user_id FROM events WHERE {_DAY}",
    "delta_restrict": f"""
        SELECT * FROM events WHERE user_id IN (SELECT user_id FROM events WHERE {_DAY})""",
    "delta_upsert": f"""WITH {_CHANGES}, recent AS (
            SELECT * FROM changes WHERE o_orderdate >= TIMESTAMP '2001-07-01')
        SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM recent)
        UNION ALL SELECT * FROM recent""",
    "partition_upsert": """
        SELECT * FROM customer
        WHERE c_nationkey NOT IN (3, 4) AND NOT (c_nationkey = 8 AND c_custkey % 3 = 0)
        UNION ALL
        SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 5 ELSE c_nationkey END,
               -c_acctbal, c_mktsegment FROM customer WHERE c_nationkey IN (3, 4)
        UNION ALL
        SELECT -c_custkey, c_name, 99, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 7""",
    "snapshot_diff": f"""WITH {_CUSTOMERS_LATER}
        SELECT n.*, CASE WHEN o.c_custkey IS NULL THEN 'insert' ELSE 'update' END AS change
        FROM later n LEFT JOIN customer o ON n.c_custkey = o.c_custkey
        WHERE o.c_custkey IS NULL OR o.c_acctbal IS DISTINCT FROM n.c_acctbal
        UNION ALL
        SELECT c_custkey, NULL, NULL, NULL, NULL, 'delete' FROM customer o
        WHERE NOT EXISTS (SELECT 1 FROM later n WHERE n.c_custkey = o.c_custkey)""",
    "snapshot_replay": f"SELECT * FROM ({later_sql('policy_object')})",
    "control_figures": f"WITH {_LEFT_FIGURES}, {_RIGHT_FIGURES} {_BESIDE}",
    "kept_figures": f"WITH {_CHANGED_FIGURES}, {_RIGHT_FIGURES} {_BESIDE}",
    "differing_keys": f"""WITH {_CUSTOMERS_LATER}
        SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey,
               CAST(count(o.c_custkey) AS BIGINT) AS left_rows, CAST(count(n.c_custkey) AS BIGINT) AS right_rows
        FROM customer o FULL OUTER JOIN later n ON o.c_custkey = n.c_custkey
        WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_acctbal IS DISTINCT FROM n.c_acctbal
        GROUP BY 1""",
    "differing_orders": """
        SELECT o_orderkey, CAST(1 AS BIGINT) AS left_rows,
               CAST(CASE o_orderkey % 5000 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 2 END AS BIGINT) AS right_rows
        FROM orders WHERE o_orderkey % 5000 IN (1, 2, 3)""",
    "gap_rows": f"SELECT o.* FROM orders o WHERE NOT {_WITH_LINES}",
    "gap_adjust": "SELECT * FROM orders",
    "version_gaps": _runs(f"({later_sql('policy_object')})", "num_poliza", "num_version", 1,
                          "cve_filiacion IS NOT NULL AND trim(cve_filiacion) <> ''"),
    "order_gaps": _runs("orders o", "o_orderstatus", "o_orderkey", -5, _WITH_LINES),
}
ORACLES["pinned_snapshot"] = ORACLES["snapshot_before_adjust"]

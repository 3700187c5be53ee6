"""One query per operator. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold import fixed
from partyfold import functions as fn
from partyfold import operators as op
from partyfold import plans
from partyfold import sources as io
from workload.scratch import scratch_dir
from workload.views import later, table, view

Query = Callable[[SparkSession, str], DataFrame]

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)

EVENTS_REFERENCE = date(2024, 1, 15)
ORDERS_REFERENCE = date(2001, 7, 15)
FIRST_DAY, LAST_DAY = date(1996, 1, 1), date(2000, 12, 31)
BACKUP_DAY = date(2024, 1, 31)


# The insured table


def insured_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.insured_flat(
        view(spark, sf_dir, "policy_object"),
        view(spark, sf_dir, "party_master"),
        view(spark, sf_dir, "contact_data"),
    )


def insured_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored tables to a stored table."""
    root = scratch_dir(spark)
    raw, modelled = f"{root}/raw", f"{root}/modelled"
    for layer, name in [
        (modelled, "policy_object"),
        (raw, "party_master"),
        (modelled, "contact_data"),
    ]:
        io.overwrite_dataset(view(spark, sf_dir, name), io.table_path(layer, name))
    return plans.run_insured(spark, raw, modelled)


def _inputs(spark: SparkSession, sf_dir: str, tables: Callable = view) -> plans.InsuredInputs:
    names = ("policy_object", "party_master", "contact_data")
    return plans.InsuredInputs(*[tables(spark, sf_dir, name) for name in names])


def insured_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored insured table after changes and deletions in all three inputs."""
    path = io.table_path(scratch_dir(spark), "insured_flat")
    io.overwrite_dataset(insured_flat(spark, sf_dir), path)
    return plans.refresh_insured(path, _inputs(spark, sf_dir), _inputs(spark, sf_dir, later))


# Scans and sinks


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.read_dataset(spark, f"{sf_dir}/orders.parquet", expected=ORDERS_SCHEMA)


def overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = io.table_path(scratch_dir(spark), "supplier")
    suppliers = table(spark, sf_dir, "supplier")
    io.overwrite_dataset(suppliers, path)
    io.overwrite_dataset(suppliers, path)
    return io.read_dataset(spark, path)


def sql_on_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans.register_views(
        {
            "fold_orders": table(spark, sf_dir, "orders"),
            "fold_customer": table(spark, sf_dir, "customer"),
        }
    )
    return spark.sql(
        """
        SELECT o.o_orderkey, o.o_orderpriority, c.c_name, c.c_mktsegment
        FROM fold_orders o LEFT JOIN fold_customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderpriority IS NOT NULL AND trim(o.o_orderpriority) <> ''
        """
    )


# Projections and filters


def project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("cve_asegurado"),
        F.col("s_name").alias("nombre"),
        F.col("s_nationkey").alias("entidad_federativa"),
    )


def role_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", fn.role().alias("ind_rol"))


def filter_nonblank_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "policy_object").where(fn.usable_key(F.col("cve_filiacion")))


# Joins

# One party holds a third of the policy rows; its versions are dealt out.
_VERSIONS = op.Spread(by=["num_poliza", "num_version"])


def _usable_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_nonblank_key(spark, sf_dir)


def join_left_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = op.first_per_key(view(spark, sf_dir, "party_master"), [fixed.MASTER_KEY])
    policies = _usable_policies(spark, sf_dir)
    return op.left_join_one(policies, master, ["cve_filiacion"], [fixed.MASTER_KEY], _VERSIONS).select(
        *fixed.POLICY_COLUMNS, *fixed.MASTER_COLUMNS
    )


def join_left_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    contacts = view(spark, sf_dir, "contact_data").withColumnRenamed(
        fixed.CONTACT_KEY, "contact_key"
    )
    contacts = op.first_per_key(contacts, ["contact_key"])
    policies = _usable_policies(spark, sf_dir)
    return op.left_join_one(policies, contacts, ["cve_filiacion"], ["contact_key"], _VERSIONS).select(
        *fixed.POLICY_COLUMNS, *fixed.CONTACT_COLUMNS
    )


def join_chain_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.chain_fanout(
        _usable_policies(spark, sf_dir),
        "cve_filiacion",
        [
            (view(spark, sf_dir, "party_master"), fixed.MASTER_KEY),
            (view(spark, sf_dir, "contact_data"), fixed.CONTACT_KEY),
        ],
    )


def reduced_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable policies with the reduced master and the reduced contacts, one row each."""
    policies = join_left_master(spark, sf_dir)
    contacts = view(spark, sf_dir, "contact_data").withColumnRenamed(
        fixed.CONTACT_KEY, "contact_key"
    )
    contacts = op.first_per_key(contacts, ["contact_key"])
    return op.left_join_one(policies, contacts, ["cve_filiacion"], ["contact_key"], _VERSIONS)


# Aggregations


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_rows(table(spark, sf_dir, "events"), ["user_id", "event_type"])


def dedup_policy_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.first_per_key(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        order=["l_shipdate", "l_partkey", "l_suppkey"],
    )


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.row_count(table(spark, sf_dir, "lineitem"))


# Scalar functions


def cast_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderpriority").cast("string").alias("priority_text"),
    )


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tab = F.char(F.lit(9))
    dirty = F.concat(tab, F.col("c_name"), tab, F.col("c_mktsegment"), F.lit(" "))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fn.clean_text(dirty).alias("clean")
    )


def regex_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("c_name"), F.lit("#"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.regexp_replace(name, fixed.BROKEN_MARK, fixed.REPAIRED_LETTER).alias("repaired"),
    )


def person_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "party_master").select(
        "cdfiliac", "tcpefiju", fn.person_type(F.col("tcpefiju")).alias("desc_tipo_persona")
    )


def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [fn.clean_text(F.col(c)) for c in ("dnnomrzm", "dnap1rzm", "dnap2rzm")]
    return view(spark, sf_dir, "party_master").select(
        "cdfiliac", "tcpefiju", fn.full_name(F.col("tcpefiju"), *parts).alias("nombre_completo")
    )


# Data operations around the jobs


def replace_load_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals, dates and timestamps through a replaced warehouse table, nulls included."""
    is_error = F.col("event_type") == "error"
    typed = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "value",
        F.when(~is_error, F.col("value").cast("decimal(10,2)")).alias("amount"),
        F.when(~is_error, F.col("ts").cast("date")).alias("day"),
        F.when(~is_error, F.col("ts")).alias("seen"),
    )
    path = io.table_path(scratch_dir(spark), "typed_events")
    io.replace_load(typed, path)
    return io.replace_load(typed, path)


def catalog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the catalog, loaded twice; the second load has a column more."""
    name = f"catalog_load_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    path = io.table_path(scratch_dir(spark), "orders")
    io.replace_load(orders, path, name)
    io.replace_load(orders.withColumn("priced", F.col("o_totalprice").cast("decimal(12,2)")), path, name)
    return spark.table(name)


def _text_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, T.StructType]:
    """Events as text, some of them with faults, and what they should be."""
    events = table(spark, sf_dir, "events")
    text = events.select(
        F.when(F.col("event_id") % 50 != 0, F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("event_id") % 7 == 0, "soon").otherwise(F.col("ts").cast("date").cast("string")).alias("day"),
        F.concat(F.col("user_id").cast("string"), F.when(F.col("event_id") % 9 == 0, "x").otherwise("")).alias("user_id"),
        "event_type",
    )
    wanted = T.StructType([
        T.StructField("event_id", T.LongType(), False), T.StructField("day", T.DateType()),
        T.StructField("user_id", T.DecimalType(12, 2)),
    ])
    return text, wanted


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, wanted = _text_events(spark, sf_dir)
    load = io.checked_load(text, io.table_path(scratch_dir(spark), "events"), wanted)
    return load.accepted.withColumn("user_id", F.col("user_id").cast("double"))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows with their problems, and how many rows of both kinds the load counted."""
    text, wanted = _text_events(spark, sf_dir)
    load = io.checked_load(text, io.table_path(scratch_dir(spark), "events"), wanted)
    listed = F.array_join(F.transform("problems", lambda p: F.concat(p["column"], F.lit(": "), p["reason"])), "; ")
    return load.rejected.withColumn("problems", listed).withColumns(
        {"accepted_rows": F.lit(load.accepted_rows).cast("bigint"), "rejected_rows": F.lit(load.rejected_rows).cast("bigint")}
    )


def bucketed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy rows in buckets by policy and version, reduced without a shuffle."""
    name = f"policy_rows_{uuid.uuid4().hex}"
    rows = view(spark, sf_dir, "policy_object")
    io.write_bucketed(rows, name, f"{scratch_dir(spark)}/policy", ["num_poliza", "num_version"], 8)
    [stored] = io.co_located(spark, [name], ["num_poliza", "num_version"])
    return op.first_per_key(stored, ["num_poliza", "num_version"])


def dataset_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    copy = io.table_path(scratch_dir(spark), "supplier_copy")
    io.copy_dataset(spark, f"{sf_dir}/nation.parquet", copy)
    return io.copy_dataset(spark, f"{sf_dir}/supplier.parquet", copy)


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.matched_rows(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        ["o_orderkey"],
        ["l_orderkey"],
    )


def snapshot_before_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot and adjusted table, told apart by the folder they are in."""
    root, name = scratch_dir(spark), "orders"
    orders = table(spark, sf_dir, "orders")
    io.overwrite_dataset(_orders_with_lines(spark, sf_dir), io.table_path(root, name))
    adjusted = io.adjust_after_snapshot(
        spark, root, name, lambda before: op.gap_adjust(before, orders, ["o_orderkey"])
    )
    before = io.read_table(spark, root, name, part=fixed.SNAPSHOT_DIR)
    return op.union_all({fixed.SNAPSHOT_DIR: before, fixed.DATA_DIR: adjusted}, tag="folder")


def pinned_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a pinned version for a snapshot, read after two more replacements."""
    root, name = scratch_dir(spark), "orders"
    path = io.table_path(root, name)
    orders = table(spark, sf_dir, "orders")
    io.overwrite_dataset(_orders_with_lines(spark, sf_dir), path)
    io.adjust_after_pin(spark, root, name, lambda before: op.gap_adjust(before, orders, ["o_orderkey"]))
    for _ in range(2):
        io.overwrite_dataset(io.read_dataset(spark, path), path)
    before = io.read_pinned(spark, path, fixed.SNAPSHOT_DIR)
    return op.union_all({fixed.SNAPSHOT_DIR: before, fixed.DATA_DIR: io.read_dataset(spark, path)}, tag="folder")


def product_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in one directory per brand, copied as they are."""
    path = io.table_path(scratch_dir(spark), "parts_by_brand")
    io.write_by_product(table(spark, sf_dir, "part"), path, "p_brand")
    return io.copy_dataset(spark, path, f"{path}_copy")


def dated_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every table of a layer that has nested folders, from its backup."""
    layer = f"{scratch_dir(spark)}/modelled"
    for name in ("supplier", "party/part", "party/customer"):
        source = table(spark, sf_dir, name.rpartition("/")[2])
        io.overwrite_dataset(source, io.table_path(layer, name))
    copies = io.backup_layer(spark, layer, fixed.FULL, BACKUP_DAY)
    named = {
        name: df.withColumn(
            "backup", F.regexp_extract(F.input_file_name(), "(modelled-respaldo-[^/]*)/", 1)
        )
        for name, df in copies.items()
    }
    return op.union_all(named, tag="dataset")


def load_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load event per event type and day, appended twice and kept once."""
    events = io.load_events(
        table(spark, sf_dir, "events"),
        table=F.col("event_type"),
        mode=F.lit(fixed.FULL),
        stamp=fn.date_stamp(F.col("ts")),
    )
    path = io.table_path(scratch_dir(spark), "load_manifest")
    io.append_manifest(events, path)
    io.append_manifest(events, path)
    return io.read_manifest(spark, path)


def manifest_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended by four branches at once, two of them the same ones, and merged."""
    events = io.load_events(
        table(spark, sf_dir, "events"),
        table=F.col("event_type"),
        mode=F.lit(fixed.DELTA),
        stamp=fn.date_stamp(F.col("ts")),
    )
    path = io.table_path(scratch_dir(spark), "load_manifest")
    branches = [events, events, events.where("date < '20240110'"), events.where("date >= '20240120'")]
    with ThreadPoolExecutor(max_workers=len(branches)) as pool:
        list(pool.map(lambda branch: io.append_manifest(branch, path), branches))
    io.compact_manifest(spark, path)
    return io.read_manifest(spark, path)


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with a new status; the urgent ones come as new orders."""
    orders = table(spark, sf_dir, "orders")
    is_new = F.col("o_orderpriority") == "1-URGENT"
    key = F.when(is_new, -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    return orders.withColumns({"o_orderkey": key, "o_orderstatus": F.lit("X")})


def _recent_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of a delta: those of the orders since July 2001."""
    since = F.lit("2001-07-01").cast("timestamp_ntz")
    return _order_changes(spark, sf_dir).where(F.col("o_orderdate") >= since)


def _load_orders(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    path = io.table_path(scratch_dir(spark), "orders")
    io.overwrite_dataset(table(spark, sf_dir, "orders"), path)
    loaded = plans.loaded_table(
        mode,
        base=io.read_dataset(spark, path),
        source=_order_changes(spark, sf_dir),
        keys=["o_orderkey"],
        changed_at="o_orderdate",
        reference=ORDERS_REFERENCE,
        days=14,
    )
    io.overwrite_dataset(loaded, path)
    return io.read_dataset(spark, path)


def load_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_orders(spark, sf_dir, fixed.FULL)


def load_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_orders(spark, sf_dir, fixed.DELTA)


def _listed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands of large parts, through a text file with dotted codes."""
    path = f"{scratch_dir(spark)}/products.txt"
    brands = (
        table(spark, sf_dir, "part")
        .groupBy("p_brand")
        .agg(F.avg("p_size").alias("size"))
        .where(F.col("size") >= 25.5)
    )
    dotted = F.concat(F.replace(F.col("p_brand"), F.lit("#"), F.lit(".#.")), F.lit("."))
    brands.select(dotted.alias("value")).write.text(path)
    return io.read_product_list(spark, path, "p_brand")


def product_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    kept = op.keep_products(parts, _listed_products(spark, sf_dir), "p_brand")
    price = F.sum(F.col("p_retailprice").cast("decimal(18,2)"))
    return kept.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"), price.cast("double").alias("total_price")
    )


def product_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed products written to one directory each and merged again."""
    parts = table(spark, sf_dir, "part")
    kept = op.keep_products(parts, _listed_products(spark, sf_dir), "p_brand")
    path = io.table_path(scratch_dir(spark), "parts_by_brand")
    io.write_by_product(kept, path, "p_brand")
    return io.read_by_product(spark, path, kept)


def date_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.date_stamp(day).alias("stamp"),
        fn.day_of_month(day).alias("day"),
        fn.is_day_of_month(day, "07").alias("is_due"),
    )


# Operators of our own definition


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("party_key"),
        F.col("s_acctbal").alias("balance"),
    )
    return op.union_all({"customer": customers, "supplier": suppliers})


def matched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_lines(spark, sf_dir)


def unmatched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unmatched_rows(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        ["o_orderkey"],
        ["l_orderkey"],
    )


def spread_matched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the orders that are there, large orders dealt out by line."""
    return op.matched_rows(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        ["l_orderkey"],
        ["o_orderkey"],
        op.Spread(by=["l_linenumber", "l_partkey", "l_suppkey"]),
    )


def delta_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.delta_keys(
        table(spark, sf_dir, "events"), ["user_id"], "ts", EVENTS_REFERENCE, days=1
    )


def delta_keys_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.delta_keys(
        table(spark, sf_dir, "events"), ["user_id"], "ts", EVENTS_REFERENCE, 1, fixed.FULL
    )


def delta_keys_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys as of a delta, from a day stamp in text."""
    events = table(spark, sf_dir, "events").withColumn("stamp", fn.date_stamp(F.col("ts")))
    return op.delta_keys(
        events, ["user_id"], "Stamp", EVENTS_REFERENCE, days=1, date_format="yyyyMMdd"
    )


def delta_restrict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.delta_restrict(
        table(spark, sf_dir, "events"), delta_keys(spark, sf_dir), ["user_id"]
    )


def delta_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.delta_upsert(
        table(spark, sf_dir, "orders"), _recent_changes(spark, sf_dir), ["o_orderkey"]
    )


def partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in folders by nation; those of some nations change, move to another, come or go."""
    customers = table(spark, sf_dir, "customer")
    path = io.table_path(scratch_dir(spark), "customer")
    io.write_partitions(customers, path, ["c_nationkey"])
    moved = customers.where("c_nationkey IN (3, 4)").withColumn(
        "c_nationkey", F.when(F.col("c_custkey") % 2 == 0, 5).otherwise(F.col("c_nationkey"))
    )
    came = customers.where("c_nationkey = 7").withColumns({"c_custkey": -F.col("c_custkey"), "c_nationkey": F.lit(99)})
    gone = customers.where("c_nationkey = 8 AND c_custkey % 3 = 0")
    delta = moved.withColumn("c_acctbal", -F.col("c_acctbal")).unionByName(came)
    return io.apply_to_partitions(path, delta, ["c_custkey"], deleted=gone)


def _customers_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers some days later: some went, some came, some have another balance or none."""
    customers = table(spark, sf_dir, "customer")
    came = customers.where("c_custkey % 6 = 1").withColumn("c_custkey", -F.col("c_custkey"))
    balance = F.when(F.col("c_custkey") % 4 == 1, F.col("c_acctbal") + 1).when(
        F.col("c_custkey") % 4 != 2, F.col("c_acctbal")
    )
    return customers.where("c_custkey % 5 <> 0").withColumn("c_acctbal", balance).unionByName(came)


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.snapshot_diff(
        table(spark, sf_dir, "customer"), _customers_later(spark, sf_dir), ["c_custkey"]
    )


def snapshot_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policy rows some days later, from the rows before and the difference."""
    before, after = view(spark, sf_dir, "policy_object"), later(spark, sf_dir, "policy_object")
    key = ["num_poliza", "num_version"]
    return op.apply_diff(before, op.snapshot_diff(before, after, key), key)


def control_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = op.FigureSource(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        F.col("o_totalprice"),
        {"year": F.year("o_orderdate"), "status": F.col("o_orderstatus")},
    )
    lines = op.FigureSource(
        table(spark, sf_dir, "lineitem"),
        "l_shipdate",
        F.col("l_extendedprice"),
        {"year": F.year("l_shipdate"), "status": F.col("l_linestatus")},
    )
    figures = op.control_figures(orders, lines, FIRST_DAY, LAST_DAY, T.DecimalType(38, 4))
    amounts = ("left_amount", "right_amount", "amount_difference")
    return figures.withColumns({c: F.col(c).cast("double") for c in amounts})


def differing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers behind the difference of two snapshots, found by descending into hash ranges."""
    return op.differing_keys(
        table(spark, sf_dir, "customer"), _customers_later(spark, sf_dir), ["c_custkey"], bits=4
    )


def differing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few orders among all: one status changed, one order gone, one there twice."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderkey") % 5000 == 1, "?").otherwise(F.col("o_orderstatus"))
    other = orders.where("o_orderkey % 5000 <> 2").withColumn("o_orderstatus", status)
    return op.differing_keys(orders, other.unionByName(orders.where("o_orderkey % 5000 = 3")), ["o_orderkey"])


def _figure_source(df: DataFrame, prefix: str, day: str, amount: str, status: str) -> op.FigureSource:
    groups = {"year": F.year(f"{prefix}_{day}"), "status": F.col(f"{prefix}_{status}")}
    return op.FigureSource(df, f"{prefix}_{day}", F.col(f"{prefix}_{amount}"), groups)


def kept_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures kept by day, after two days of the orders have changed and were counted again."""
    kind, root = T.DecimalType(20, 4), scratch_dir(spark)
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    plans.store_figures(_figure_source(orders, "o", "orderdate", "totalprice", "orderstatus"), f"{root}/orders", kind)
    plans.store_figures(_figure_source(lines, "l", "shipdate", "extendedprice", "linestatus"), f"{root}/lines", kind)
    days = [date(1997, 3, 1), date(1998, 7, 4)]
    on_days = F.col("o_orderdate").cast("date").isin(days)
    changed = orders.withColumn("o_orderstatus", F.when(on_days, "X").otherwise(F.col("o_orderstatus")))
    plans.refresh_figures(_figure_source(changed, "o", "orderdate", "totalprice", "orderstatus"), f"{root}/orders", days)
    figures = plans.kept_figures(spark, f"{root}/orders", f"{root}/lines", FIRST_DAY, LAST_DAY)
    amounts = ("left_amount", "right_amount", "amount_difference")
    return figures.withColumns({c: F.col(c).cast("double") for c in amounts})


def gap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.gap_rows(
        table(spark, sf_dir, "orders"), _orders_with_lines(spark, sf_dir), ["o_orderkey"]
    )


def version_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of versions without a usable policy row, from version 1 on; negative policies are kept too."""
    usable = later(spark, sf_dir, "policy_object").where(fn.usable_key(F.col("cve_filiacion")))
    gaps = op.missing_ranges(usable, ["num_poliza"], "num_version", first=1)
    return gaps.withColumn("missing", F.col("missing").cast("bigint"))


def order_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of order keys without lines, by status: a few keys with very many numbers."""
    gaps = op.missing_ranges(_orders_with_lines(spark, sf_dir), ["o_orderstatus"], "o_orderkey", first=-5)
    return gaps.withColumn("missing", F.col("missing").cast("bigint"))


def gap_adjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.gap_adjust(
        _orders_with_lines(spark, sf_dir), table(spark, sf_dir, "orders"), ["o_orderkey"]
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        insured_flat,
        insured_job,
        insured_upkeep,
        scan_table,
        overwrite_roundtrip,
        sql_on_views,
        project_alias,
        role_literal,
        filter_nonblank_key,
        join_left_master,
        join_left_contact,
        join_chain_fanout,
        reduced_chain,
        distinct_rows,
        dedup_policy_version,
        row_count,
        cast_char,
        clean_text,
        regex_replace,
        person_type,
        full_name,
        replace_load_types,
        catalog_load,
        accepted_rows,
        rejected_rows,
        bucketed_versions,
        dataset_copy,
        snapshot_before_adjust,
        pinned_snapshot,
        product_copy,
        dated_backup,
        load_manifest,
        manifest_branches,
        load_full,
        load_delta,
        product_partition,
        product_directories,
        date_stamp,
        union_all,
        matched_rows,
        unmatched_rows,
        spread_matched_rows,
        delta_keys,
        delta_keys_full,
        delta_keys_text,
        delta_restrict,
        delta_upsert,
        partition_upsert,
        snapshot_diff,
        snapshot_replay,
        control_figures,
        differing_keys,
        differing_orders,
        kept_figures,
        gap_rows,
        version_gaps,
        order_gaps,
        gap_adjust,
    )
}

"""What the plans look like: nothing in Python, no pairs, early reduction, split skew."""

import re

import pytest
from conftest import DATA
from pyspark.sql import functions as F
from rows import executed_plan, planned

from partyfold import operators as op
from partyfold import plans
from workload.queries import QUERIES
from workload.views import view

SMALL = str(DATA / "sf0.001")
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
FORBIDDEN = re.compile(r"Python|Pandas|Arrow|Cartesian|NestedLoop|BroadcastExchange")


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_no_pairs_no_forced_broadcast(spark, settings, name):
    settings(NO_BROADCAST)
    plan = planned(QUERIES[name](spark, SMALL))
    assert not FORBIDDEN.search(plan), plan


@pytest.mark.parametrize("name", ["dedup_policy_version", "insured_flat", "join_left_master"])
def test_rows_are_reduced_before_they_are_shuffled(spark, name):
    plan = planned(QUERIES[name](spark, SMALL))
    final, partial = plan.index(", Final"), plan.index(", Partial")
    assert final < plan.index("Exchange", final) < partial


@pytest.mark.parametrize(
    "name", ["distinct_rows", "join_chain_fanout", "control_figures", "delta_keys"]
)
def test_groups_are_combined_before_they_are_shuffled(spark, name):
    plan = planned(QUERIES[name](spark, SMALL))
    assert plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2


def test_insured_table_joins_once_and_shuffles_four_times(spark, settings):
    settings(NO_BROADCAST)
    plan = planned(QUERIES["insured_flat"](spark, SMALL))
    assert plan.count("SortMergeJoin") == 1
    shuffled_by = re.findall(r" Exchange hashpartitioning\((\w+)", plan)
    assert [k for k in shuffled_by if k != "__bucket"] == [
        "cve_filiacion", "num_poliza", "__right_key_0", "__party",
    ]


@pytest.mark.parametrize(
    ("name", "pushed", "columns"),
    [
        ("delta_keys", "GreaterThanOrEqual(ts,2024-01-14T00:00), LessThan(ts,2024-01-15T00:00)",
         "ts:timestamp_ntz,user_id:bigint"),
        ("control_figures", "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)",
         "o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz"),
        ("distinct_rows", "", "user_id:bigint,event_type:string"),
        ("matched_rows", "", "l_orderkey:bigint"),
        ("row_count", "", ""),
        ("insured_flat", "", "c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,"
         "c_mktsegment:string"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, settings, name, pushed, columns):
    settings({"spark.sql.maxMetadataStringLength": "2000"})
    df = QUERIES[name](spark, SMALL)
    plan = planned(df)
    assert pushed in plan
    assert f"struct<{columns}>" in plan


ORDER_FILTER = "o_orderstatus = 'F'"


@pytest.mark.parametrize("spread", [None, op.Spread(by=["o_custkey"])], ids=["plain", "spread"])
def test_joins_let_filters_and_pruning_through(spark, spread):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    more = {"o_custkey:bigint,"} if spread else {""}
    kept = op.matched_rows(orders, lines, ["o_orderkey"], ["l_orderkey"], spread)
    plan = planned(kept.where(ORDER_FILTER).select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in plan
    assert f"struct<o_orderkey:bigint,{more.pop()}o_orderstatus:string>" in plan

    customers = spark.read.parquet(f"{SMALL}/customer.parquet")
    joined = op.left_join_one(
        orders, customers, ["o_custkey"], ["c_custkey"],
        spread and op.Spread(by=["o_orderkey"]),
    )
    since = F.lit("2001-01-01").cast("timestamp_ntz")
    plan = planned(joined.where(F.col("o_orderdate") >= since).select("o_orderkey", "c_name"))
    assert "GreaterThanOrEqual(o_orderdate,2001-01-01T00:00)" in plan
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "struct<c_custkey:bigint,c_name:string>" in plan


@pytest.mark.parametrize("spread", [True, False])
def test_filters_on_the_insured_table_reach_its_scans(spark, spread):
    views = [view(spark, SMALL, n) for n in ("policy_object", "party_master", "contact_data")]
    plan = planned(plans.insured_flat(*views, spread=spread).where("num_poliza = 7"))
    assert "EqualTo(l_orderkey,7)" in plan


def test_gap_rows_read_only_the_keys_of_the_target(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    target = orders.withColumnRenamed("o_orderstatus", "other")
    plan = planned(op.gap_rows(orders, target, ["o_orderkey"]))
    assert plan.count("ReadSchema: struct<o_orderkey:bigint>") + plan.count("struct<o_orderkey:bigint>") >= 1
    assert plan.count("Exchange hashpartitioning") <= 3


@pytest.fixture
def skewed(spark, settings):
    """A left side with one key on a third of its rows, and settings small enough to notice."""
    settings(
        {
            **NO_BROADCAST,
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("string")
    return spark.range(0, 120_000, 1, 8).select(key.alias("k"), "id", F.sha1(F.col("id").cast("string")).alias("v"))


@pytest.mark.parametrize("how", ["left", "semi", "anti", "upsert"])
def test_a_hot_key_is_split_over_tasks(spark, skewed, how):
    # The right side comes out of an aggregation, which is what usually prevents the split.
    other = spark.range(0, 8000, 1, 4).select((F.col("id") % 4000).cast("string").alias("key"))
    right = op.first_per_key(other.withColumn("w", F.lit("x")), ["key"])
    by = op.Spread(by=["id"], rows_per_task=200_000)
    joined = {
        "left": lambda: op.left_join_one(skewed, right, ["k"], ["key"], by),
        "semi": lambda: op.matched_rows(skewed, other, ["k"], ["key"], by),
        "anti": lambda: op.unmatched_rows(
            skewed, other.where("key <> '7'"), ["k"], ["key"], spread=by
        ),
        "upsert": lambda: op.delta_upsert(skewed, skewed.where("id = 1"), ["k"], by),
    }[how]()
    plan = executed_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan, plan


def test_a_hot_party_is_split_in_the_insured_table(spark, skewed):
    from partyfold import fixed

    policies = skewed.select(
        F.col("id").alias("num_poliza"),
        F.lit(1).alias("num_version"),
        F.col("k").alias("cve_filiacion"),
    )
    key = F.col("id").cast("string")
    master = spark.range(6000).select(
        key.alias("cdfiliac"), *[key.alias(c) for c in fixed.MASTER_COLUMNS]
    )
    contacts = spark.range(6000).select(
        key.alias("cve_filiacion"), *[key.alias(c) for c in fixed.CONTACT_COLUMNS]
    )
    result = plans.insured_flat(policies, master, contacts)
    assert "SortMergeJoin(skew=true)" in executed_plan(result)
    assert result.count() == 120_000
    assert result.where("rfc = cve_asegurado").count() == 120_000


def test_a_hot_product_is_split_when_written(spark, skewed, tmp_path):
    from partyfold import sources as io

    hot = skewed.withColumn("k", F.when(F.col("k") == "7", "hot").otherwise("cold"))
    path = tmp_path / "by_product"
    io.write_by_product(hot, str(path), "k")
    assert len(list(path.glob("version-*/k=hot/*.parquet"))) > 1
    assert io.read_by_product(spark, str(path), hot).count() == 120_000

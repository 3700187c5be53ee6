"""How joins spread hot keys: measured bounds, and the same results as without salts."""

from importlib import import_module

import pytest
from pyspark.sql import functions as F
from rows import bag

from partyfold import operators as op

joins = import_module("partyfold.operators.joins")

ROWS = 60_000
SPREAD = op.Spread(by=["v"], rows_per_task=500)


def salts_of(df, keys, spread=SPREAD):
    """The salts of buckets that have more than one."""
    [row] = joins._salts_per_bucket(df, keys, spread).collect()
    assert len(row[0]) == spread.buckets
    return [n for n in row[0] if n > 1]


@pytest.fixture
def skewed(spark):
    """A third of the rows have one key."""
    hot = F.col("id") % 3 == 0
    key = F.when(hot, 7).otherwise(F.col("id") % 5000).cast("string")
    return spark.range(0, ROWS, 1, 8).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture
def right(spark):
    key = (F.col("id") * 2 + 1).cast("string")
    return spark.range(3000).select(key.alias("key"), F.col("id").alias("w"))


def test_no_salts_without_hot_keys(spark):
    assert salts_of(spark.range(100_000), ["id"]) == []
    assert salts_of(spark.range(0), ["id"]) == []
    few = op.Spread(by=["id"], rows_per_task=10, buckets=8)
    assert salts_of(spark.range(100_000), ["id"], few) == []  # all buckets alike


def test_salts_follow_the_number_of_rows(skewed):
    assert 40 <= max(salts_of(skewed, ["k"])) <= 42


def test_there_is_no_largest_number_of_salts(spark):
    one_key = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    spread = op.Spread(by=["v"], rows_per_task=2)
    assert salts_of(one_key, ["k"], spread) == [10_000]
    keys = spark.createDataFrame([(1,)], "k int")
    assert op.matched_rows(one_key, keys, ["k"], spread=spread).count() == 20_000


def test_a_hot_key_gets_many_salts_and_the_same_ones_again(skewed):
    salts = joins._salts_per_bucket(skewed, ["k"], SPREAD)
    salted = joins._take_one_salt(skewed, salts, ["k"], SPREAD)
    hot = salted.where("k = '7'")
    assert salted.count() == ROWS
    assert hot.select("__salt").distinct().count() >= 40
    again = joins._take_one_salt(skewed.repartition(3), salts, ["k"], SPREAD).where("k = '7'")
    assert bag(hot) == bag(again)


def test_right_rows_are_repeated_for_hot_buckets_only(skewed, right):
    salts = joins._salts_per_bucket(skewed, ["k"], SPREAD)
    repeated = joins._repeat_for_salts(right, salts, ["key"], SPREAD)
    assert repeated.where("key = '7'").count() >= 40
    assert repeated.count() < right.count() + 100


@pytest.mark.parametrize("spread", [None, SPREAD], ids=["plain", "spread"])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_results_are_those_of_plain_joins(skewed, right, settings, threshold, spread):
    settings({"spark.sql.autoBroadcastJoinThreshold": threshold})
    keys = right.select(F.col("key").alias("k"))
    left = bag(op.left_join_one(skewed, right, ["k"], ["key"], spread))
    assert left == bag(skewed.join(right, F.col("k") == F.col("key"), "left").drop("key"))
    semi = bag(op.matched_rows(skewed, keys, ["k"], spread=spread))
    assert semi == bag(skewed.join(keys, "k", "left_semi"))
    anti = bag(op.unmatched_rows(skewed, keys, ["k"], spread=spread))
    assert anti == bag(skewed.join(keys, "k", "left_anti"))


def test_tables_with_columns_that_cannot_be_hashed(frame):
    table = frame([(1, {"a": 1}), (2, {})], "k int, m map<string,int>")
    spread = op.Spread(by=["k"], rows_per_task=1)
    kept = op.matched_rows(table, frame([(1,)], "k int"), ["k"], spread=spread)
    assert kept.first()["m"] == {"a": 1}


def test_hot_null_key(spark):
    key = F.when(F.col("id") % 3 > 0, F.col("id"))
    base = spark.range(0, 3000, 1, 4).select(key.alias("k"), F.lit("base").alias("v"))
    delta = spark.createDataFrame([(None, "delta"), (1, "delta")], "k bigint, v string")
    spread = op.Spread(by=["v"], rows_per_task=100)
    result = op.delta_upsert(base, delta, ["k"], spread)
    assert bag(result.groupBy("v").count()) == {("base", 1999): 1, ("delta", 2): 1}


def test_a_join_that_counts_another_table_is_still_whole(spark, skewed, right):
    cold = spark.range(10).select(F.col("id").cast("string").alias("k"))
    hot = skewed.select("k").where("k = '7'")
    plain = bag(op.left_join_one(skewed, right, ["k"], ["key"]))
    for counted in (cold, hot):
        spread = op.Spread(by=["v"], counted=counted, rows_per_task=500)
        assert bag(op.left_join_one(skewed, right, ["k"], ["key"], spread)) == plain


def test_keys_of_different_types_are_refused(frame):
    left, right = frame([(1,)], "k int"), frame([(1,)], "k bigint")
    with pytest.raises(ValueError, match="differ in type"):
        op.matched_rows(left, right, ["k"])


def test_a_spread_needs_columns_and_rows():
    for wrong in ({"by": []}, {"by": ["a"], "rows_per_task": 0}, {"by": ["a"], "buckets": 0}):
        with pytest.raises(ValueError, match="spread by"):
            op.Spread(**wrong)

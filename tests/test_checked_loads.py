"""Loads that keep misfits apart, and tables in buckets."""

import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import bag, planned

from partyfold import operators as op
from partyfold import sources as io

TEXT = "id string, day string, amount string, at string, other string"
WANTED = T.StructType([
    T.StructField("id", T.IntegerType(), False), T.StructField("day", T.DateType()),
    T.StructField("amount", T.DecimalType(6, 2)), T.StructField("at", T.TimestampNTZType()),
])


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t" / "data")


ROWS = [
    ("1", "2024-01-31", "12.50", "2024-01-31 10:00:00", "kept"),
    ("1", "2024-01-31", "12.50", "2024-01-31 10:00:00", "kept"),
    ("2", None, None, None, None),
    (None, "2024-01-31", "1", None, "no id"),
    ("3", "31.01.2024", "1.234", "soon", "three faults"),
    ("4", "2024-02-30", "1", None, "no such day"),
    ("5", "2024-02-29", "99999.99", None, "too long"),
    ("99999999999", None, None, None, "too large"),
    ("six", None, "1e2", None, "words"),
]


def test_accepted_and_rejected_make_the_whole(frame, path):
    load = io.checked_load(frame(ROWS, TEXT), path, WANTED)
    assert [(f.name, f.dataType) for f in load.accepted.schema] == [(f.name, f.dataType) for f in WANTED]
    assert bag(load.accepted) == {
        (1, date(2024, 1, 31), Decimal("12.50"), datetime(2024, 1, 31, 10)): 2, (2, None, None, None): 1,
    }
    faults = {r["other"]: [(p["column"], p["value"], p["reason"]) for p in r["problems"]] for r in load.rejected.collect()}
    fit = "does not fit "
    assert faults == {
        "no id": [("id", None, "missing")],
        "three faults": [("day", "31.01.2024", fit + "date"), ("amount", "1.234", fit + "decimal(6,2)"), ("at", "soon", fit + "timestamp_ntz")],
        "no such day": [("day", "2024-02-30", fit + "date")],
        "too long": [("amount", "99999.99", fit + "decimal(6,2)")],
        "too large": [("id", "99999999999", fit + "int")],
        "words": [("id", "six", fit + "int")],
    }
    assert bag(load.rejected.drop("problems")) == Counter(r for r in ROWS if r[4] not in ("kept", None))
    assert (load.accepted_rows, load.rejected_rows) == (3, 6)


@pytest.mark.parametrize("seed", range(2))
def test_no_row_is_lost_whatever_comes(frame, path, seed):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice(values)
    rows = [
        (pick("1", "x", None, " 2 "), pick("2024-01-01", "", None), pick("1.1", "-0.005", "NaN", None), pick("2024-01-01", "?", None), str(i))
        for i in range(40)
    ]
    load = io.checked_load(frame(rows, TEXT).repartition(4), path, WANTED)
    assert load.accepted_rows == load.accepted.count() and load.rejected_rows == load.rejected.count()
    assert load.accepted_rows + load.rejected_rows == len(rows)
    refused = {r["other"] for r in load.rejected.collect()}
    assert bag(load.rejected.drop("problems")) == Counter(r for r in rows if r[4] in refused)
    good = frame([r for r in rows if r[4] not in refused], TEXT)
    assert bag(load.accepted) == bag(good.select(*[F.col(f.name).cast(f.dataType) for f in WANTED]))


def test_numbers_that_would_lose_digits_do_not_fit(frame, path):
    wanted = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.DecimalType(4, 1))])
    rows = [(1.0, Decimal("1.10")), (1.5, Decimal("1.10")), (3e9, Decimal("1.10")), (2.0, Decimal("1.15")), (float("nan"), None)]
    load = io.checked_load(frame(rows, "n double, d decimal(10,2)"), path, wanted)
    assert bag(load.accepted) == {(1, Decimal("1.1")): 1}
    assert [len(r["problems"]) for r in load.rejected.collect()] == [1] * 4


def test_one_job_writes_both_parts_and_a_failing_load_keeps_the_old_ones(spark, frame, path):
    io.checked_load(frame(ROWS, TEXT), path, WANTED)
    assert io.read_rejected(spark, path).count() == 6
    broken = frame(ROWS, TEXT).withColumn("day", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        io.checked_load(broken, path, WANTED)
    assert io.read_accepted(spark, path).count() == 3
    empty = io.checked_load(frame([], TEXT), path, WANTED)
    assert (empty.accepted.count(), empty.rejected.count(), empty.accepted_rows, empty.rejected_rows) == (0, 0, 0, 0)
    clean = io.checked_load(frame(ROWS[:2], TEXT), path, WANTED)
    assert clean.rejected.count() == 0 and "problems" in clean.rejected.columns
    with pytest.raises(ValueError, match="of the load's own"):
        io.checked_load(frame([(1,)], "problems int"), path, T.StructType([T.StructField("problems", T.IntegerType())]))


# Buckets

PAIRS = "k int, j string, v int"


@pytest.fixture
def bucketed(spark, tmp_path):
    made = []

    def make(name, df, keys, buckets):
        made.append(name)
        return io.write_bucketed(df, name, str(tmp_path / name), keys, buckets)

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_reductions_and_joins_need_no_shuffle(spark, frame, bucketed, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    rows = [(i % 50, str(i % 3), i) for i in range(500)]
    plain = frame(rows, PAIRS)
    bucketed("fold_rows", plain, ["k", "j"], 4)
    bucketed("fold_names", plain.select("k", "j", F.lit(1).alias("w")).distinct(), ["k", "j"], 4)
    stored, names = io.co_located(spark, ["fold_rows", "fold_names"], ["k", "j"])
    for build in (
        lambda a, _: op.first_per_key(a, ["k", "j"]),
        lambda a, b: op.left_join_one(a, b.withColumnsRenamed({"k": "k2", "j": "j2"}), ["k", "j"], ["k2", "j2"]),
    ):
        moved, there = build(plain, names), build(stored, names)
        assert planned(there).count("Exchange") == 0 < planned(moved).count("Exchange")
        assert bag(there) == bag(moved)


def test_unequal_buckets_are_refused(spark, frame, bucketed):
    df = frame([(1, "a", 1)], PAIRS)
    bucketed("fold_four", df, ["k"], 4)
    bucketed("fold_eight", df, ["k"], 8)
    assert io.bucket_spec(spark, "fold_eight") == (8, ["k"])
    with pytest.raises(ValueError, match="same buckets"):
        io.co_located(spark, ["fold_four", "fold_eight"])
    with pytest.raises(ValueError, match="not by"):
        io.co_located(spark, ["fold_four"], ["j"])
    df.write.saveAsTable("fold_plain")
    try:
        with pytest.raises(ValueError, match="not in buckets"):
            io.bucket_spec(spark, "fold_plain")
    finally:
        spark.sql("DROP TABLE fold_plain")


def test_a_table_in_buckets_is_replaced_or_stays(spark, frame, bucketed, tmp_path):
    bucketed("fold_kept", frame([(1, "a", 1)], PAIRS), ["k"], 2)
    broken = frame([(2, "b", 2)], PAIRS).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        bucketed("fold_kept", broken, ["k"], 2)
    assert bag(spark.table("fold_kept")) == {(1, "a", 1): 1}
    grown = spark.table("fold_kept").unionAll(frame([(2, "b", 2)], PAIRS))  # reads what it replaces
    assert bag(bucketed("fold_kept", grown, ["k"], 2)) == {(1, "a", 1): 1, (2, "b", 2): 1}
    assert len(list((tmp_path / "fold_kept").glob("version-*"))) == 1

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import bag

from partyfold import operators as op


def test_row_count_of_rows_with_a_stated_schema(spark):
    schema = T.StructType(
        [
            T.StructField("foe1", T.StringType(), False),
            T.StructField("foe2", T.StringType(), False),
        ]
    )
    df = spark.createDataFrame([("bar1.1", "bar2.1"), ("bar1.2", "bar2.2")], schema)
    assert op.row_count(df).first()["row_count"] == 2
    assert op.row_count(df.limit(0)).first()["row_count"] == 0


def test_distinct_treats_nulls_as_equal(frame):
    df = frame([(1, None), (1, None), (1, "a"), (None, None), (None, None)], "k int, v string")
    assert bag(op.distinct_rows(df)) == {(1, None): 1, (1, "a"): 1, (None, None): 1}
    assert bag(op.distinct_rows(df, ["k"])) == {(1,): 1, (None,): 1}


def test_first_per_key_takes_the_smallest_row_nulls_first(frame):
    rows = [(1, "b", 1), (1, "a", 9), (2, "x", None), (2, None, 5), (None, "z", 1), (None, "y", 2)]
    df = frame(rows, "k int, v string, w int")
    assert bag(op.first_per_key(df, ["k"])) == {(1, "a", 9): 1, (2, None, 5): 1, (None, "y", 2): 1}
    by_w = op.first_per_key(df, ["k"], order=["w"])
    assert bag(by_w) == {(1, "b", 1): 1, (2, "x", None): 1, (None, "z", 1): 1}
    assert by_w.columns == df.columns


def test_first_per_key_ignores_the_case_of_names_and_the_order_of_rows(frame):
    rows = [(k % 5, v % 7, str(v)) for k, v in zip(range(60), range(60, 0, -1))]
    schema = "NUM_POLIZA int, v int, w string"
    expected = bag(op.first_per_key(frame(rows, schema), ["num_poliza"]))
    shuffled = frame(rows[::-1], schema).repartition(7)
    assert bag(op.first_per_key(shuffled, ["Num_Poliza"])) == expected
    assert expected.total() == 5


def test_first_per_key_of_keys_alone_and_of_unknown_keys(frame):
    df = frame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert bag(op.first_per_key(df, ["a", "b"])) == {(1, 2): 1, (3, 4): 1}
    with pytest.raises(ValueError, match="no such columns"):
        op.first_per_key(df, ["c"])


def test_left_join_one_compares_keys_as_they_are(frame):
    left = frame([("K1", 1), ("K1 ", 2), (None, 3), ("K2", 4), ("K2", 4)], "k string, n int")
    right = frame([("K1", "one"), ("K2", None), (None, "null")], "key string, v string")
    joined = op.left_join_one(left, right, ["k"], ["key"])
    assert joined.columns == ["k", "n", "v"]
    assert bag(joined) == {
        ("K1", 1, "one"): 1,
        ("K1 ", 2, None): 1,
        (None, 3, None): 1,
        ("K2", 4, None): 2,
    }


def test_left_join_one_refuses_ambiguous_columns_and_uneven_keys(frame):
    left = frame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="both sides"):
        op.left_join_one(left, frame([(1, "b")], "key int, V string"), ["k"], ["key"])
    with pytest.raises(ValueError, match="same number"):
        op.left_join_one(left, frame([(1, 2)], "a int, b int"), ["k"], ["a", "b"])


def test_matched_and_unmatched_split_a_table(frame):
    table = frame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    keys = frame([(1, 0), (1, 0), (3, 0), (None, 0)], "key int, x int")
    matched = op.matched_rows(table, keys, ["k"], ["key"])
    unmatched = op.unmatched_rows(table, keys, ["k"], ["key"])
    assert bag(matched) == {(1, "a"): 2}
    assert bag(unmatched) == {(2, "b"): 1, (None, "c"): 1}
    assert bag(matched.unionAll(unmatched)) == bag(table)


def test_split_on_two_keys_of_one_and_the_same_table(frame):
    table = frame([(1, "a", 1), (1, "b", 2), (2, "a", 3)], "k int, l string, n int")
    later = table.where("n >= 2")
    assert bag(op.matched_rows(table, later, ["k", "l"])) == {(1, "b", 2): 1, (2, "a", 3): 1}
    assert bag(op.unmatched_rows(table, later, ["k", "l"])) == {(1, "a", 1): 1}


def test_chain_fanout_counts_what_the_joins_would_make(frame):
    left = frame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    one = frame([("a",), ("a",), ("a",), ("d",), (None,), (None,)], "x string")
    two = frame([("a",), ("a",), ("b",), ("b",)], "y string")
    joined = left.join(one, left.k == one.x, "left").join(two, left.k == two.y, "left")
    expected = bag(joined.groupBy("k").count())
    assert bag(op.chain_fanout(left, "k", [(one, "x"), (two, "y")])) == expected


def test_chain_fanout_of_more_rows_than_a_bigint_counts(spark):
    side = spark.range(0, 3_000_000, 1, 8).select(F.lit("a").alias("k"))
    [row] = op.chain_fanout(side, "k", [(side, "k"), (side, "k")]).collect()
    assert row["joined_rows"] == 27 * 10**18


def test_first_per_key_of_rows_with_maps(frame):
    rows = [("a", 2, {"x": 1}), ("a", 1, {"y": 2}), ("a", 1, {"z": 1}), ("b", 1, None)]
    table = frame(rows, "k string, n int, m map<string,int>")
    kept = {r["k"]: (r["n"], r["m"]) for r in op.first_per_key(table, ["k"]).collect()}
    assert kept["a"][0] == 1 and kept["b"] == (1, None)
    assert kept == {
        r["k"]: (r["n"], r["m"]) for r in op.first_per_key(table.repartition(3), ["k"]).collect()
    }


def test_union_all_by_name_with_missing_columns(frame):
    a = frame([(1, "x"), (1, "x")], "k int, v string")
    b = frame([("y", 2)], "v string, k int")
    c = frame([(3,)], "k int")
    united = op.union_all({"a": a, "b": b, "c": c})
    assert united.columns == ["k", "v", "source"]
    assert bag(united) == {(1, "x", "a"): 2, (2, "y", "b"): 1, (3, None, "c"): 1}


def test_union_all_keeps_existing_columns_safe(frame):
    with pytest.raises(ValueError, match="exists already"):
        op.union_all({"a": frame([(1, "x")], "k int, Source string")})
    with pytest.raises(ValueError, match="nothing"):
        op.union_all({})


CHANGES = [
    (1, datetime(2024, 1, 7, 23, 59, 59)),
    (2, datetime(2024, 1, 8)),
    (2, datetime(2024, 1, 9, 12)),
    (3, datetime(2024, 1, 9, 23, 59, 59)),
    (4, datetime(2024, 1, 10)),
    (None, datetime(2024, 1, 9)),
    (5, None),
]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_delta_keys_take_the_days_before_the_reference(frame, kind):
    df = frame(CHANGES, "k int, at timestamp_ntz").withColumn("at", F.col("at").cast(kind))
    keys = op.delta_keys(df, ["k"], "AT", date(2024, 1, 10), days=2)
    assert bag(keys) == {(2,): 1, (3,): 1}


@pytest.mark.parametrize("date_format", ["yyyyMMdd", "yyyy-MM-dd", "yyyy/MM/dd"])
def test_delta_keys_of_text_dates(frame, date_format):
    df = frame(CHANGES, "k int, at timestamp_ntz").withColumn("at", F.date_format("at", date_format))
    keys = op.delta_keys(df, ["k"], "at", date(2024, 1, 10), days=2, date_format=date_format)
    assert bag(keys) == {(2,): 1, (3,): 1}
    with pytest.raises(ValueError, match="state its date_format"):
        op.delta_keys(df, ["k"], "at", date(2024, 1, 10), days=2)
    with pytest.raises(ValueError, match="state its date_format"):
        op.delta_keys(df, ["k"], "at", date(2024, 1, 10), days=2, date_format="ddMMyyyy")


def test_delta_keys_refuse_numbers(frame):
    df = frame([(1, 20240109)], "k int, at int")
    with pytest.raises(ValueError, match="not a date"):
        op.delta_keys(df, ["k"], "at", date(2024, 1, 10), days=2)


def test_delta_keys_in_full_mode_are_all_keys(frame):
    df = frame(CHANGES, "k int, at timestamp_ntz")
    keys = op.delta_keys(df, ["k"], "at", date(2024, 1, 10), days=2, mode="full")
    assert bag(keys) == {(k,): 1 for k in (1, 2, 3, 4, 5)}
    with pytest.raises(ValueError, match="load mode"):
        op.delta_keys(df, ["k"], "at", date(2024, 1, 10), 2, mode="other")


def test_delta_restrict(frame):
    table = frame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert bag(op.delta_restrict(table, frame([(1,)], "k int"), ["k"])) == {
        (1, "a"): 1,
        (1, "b"): 1,
    }


def test_delta_upsert_replaces_keys_and_can_be_repeated(frame):
    base = frame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")], "k int, v string")
    delta = frame([(1, "x"), (3, "y"), (None, "z"), (3, "y")], "k int, v string")
    once = op.delta_upsert(base, delta, ["k"])
    assert bag(once) == {
        (1, "x"): 1,
        (2, "c"): 1,
        (4, "e"): 1,
        (3, "y"): 2,
        (None, "z"): 1,
    }
    assert bag(op.delta_upsert(once, delta, ["k"])) == bag(once)


def test_control_figures_side_by_side(frame):
    first, last = date(2013, 10, 1), date(2020, 7, 1)
    left = frame(
        [
            ("a", datetime(2013, 10, 1), 1.1),
            ("a", datetime(2020, 7, 1, 23, 59, 59), 2.2),
            ("a", datetime(2020, 7, 2), 99.0),
            ("a", datetime(2013, 9, 30, 23, 59, 59), 99.0),
            ("b", datetime(2014, 1, 1), None),
            (None, datetime(2014, 1, 1), 5.0),
        ],
        "g string, at timestamp_ntz, amount double",
    )
    right = frame(
        [("a", date(2020, 7, 1), Decimal("3.00")), (None, date(2013, 10, 1), Decimal("5.00")),
         ("c", date(2015, 1, 1), Decimal("7.25"))],
        "name string, day date, paid decimal(10,2)",
    )
    figures = op.control_figures(
        op.FigureSource(left, "at", F.col("amount"), {"group": F.col("g")}),
        op.FigureSource(right, "day", F.col("paid"), {"group": F.col("name")}),
        first,
        last,
        T.DecimalType(18, 2),
    )
    money = Decimal
    assert bag(figures) == {
        ("a", 2, 1, 1, money("3.30"), money("3.00"), money("0.30")): 1,
        ("b", 1, 0, 1, money("0.00"), money("0.00"), money("0.00")): 1,
        ("c", 0, 1, -1, money("0.00"), money("7.25"), money("-7.25")): 1,
        (None, 1, 1, 0, money("5.00"), money("5.00"), money("0.00")): 1,
    }


def figures_of(left, right, kind=None):
    day = date(2020, 1, 1)
    sides = [op.FigureSource(df, "day", F.col("amount"), {"g": F.col("g")}) for df in (left, right)]
    return op.control_figures(*sides, day, day, kind)


def amounts(frame, kind, *values):
    return frame([("a", date(2020, 1, 1), v) for v in values], f"g string, day date, amount {kind}")


def test_control_figures_keep_all_digits(frame):
    left = amounts(frame, "decimal(20,3)", Decimal("0.004"), Decimal("12345678901234567.001"))
    right = amounts(frame, "decimal(5,1)", Decimal("0.5"))
    [row] = figures_of(left, right).collect()
    assert row["left_amount"] == Decimal("12345678901234567.005")
    assert row["amount_difference"] == Decimal("12345678901234566.505")
    [row] = figures_of(amounts(frame, "bigint", 2**62, 2**62), amounts(frame, "int", 1)).collect()
    assert row["left_amount"] == 2**63


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_control_figures_never_lose_an_amount(frame, settings, ansi):
    settings({"spark.sql.ansi.enabled": ansi})
    small = amounts(frame, "double", 1.0)
    with pytest.raises(Exception, match="an amount does not fit"):
        figures_of(amounts(frame, "double", 1e17), small, T.DecimalType(18, 2)).collect()
    nines = amounts(frame, "decimal(38,0)", *[Decimal("9" * 38)] * 2)
    with pytest.raises(Exception, match="does not fit|OVERFLOW|overflow"):
        figures_of(nines, amounts(frame, "int", 1)).collect()
    with pytest.raises(ValueError, match="state the amount_type"):
        figures_of(small, small)
    with pytest.raises(ValueError, match="no decimal holds"):
        figures_of(amounts(frame, "decimal(38,0)"), amounts(frame, "decimal(38,38)"))


def test_control_figures_need_the_same_groups(frame):
    df = frame([("a", date(2020, 1, 1), 1.0)], "g string, day date, amount double")
    side = op.FigureSource(df, "day", F.col("amount"), {"g": F.col("g")})
    other = op.FigureSource(df, "day", F.col("amount"), {"h": F.col("g")})
    with pytest.raises(ValueError, match="same group names"):
        op.control_figures(side, other, date(2020, 1, 1), date(2020, 1, 1))


def test_gaps(frame):
    source = frame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "k int, v string")
    target = frame([(1, "t"), (3, "t")], "k int, v string")
    assert bag(op.gap_rows(source, target, ["k"])) == {(2, "b"): 2, (None, "c"): 1}
    adjusted = op.gap_adjust(target, source, ["k"])
    assert bag(adjusted) == {(1, "t"): 1, (3, "t"): 1, (2, "b"): 2, (None, "c"): 1}
    assert bag(op.gap_adjust(adjusted, source, ["k"])) == bag(adjusted)


def test_keep_products_counts_a_repeated_product_once(frame):
    df = frame([("P1", 1), ("P1", 2), ("P2", 3), (None, 4)], "product string, n int")
    listed = frame([("P1",), ("P1",), ("P9",)], "code string")
    assert bag(op.keep_products(df, listed, "product")) == {("P1", 1): 1, ("P1", 2): 1}

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from partyfold import functions as fn

TEXT = "text string"
NAME = "code string, given string, first string, second string"


@pytest.mark.parametrize(
    ("dirty", "clean"),
    [
        ("\tMU#OZ ", "MUÑOZ"),
        ("A#B#", "AÑBÑ"),
        ("a\tb", "a b"),
        (" \t x \t ", "x"),
        ("", ""),
        ("\t", ""),
        ("a  b", "a  b"),
        ("\na\n", "\na\n"),
        (None, None),
    ],
)
def test_clean_text(frame, dirty, clean):
    df = frame([(dirty,)], TEXT).select(fn.clean_text(F.col("text")))
    assert df.first()[0] == clean


def test_clean_text_twice_is_once(frame):
    rows = [("\tMU#OZ ",), ("a\tb",), (" # ",), (None,), ("##\t\t",)]
    once = frame(rows, TEXT).select(fn.clean_text(F.col("text")).alias("text"))
    assert once.select(fn.clean_text(F.col("text"))).collect() == once.collect()


@pytest.mark.parametrize(
    ("key", "usable"),
    [("K1", True), ("K1 ", True), ("\t", True), ("", False), ("   ", False), (None, False)],
)
def test_usable_key(frame, key, usable):
    assert frame([(key,)], TEXT).where(fn.usable_key(F.col("text"))).count() == usable


@pytest.mark.parametrize(
    ("code", "label", "name"),
    [
        ("F", "Fisica", "Ana Paz Gil"),
        ("f", "Moral", "Ana Paz Gil"),
        (" F", "Fisica", "Paz Gil Ana"),
        ("F ", "Fisica", "Paz Gil Ana"),
        (" f", "Moral", "Paz Gil Ana"),
        ("M", "Moral", "Paz Gil Ana"),
        ("", "Moral", "Paz Gil Ana"),
        (None, "Moral", "Paz Gil Ana"),
    ],
)
def test_label_and_name_order_test_the_code_differently(frame, code, label, name):
    df = frame([(code, "Ana", "Paz", "Gil")], NAME).select(
        fn.person_type(F.col("code")),
        fn.full_name(*[F.col(c) for c in ("code", "given", "first", "second")]),
    )
    assert tuple(df.first()) == (label, name)


@pytest.mark.parametrize(
    ("parts", "name"),
    [
        (("F", "Ana", None, "Gil"), "Ana  Gil"),
        (("M", "Ana", None, "Gil"), "Gil Ana"),
        (("M", "Ana", "Paz", None), "Paz  Ana"),
        (("F", None, None, None), ""),
        ((None, None, None, None), ""),
    ],
)
def test_full_name_with_missing_parts(frame, parts, name):
    df = frame([parts], NAME).select(
        fn.full_name(*[F.col(c) for c in ("code", "given", "first", "second")])
    )
    assert df.first()[0] == name


def test_role(frame):
    assert frame([("x",)], TEXT).select(fn.role()).first()[0] == "ASEGURADO"


def test_date_pieces(frame):
    day = F.col("day")
    df = frame([(datetime(2024, 3, 7),), (None,)], "day timestamp_ntz").select(
        fn.date_stamp(day), fn.day_of_month(day), fn.is_day_of_month(day, "07")
    )
    assert [tuple(r) for r in df.collect()] == [("20240307", "07", True), (None, None, None)]


def test_dates_do_not_move_with_the_zone(frame, settings):
    # Clocks in this zone went from 00:00 to 01:00 on that day.
    settings({"spark.sql.session.timeZone": "America/Sao_Paulo"})
    df = frame([(datetime(2018, 11, 4),)], "day timestamp_ntz")
    assert df.select(fn.date_stamp(F.col("day"))).first()[0] == "20181104"


def test_day_setting_is_compared_as_text(frame):
    df = frame([(datetime(2024, 3, 7),)], "day timestamp_ntz")
    assert df.select(fn.is_day_of_month(F.col("day"), "7")).first()[0] is False

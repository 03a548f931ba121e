"""Names, times and texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lapledger.functions import names, texts, times


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("ANN O'NEIL", "Ann O'Neil"),
        ("bo mcrae", "Bo McRae"),
        ("cy smith-mclean", "Cy Smith-McLean"),
        ("mcdonald", "Mcdonald"),
        ("di d'arcy-o'shea", "Di D'Arcy-O'Shea"),
        ("éva ünal", "Éva Ünal"),
        ("ed o'mcrae", "Ed O'Mcrae"),
        ("", ""),
        (None, None),
    ],
)
def test_standard_name(spark, given, expected):
    assert value(spark, names.standard_name(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [("LEE KAY Ann", "Ann LEE KAY"), (" LEE  Ann ", "Ann LEE"), ("Solo", "Solo")],
)
def test_reversed_name(spark, given, expected):
    assert value(spark, names.reversed_name(F.lit(given))) == expected


@pytest.mark.parametrize(
    ("given", "first", "last"),
    [("Ann Lee Kay", "Ann", "Lee Kay"), ("Solo", "Solo", "")],
)
def test_split_name(spark, given, first, last):
    assert value(spark, names.first_name(F.lit(given))) == first
    assert value(spark, names.last_name(F.lit(given))) == last


def test_page_ref(spark):
    assert value(spark, names.page_ref(F.lit("Ann O'Neil"))) == "a-ann-o-neil"


@pytest.mark.parametrize(
    ("given", "seconds"),
    [
        ("7:44.6", 464.6),
        ("26:03.4", 1563.4),
        ("1:02:03.5", 3723.5),
        ("0:00:00.0", 0.0),
        ("DNF", None),
        ("-", None),
        ("", None),
        (None, None),
    ],
)
def test_time_seconds(spark, given, seconds):
    found = value(spark, times.time_seconds(F.lit(given).cast("string")))
    assert found == (None if seconds is None else pytest.approx(seconds))


@pytest.mark.parametrize(
    ("given", "seconds"), [("-1:30.0", -90.0), ("+12:00.0", 720.0), ("+1:00:00.0", 3600.0)]
)
def test_handicap_seconds(spark, given, seconds):
    assert value(spark, times.handicap_seconds(F.lit(given))) == seconds


@pytest.mark.parametrize(
    ("seconds", "rounding", "tenths", "expected"),
    [
        (3723.25, "no", True, "01:02:03.3"),
        (59.96, "no", True, "00:01:00.0"),
        (59.9, "floor", False, "00:00:59"),
        (59.1, "ceiling", False, "00:01:00"),
        (59.5, "round", False, "00:01:00"),
        (None, "no", True, None),
    ],
)
def test_seconds_hms(spark, seconds, rounding, tenths, expected):
    column = F.lit(seconds).cast("double")
    assert value(spark, times.seconds_hms(column, rounding, tenths)) == expected


@pytest.mark.parametrize(
    ("seconds", "expected"),
    [(464.6, "07:44.6"), (3723.5, "1:02:03.5"), (3599.96, "1:00:00.0"), (0.0, "00:00.0")],
)
def test_seconds_short(spark, seconds, expected):
    assert value(spark, times.seconds_short(F.lit(seconds))) == expected


@pytest.mark.parametrize(
    ("place", "expected"),
    [(1, "1st"), (2, "2nd"), (3, "3rd"), (4, "4th"), (11, "11th"), (12, "12th"), (13, "13th"),
     (21, "21st"), (111, "111th"), (112, "112th"), (122, "122nd"), (0, "NA"), (None, "NA")],
)
def test_place_text(spark, place, expected):
    assert value(spark, texts.place_text(F.lit(place).cast("int"))) == expected


@pytest.mark.parametrize(
    ("parts", "expected"),
    [([], ""), (["a"], "a"), (["a", "b"], "a and b"), (["a", "b", "c"], "a, b, and c")],
)
def test_and_list(spark, parts, expected):
    column = F.array(*[F.lit(p) for p in parts]).cast("array<string>")
    assert value(spark, texts.and_list(column)) == expected


def test_name_block(spark):
    few = F.array(*[F.lit(f"n{i}") for i in range(19)])
    assert value(spark, texts.name_block(few)) == "\n".join(f"n{i}" for i in range(19))
    many = F.array(*[F.lit(f"n{i}") for i in range(21)])
    lines = value(spark, texts.name_block(many)).split("\n")
    assert lines[0] == "n0, n1" and lines[-1] == "n20"


@pytest.mark.parametrize(
    ("header", "expected"), [("'98-99", "1998-1999"), ("'99-00", "1999-2000"), ("'68-69", "2068-1969")]
)
def test_season_text(spark, header, expected):
    assert value(spark, texts.season_text(F.lit(header))) == expected

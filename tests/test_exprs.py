import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from caremesa.functions import age_years, blank, flag, minutes_between, percent


def test_minutes_count_boundaries(spark):
    rows = [
        ("1999-01-01 10:00:59", "1999-01-01 10:01:01"), ("1999-01-01 10:00:01", "1999-01-01 10:00:59"),
        ("1999-01-01 23:59:30", "1999-01-02 00:00:10"), ("1999-01-01 10:05:00", "1999-01-01 10:02:59"),
        ("1999-01-01 10:00:00", None),
    ]
    frame = spark.createDataFrame(rows, "a string, b string").selectExpr("cast(a as timestamp_ntz) a", "cast(b as timestamp_ntz) b")
    got = [r[0] for r in frame.select(minutes_between(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 0, 1, -3, None]


def test_age_at_birthdays(spark):
    born = ["2000-02-29", "1990-06-30", "1990-07-01", "2010-01-01"]
    frame = spark.createDataFrame([(b,) for b in born], "b string").selectExpr("cast(b as date) b")

    def at(day):
        return [r[0] for r in frame.select(age_years(F.col("b"), dt.date.fromisoformat(day))).collect()]

    assert at("2025-02-28")[0] == 25 and at("2025-02-27")[0] == 24
    assert at("1999-06-30")[1:3] == [9, 8]
    assert at("1999-06-30")[3] == -11


def test_percent_guards_and_rounds(spark):
    frame = spark.createDataFrame([(1, 3), (1, 8), (5, 0), (5, None), (None, 5), (2, 3)], "n bigint, d bigint")
    got = [r[0] for r in frame.select(percent(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("33.33"), Decimal("12.50"), None, None, None, Decimal("66.67")]
    half = spark.createDataFrame([(1, 800)], "n bigint, d bigint").select(percent(F.col("n"), F.col("d"))).first()[0]
    assert half == Decimal("0.13")


def test_blank_and_flag(spark):
    frame = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "t string")
    assert [r[0] for r in frame.select(blank(F.col("t"))).collect()] == [True, True, True, False]
    assert [r[0] for r in frame.select(flag(F.col("t") == "x")).collect()] == [0, 0, 0, 1]

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from medallion.functions import cleaning as c


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("word", ["NULL", " null ", "na", "?", "None", "", "  "])
def test_all_sentinels_become_null(spark, word):
    assert one(spark, c.null_if_sentinel("x"), word) is None


def test_kept_value_is_not_trimmed(spark):
    assert one(spark, c.null_if_sentinel("x"), " a ") == " a "
    assert one(spark, c.null_if_sentinel("x"), None) is None


def test_variants_use_the_smaller_sentinel_set(spark):
    df = spark.createDataFrame([("NA", " ? "), (None, "b"), ("", "NULL"), (" a ", "b")], "p string, q string")
    got = [r[0] for r in df.select(c.coalesce_variants("p", "q")).collect()]
    assert got == ["?", "b", None, "a"]


def test_ids_fall_back_to_the_next_readable_column(spark):
    df = spark.createDataFrame([("x", "7", None), (None, None, "9"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(c.coalesce_ids("a", "b", "c")).collect()] == [7, 9, None]


def test_casts_never_raise(spark):
    assert one(spark, c.safe_cast("x", "decimal(12,2)"), "NULL") is None
    assert one(spark, c.safe_cast("x", "decimal(12,2)"), "5.126") == Decimal("5.13")
    assert one(spark, c.safe_cast("x", "int"), "99999999999") is None


@pytest.mark.parametrize("text, number", [("23.4 kmpl", Decimal("23.40")), ("bhp", None), (None, None), ("74 bhp", Decimal("74.00"))])
def test_number_in_front_of_unit(spark, text, number):
    assert one(spark, c.extract_number("x", "decimal(6,2)"), text) == number


def test_unit_first_hit_wins_and_case_matters(spark):
    unit = c.extract_unit("x", ["km/kg", "kmpl"])
    assert one(spark, unit, "1 kmpl km/kg") == "km/kg"
    assert one(spark, unit, "1 KMPL") is None
    assert one(spark, unit, None) is None


@pytest.mark.parametrize("text, flag", [("27:00.0", True), ("2001-01-01", False), ("127:00.0", False), (None, None)])
def test_corrupt_date_pattern(spark, text, flag):
    assert one(spark, c.matches_corrupt("x"), text) is flag


def test_enum(spark):
    assert one(spark, c.normalise_enum("x", ["Y", "N"]), " y") == "Y"
    assert one(spark, c.normalise_enum("x", ["Y", "N"]), "maybe") is None


@pytest.mark.parametrize(
    "text, day",
    [("2001-02-03", datetime.date(2001, 2, 3)), ("2001-02-30", None), ("2001-2-3", None), ("2001-02-03 10:00", None), ("x", None)],
)
def test_iso_day_is_strict(spark, text, day):
    assert one(spark, c.safe_date("x"), text) == day


def test_other_date_format(spark):
    assert one(spark, c.safe_date("x", "dd.MM.yyyy"), "03.02.2001") == datetime.date(2001, 2, 3)
    assert one(spark, c.safe_date("x", "dd.MM.yyyy"), "2001-02-03") is None


def test_listing_time(spark):
    stamp = c.safe_timestamp("x", "dd-MM-yyyy HH:mm").cast("string")
    assert one(spark, stamp, "10-02-2017 20:22") == "2017-02-10 20:22:00"
    assert one(spark, stamp, "27:00.0") is None
    assert one(spark, stamp, " na ") is None


def test_order_violation_is_never_null(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1), (1, None)], "s int, e int")
    assert [r[0] for r in df.select(c.violates_order("s", "e")).collect()] == [False, True, False, False]


def test_outlier_flag_null_handling(spark):
    assert one(spark, c.outlier_flag("x", 10), None, "int") is None
    assert one(spark, c.outlier_flag("x", 10, null_is=False), None, "int") is False
    assert one(spark, c.outlier_flag("x", 10), 11, "int") is True


def test_percentage(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (1, None), (0, 5)], "a bigint, b bigint")
    assert [r[0] for r in df.select(c.safe_pct("a", "b")).collect()] == [33.33, None, None, 0.0]


def test_buckets(spark):
    aging = c.bucketize("x", [(30, "0-30"), (60, "30-60")], "60+", at_least=False)
    assert [one(spark, aging, v, "int") for v in (30, 31, 60, 61)] == ["0-30", "30-60", "30-60", "60+"]
    level = c.bucketize("x", [(80, "HIGH"), (60, "MEDIUM")], "LOW", at_least=True)
    assert [one(spark, level, v, "int") for v in (80, 79, 60, 59)] == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_first_match_order_and_null(spark):
    label = c.first_match([("a", "x > 5"), ("b", "x > 1")])
    assert [one(spark, label, v, "int") for v in (9, 2, 0, None)] == ["a", "b", None, None]


def test_region_code_case(spark):
    assert one(spark, c.norm_upper(F.col("x")), " west ") == "WEST"

from datetime import date, datetime
from decimal import Decimal
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.measures import exact_sum
from stratamart.functions import (
    NULL_WORDS,
    calendar_columns,
    clean_value,
    date_key,
    record_hash,
    sales_measures,
    scrub,
    scrub_phone,
    title_case,
    upper_case,
)


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize("word", [*NULL_WORDS, " N/A ", "Null", "<NA>", "UNKNOWN"])
def test_null_words_are_null(spark, word):
    assert one(spark, word, scrub) is None


def test_other_text_is_trimmed(spark):
    assert one(spark, "  Nathan ", scrub) == "Nathan"
    assert one(spark, None, scrub) is None


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("N/A", None),
        ("3268542351", "3268542351"),
        ("(547)452-5534x1928", "54745255341928"),
        ("403.491.1718", "4034911718"),
        ("123", None),
        ("1" * 16, None),
        (None, None),
    ],
)
def test_phone(spark, raw, clean):
    assert one(spark, raw, lambda c: scrub_phone(scrub(c))) == clean


@pytest.mark.parametrize(
    "raw, target, clean",
    [
        ("$12.50", "decimal(10,2)", Decimal("12.50")),
        ("1,299.00", "decimal(10,2)", Decimal("1299.00")),
        ("12-3", "decimal(10,2)", None),
        ("1-2", "int", None),
        ("A12B3", "int", 123),
        ("3.7", "int", None),
        ("-4", "int", -4),
        ("9999999999", "int", None),
        ("9999999999", "bigint", 9999999999),
        ("abc", "int", None),
        ("nan", "double", None),
        ("0.5", "double", 0.5),
    ],
)
def test_numbers(spark, raw, target, clean):
    assert one(spark, raw, lambda c: clean_value(c, T.StringType(), target)) == clean


def test_numeric_input_keeps_its_exponent(spark):
    as_rate = lambda c: clean_value(c, T.DoubleType(), "decimal(12,2)")
    assert one(spark, 1.0e7, as_rate, "double") == Decimal("10000000.00")


def test_dates_and_timestamps(spark):
    as_date = lambda c: clean_value(c, T.StringType(), "date", "yyyy-MM-dd")
    assert one(spark, "2024-03-15", as_date) == date(2024, 3, 15)
    assert one(spark, "1998-13-01", as_date) is None
    as_time = lambda c: clean_value(c, T.StringType(), "timestamp")
    assert one(spark, "2024-01-01 10:00:00", as_time) == datetime(2024, 1, 1, 10)
    assert one(spark, "yesterday", as_time) is None


def test_case_rules(spark):
    assert one(spark, " home GOODS ", title_case) == "Home Goods"
    assert one(spark, "mens-wear", title_case) == "Mens-wear"
    assert one(spark, " tx ", upper_case) == "TX"


def test_hash_joins_columns_and_reads_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(record_hash(["x", "y", "z"])).first()[0] == sha256(b"a||||3").hexdigest()


def test_unambiguous_hashes_tell_rows_apart(spark):
    rows = [("a||b", "c"), ("a", "b||c"), ("a||b||c", ""), ("a", None), ("a", ""), (None, "a"), ("", "a"), ("-", ""), ("1:a", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    exact = [r[0] for r in df.select(record_hash(["x", "y"], unambiguous=True)).collect()]
    assert len(set(exact)) == len(rows)
    assert exact[0] == sha256(b"4:a||b1:c").hexdigest() and exact[3] == sha256(b"1:a-").hexdigest()
    plain = [r[0] for r in df.select(record_hash(["x", "y"])).collect()]
    assert plain[0] == plain[1] and plain[3] == plain[4]


def test_calendar_agrees_with_python(spark):
    df = spark.sql("select explode(sequence(date'1999-12-20', date'2005-01-10')) as day")
    for row in df.select("day", *[c.alias(n) for n, c in calendar_columns(F.col("day")).items()]).collect():
        day = row["day"]
        assert row["DateSK"] == int(day.strftime("%Y%m%d"))
        assert row["CalendarDate"] == day.isoformat()
        assert (row["Quarter"], row["MonthName"], row["DayName"]) == ((day.month + 2) // 3, day.strftime("%B"), day.strftime("%A"))
        assert (row["DayOfWeek"], row["WeekOfYear"]) == (day.isoweekday(), day.isocalendar()[1])
        assert row["IsWeekend"] == (day.isoweekday() > 5)
    assert df.select(date_key(F.col("day"))).schema[0].dataType == T.IntegerType()


def test_measures(spark):
    df = spark.sql("select 2 as q, cast(1200.00 as decimal(10,2)) as p, cast(100.10 as decimal(10,2)) as c, 4.0D as r")
    out = df.select(*[v.alias(n) for n, v in sales_measures(F.col("q"), F.col("p"), F.col("c"), F.col("r")).items()])
    assert tuple(out.first()) == (Decimal("2400.00"), 600.0, 50.05, 549.95)
    assert out.schema["LineTotalLocal"].dataType == T.DecimalType(21, 2)
    assert out.schema["LineTotalBaseCurrency"].dataType == T.DoubleType()


def test_sums_are_exact_in_any_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1e9,), (-0.3,), (None,), (4.35,)], "x double")
    assert df.select(exact_sum(F.col("x"))).first()[0] == 1000000004.35
    assert df.filter("x is null").select(exact_sum(F.col("x"))).first()[0] is None

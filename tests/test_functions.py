from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import avg_if, sum_if


def c():
    return F.col("c")


def one_column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r["o"] for r in df.select("i", expression.alias("o")).orderBy("i").collect()]


def test_only_spaces_are_trimmed(spark):
    assert one_column(spark, ["  x ", " ", "", None, "\tx"], fn.blank_to_null(c())) == ["x", None, None, None, "\tx"]


def test_canonical_spelling_and_default(spark):
    tiers = fn.canonicalize(c(), ("Basic", "Pro", "Enterprise"))
    assert one_column(spark, [" PRO", "basic", "gold", None], tiers) == ["Pro", "Basic", None, None]
    priority = fn.canonicalize(c(), ("low", "medium", "high", "urgent"), default="low")
    assert one_column(spark, ["URGENT", "p0", None], priority) == ["urgent", "low", "low"]


def test_bad_dates_become_null(spark):
    texts = ["5/1/2024", "05/01/2024", "31/02/2024", "05/01/2024x", " ", None]
    day = dt.date(2024, 1, 5)
    assert one_column(spark, texts, fn.parse_dmy(c())) == [day, day, None, None, None, None]
    texts = ["2024-1-5", " 2024-01-05", "2024-13-01", "2024-01-05 10:00:00"]
    assert one_column(spark, texts, fn.parse_iso_date(c())) == [day, day, None, None]


def test_datetimes_ignore_the_session_time_zone(spark):
    texts = ["2024-03-10 02:30:00", "2024-3-10 2:30:00", "2024-03-10", "2024-03-10 25:00:00"]
    moment = dt.datetime(2024, 3, 10, 2, 30)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there that day
    try:
        assert one_column(spark, texts, fn.parse_iso_datetime(c())) == [moment, moment, None, None]
        hours = fn.hours_between(F.lit("2024-03-10 00:00:00").cast("timestamp_ntz"), c().cast("timestamp_ntz"))
        assert one_column(spark, ["2024-03-10 04:59:59"], hours) == [4]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_whole_hours_truncate(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    hours = fn.hours_between(start, c().cast("timestamp_ntz"))
    assert one_column(spark, ["2024-01-01 02:59:59", "2024-01-03 00:00:00", None], hours) == [2, 48, None]


def test_unsigned_integers_take_the_default_for_blanks_only(spark):
    texts = ["12", " 7 ", " ", None, "-3", "12.7", "abc", "99999999999"]
    assert one_column(spark, texts, fn.parse_uint(c(), 1)) == [12, 7, 1, 1, None, None, None, None]


def test_decimals(spark):
    texts = ["10.255", "", None, "x", "123456789.00"]
    expected = [Decimal("10.26"), Decimal("0.00"), Decimal("0.00"), None, None]
    assert one_column(spark, texts, fn.parse_decimal(c(), 10, 2, "0")) == expected


def test_decimal_text_rounds_half_up_to_integer(spark):
    texts = ["4.0", "4.5", "2.5", "0.4", "", "x"]
    assert one_column(spark, texts, fn.parse_rounded_uint(c())) == [4, 5, 3, 0, None, None]


def test_flags(spark):
    assert one_column(spark, ["TRUE ", "true", "False", "", "1", None], fn.parse_flag(c())) == [
        True, True, False, False, False, None,
    ]


def test_month_keys(spark):
    days = [dt.date(2024, 2, 29), None]
    assert one_column(spark, days, fn.month_key(c()), "date") == [202402, None]
    assert one_column(spark, days, fn.month_end(c()), "date") == [dt.date(2024, 2, 29), None]
    assert one_column(spark, [202402, 202312, None], fn.key_to_month(c()), "int") == [
        dt.date(2024, 2, 1), dt.date(2023, 12, 1), None,
    ]


@pytest.mark.parametrize("digits", [2, 4])
def test_ratios_match_exact_arithmetic(spark, digits):
    rng = random.Random(digits)
    pairs = [(rng.randint(-5000, 5000), rng.randint(1, 400)) for _ in range(3000)] + [(-1, 8), (1, 8), (23, 40), (7, 0)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    got = df.select("i", fn.round_ratio("a", "b", digits).alias("o")).orderBy("i").collect()
    for (a, b), row in zip(pairs, got):
        if b == 0:
            assert row["o"] is None
            continue
        exact = Fraction(a * 10**digits, b)
        units = int(abs(exact) + Fraction(1, 2)) * (1 if exact >= 0 else -1)
        assert row["o"] == Decimal(units).scaleb(-digits), (a, b)


def test_percentages_of_money(spark):
    rows = [(Decimal("1.25"), Decimal("3.00")), (Decimal("0"), Decimal("0"))]
    df = spark.createDataFrame(rows, "a decimal(22,2), b decimal(22,2)")
    assert [r[0] for r in df.select(fn.pct("a", "b")).collect()] == [Decimal("41.67"), None]
    assert [r[0] for r in df.select(fn.safe_ratio("b", "a")).collect()] == [Decimal("2.4"), None]
    assert Decimal("2.675").quantize(Decimal("0.01"), ROUND_HALF_UP) == Decimal("2.68")


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([(1, 4), (1, None), (0, 10)], "k int, v int")
    row = df.agg(
        sum_if(F.col("k") == 1, F.col("v")).alias("s"),
        sum_if(F.col("k") == 2, F.col("v")).alias("none"),
        avg_if(F.col("k") == 1, F.col("v")).alias("a"),
        avg_if(F.col("k") == 2, F.col("v")).alias("no_rows"),
    ).first()
    assert (row["s"], row["none"], row["a"], row["no_rows"]) == (4, 0, 4.0, None)

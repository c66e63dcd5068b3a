import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.functions import (
    exact_sum,
    fiscal_month,
    fiscal_year,
    percent,
    period_start,
    ratio,
    round_to,
    zero_as,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "value, places, expected",
    [
        (0.145, 2, 0.15),
        (0.14499999999999996, 2, 0.15),
        (1.005, 2, 1.01),
        (-2.5, 0, -3.0),
        (2.4, 0, 2.0),
        (123456.125, 2, 123456.13),
        (1e15 + 0.25, 1, 1e15 + 0.3),
        (None, 2, None),
    ],
)
def test_rounding_is_half_up_and_ignores_float_noise(spark, value, places, expected):
    assert one(spark, round_to(F.lit(value).cast("double"), places)) == expected


def test_division_by_zero_is_unknown(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(1), F.lit(0))) is None
    assert one(spark, percent(F.lit(1), F.lit(8))) == 12.5


def test_zero_replacement(spark):
    assert one(spark, zero_as(F.lit(0), 1)) == 1
    assert one(spark, zero_as(F.lit(0), None)) is None
    assert one(spark, zero_as(F.lit(5), 1)) == 5


def test_money_sum_does_not_depend_on_order(spark):
    values = [(0.1,)] * 1000 + [(1e9,), (-1e9,), (0.0001,)]
    forward = spark.createDataFrame(values, "v double").agg(exact_sum("v")).first()[0]
    backward = spark.createDataFrame(values[::-1], "v double").repartition(7)
    assert forward == backward.agg(exact_sum("v")).first()[0] == 100.0001


def test_money_sum_does_not_overflow_a_long(spark):
    big = spark.range(20_000).select(F.lit(9.0e13).alias("v"))
    assert big.agg(exact_sum("v")).first()[0] == 1.8e18


@pytest.mark.parametrize(
    "day, year, month",
    [("2024-04-01", 2024, 1), ("2024-03-31", 2023, 12), ("2024-12-31", 2024, 9), ("2024-01-31", 2023, 10)],
)
def test_fiscal_calendar_starts_in_april(spark, day, year, month):
    d = F.lit(day).cast("date")
    assert (one(spark, fiscal_year(d)), one(spark, fiscal_month(d))) == (year, month)


def test_weeks_start_on_monday(spark):
    d = F.lit("2024-05-12").cast("date")
    assert one(spark, period_start("week", d)) == dt.date(2024, 5, 6)


def test_fine_grained_sums_need_more_places(spark):
    small = spark.range(1000).select(F.lit(0.00004).alias("v"))
    assert small.agg(exact_sum("v", places=8, digits=28)).first()[0] == 0.04
    large = spark.range(3).select(F.lit(2e14).alias("v"))
    assert large.agg(exact_sum("v", digits=28)).first()[0] == 6e14


def test_rounding_has_one_rule_for_all_sizes(spark):
    for value in (4.4e9, 4.6e9, 1e15):
        assert one(spark, round_to(F.lit(value + 0.125), 2)) == round(value + 0.13, 2)
    assert one(spark, round_to(F.lit(1e300), 2)) == 1e300

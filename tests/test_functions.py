"""Column functions on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationlake import Frequency, RequiredData
from stationlake.functions import periods
from stationlake.functions.conditions import CONDITIONS, condition_name
from stationlake.functions.geo import distance_km
from stationlake.functions.inventory import covers
from stationlake.operators.located import time_key

D, T = dt.date, dt.datetime


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "text, start, end",
    [
        ("2023-07-15T12:00:00+02:00", T(2023, 7, 15, 10), T(2023, 7, 15, 10)),
        ("2023-07-15T12:00:00+0200", T(2023, 7, 15, 10), T(2023, 7, 15, 10)),
        ("2023-11-05T06:30:00Z", T(2023, 11, 5, 6, 30), T(2023, 11, 5, 6, 30)),
        ("2023-11-05 05:30:00 UTC", T(2023, 11, 5, 5, 30), T(2023, 11, 5, 5, 30)),
        ("2023-03-12 02:30:00", T(2023, 3, 12, 2, 30), T(2023, 3, 12, 2, 30)),
        ("2023-07-15T12:00:00", None, None),
        ("2023-07-15", T(2023, 7, 15), T(2023, 7, 15, 23, 59, 59, 999_999)),
        ("2024-02", T(2024, 2, 1), T(2024, 2, 29, 23, 59, 59, 999_999)),
        ("2023", T(2023, 1, 1), T(2023, 12, 31, 23, 59, 59, 999_999)),
        ("2023-13", None, None),
        ("2023-7-5", None, None),
        ("2023-07-15 25:00:00", None, None),
        ("soon", None, None),
        (None, None, None),
    ],
)
def test_datetime_bounds(spark, zone, text, start, end):
    df = spark.createDataFrame([(text,)], "period string")
    row = periods.resolve_datetime_periods(df).first()
    assert (row.start_at, row.end_at) == (start, end)
    assert row.status == ("ok" if start else "bad_period")


def test_kinds_restrict_what_is_accepted(spark):
    df = spark.createDataFrame([("2023",), ("2023-05",), ("2023-05-06",)], "period string")

    def accepted(kinds):
        rows = periods.resolve_date_periods(df, kinds=kinds).collect()
        return [row.status == "ok" for row in rows]

    assert accepted(periods.DATE_RANGE) == [True, True, True]
    assert accepted(periods.DATE_PERIOD) == [True, True, False]
    months = periods.resolve_month_periods(df, kinds=periods.MONTH_PERIOD).collect()
    assert [row.status for row in months] == ["ok", "bad_period", "bad_period"]


def test_month_bounds_are_not_checked(spark):
    df = spark.createDataFrame([("2023-13",)], "period string")
    row = periods.resolve_month_periods(df).first()
    assert (row.start_year, row.start_month, row.end_year, row.end_month) == (2023, 13, 2023, 13)


def test_nearest_hour(spark, zone):
    at = [
        ("2023-01-01 14:29:59.999999", T(2023, 1, 1, 14)),
        ("2023-01-01 14:30:00", T(2023, 1, 1, 15)),
        ("2023-12-31 23:30:00", T(2024, 1, 1)),
        ("2023-03-12 01:45:00", T(2023, 3, 12, 2)),  # does not exist in New York
        ("2023-11-05 01:10:00", T(2023, 11, 5, 1)),  # exists twice there
    ]
    df = spark.createDataFrame(at, "at string, hour timestamp_ntz")
    column = time_key(Frequency.HOURLY, F.col("at").cast("timestamp_ntz"))["datetime"]
    for row in df.select(column.alias("found"), "hour").collect():
        assert row.found == row.hour


@pytest.mark.parametrize(
    "a, b, km",
    [
        ((0, 179.95), (0, 179.9), 5.560),
        ((0, 179.95), (0, -179.9), 16.679),
        ((90, 0), (89.9, 180), 11.119),
        ((10, 20), (10, 20), 0.0),
        ((0, 0), (0, 180), 20015.087),
    ],
)
def test_distance(spark, a, b, km):
    column = distance_km(*(F.lit(float(x)) for x in (*a, *b)))
    assert one(spark, column) == pytest.approx(km, abs=1e-3)


DATES = (D(2010, 6, 15), D(2019, 2, 1))


@pytest.mark.parametrize(
    "frequency, required, span, expected",
    [
        (Frequency.DAILY, RequiredData.any(), DATES, True),
        (Frequency.DAILY, RequiredData.any(), (DATES[0], None), False),
        (Frequency.HOURLY, RequiredData.any(), (None, DATES[1]), False),
        (Frequency.DAILY, RequiredData.specific_date(DATES[0]), DATES, True),
        (Frequency.DAILY, RequiredData.specific_date(DATES[1]), DATES, True),
        (Frequency.DAILY, RequiredData.specific_date(D(2019, 2, 2)), DATES, False),
        (Frequency.DAILY, RequiredData.date_range(*DATES), DATES, True),
        (Frequency.DAILY, RequiredData.date_range(DATES[0], D(2019, 2, 2)), DATES, False),
        # A range that ends before it starts follows the two comparisons as they are.
        (Frequency.DAILY, RequiredData.date_range(D(2018, 1, 1), D(2012, 1, 1)), DATES, True),
        (Frequency.DAILY, RequiredData.full_year(2011), DATES, True),
        (Frequency.DAILY, RequiredData.full_year(2010), DATES, False),
        (Frequency.DAILY, RequiredData.full_year(2019), DATES, False),
        (Frequency.DAILY, RequiredData.full_year(2015), (D(2015, 1, 1), D(2015, 12, 31)), True),
        (Frequency.DAILY, RequiredData.full_year(2015), (D(2015, 1, 2), D(2015, 12, 31)), False),
        (Frequency.DAILY, RequiredData.full_year(2015), (D(2015, 1, 1), D(2015, 12, 30)), False),
        (Frequency.DAILY, RequiredData.full_year(300_000), DATES, False),
        (Frequency.MONTHLY, RequiredData.date_range(*DATES), (2010, 2019), True),
        (Frequency.MONTHLY, RequiredData.specific_date(D(2019, 12, 31)), (2010, 2019), True),
        (Frequency.MONTHLY, RequiredData.specific_date(D(2020, 1, 1)), (2010, 2019), False),
        (Frequency.CLIMATE, RequiredData.full_year(2010), (2010, 2019), True),
        (Frequency.CLIMATE, RequiredData.full_year(2009), (2010, 2019), False),
        (Frequency.CLIMATE, RequiredData.any(), (2010, None), False),
    ],
)
def test_inventory(spark, frequency, required, span, expected):
    kind = "int" if frequency in (Frequency.MONTHLY, Frequency.CLIMATE) else "date"
    df = spark.createDataFrame([span], f"a {kind}, b {kind}")
    found = df.filter(covers(frequency, required, F.col("a"), F.col("b")))
    assert (found.count() == 1) is expected


def test_conditions(spark):
    codes = [(c,) for c in (0, 1, 4, 27, 28, None)]
    df = spark.createDataFrame(codes, "coco bigint").select(condition_name(F.col("coco")))
    assert [row[0] for row in df.collect()] == [None, "Clear", "Overcast", "Storm", None, None]
    assert len(CONDITIONS) == 27

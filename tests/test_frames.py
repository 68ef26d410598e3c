"""Frames and records on hand-made rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stationlake import (
    ClimateFrame,
    DailyFrame,
    DateParsingError,
    ExpectedSingleRow,
    Frequency,
    HourlyFrame,
    Month,
    MonthlyFrame,
    Year,
    schemas,
    single_records,
)
from stationlake.operators import located
from stationlake.operators.records import json_records

D, T = dt.date, dt.datetime


def frame(spark, kind, rows):
    """A frame from dicts; columns that a row leaves out are null."""
    return kind(spark.createDataFrame(rows, schemas.ddl(schemas.table_columns(kind.frequency))))


@pytest.fixture(scope="module")
def hourly(spark):
    start = T(2023, 12, 30)
    rows = [{"station": "a", "datetime": start + dt.timedelta(hours=h)} for h in range(96)]
    return frame(spark, HourlyFrame, rows)


@pytest.fixture(scope="module")
def daily(spark):
    start = D(2019, 1, 1)
    rows = [{"station": "a", "date": start + dt.timedelta(days=d)} for d in range(800)]
    return frame(spark, DailyFrame, rows)


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [{"station": "a", "year": y, "month": m} for y in (2019, 2020) for m in range(1, 13)]
    return frame(spark, MonthlyFrame, rows)


@pytest.fixture(scope="module")
def climate(spark):
    rows = [
        {"station": "a", "start_year": s, "end_year": s + 29, "month": m}
        for s in (1961, 1991)
        for m in range(1, 13)
    ]
    return frame(spark, ClimateFrame, rows)


def bounds(frame, column):
    return tuple(frame.df.agg(F.min(column), F.max(column), F.count("*")).first())


def test_hourly(hourly):
    assert bounds(hourly.get_for_period(D(2023, 12, 31)), "datetime") == (
        T(2023, 12, 31),
        T(2023, 12, 31, 23),
        24,
    )
    assert hourly.get_for_period(Month(year=2023, month=12)).df.count() == 48
    assert hourly.get_for_period(Year(2024)).df.count() == 48
    assert hourly.get_range("2023-12-30", "2023-12-31").df.count() == 48
    assert hourly.get_range(T(2023, 12, 31, 1), T(2023, 12, 31, 3)).df.count() == 3
    assert hourly.get_range(Year(2024), Year(2023)).df.count() == 0
    at = hourly.get_at(T(2023, 12, 31, 23, 30)).df.collect()
    assert [row.datetime for row in at] == [T(2024, 1, 1)]
    assert hourly.get_at(Year(2024)).df.first().datetime == T(2024, 1, 1)
    assert hourly.get_at("2023-12-31T02:10:00+02:00").df.first().datetime == T(2023, 12, 31)
    with pytest.raises(DateParsingError):
        hourly.get_at("2023-1x")


def test_hourly_in_another_zone(spark, hourly):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert hourly.get_for_period(D(2023, 12, 31)).df.count() == 24
        assert hourly.get_at(T(2023, 12, 31, 5)).df.first().datetime == T(2023, 12, 31, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_daily(daily):
    assert bounds(daily.get_for_period(Year(2020)), "date") == (D(2020, 1, 1), D(2020, 12, 31), 366)
    assert bounds(daily.get_for_period(Month(year=2020, month=2)), "date")[1:] == (
        D(2020, 2, 29),
        29,
    )
    assert daily.get_range("2019-12-30", D(2020, 1, 2)).df.count() == 4
    assert daily.get_range(D(2020, 1, 2), D(2019, 12, 30)).df.count() == 0
    assert daily.get_at(Year(2020)).df.first().date == D(2020, 1, 1)
    assert daily.get_at(Month(year=2020, month=3)).df.first().date == D(2020, 3, 1)
    with pytest.raises(TypeError):
        daily.get_for_period("2020-01-01")


def test_monthly(monthly):
    over_year = monthly.get_range(Month(year=2019, month=11), Month(year=2020, month=2))
    found = [(row.year, row.month) for row in over_year.df.orderBy("year", "month").collect()]
    assert found == [(2019, 11), (2019, 12), (2020, 1), (2020, 2)]
    assert monthly.get_range(Year(2019), Year(2020)).df.count() == 24
    assert monthly.get_for_period(Year(2020)).df.count() == 12
    assert monthly.get_at(Year(2020)).df.first().month == 1
    assert monthly.get_at(Month(year=2023, month=13)).df.count() == 0


def test_climate(climate):
    assert climate.get_at(Year(1991), Year(2020), 11).df.count() == 1
    assert climate.get_at(Year(1991), Year(2020), 13).df.count() == 0


def test_frames_chain_and_do_not_change(daily):
    year = daily.get_for_period(Year(2020))
    assert year.filter("date > date '2020-12-30'").filter(F.col("station") == "a").df.count() == 1
    assert year.limit(5).df.count() == 5
    assert year.df.count() == 366 and type(year) is DailyFrame


def test_hourly_records(spark):
    rows = [
        {"station": "a", "datetime": T(2023, 9, 1), "temp": 12.7, "rhum": 96, "coco": 4},
        {"station": "a", "datetime": T(2023, 9, 1, 1), "tsun": 3_000_000_000, "coco": 28},
        {"station": "a", "date": "bad", "datetime": None, "temp": 1.0},
    ]
    frame_ = frame(spark, HourlyFrame, rows)
    assert frame_.df.filter("tsun > 2147483647").count() == 1
    first, second = frame_.records().orderBy("datetime").collect()
    assert frame_.records().columns == [
        "station", "datetime", "temperature", "dew_point", "relative_humidity", "precipitation",
        "snow", "wind_direction", "wind_speed", "peak_wind_gust", "pressure", "sunshine_minutes",
        "condition",
    ]
    assert (first.temperature, first.relative_humidity, first.condition) == (12.7, 96, "Overcast")
    assert (second.sunshine_minutes, second.condition) == (None, None)
    kinds = dict(frame_.records().dtypes)
    assert kinds["sunshine_minutes"] == kinds["snow"] == "int"


def test_daily_record_as_json(spark):
    row = {
        "station": "10384", "date": D(2023, 10, 26), "tavg": 9.7, "tmin": 9.2, "tmax": 10.5,
        "wdir": 53, "wspd": 10.1, "wpgt": 29.6, "pres": 994.9,
    }
    found = frame(spark, DailyFrame, [row]).json_records().first()
    assert json.loads(found.record) == {
        "date": "2023-10-26",
        "average_temperature": 9.7,
        "minimum_temperature": 9.2,
        "maximum_temperature": 10.5,
        "precipitation": None,
        "snow": None,
        "wind_direction": 53,
        "wind_speed": 10.1,
        "peak_wind_gust": 29.6,
        "pressure": 994.9,
        "sunshine_minutes": None,
    }


def test_monthly_and_climate_records_skip_odd_times(spark):
    months = [{"year": 2020, "month": m} for m in (0, 1, 12, 13, None)]
    months += [{"year": 3_000_000_000, "month": 5}, {"year": None, "month": 5}]
    found = frame(spark, MonthlyFrame, months).records().orderBy("month").collect()
    assert [(row.year, row.month) for row in found] == [(2020, 1), (2020, 12)]
    normals = [{"start_year": 1991, "end_year": 2020, "month": m} for m in (0, 1, 13)]
    normals += [{"start_year": None, "end_year": 2020, "month": 1}]
    assert frame(spark, ClimateFrame, normals).records().count() == 1


def test_single_record(spark, daily):
    assert daily.get_at(D(2020, 5, 1)).single_record().date == D(2020, 5, 1)
    for narrow, actual in ((daily.get_for_period(Year(2020)), 366), (daily.filter("false"), 0)):
        with pytest.raises(ExpectedSingleRow) as error:
            narrow.single_record()
        assert error.value.actual == actual
    undated = frame(spark, DailyFrame, [{"station": "a", "tavg": 1.0}])
    with pytest.raises(ExpectedSingleRow) as error:
        undated.single_record()
    assert error.value.actual == 0


def test_single_records_of_a_table(spark):
    columns = schemas.ddl({"request_id": "bigint"} | schemas.table_columns(Frequency.DAILY))
    day = D(2020, 1, 1)
    rows = [{"request_id": 1, "station": "a", "date": day, "tavg": 3.5}]
    rows += [{"request_id": 2, "station": "a", "date": day}] * 3
    rows += [{"request_id": 3, "station": "a", "date": None}]
    accepted, rejected = single_records(
        spark.createDataFrame(rows, columns),
        spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "request_id bigint"),
        Frequency.DAILY,
    )
    (row,) = accepted.collect()
    assert (row.request_id, row.station, row.average_temperature) == (1, "a", 3.5)
    assert {row.request_id: row.actual for row in rejected.collect()} == {2: 3, 3: 0, 4: 0}


def test_json_of_values_that_json_lacks(spark):
    rows = spark.sql(
        "SELECT 'a' AS station, timestamp_ntz'2024-03-31 02:30:00' AS datetime, double('NaN') AS temp, "
        "double('Infinity') AS dwpt, double('-Infinity') AS prcp, 1.5D AS wspd, null AS wpgt, 1013.0D AS pres, "
        "5L AS rhum, null AS snow, null AS wdir, null AS tsun, 7L AS coco"
    )
    record = json.loads(json_records(rows, Frequency.HOURLY).first().record)
    assert record["datetime"] == "2024-03-31T02:30:00Z"
    assert [record[k] for k in ("temperature", "dew_point", "precipitation", "wind_speed")] == [None, None, None, 1.5]


def test_years_beyond_int_do_not_fail_a_period_join(spark):
    weather = spark.createDataFrame(
        [("a", 3_000_000_000, 1, 1.0), ("a", 2020, 5, 2.0)], "station string, year long, month long, tavg double"
    )
    wanted = spark.createDataFrame([(1, "a")], "request_id long, station string")
    bound = {"year": F.lit(2020).cast("bigint"), "month": F.lit(5).cast("bigint")}
    found = located.weather_between(wanted, weather, Frequency.MONTHLY, bound, bound).collect()
    assert [(r.year, r.tavg) for r in found] == [(2020, 2.0)]

"""Filters of weather frames with literal arguments, and records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.operators.frames import (
    ClimateFrame,
    DailyFrame,
    HourlyFrame,
    MonthlyFrame,
    WeatherFrame,
)
from stationlake.operators.records import FIELDS
from stationlake.plans.fixtures import view
from stationlake.plans.registry import register
from stationlake.plans.store_queries import ONE_STATION, VIEW_OF, columns_of
from stationlake.functions.conditions import CONDITIONS
from stationlake.values import Frequency, Month, Year


def _frame(kind: type[WeatherFrame], spark: SparkSession, sf_dir: str):
    names = schemas.table_columns(kind.frequency)
    return kind(view(spark, sf_dir, VIEW_OF[kind.frequency]).select(*names))


def _register_filter(
    name: str, kind: type[WeatherFrame], narrow: Callable, where: str
) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return narrow(_frame(kind, spark, sf_dir)).df

    table = VIEW_OF[kind.frequency]
    register(
        name, query, f"SELECT {columns_of(kind.frequency)} FROM {table} WHERE {where}", (table,)
    )


_register_filter(
    "hourly_filter",
    HourlyFrame,
    lambda frame: frame.filter((F.col("temp") > 5) & F.col("prcp").isNotNull()),
    "temp > 5 AND prcp IS NOT NULL",
)
_register_filter(
    "daily_filter",
    DailyFrame,
    lambda frame: frame.filter("tmax > 20 OR snow >= 10"),
    "tmax > 20 OR snow >= 10",
)
_register_filter(
    "monthly_filter", MonthlyFrame, lambda frame: frame.filter("tsun > 5000"), "tsun > 5000"
)
_register_filter(
    "climate_filter",
    ClimateFrame,
    lambda frame: frame.filter(F.col("tmin") < 0).filter("prcp IS NULL"),
    "tmin < 0 AND prcp IS NULL",
)

_register_filter(
    "hourly_range",
    HourlyFrame,
    lambda frame: frame.get_range(dt.datetime(2024, 1, 10, 6, 30), "2024-01-12"),
    "datetime >= TIMESTAMP '2024-01-10 06:30:00' AND datetime < TIMESTAMP '2024-01-13 00:00:00'",
)
_register_filter(
    "hourly_range_zoned",
    HourlyFrame,
    lambda frame: frame.get_range("2024-01-10T06:00:00+02:00", "2024-01-10T20:00:00Z"),
    "datetime BETWEEN TIMESTAMP '2024-01-10 04:00:00' AND TIMESTAMP '2024-01-10 20:00:00'",
)
_register_filter(
    "daily_range",
    DailyFrame,
    lambda frame: frame.get_range("1996-03-15", Month(year=1997, month=2)),
    "date BETWEEN DATE '1996-03-15' AND DATE '1997-02-28'",
)
_register_filter(
    "daily_range_inverted",
    DailyFrame,
    lambda frame: frame.get_range(Year(1998), Year(1997)),
    "date >= DATE '1998-01-01' AND date <= DATE '1997-12-31'",
)
_register_filter(
    "monthly_range",
    MonthlyFrame,
    lambda frame: frame.get_range(Month(year=1995, month=11), Month(year=1996, month=2)),
    "year * 12 + month BETWEEN 1995 * 12 + 11 AND 1996 * 12 + 2",
)

_register_filter(
    "hourly_at",
    HourlyFrame,
    lambda frame: frame.get_at(dt.datetime(2024, 1, 15, 11, 30)),
    "datetime = TIMESTAMP '2024-01-15 12:00:00'",
)
_register_filter(
    "daily_at",
    DailyFrame,
    lambda frame: frame.get_at(dt.date(1997, 6, 15)),
    "date = DATE '1997-06-15'",
)
_register_filter(
    "monthly_at",
    MonthlyFrame,
    lambda frame: frame.get_at(Month(year=1996, month=7)),
    "year = 1996 AND month = 7",
)
_register_filter(
    "climate_at",
    ClimateFrame,
    lambda frame: frame.get_at(Year(1991), Year(2020), 11),
    "start_year = 1991 AND end_year = 2020 AND month = 11",
)

_register_filter(
    "hourly_period_day",
    HourlyFrame,
    lambda frame: frame.get_for_period(dt.date(2024, 1, 15)),
    "CAST(datetime AS date) = DATE '2024-01-15'",
)
# The hourly view covers January 2024 only: another month and another year have to give nothing.
_register_filter(
    "hourly_period_other_month",
    HourlyFrame,
    lambda frame: frame.get_for_period(Month(year=2024, month=2)),
    "datetime >= TIMESTAMP '2024-02-01 00:00:00' AND datetime < TIMESTAMP '2024-03-01 00:00:00'",
)
_register_filter(
    "hourly_period_other_year",
    HourlyFrame,
    lambda frame: frame.get_for_period(Year(2023)),
    "extract(year FROM datetime) = 2023",
)
_register_filter(
    "hourly_period_month",
    HourlyFrame,
    lambda frame: frame.get_for_period(Month(year=2024, month=1)),
    "datetime >= TIMESTAMP '2024-01-01 00:00:00' AND datetime < TIMESTAMP '2024-02-01 00:00:00'",
)
_register_filter(
    "hourly_period_year",
    HourlyFrame,
    lambda frame: frame.get_for_period(Year(2024)),
    "extract(year FROM datetime) = 2024",
)
_register_filter(
    "daily_period_year",
    DailyFrame,
    lambda frame: frame.get_for_period(Year(1996)),
    "extract(year FROM date) = 1996",
)
_register_filter(
    "daily_period_month",
    DailyFrame,
    lambda frame: frame.get_for_period(Month(year=1996, month=2)),
    "date BETWEEN DATE '1996-02-01' AND DATE '1996-02-29'",
)
_register_filter(
    "monthly_period_year",
    MonthlyFrame,
    lambda frame: frame.get_for_period(Year(1997)),
    "year = 1997",
)
_register_filter(
    "daily_period_then_filter",
    DailyFrame,
    lambda frame: frame.get_for_period(Year(1996)).filter(F.col("tmin") < -15),
    "extract(year FROM date) = 1996 AND tmin < -15",
)
_register_filter(
    "daily_station",
    DailyFrame,
    lambda frame: frame.station(ONE_STATION),
    f"station = '{ONE_STATION}'",
)


def daily_station_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = view(spark, sf_dir, "stations").filter("elevation >= 100")
    return _frame(DailyFrame, spark, sf_dir).stations(high).df


def daily_chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(DailyFrame, spark, sf_dir).get_for_period(Year(1996)).chart_series()


register(
    "daily_station_set",
    daily_station_set,
    f"""
    SELECT {columns_of(Frequency.DAILY)} FROM daily
    WHERE station IN (SELECT station FROM stations WHERE elevation >= 100)
    """,
    ("daily", "stations"),
)
register(
    "daily_chart_series",
    daily_chart_series,
    "SELECT station, date, tavg, tmin, tmax FROM daily WHERE extract(year FROM date) = 1996",
    ("daily",),
)


# -- records

CONDITION_SQL = "CASE coco " + " ".join(
    f"WHEN {code} THEN '{name}'" for code, name in enumerate(CONDITIONS, 1)
) + " END"
VALID_SQL = {
    Frequency.HOURLY: "datetime IS NOT NULL",
    Frequency.DAILY: "date IS NOT NULL",
    Frequency.MONTHLY: "month BETWEEN 1 AND 12",
    Frequency.CLIMATE: "month BETWEEN 1 AND 12",
}


def record_columns_sql(frequency: Frequency) -> str:
    columns = [
        f"{f'TRY_CAST({source} AS integer)' if narrow else source} AS {field}"
        for field, source, narrow in FIELDS[frequency]
    ]
    if frequency is Frequency.HOURLY:
        columns.append(f"{CONDITION_SQL} AS condition")
    return ", ".join(columns)


def _records(kind: type[WeatherFrame]):
    return lambda spark, sf_dir: _frame(kind, spark, sf_dir).records()


for _kind in (HourlyFrame, DailyFrame, MonthlyFrame, ClimateFrame):
    _view = VIEW_OF[_kind.frequency]
    register(
        f"{_view}_records",
        _records(_kind),
        f"SELECT station, {record_columns_sql(_kind.frequency)} FROM {_view} "
        f"WHERE {VALID_SQL[_kind.frequency]}",
        (_view,),
    )


def weather_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _frame(HourlyFrame, spark, sf_dir).with_condition()
    return rows.select("station", "datetime", "coco", "condition")


register(
    "weather_condition",
    weather_condition,
    f"SELECT station, datetime, coco, {CONDITION_SQL} AS condition FROM hourly",
    ("hourly",),
)


def daily_records_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text forms of doubles differ between engines, so there is no SQL for this one."""
    return _frame(DailyFrame, spark, sf_dir).json_records()


register("daily_records_json", daily_records_json)


# -- records as JSON, read back

#: Written out by hand: keys in order, and each value as it has to come back.
JSON_SQL = {
    "hourly": """
SELECT station,
  'datetime,temperature,dew_point,relative_humidity,precipitation,snow,wind_direction,wind_speed,'
  || 'peak_wind_gust,pressure,sunshine_minutes,condition' AS keys,
  strftime(datetime, '%Y-%m-%dT%H:%M:%SZ') AS time,
  CASE WHEN isfinite(temp) THEN temp END AS temperature,
  CASE WHEN isfinite(pres) THEN pres END AS pressure, TRY_CAST(rhum AS integer) AS whole
FROM hourly WHERE datetime IS NOT NULL
""",
    "daily": """
SELECT station,
  'date,average_temperature,minimum_temperature,maximum_temperature,precipitation,snow,wind_direction,'
  || 'wind_speed,peak_wind_gust,pressure,sunshine_minutes' AS keys,
  strftime(date, '%Y-%m-%d') AS time,
  CASE WHEN isfinite(tavg) THEN tavg END AS temperature,
  CASE WHEN isfinite(pres) THEN pres END AS pressure, TRY_CAST(snow AS integer) AS whole
FROM daily WHERE date IS NOT NULL
""",
    "monthly": """
SELECT station,
  'year,month,average_temperature,minimum_temperature,maximum_temperature,precipitation,wind_speed,'
  || 'pressure,sunshine_minutes' AS keys,
  CAST(year AS varchar) AS time,
  CASE WHEN isfinite(tavg) THEN tavg END AS temperature,
  CASE WHEN isfinite(pres) THEN pres END AS pressure, TRY_CAST(month AS integer) AS whole
FROM monthly WHERE month BETWEEN 1 AND 12
""",
    "climate": """
SELECT station,
  'start_year,end_year,month,minimum_temperature,maximum_temperature,precipitation,wind_speed,pressure,'
  || 'sunshine_minutes' AS keys,
  CAST(start_year AS varchar) AS time,
  CASE WHEN isfinite(tmin) THEN tmin END AS temperature,
  CASE WHEN isfinite(pres) THEN pres END AS pressure, TRY_CAST(month AS integer) AS whole
FROM climate WHERE month BETWEEN 1 AND 12
""",
}
#: Names of the fields that are read back as time, temperature and a whole number.
JSON_FIELDS = {
    HourlyFrame: ("datetime", "temperature", "relative_humidity"),
    DailyFrame: ("date", "average_temperature", "snow"),
    MonthlyFrame: ("year", "average_temperature", "month"),
    ClimateFrame: ("start_year", "minimum_temperature", "month"),
}


def _json_read_back(kind: type[WeatherFrame]):
    time, temperature, whole = JSON_FIELDS[kind]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = F.col("record")
        return _frame(kind, spark, sf_dir).json_records().select(
            "station",
            F.concat_ws(",", F.json_object_keys(text)).alias("keys"),
            F.get_json_object(text, f"$.{time}").alias("time"),
            F.get_json_object(text, f"$.{temperature}").cast("double").alias("temperature"),
            F.get_json_object(text, "$.pressure").cast("double").alias("pressure"),
            F.get_json_object(text, f"$.{whole}").cast("int").alias("whole"),
        )

    return query


for _kind in JSON_FIELDS:
    _view = VIEW_OF[_kind.frequency]
    register(f"{_view}_records_json_read_back", _json_read_back(_kind), JSON_SQL[_view], (_view,))

"""Requests joined to weather rows: both join strategies against plain Python."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationlake import Frequency, schemas, weather_at, weather_between, weather_of
from stationlake.operators import joins
from stationlake.operators.located import time_key

D, T = dt.date, dt.datetime
STRATEGIES = pytest.mark.parametrize(
    "sizes",
    [
        {"broadcast_rows": 1_000_000},
        {"broadcast_rows": 1_000_000, "fan_out": 0},
        {"broadcast_rows": 0},
    ],
    ids=["broadcast", "asked_once", "salted"],
)


@pytest.fixture(scope="module")
def daily(spark):
    rows = [
        {"station": station, "date": D(2019, 11, 1) + dt.timedelta(days=i), "tavg": float(i)}
        for station in ("a", "b", "c")
        for i in range(120)
    ]
    return spark.createDataFrame(rows, schemas.ddl(schemas.table_columns(Frequency.DAILY)))


def keys(df, *columns):
    return sorted(tuple(row) for row in df.select("request_id", "station", *columns).collect())


def crowd():
    """Most requests ask for the same station and day; some for nothing that exists."""
    rows = [(i, "a", D(2019, 12, 24)) for i in range(300)]
    rows += [(300 + i, "abcx"[i % 4], D(2019, 10, 25) + dt.timedelta(days=i)) for i in range(140)]
    return rows + [(900, None, D(2019, 12, 24)), (901, "a", None)]


@STRATEGIES
def test_at(spark, daily, sizes):
    rows = crowd()
    requests = spark.createDataFrame(rows, "request_id int, station string, day date")
    found = weather_at(
        requests, daily, Frequency.DAILY, time_key(Frequency.DAILY, F.col("day")), len(rows),
        **sizes,
    )
    first, last = D(2019, 11, 1), D(2020, 2, 28)
    expected = sorted(
        (i, s, day) for i, s, day in rows if s in ("a", "b", "c") and day and first <= day <= last
    )
    assert keys(found, "date") == expected


@STRATEGIES
def test_between(spark, daily, sizes):
    rows = [(i, "a", D(2019, 12, 30), D(2020, 1, 2)) for i in range(200)]
    rows += [
        (201, "b", D(2019, 1, 1), D(2021, 12, 31)),
        (202, "c", D(2020, 1, 5), D(2020, 1, 5)),
        (203, "c", D(2020, 1, 5), D(2020, 1, 4)),
        (204, "c", None, D(2020, 1, 4)),
        (205, "x", D(2020, 1, 1), D(2020, 1, 4)),
        (206, None, D(2020, 1, 1), D(2020, 1, 4)),
    ]
    requests = spark.createDataFrame(rows, "request_id int, station string, s date, e date")
    found = weather_between(
        requests, daily, Frequency.DAILY, {"date": F.col("s")}, {"date": F.col("e")},
        **sizes,
    )
    counts = {row[0]: row[1] for row in found.groupBy("request_id").count().collect()}
    assert counts == dict.fromkeys(range(200), 4) | {201: 120, 202: 1}


@STRATEGIES
def test_months_between(spark, sizes):
    months = [
        {"station": "a", "year": y, "month": m} for y in (2019, 2020, 2021) for m in range(1, 13)
    ]
    monthly = spark.createDataFrame(months, schemas.ddl(schemas.table_columns(Frequency.MONTHLY)))
    rows = [(1, "a", 2019, 11, 2020, 2), (2, "a", 2020, 1, 2020, 12), (3, "a", 2021, 13, 2021, 13),
            (4, "a", 2019, 6, 2021, 6), (5, "a", 2020, 5, 2020, 4)]
    requests = spark.createDataFrame(
        rows, "request_id int, station string, sy bigint, sm bigint, ey bigint, em bigint"
    )
    found = weather_between(
        requests,
        monthly,
        Frequency.MONTHLY,
        {"year": F.col("sy"), "month": F.col("sm")},
        {"year": F.col("ey"), "month": F.col("em")},
        **sizes,
    )
    counts = {row[0]: row[1] for row in found.groupBy("request_id").count().collect()}
    assert counts == {1: 4, 2: 12, 4: 25}


@STRATEGIES
def test_hours_between(spark, sizes):
    hours = [
        {"station": "a", "datetime": T(2019, 12, 30) + dt.timedelta(hours=i)} for i in range(96)
    ]
    hourly = spark.createDataFrame(hours, schemas.ddl(schemas.table_columns(Frequency.HOURLY)))
    requests = spark.createDataFrame(
        [(1, "a", T(2019, 12, 31, 22), T(2020, 1, 1, 1, 59, 59, 999_999))],
        "request_id int, station string, s timestamp_ntz, e timestamp_ntz",
    )
    found = weather_between(
        requests, hourly, Frequency.HOURLY, {"datetime": F.col("s")}, {"datetime": F.col("e")},
        **sizes,
    )
    assert [row[2].hour for row in keys(found, "datetime")] == [22, 23, 0, 1]


@STRATEGIES
def test_all_rows_of_a_station(spark, daily, sizes):
    requests = spark.createDataFrame(
        [(i, "a") for i in range(50)] + [(50, "b"), (51, "x"), (52, None)],
        "request_id int, station string",
    )
    found = weather_of(requests, daily, 53, **sizes)
    counts = {row[0]: row[1] for row in found.groupBy("request_id").count().collect()}
    assert counts == dict.fromkeys(range(51), 120)


@STRATEGIES
def test_repeated_rows_of_requests_and_weather_are_all_kept(spark, daily, sizes):
    day = D(2019, 12, 24)
    rows = [(i % 7, "a", day) for i in range(60)] + [(None, "b", day)] * 3
    requests = spark.createDataFrame(rows, "request_id int, station string, day date")
    twice = daily.unionAll(daily.filter("station = 'a'"))
    found = weather_at(
        requests, twice, Frequency.DAILY, time_key(Frequency.DAILY, F.col("day")), len(rows), **sizes
    )
    expected = {i: 2 * sum(row[0] == i for row in rows) for i in range(7)} | {None: 3}
    assert {row[0]: row[1] for row in found.groupBy("request_id").count().collect()} == expected


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0], ids=["asked_once", "salted"])
def test_years_of_a_station_are_spread(spark, daily, broadcast_rows):
    requests = spark.createDataFrame(
        [(i, "a") for i in range(50)] + [(50, "b"), (51, "x"), (52, None)],
        "request_id int, station string",
    )
    by_year = daily.withColumn("year_part", F.year("date"))
    found = weather_of(requests, by_year, 53, broadcast_rows=broadcast_rows, fan_out=0)
    assert found.columns == ["request_id", *daily.columns]
    counts = {row[0]: row[1] for row in found.groupBy("request_id").count().collect()}
    assert counts == dict.fromkeys(range(51), 120)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0], ids=["asked_once", "salted"])
def test_a_place_that_a_third_asks_for_is_no_long_task(spark, daily, broadcast_rows):
    rows = [(i, "a", D(2019, 12, 24)) for i in range(10_000)]
    rows += [(10_000 + i, "abc"[i % 3], D(2019, 11, 1) + dt.timedelta(days=i % 119)) for i in range(20_000)]
    requests = spark.createDataFrame(rows, "request_id int, station string, day date")
    # Without a shuffle or with joined partitions the sizes would say nothing about the keys.
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = weather_at(
            requests, daily, Frequency.DAILY, time_key(Frequency.DAILY, F.col("day")), len(rows),
            broadcast_rows=broadcast_rows, fan_out=0,
        )
        sizes = sorted(
            row[1] for row in found.groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sum(sizes) == len(rows)
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_spread_without_loss(spark, how):
    rows = [(i, "hot") for i in range(1000)] + [(1000 + i, f"k{i}") for i in range(500)]
    rows += [(2000 + i, None) for i in range(400)]
    left = spark.createDataFrame(rows, "request_id int, k string")
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 500, 2)], "k string, v int"
    )
    hot = joins.hot_keys(left.dropna(subset=["k"]), ["k"], len(rows), shares=20).collect()
    assert [(row.k, row._parts) for row in hot] == [("hot", 11)]
    salted = joins.salted_join(left, right, ["k"], len(rows), how, shares=20)
    plain = left.join(right, "k", how)
    columns = ["request_id", "k", "v"]
    assert salted.select(columns).exceptAll(plain.select(columns)).isEmpty()
    assert plain.select(columns).exceptAll(salted.select(columns)).isEmpty()
    spread = joins.salted_join(left, right, ["k"], len(rows), how, F.col("v") > 1, shares=20)
    expected = left.join(right.filter("v > 1"), "k", how)
    assert spread.select(columns).exceptAll(expected.select(columns)).isEmpty()
    assert spread.count() == expected.count()

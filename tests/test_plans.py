"""What Spark makes of the queries: pushed filters, pruned folders, few shuffles."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from stationlake import DailyFrame, Frequency, HourlyFrame, Month, MonthlyFrame, Store, WeatherLake, Year
from stationlake.operators import located, nearest
from stationlake.plans.fixtures import VIEWS, catalogue, view

SF_DIR = "/root/testdata/sf0.001"
PLACE_QUERIES = [name for name in queries() if "near" in name or "location" in name]


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("plans") / "store"), buckets=4)
    day = dt.date(2024, 1, 1)
    store.append(view(spark, SF_DIR, "daily"), Frequency.DAILY, day)
    store.append(view(spark, SF_DIR, "hourly"), Frequency.HOURLY, day)
    store.append(view(spark, SF_DIR, "monthly"), Frequency.MONTHLY, day)
    return store


def test_views_are_grouped_by_hashing(spark):
    for name in ("daily", "hourly"):
        assert "SortAggregate" not in plan(view(spark, SF_DIR, name))


@pytest.mark.parametrize("name, table", [("daily", "lineitem"), ("hourly", "events")])
def test_views_over_odd_texts_are_what_their_sql_says(spark, tmp_path, name, table):
    """Groups of every kind of text that the views look for: less, equal, greater, null, and mixed."""
    text = {"daily": "l_linestatus", "hourly": "event_type"}[name]
    middle = {"daily": "O", "hourly": "view"}[name]
    some = ["", "A", middle, middle + " ", middle.lower(), "zz", None]
    groups = [(a,) for a in some] + [(a, b) for a in some for b in some]
    rows = []
    base = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    like = base.first().asDict()
    for i, group in enumerate(groups):
        at = {"l_suppkey": 1, "l_shipdate": dt.datetime(2000, 1, 1) + dt.timedelta(days=i)}
        if name == "hourly":
            at = {"user_id": 1, "ts": dt.datetime(2000, 1, 1) + dt.timedelta(hours=i)}
        if "l_shipdate" in at and not isinstance(like["l_shipdate"], dt.datetime):
            at["l_shipdate"] = at["l_shipdate"].date()
        rows += [like | at | {text: each} for each in group]
    spark.createDataFrame([tuple(r[c] for c in base.columns) for r in rows], base.schema).write.parquet(f"{tmp_path}/{table}.parquet")
    spark.read.parquet(f"{SF_DIR}/supplier.parquet").write.parquet(f"{tmp_path}/supplier.parquet")
    sql = VIEWS[name]
    for other in ("lineitem", "events", "supplier"):
        sql = re.sub(rf"\bFROM {other}\b", f"FROM parquet.`{tmp_path}/{other}.parquet`", sql)
    found, expected = view(spark, str(tmp_path), name), spark.sql(sql)
    assert sorted(map(str, found.drop("datetime").collect())) == sorted(map(str, expected.drop("datetime").collect()))
    prcp = {row.prcp is None for row in found.collect()}
    assert found.count() == len(groups) and prcp == {True, False}


def test_station_prunes_to_one_bucket(store):
    text = plan(store.scan_station(Frequency.DAILY, "000000007"))
    assert "EqualTo(station,000000007)" in text
    assert "PartitionFilters: [isnotnull(bucket" in text and "Exchange" not in text


@pytest.mark.parametrize(
    "kind, narrow, pushed",
    [
        (
            DailyFrame,
            lambda f: f.get_for_period(Year(1996)),
            ["GreaterThanOrEqual(date,1996-01-01)", "LessThanOrEqual(date,1996-12-31)", "(year_part#N = 1996)"],
        ),
        (DailyFrame, lambda f: f.get_at("1996-05-01"), ["EqualTo(date,1996-05-01)", "(year_part#N = 1996)"]),
        (DailyFrame, lambda f: f.get_for_period(Month(1996, 5)), ["(year_part#N = 1996)"]),
        (
            DailyFrame,
            lambda f: f.get_range(Year(1996), Year(1997)),
            ["(year_part#N >= 1996)", "(year_part#N <= 1997)"],
        ),
        (HourlyFrame, lambda f: f.get_at("2024-01-15 12:31:00"), ["(year_part#N = 2024)"]),
        (MonthlyFrame, lambda f: f.get_at(Month(1996, 5)), ["(year_part#N = 1996)"]),
        (
            HourlyFrame,
            lambda f: f.get_for_period(dt.date(2024, 1, 15)),
            ["GreaterThanOrEqual(datetime,2024-01-15T00:00", "LessThanOrEqual(datetime,2024-01-15T23"],
        ),
        (
            MonthlyFrame,
            lambda f: f.get_range(Month(1995, 11), Month(1996, 2)),
            ["Or(GreaterThan(year,1995)", "Or(LessThan(year,1996)"],
        ),
    ],
)
def test_time_filters_reach_the_scan(store, kind, narrow, pushed):
    text = re.sub(r"#\d+", "#N", plan(narrow(kind(store.scan(kind.frequency))).df))
    folders = re.search(r"PartitionFilters: \[.*\]", text).group()
    for condition in pushed:
        assert condition in (folders if "year_part" in condition else text)


def test_station_sets_prune_and_keep_the_layout(spark, store):
    lake = WeatherLake(spark, store.root)
    some = spark.createDataFrame([("000000007",), ("000000005",)], "station string")
    for frame in (lake.daily().stations(some), lake.daily().all().stations(some)):
        text = plan(frame.get_for_period(Year(1996)).df)
        assert "dynamicpruningexpression(bucket" in text and "(year_part" in text
    assert "EqualTo(station,000000007)" in plan(lake.daily().station("000000007").df)


def test_merging_costs_nothing_where_no_station_was_written_twice(spark, store, tmp_path):
    assert "Join" not in plan(store.scan(Frequency.DAILY), "simple")
    again = Store(spark, str(tmp_path / "again"), buckets=2)
    daily = view(spark, SF_DIR, "daily")
    again.append(daily.filter("station < '000000005'"), Frequency.DAILY, dt.date(2024, 1, 1))
    again.append(daily, Frequency.DAILY, dt.date(2024, 1, 2))
    assert len(again.live(Frequency.DAILY)) == 2
    assert "Join" not in plan(again.scan(Frequency.DAILY), "simple")
    again.drop_station(Frequency.DAILY, "000000007")
    text = plan(DailyFrame(again.scan(Frequency.DAILY)).get_at("1996-05-01").df)
    assert "LeftAnti" in text and "PartitionFilters: [isnotnull(year_part" in text


def test_only_needed_columns_are_read(store):
    series = DailyFrame(store.scan(Frequency.DAILY)).get_for_period(Year(1996)).chart_series()
    schema = plan(series).split("ReadSchema: ")[1].splitlines()[0]
    assert schema == "struct<station:string,date:date,tavg:double,tmin:double,tmax:double>"


def test_search_shuffles_requests_once(spark, store):
    requests = view(spark, SF_DIR, "requests").select("request_id", "lat", "lon")
    served = nearest.serving_stations(
        requests,
        catalogue(spark, SF_DIR),
        store.available(Frequency.DAILY),
        Frequency.DAILY,
        count=100_000,
    )
    text = plan(served, "simple")
    assert text.count("hashpartitioning(request_id") == 1
    assert "SortMergeJoin" not in text


def test_few_requests_leave_the_weather_table_in_place(spark, store):
    requests = spark.createDataFrame(
        [(1, "000000007", dt.date(1996, 5, 1))], "request_id int, station string, day date"
    )
    found = located.weather_at(
        requests,
        store.scan(Frequency.DAILY),
        Frequency.DAILY,
        located.time_key(Frequency.DAILY, F.col("day")),
        1,
        store.bucket_of,
    )
    text = plan(found)
    assert "dynamicpruningexpression(bucket" in text and "dynamicpruningexpression(year_part" in text
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
    stations = requests.select("station")
    assert "dynamicpruningexpression(bucket" in plan(store.scan_stations(Frequency.DAILY, stations))


def test_crowded_requests_thin_out_the_weather_where_it_is_read(spark, store):
    requests = spark.createDataFrame(
        [(i, "000000007", dt.date(1996, 5, 1)) for i in range(40)],
        "request_id int, station string, day date",
    )
    found = located.weather_at(
        requests,
        store.scan(Frequency.DAILY),
        Frequency.DAILY,
        located.time_key(Frequency.DAILY, F.col("day")),
        40,
        store.bucket_of,
        fan_out=0,
    )
    text = plan(found)
    assert "dynamicpruningexpression(bucket" in text and "dynamicpruningexpression(year_part" in text
    assert "BroadcastHashJoin LeftSemi" in text
    assert found.count() == 40


@pytest.mark.parametrize("name", PLACE_QUERIES)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF_DIR), "simple")
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in text

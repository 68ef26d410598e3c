"""Station search and weather at places, for whole tables of requests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions import periods
from stationlake.functions.geo import distance_km
from stationlake.lake import WeatherLake
from stationlake.operators import located
from stationlake.operators.frames import FRAMES, DailyFrame, HourlyFrame, MonthlyFrame
from stationlake.operators.nearest import find_stations, nearest_stations, serving_stations
from stationlake.operators.records import single_records
from stationlake.plans.filter_queries import record_columns_sql
from stationlake.plans.fixtures import catalogue, view
from stationlake.plans.registry import register
from stationlake.plans.store_queries import VIEW_OF, WRITTEN
from stationlake.scratch import scratch_folder
from stationlake.sizing import BROADCAST_ROWS
from stationlake.values import Frequency, Month, RequiredData, Year

# Columns need a session, so requirements are made when a query runs.
Required = Callable[[], RequiredData]

# -- SQL pieces: brute force over all pairs

DISTANCE_SQL = (
    "2 * 6371.0 * asin(sqrt(least(1.0, "
    "pow(sin(radians(s.latitude - r.lat) / 2), 2) + cos(radians(r.lat)) * "
    "cos(radians(s.latitude)) * pow(sin(radians(s.longitude - r.lon) / 2), 2))))"
)


def ranked_sql(inventory: str, radius: float) -> str:
    """WITH term ``ranked``: every station within the radius of every request, ranked."""
    return f"""
    pairs AS (
      SELECT r.request_id, r.lat, r.lon, r.on_date, r.at, s.station, {DISTANCE_SQL} AS km
      FROM requests r JOIN stations s ON {inventory}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY km, station) AS rank
      FROM pairs WHERE km <= {radius})
    """


def served_sql(inventory: str, radius: float, limit: int, table: str) -> str:
    """WITH term ``served``: the outcome of every request."""
    return f"""
    {ranked_sql(inventory, radius)},
    tried AS (
      SELECT request_id, count(*) AS n,
        min(CASE WHEN station IN (SELECT station FROM {table}) THEN rank END) AS best
      FROM ranked WHERE rank <= {limit} GROUP BY request_id),
    served AS (
      SELECT q.request_id, q.lat, q.lon, q.on_date, q.at, k.station, k.km AS distance_km,
        coalesce(t.n, 0) AS stations_tried,
        CASE WHEN t.n IS NULL THEN 'no_station' WHEN t.best IS NULL THEN 'no_data'
          ELSE 'ok' END AS status
      FROM requests q LEFT JOIN tried t ON t.request_id = q.request_id
      LEFT JOIN ranked k ON k.request_id = t.request_id AND k.rank = t.best)
    """


def any_sql(kind: str) -> str:
    return f"s.{kind}_start IS NOT NULL AND s.{kind}_end IS NOT NULL"


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_km", F.round("distance_km", 6))


# -- distance and nearest stations


def station_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance from every request to the station that its period request names."""
    named = view(spark, sf_dir, "period_requests").select("request_id", "station")
    stations = view(spark, sf_dir, "stations").select("station", "latitude", "longitude")
    pairs = view(spark, sf_dir, "requests").join(named, "request_id").join(stations, "station")
    km = distance_km(F.col("lat"), F.col("lon"), F.col("latitude"), F.col("longitude"))
    return rounded(pairs.select("request_id", "station", km.alias("distance_km")))


register(
    "station_distance",
    station_distance,
    f"""
    SELECT r.request_id, s.station, round({DISTANCE_SQL}, 6) AS distance_km
    FROM requests r JOIN period_requests p ON p.request_id = r.request_id
    JOIN stations s ON s.station = p.station
    """,
    ("requests", "period_requests", "stations"),
)


def _register_nearest(
    name: str,
    inventory: str,
    frequency: Frequency | None = None,
    required: Required = RequiredData.any,
    k: int = 5,
    radius: float = 50.0,
) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        requests = view(spark, sf_dir, "requests")
        found = nearest_stations(
            requests, catalogue(spark, sf_dir), k, radius, frequency, required()
        )
        return rounded(found.select("request_id", "station", "distance_km", "rank"))

    register(
        name,
        query,
        f"""
        , {ranked_sql(inventory, radius)}
        SELECT request_id, station, round(km, 6) AS distance_km, rank
        FROM ranked WHERE rank <= {k}
        """,
        ("requests", "stations"),
    )


def _register_crowded(name: str, broadcast_rows: int) -> None:
    """All places and stations drawn together into a few kilometres: every cell is crowded."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        drawn = [(50 + (F.col(lat) - 48) / 40, 8 + (F.col(lon) - 5) / 40) for lat, lon in (
            ("lat", "lon"), ("location.latitude", "location.longitude"))]
        requests = view(spark, sf_dir, "requests").select(
            "request_id", drawn[0][0].alias("lat"), drawn[0][1].alias("lon")
        )
        place = F.struct(drawn[1][0].alias("latitude"), drawn[1][1].alias("longitude"), F.col("location.elevation"))
        stations = catalogue(spark, sf_dir).withColumn("location", place)
        found = nearest_stations(requests, stations, 2, 50.0, broadcast_rows=broadcast_rows)
        return rounded(found.select("request_id", "station", "distance_km", "rank"))

    register(
        name,
        query,
        f"""
        , asked AS (
          SELECT request_id, 50 + (lat - 48) / 40 AS lat, 8 + (lon - 5) / 40 AS lon FROM requests),
        sites AS (
          SELECT station, 50 + (latitude - 48) / 40 AS latitude, 8 + (longitude - 5) / 40 AS longitude FROM stations),
        pairs AS (
          SELECT r.request_id, s.station, {DISTANCE_SQL} AS km FROM asked r CROSS JOIN sites s),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY km, station) AS rank FROM pairs WHERE km <= 50)
        SELECT request_id, station, round(km, 6) AS distance_km, rank FROM ranked WHERE rank <= 2
        """,
        ("requests", "stations"),
    )


_register_crowded("nearest_stations_crowded", BROADCAST_ROWS)
_register_crowded("nearest_stations_crowded_shuffled", 0)


def specific_day() -> RequiredData:
    return RequiredData.specific_date(F.col("on_date"))


def specific_day_of_instant() -> RequiredData:
    return RequiredData.specific_date(F.col("at").cast("date"))


def full_year_of_day() -> RequiredData:
    return RequiredData.full_year(F.year("on_date"))


_register_nearest("nearest_stations", "true")
_register_nearest("nearest_stations_wide", "true", k=12, radius=180.0)
_register_nearest("nearest_stations_zero", "false", k=0)
_register_nearest(
    "nearest_stations_daily_any", any_sql("daily"), Frequency.DAILY
)
_register_nearest(
    "nearest_stations_daily_specific_date",
    "s.daily_start <= r.on_date AND s.daily_end >= r.on_date",
    Frequency.DAILY,
    specific_day,
)
_register_nearest(
    "nearest_stations_daily_date_range",
    "s.daily_start <= r.on_date AND s.daily_end >= r.on_date + 400",
    Frequency.DAILY,
    lambda: RequiredData.date_range(F.col("on_date"), F.date_add("on_date", 400)),
)
_register_nearest(
    "nearest_stations_daily_full_year",
    "s.daily_start <= make_date(extract(year FROM r.on_date), 1, 1) "
    "AND s.daily_end >= make_date(extract(year FROM r.on_date), 12, 31)",
    Frequency.DAILY,
    full_year_of_day,
)
_register_nearest(
    "nearest_stations_daily_full_year_1997",
    "s.daily_start <= DATE '1997-01-01' AND s.daily_end >= DATE '1997-12-31'",
    Frequency.DAILY,
    lambda: RequiredData.full_year(1997),
)
_register_nearest(
    "nearest_stations_daily_full_year_2001",
    "s.daily_start <= DATE '2001-01-01' AND s.daily_end >= DATE '2001-12-31'",
    Frequency.DAILY,
    lambda: RequiredData.full_year(2001),
)
_register_nearest(
    "nearest_stations_hourly_specific_date",
    "s.hourly_start <= CAST(r.at AS date) AND s.hourly_end >= CAST(r.at AS date)",
    Frequency.HOURLY,
    specific_day_of_instant,
)
_register_nearest(
    "nearest_stations_monthly_any", any_sql("monthly"), Frequency.MONTHLY
)
_register_nearest(
    "nearest_stations_monthly_specific_date",
    "s.monthly_start <= extract(year FROM r.on_date) "
    "AND s.monthly_end >= extract(year FROM r.on_date)",
    Frequency.MONTHLY,
    specific_day,
)
_register_nearest(
    "nearest_stations_monthly_date_range",
    "s.monthly_start <= 1995 AND s.monthly_end >= 2001",
    Frequency.MONTHLY,
    lambda: RequiredData.date_range(dt.date(1995, 6, 15), dt.date(2001, 2, 1)),
)
_register_nearest(
    "nearest_stations_monthly_full_year",
    "s.monthly_start <= extract(year FROM r.on_date) "
    "AND s.monthly_end >= extract(year FROM r.on_date)",
    Frequency.MONTHLY,
    full_year_of_day,
)
_register_nearest(
    "nearest_stations_climate_any", any_sql("normals"), Frequency.CLIMATE
)
_register_nearest(
    "nearest_stations_climate_full_year_2021",
    "s.normals_start <= 2021 AND s.normals_end >= 2021",
    Frequency.CLIMATE,
    lambda: RequiredData.full_year(2021),
)
_register_nearest(
    "nearest_stations_climate_full_year",
    "s.normals_start <= 1995 AND s.normals_end >= 1995",
    Frequency.CLIMATE,
    lambda: RequiredData.full_year(1995),
)


def find_stations_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_stations(
        view(spark, sf_dir, "requests"),
        catalogue(spark, sf_dir),
        Frequency.DAILY,
        RequiredData.any(),
    )
    return rounded(
        found.select(
            "request_id",
            "lat",
            "lon",
            "rank",
            "distance_km",
            F.col("station.id").alias("station"),
            "station.country",
            F.element_at("station.name", F.lit("en")).alias("name_en"),
        )
    )


register(
    "find_stations_default",
    find_stations_default,
    f"""
    , {ranked_sql(any_sql("daily"), 50.0)}
    SELECT k.request_id, k.lat, k.lon, k.rank, round(k.km, 6) AS distance_km, k.station,
      s.country, s.name_en
    FROM ranked k JOIN stations s ON s.station = k.station WHERE k.rank <= 5
    """,
    ("requests", "stations"),
)


# -- the station that serves a place


def serve(
    spark: SparkSession,
    sf_dir: str,
    frequency: Frequency,
    required: RequiredData | None = None,
    station_limit: int = 3,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    weather = view(spark, sf_dir, VIEW_OF[frequency])
    return serving_stations(
        view(spark, sf_dir, "requests"),
        catalogue(spark, sf_dir),
        located.stations_with_data(weather),
        frequency,
        required,
        station_limit=station_limit,
        carry=carry,
    )


INVENTORY_OF = {
    Frequency.HOURLY: "hourly",
    Frequency.DAILY: "daily",
    Frequency.MONTHLY: "monthly",
    Frequency.CLIMATE: "normals",
}


def _nearest_with_data(frequency: Frequency):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        served = serve(spark, sf_dir, frequency).filter("status = 'ok'")
        return rounded(served.select("request_id", "station", "distance_km"))

    return query


for _frequency, _table in VIEW_OF.items():
    register(
        f"nearest_with_data_{_table}",
        _nearest_with_data(_frequency),
        f"""
        , {served_sql(any_sql(INVENTORY_OF[_frequency]), 50.0, 3, _table)}
        SELECT request_id, station, round(distance_km, 6) AS distance_km
        FROM served WHERE status = 'ok'
        """,
        ("requests", "stations", _table),
    )

COVERS_DAY = "s.daily_start <= r.on_date AND s.daily_end >= r.on_date"
COVERS_HOUR = "s.hourly_start <= CAST(r.at AS date) AND s.hourly_end >= CAST(r.at AS date)"
COVERS_YEAR = (
    "s.monthly_start <= extract(year FROM r.on_date) "
    "AND s.monthly_end >= extract(year FROM r.on_date)"
)


def location_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = serve(spark, sf_dir, Frequency.DAILY, specific_day(), station_limit=2)
    return served.select("request_id", "station", "stations_tried", "status")


register(
    "location_outcome",
    location_outcome,
    f"""
    , {served_sql(COVERS_DAY, 50.0, 2, "daily")}
    SELECT request_id, station, stations_tried, status FROM served
    """,
    ("requests", "stations", "daily"),
)


# -- a point in time at a place


def _register_at(
    name: str,
    frequency: Frequency,
    required: Required,
    inventory: str,
    at: Callable[[], dict[str, Column]],
    carry: tuple[str, ...],
    match: str,
) -> None:
    table = VIEW_OF[frequency]
    names = list(schemas.table_columns(frequency))[1:]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        requests = view(spark, sf_dir, "requests")
        served = serve(spark, sf_dir, frequency, required(), 3, carry)
        rows = located.weather_at(
            served, view(spark, sf_dir, table), frequency, at(), requests.count()
        )
        return rounded(rows.select("request_id", "station", "distance_km", *names))

    columns = ", ".join(f"w.{column}" for column in names)
    register(
        name,
        query,
        f"""
        , {served_sql(inventory, 50.0, 3, table)}
        SELECT q.request_id, q.station, round(q.distance_km, 6) AS distance_km, {columns}
        FROM served q JOIN {table} w ON w.station = q.station AND {match}
        """,
        ("requests", "stations", table),
    )


_register_at(
    "daily_at_location",
    Frequency.DAILY,
    specific_day,
    COVERS_DAY,
    lambda: located.time_key(Frequency.DAILY, F.col("on_date")),
    ("on_date",),
    "w.date = q.on_date",
)
_register_at(
    "hourly_at_location",
    Frequency.HOURLY,
    specific_day_of_instant,
    COVERS_HOUR,
    lambda: located.time_key(Frequency.HOURLY, F.col("at")),
    ("at",),
    "w.datetime = date_trunc('hour', q.at + INTERVAL 30 MINUTE)",
)
_register_at(
    "monthly_at_location",
    Frequency.MONTHLY,
    specific_day,
    COVERS_YEAR,
    lambda: located.time_key(Frequency.MONTHLY, F.col("on_date")),
    ("on_date",),
    "w.year = extract(year FROM q.on_date) AND w.month = extract(month FROM q.on_date)",
)
_register_at(
    "climate_at_location",
    Frequency.CLIMATE,
    RequiredData.any,
    any_sql("normals"),
    lambda: {
        "start_year": F.lit(1991).cast("bigint"),
        "end_year": F.lit(2020).cast("bigint"),
        "month": F.month("on_date").cast("bigint"),
    },
    ("on_date",),
    "w.start_year = 1991 AND w.end_year = 2020 AND w.month = extract(month FROM q.on_date)",
)


# -- the same through the front door: a store, its catalogue and its status log


def _daily_lake(spark: SparkSession, sf_dir: str) -> WeatherLake:
    lake = WeatherLake(spark, scratch_folder(spark, "lake"), buckets=8)
    lake.store.save_catalogue(catalogue(spark, sf_dir))
    lake.store.append(view(spark, sf_dir, "daily"), Frequency.DAILY, WRITTEN)
    return lake


def daily_at_location_via_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = view(spark, sf_dir, "requests")
    rows = _daily_lake(spark, sf_dir).daily().at(requests, "on_date", specific_day(), station_limit=3)
    names = list(schemas.table_columns(Frequency.DAILY))[1:]
    return rounded(rows.select("request_id", "station", "distance_km", *names))


def at_location_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with its outcome; the inventory is asked for any data, so a day may have no row."""
    requests = view(spark, sf_dir, "requests")
    found = _daily_lake(spark, sf_dir).daily().at_outcomes(requests, "on_date", station_limit=2)
    return found.select("request_id", "station", "stations_tried", "status")


register(
    "daily_at_location_via_store",
    daily_at_location_via_store,
    f"""
    , {served_sql(COVERS_DAY, 50.0, 3, "daily")}
    SELECT q.request_id, q.station, round(q.distance_km, 6) AS distance_km,
      {", ".join(f"w.{column}" for column in list(schemas.table_columns(Frequency.DAILY))[1:])}
    FROM served q JOIN daily w ON w.station = q.station AND w.date = q.on_date
    """,
    ("requests", "stations", "daily"),
)
register(
    "at_location_outcome",
    at_location_outcome,
    f"""
    , {served_sql(any_sql("daily"), 50.0, 2, "daily")}
    SELECT q.request_id, q.station, q.stations_tried,
      CASE WHEN q.on_date IS NULL THEN 'bad_time'
        WHEN q.status = 'ok' AND w.station IS NULL THEN 'no_row' ELSE q.status END AS status
    FROM served q LEFT JOIN (SELECT DISTINCT station, date FROM daily) w
      ON w.station = q.station AND w.date = q.on_date
    """,
    ("requests", "stations", "daily"),
)


# -- a third of all requests at one place and day, with few and with many different keys


def _register_hot(name: str, broadcast_rows: int) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = _daily_lake(spark, sf_dir).store
        requests = view(spark, sf_dir, "hot_requests")
        served = serving_stations(
            requests, store.stations(), store.available(Frequency.DAILY), Frequency.DAILY,
            station_limit=3, carry=("on_date",),
        )
        rows = located.weather_at(
            served, store.scan(Frequency.DAILY), Frequency.DAILY,
            located.time_key(Frequency.DAILY, F.col("on_date")), requests.count(), store.bucket_of,
            broadcast_rows, fan_out=0,
        )
        names = list(schemas.table_columns(Frequency.DAILY))[1:]
        return rounded(rows.select("request_id", "station", "distance_km", *names))

    register(
        name,
        query,
        f"""
        , {served_sql(any_sql("daily"), 50.0, 3, "daily").replace("requests", "hot_requests")}
        SELECT q.request_id, q.station, round(q.distance_km, 6) AS distance_km,
          {", ".join(f"w.{column}" for column in list(schemas.table_columns(Frequency.DAILY))[1:])}
        FROM served q JOIN daily w ON w.station = q.station AND w.date = q.on_date
        """,
        ("hot_requests", "stations", "daily"),
    )


_register_hot("daily_at_hot_place", BROADCAST_ROWS)
_register_hot("daily_at_hot_place_shuffled", 0)


# -- one period, the same for all places


def _register_period(name: str, frequency: Frequency, narrow, where: str) -> None:
    table = VIEW_OF[frequency]
    names = list(schemas.table_columns(frequency))[1:]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        requests = view(spark, sf_dir, "requests")
        frame = narrow(FRAMES[frequency](view(spark, sf_dir, table)))
        served = serve(spark, sf_dir, frequency, station_limit=1)
        rows = located.weather_of(served, frame.df, requests.count())
        return rows.select("request_id", "station", *names)

    columns = ", ".join(f"w.{column}" for column in names)
    register(
        name,
        query,
        f"""
        , {served_sql(any_sql(INVENTORY_OF[frequency]), 50.0, 1, table)}
        SELECT q.request_id, q.station, {columns}
        FROM served q JOIN {table} w ON w.station = q.station WHERE {where}
        """,
        ("requests", "stations", table),
    )


_register_period(
    "daily_period_at_location",
    Frequency.DAILY,
    lambda frame: DailyFrame.get_for_period(frame, Month(year=1996, month=5)),
    "w.date BETWEEN DATE '1996-05-01' AND DATE '1996-05-31'",
)
_register_period(
    "hourly_range_at_location",
    Frequency.HOURLY,
    lambda frame: HourlyFrame.get_range(frame, "2024-01-10", "2024-01-12"),
    "w.datetime >= TIMESTAMP '2024-01-10 00:00:00' AND w.datetime < TIMESTAMP '2024-01-13 00:00:00'",
)
_register_period(
    "monthly_range_at_location",
    Frequency.MONTHLY,
    lambda frame: MonthlyFrame.get_range(frame, Month(year=1995, month=11), Year(1996)),
    "w.year * 12 + w.month BETWEEN 1995 * 12 + 11 AND 1996 * 12 + 12",
)


# -- period texts, one per request


def resolve_date_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.resolve_date_periods(view(spark, sf_dir, "period_requests"))


def resolve_datetime_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.resolve_datetime_periods(view(spark, sf_dir, "period_requests"))


def resolve_month_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.resolve_month_periods(view(spark, sf_dir, "period_requests"))


def resolve_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's instant in four spellings, the last of which is refused."""
    at = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    spellings = {
        "plain": at,
        "utc": F.concat(F.regexp_replace(at, " ", "T"), F.lit("Z")),
        "offset": F.concat(F.regexp_replace(at, " ", "T"), F.lit("+02:00")),
        "no_zone": F.regexp_replace(at, " ", "T"),
    }
    texts = F.explode(
        F.array(*(
            F.struct(F.lit(name).alias("spelling"), text.alias("period"))
            for name, text in spellings.items()
        ))
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", texts.alias("t"))
    return periods.resolve_datetime_periods(events.select("event_id", "t.*"))


GOOD = "period <> 'soon' AND period <> '2023-13'"
START_SQL = f"""
    CASE WHEN {GOOD} THEN CASE length(period) WHEN 4 THEN TRY_CAST(period || '-01-01' AS date)
      WHEN 7 THEN TRY_CAST(period || '-01' AS date) ELSE TRY_CAST(period AS date) END END
"""
END_SQL = f"""
    CASE WHEN {GOOD} THEN CASE length(period) WHEN 4 THEN TRY_CAST(period || '-12-31' AS date)
      WHEN 7 THEN last_day(TRY_CAST(period || '-01' AS date))
      ELSE TRY_CAST(period AS date) END END
"""
STATUS_SQL = f"CASE WHEN {GOOD} THEN 'ok' ELSE 'bad_period' END"

register(
    "resolve_date_periods",
    resolve_date_periods,
    f"""
    SELECT request_id, station, period, {START_SQL} AS start_date, {END_SQL} AS end_date,
      {STATUS_SQL} AS status
    FROM period_requests
    """,
    ("period_requests",),
)
register(
    "resolve_datetime_periods",
    resolve_datetime_periods,
    f"""
    SELECT request_id, station, period, CAST({START_SQL} AS timestamp) AS start_at,
      CAST({END_SQL} AS timestamp) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS end_at,
      {STATUS_SQL} AS status
    FROM period_requests
    """,
    ("period_requests",),
)
register(
    "resolve_month_periods",
    resolve_month_periods,
    """
    SELECT request_id, station, period,
      TRY_CAST(y AS bigint) AS start_year,
      CASE length(period) WHEN 7 THEN CAST(m AS bigint) WHEN 4 THEN
        CASE WHEN y IS NOT NULL THEN CAST(1 AS bigint) END END AS start_month,
      TRY_CAST(y AS bigint) AS end_year,
      CASE length(period) WHEN 7 THEN CAST(m AS bigint) WHEN 4 THEN
        CASE WHEN y IS NOT NULL THEN CAST(12 AS bigint) END END AS end_month,
      CASE WHEN y IS NULL THEN 'bad_period' ELSE 'ok' END AS status
    FROM (
      SELECT *, CASE WHEN length(period) IN (4, 7) AND period <> 'soon'
          THEN substr(period, 1, 4) END AS y,
        CASE WHEN length(period) = 7 THEN substr(period, 6, 2) END AS m
      FROM period_requests) p
    """,
    ("period_requests",),
)
register(
    "resolve_instants",
    resolve_instants,
    """
    SELECT event_id, spelling,
      replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' ', sep) || zone AS period,
      CASE WHEN spelling <> 'no_zone' THEN date_trunc('second', ts) - shift END AS start_at,
      CASE WHEN spelling <> 'no_zone' THEN date_trunc('second', ts) - shift END AS end_at,
      CASE WHEN spelling <> 'no_zone' THEN 'ok' ELSE 'bad_period' END AS status
    FROM events, (VALUES ('plain', ' ', '', INTERVAL 0 HOUR), ('utc', 'T', 'Z', INTERVAL 0 HOUR),
      ('offset', 'T', '+02:00', INTERVAL 2 HOUR), ('no_zone', 'T', '', INTERVAL 0 HOUR))
      AS t(spelling, sep, zone, shift)
    """,
)


def _daily_of_period_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_date_periods(spark, sf_dir)
    return located.weather_between(
        resolved,
        view(spark, sf_dir, "daily"),
        Frequency.DAILY,
        {"date": F.col("start_date")},
        {"date": F.col("end_date")},
    )


def _monthly_of_period_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolve_month_periods(spark, sf_dir)
    return located.weather_between(
        resolved,
        view(spark, sf_dir, "monthly"),
        Frequency.MONTHLY,
        {"year": F.col("start_year"), "month": F.col("start_month")},
        {"year": F.col("end_year"), "month": F.col("end_month")},
    )


def hourly_around_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly rows from a day before to a day after each request's instant, at its place."""
    served = serve(
        spark,
        sf_dir,
        Frequency.HOURLY,
        specific_day_of_instant(),
        3,
        ("at",),
    )
    at = F.col("at").cast("timestamp_ntz")
    rows = located.weather_between(
        served,
        view(spark, sf_dir, "hourly"),
        Frequency.HOURLY,
        {"datetime": at - F.expr("interval 1 day")},
        {"datetime": at + F.expr("interval 1 day")},
        count=2 * view(spark, sf_dir, "requests").count(),
    )
    return rows.drop("distance_km")


def daily_request_period_at_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request's own period of daily rows, from the station that serves its place."""
    texts = view(spark, sf_dir, "period_requests").select("request_id", "period")
    served = serve(spark, sf_dir, Frequency.DAILY).select("request_id", "station")
    rows = located.weather_between(
        periods.resolve_date_periods(served.join(texts, "request_id")),
        view(spark, sf_dir, "daily"),
        Frequency.DAILY,
        {"date": F.col("start_date")},
        {"date": F.col("end_date")},
        count=12 * texts.count(),
    )
    return rows


_DAILY = ", ".join(f"w.{name}" for name in list(schemas.table_columns(Frequency.DAILY))[1:])
_MONTHLY = ", ".join(f"w.{name}" for name in list(schemas.table_columns(Frequency.MONTHLY))[1:])
_HOURLY = ", ".join(f"w.{name}" for name in list(schemas.table_columns(Frequency.HOURLY))[1:])
RESOLVED_SQL = f"""
    resolved AS (
      SELECT request_id, station, {START_SQL} AS start_date, {END_SQL} AS end_date
      FROM period_requests)
"""

register(
    "daily_for_period_requests",
    _daily_of_period_requests,
    f"""
    , {RESOLVED_SQL}
    SELECT p.request_id, p.station, {_DAILY} FROM resolved p
    JOIN daily w ON w.station = p.station AND w.date BETWEEN p.start_date AND p.end_date
    """,
    ("period_requests", "daily"),
)
register(
    "monthly_for_period_requests",
    _monthly_of_period_requests,
    f"""
    SELECT p.request_id, p.station, {_MONTHLY} FROM period_requests p
    JOIN monthly w ON w.station = p.station
    WHERE p.period = CAST(w.year AS varchar)
      OR p.period = CAST(w.year AS varchar) || '-' || lpad(CAST(w.month AS varchar), 2, '0')
    """,
    ("period_requests", "monthly"),
)
register(
    "hourly_around_requests",
    hourly_around_requests,
    f"""
    , {served_sql(COVERS_HOUR, 50.0, 3, "hourly")}
    SELECT q.request_id, q.station, {_HOURLY} FROM served q
    JOIN hourly w ON w.station = q.station
    WHERE w.datetime BETWEEN q.at - INTERVAL 1 DAY AND q.at + INTERVAL 1 DAY
    """,
    ("requests", "stations", "hourly"),
)
register(
    "daily_request_period_at_location",
    daily_request_period_at_location,
    f"""
    , {RESOLVED_SQL}, {served_sql(any_sql("daily"), 50.0, 3, "daily")}
    SELECT q.request_id, q.station, {_DAILY} FROM served q
    JOIN resolved p ON p.request_id = q.request_id
    JOIN daily w ON w.station = q.station AND w.date BETWEEN p.start_date AND p.end_date
    """,
    ("period_requests", "requests", "stations", "daily"),
)


def daily_periods_via_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request's own period at its station, from the folders of its years."""
    return _daily_lake(spark, sf_dir).daily().for_periods(view(spark, sf_dir, "period_requests"))


def period_location_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with the outcome of its own period at its place."""
    texts = view(spark, sf_dir, "period_requests").select("request_id", "period")
    requests = view(spark, sf_dir, "requests").select("request_id", "lat", "lon").join(texts, "request_id")
    found = _daily_lake(spark, sf_dir).daily().period_outcomes(requests, station_limit=2)
    return found.select("request_id", "station", "stations_tried", "status")


register(
    "daily_periods_via_store",
    daily_periods_via_store,
    f"""
    , {RESOLVED_SQL}
    SELECT p.request_id, p.station, {_DAILY} FROM resolved p JOIN daily w ON w.station = p.station AND w.date BETWEEN p.start_date AND p.end_date
    """,
    ("period_requests", "daily"),
)
register(
    "period_location_outcome",
    period_location_outcome,
    f"""
    , {RESOLVED_SQL}, {served_sql(any_sql("daily"), 50.0, 2, "daily")}
    SELECT q.request_id, q.station, q.stations_tried,
      CASE WHEN p.start_date IS NULL THEN 'bad_period'
        WHEN q.status = 'ok' AND NOT EXISTS (
          SELECT 1 FROM daily w WHERE w.station = q.station AND w.date BETWEEN p.start_date AND p.end_date)
        THEN 'no_row' ELSE q.status END AS status
    FROM served q JOIN resolved p ON p.request_id = q.request_id
    """,
    ("period_requests", "requests", "stations", "daily"),
)


def single_row_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests whose period has exactly one daily row, as records; the others with their count."""
    requests = view(spark, sf_dir, "period_requests")
    rows = _daily_of_period_requests(spark, sf_dir)
    accepted, rejected = single_records(rows, requests, Frequency.DAILY)
    return accepted.withColumn("actual", F.lit(1).cast("bigint")).unionByName(
        rejected, allowMissingColumns=True
    )


register(
    "single_row_guard",
    single_row_guard,
    f"""
    , {RESOLVED_SQL}, found AS (
      SELECT p.request_id, w.*, count(w.date) OVER (PARTITION BY p.request_id) AS actual
      FROM resolved p LEFT JOIN daily w
        ON w.station = p.station AND w.date BETWEEN p.start_date AND p.end_date)
    SELECT request_id, station, {record_columns_sql(Frequency.DAILY)}, actual
    FROM found WHERE actual = 1
    UNION ALL
    SELECT DISTINCT request_id, {", ".join(["NULL"] * 12)}, actual FROM found WHERE actual <> 1
    """,
    ("period_requests", "daily"),
)

"""Queries over files and stores: each writes into a fresh folder and reads it back."""

from __future__ import annotations

import datetime as dt
import gzip

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake.functions.periods import date_bounds
from stationlake.lake import WeatherLake
from stationlake.plans.fixtures import catalogue, view
from stationlake.plans.registry import register
from stationlake.scratch import scratch_folder
from stationlake.sources import bulk
from stationlake.sources.catalogue import scan_catalogue, station_name, write_catalogue_files
from stationlake.sources.store import Store, stale_stations, with_end_date
from stationlake.values import Frequency

TODAY = dt.date(2024, 1, 20)
WRITTEN = dt.date(2024, 1, 19)
STORED_BEFORE = dt.date(1998, 1, 1)
ONE_STATION = "000000007"
VIEW_OF = {
    Frequency.HOURLY: "hourly",
    Frequency.DAILY: "daily",
    Frequency.MONTHLY: "monthly",
    Frequency.CLIMATE: "climate",
}


def columns_of(frequency: Frequency, prefix: str = "") -> str:
    return ", ".join(prefix + name for name in schemas.table_columns(frequency))


def _landing(spark: SparkSession, sf_dir: str, frequency: Frequency) -> str:
    folder = scratch_folder(spark, f"landing-{frequency.value}")
    bulk.write_files(view(spark, sf_dir, VIEW_OF[frequency]), frequency, folder)
    return folder


def _store(spark: SparkSession) -> Store:
    return Store(spark, scratch_folder(spark, "store"), buckets=8)


def _daily_store(spark: SparkSession, sf_dir: str) -> Store:
    store = _store(spark)
    store.append(view(spark, sf_dir, "daily"), Frequency.DAILY, WRITTEN)
    return store


def _all_daily(store: Store) -> DataFrame:
    return store.scan(Frequency.DAILY).drop(*schemas.LAYOUT)


# -- bulk files


def _scan_files(frequency: Frequency):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bulk.scan(spark, frequency, _landing(spark, sf_dir, frequency))

    return query


for _frequency, _view in VIEW_OF.items():
    register(
        f"scan_{_view}_csv",
        _scan_files(_frequency),
        f"SELECT {columns_of(_frequency)} FROM {_view}",
        (_view,),
    )


# -- catalogue

CATALOGUE_SQL = """
    SELECT station, country, region, name_en, CAST(NULL AS varchar) AS name_de,
      latitude, longitude, elevation, daily_start, daily_end, hourly_start, hourly_end,
      monthly_start, monthly_end, normals_start, normals_end
    FROM stations
"""


def _catalogue_files(spark: SparkSession, sf_dir: str) -> str:
    """The catalogue as JSON arrays of at most a thousand stations each."""
    folder = scratch_folder(spark, "catalogue")
    stations = catalogue(spark, sf_dir).withColumn("block", F.substring("id", 1, 6))
    write_catalogue_files(stations, folder, "block")
    return folder


def _flat(stations: DataFrame) -> DataFrame:
    spans = [
        F.col(f"inventory.{kind}.{end}").alias(f"{kind}_{end}")
        for kind in ("daily", "hourly", "monthly", "normals")
        for end in ("start", "end")
    ]
    return stations.select(
        F.col("id").alias("station"),
        "country",
        "region",
        station_name("en").alias("name_en"),
        station_name("de").alias("name_de"),
        "location.latitude",
        "location.longitude",
        "location.elevation",
        *spans,
    )


def scan_station_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(scan_catalogue(spark, _catalogue_files(spark, sf_dir)))


def catalogue_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    outdated = catalogue(spark, sf_dir).filter("location.elevation IS NULL")
    store.save_catalogue(outdated)
    store.rebuild_catalogue(_catalogue_files(spark, sf_dir))
    return _flat(store.stations())


register("scan_station_catalogue", scan_station_catalogue, CATALOGUE_SQL, ("stations",))
register("catalogue_rebuild", catalogue_rebuild, CATALOGUE_SQL, ("stations",))


# -- store


def store_append_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations stored early, with rows up to 1997, stay as they are; the others are added."""
    early = view(spark, sf_dir, "store_status").filter("written_on <= date '2024-06-30'")
    daily = view(spark, sf_dir, "daily")
    store = _store(spark)
    store.append(
        daily.filter(F.col("date") < F.lit(STORED_BEFORE)).join(early, "station", "left_semi"),
        Frequency.DAILY,
        dt.date(2024, 6, 30),
    )
    store.ingest(_landing(spark, sf_dir, Frequency.DAILY), Frequency.DAILY, dt.date(2024, 7, 1))
    return _all_daily(store)


register(
    "store_append_missing",
    store_append_missing,
    f"""
    SELECT {columns_of(Frequency.DAILY)} FROM daily
    WHERE date < DATE '1998-01-01' OR station NOT IN (
      SELECT d.station FROM daily d JOIN store_status s ON s.station = d.station
      WHERE s.written_on <= DATE '2024-06-30' AND d.date < DATE '1998-01-01')
    """,
    ("daily", "store_status"),
)


def _scan_station(frequency: Frequency):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = _store(spark)
        store.append(view(spark, sf_dir, VIEW_OF[frequency]), frequency, WRITTEN)
        return store.scan_station(frequency, ONE_STATION)

    return query


for _frequency, _view in VIEW_OF.items():
    register(
        f"store_scan_station_{_view}",
        _scan_station(_frequency),
        f"SELECT {columns_of(_frequency)} FROM {_view} WHERE station = '{ONE_STATION}'",
        (_view,),
    )


def store_scan_station_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = view(spark, sf_dir, "stations").filter("elevation >= 100")
    return _daily_store(spark, sf_dir).scan_stations(Frequency.DAILY, high)


register(
    "store_scan_station_set",
    store_scan_station_set,
    f"""
    SELECT {columns_of(Frequency.DAILY)} FROM daily
    WHERE station IN (SELECT station FROM stations WHERE elevation >= 100)
    """,
    ("daily", "stations"),
)


def _daily_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request needs the daily rows of a station up to the day it asks for."""
    wanted = view(spark, sf_dir, "period_requests").select("request_id", "station")
    asked = view(spark, sf_dir, "requests").select(
        "request_id",
        F.lit("daily").alias("frequency"),
        F.lit("specific_date").alias("kind"),
        F.col("at").cast("date").alias("date"),
        F.lit(None).cast("date").alias("end"),
        F.lit(None).cast("int").alias("year"),
    )
    return with_end_date(wanted.join(asked, "request_id"))


# The later the last needed day up to today, the staler; days still to come do not count.
NEEDED_SQL = """
    needed AS (
      SELECT p.station, max(CAST(r.at AS date)) AS end_date
      FROM period_requests p JOIN requests r ON r.request_id = p.request_id
      WHERE CAST(r.at AS date) <= DATE '2024-01-20' GROUP BY p.station)
"""


def stale_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stale_stations(
        _daily_needs(spark, sf_dir),
        view(spark, sf_dir, "store_status").filter("written_on IS NOT NULL"),
        TODAY,
    )


register(
    "stale_partitions",
    stale_partitions,
    f"""
    , {NEEDED_SQL}
    SELECT n.station, 'daily' AS frequency, n.end_date, s.written_on
    FROM needed n LEFT JOIN store_status s ON s.station = n.station
    WHERE s.written_on IS NULL OR n.end_date > s.written_on
    """,
    ("period_requests", "requests", "store_status"),
)


def store_refresh_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations needed after the day they were written get all their rows, others keep theirs."""
    old = view(spark, sf_dir, "daily").filter(F.col("date") < F.lit(STORED_BEFORE))
    store = _store(spark)
    store.append(old, Frequency.DAILY, WRITTEN)
    store.refresh(
        _landing(spark, sf_dir, Frequency.DAILY),
        Frequency.DAILY,
        _daily_needs(spark, sf_dir),
        TODAY,
    )
    return _all_daily(store)


register(
    "store_refresh_stale",
    store_refresh_stale,
    f"""
    , {NEEDED_SQL}
    SELECT {columns_of(Frequency.DAILY)} FROM daily
    WHERE date < DATE '1998-01-01' OR station IN (
      SELECT station FROM needed
      WHERE end_date > DATE '2024-01-19'
        OR station NOT IN (SELECT station FROM daily WHERE date < DATE '1998-01-01'))
    """,
    ("daily", "period_requests", "requests"),
)


def store_drop_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _daily_store(spark, sf_dir)
    store.drop_station(Frequency.DAILY, ONE_STATION)
    return _all_daily(store)


def store_drop_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _daily_store(spark, sf_dir)
    store.drop_stations(
        Frequency.DAILY, view(spark, sf_dir, "stations").filter("elevation >= 100")
    )
    return _all_daily(store)


def store_drop_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every table after all weather was dropped: nothing."""
    store = _daily_store(spark, sf_dir)
    store.append(view(spark, sf_dir, "monthly"), Frequency.MONTHLY, WRITTEN)
    store.drop_all()
    status = store.status().select("station", "frequency")
    for frequency in Frequency:
        rows = store.scan(frequency).select("station", F.lit(frequency.value).alias("frequency"))
        status = status.unionByName(rows)
    return status


register(
    "store_drop_station",
    store_drop_station,
    f"SELECT {columns_of(Frequency.DAILY)} FROM daily WHERE station <> '{ONE_STATION}'",
    ("daily",),
)
register(
    "store_drop_stations",
    store_drop_stations,
    f"""
    SELECT {columns_of(Frequency.DAILY)} FROM daily
    WHERE station NOT IN (SELECT station FROM stations WHERE elevation >= 100)
    """,
    ("daily", "stations"),
)
register(
    "store_drop_all",
    store_drop_all,
    "SELECT station, 'daily' AS frequency FROM daily WHERE station IS NULL",
    ("daily",),
)


def store_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early rows, a refresh of what is stale, a dropped station; then one commit in other buckets."""
    store = _store(spark)
    store.append(
        view(spark, sf_dir, "daily").filter(F.col("date") < F.lit(STORED_BEFORE)), Frequency.DAILY, WRITTEN
    )
    store.refresh(
        _landing(spark, sf_dir, Frequency.DAILY), Frequency.DAILY, _daily_needs(spark, sf_dir), TODAY
    )
    store.drop_station(Frequency.DAILY, ONE_STATION)
    store.compact(Frequency.DAILY, buckets=3)
    store.vacuum(Frequency.DAILY)
    return Store(spark, store.root).scan(Frequency.DAILY).drop(*schemas.LAYOUT)


register(
    "store_compact",
    store_compact,
    f"""
    , {NEEDED_SQL}
    SELECT {columns_of(Frequency.DAILY)} FROM daily
    WHERE station <> '{ONE_STATION}' AND (date < DATE '1998-01-01' OR station IN (
      SELECT station FROM needed
      WHERE end_date > DATE '2024-01-19'
        OR station NOT IN (SELECT station FROM daily WHERE date < DATE '1998-01-01')))
    """,
    ("daily", "period_requests", "requests"),
)


#: Stations whose landed file is spoilt before it is ingested, and how.
SPOILT = {
    "000000001": "no gzip stream",
    "000000002": "a gzip stream that ends early",
    "000000003": "a line does not fit",
    "000000004": "a line does not fit",
}


def _spoil(spark: SparkSession, landing: str) -> None:
    """Files in plain text, cut short, with a short row, and with text in place of a number."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = bulk.landed_files(spark, landing).filter(F.col("station").isin(*SPOILT))
    contents = spark.read.format("binaryFile").load([row.path for row in files.collect()])
    for row in contents.select(bulk.station_of_path(F.col("path")).alias("station"), "path", "content").collect():
        lines = gzip.decompress(bytes(row.content))
        spoilt = {
            "000000001": lines,
            "000000002": bytes(row.content)[:-20],
            "000000003": gzip.compress(lines + b"2001-01-01,1.0\n"),
            "000000004": gzip.compress(lines + b"2001-01-01,x,,,,,,,,,\n"),
        }[row.station]
        path = hadoop.Path(row.path)
        stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
        stream.write(bytearray(spoilt))
        stream.close()


def ingest_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stored of every station, and why the others were left out."""
    landing = _landing(spark, sf_dir, Frequency.DAILY)
    _spoil(spark, landing)
    store = _store(spark)
    store.ingest(landing, Frequency.DAILY, WRITTEN)
    store.ingest(landing, Frequency.DAILY, TODAY)  # adds nothing, and no second row to the rejects
    stored = store.scan(Frequency.DAILY).groupBy("station").agg(F.count("*").alias("n_rows"))
    left_out = store.rejects().select("station", F.lit(0).cast("bigint").alias("n_rows"), "reason")
    return stored.withColumn("reason", F.lit(None).cast("string")).unionByName(left_out)


register(
    "ingest_with_rejects",
    ingest_with_rejects,
    f"""
    , spoilt(station, reason) AS (VALUES {", ".join(f"('{s}', '{r}')" for s, r in SPOILT.items())})
    SELECT station, CASE WHEN reason IS NULL THEN count(*) ELSE 0 END AS n_rows, reason
    FROM daily LEFT JOIN spoilt USING (station) GROUP BY station, reason
    """,
    ("daily",),
)


def hourly_range_via_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a range over the end of a year, from the folders of its years."""
    store = _store(spark)
    store.append(view(spark, sf_dir, "hourly"), Frequency.HOURLY, WRITTEN)
    frame = WeatherLake(spark, store.root).hourly().all()
    return frame.get_range("2023-12-30", dt.datetime(2024, 1, 10, 12, 30)).df


register(
    "hourly_range_via_store",
    hourly_range_via_store,
    f"""
    SELECT {columns_of(Frequency.HOURLY)} FROM hourly
    WHERE datetime >= TIMESTAMP '2023-12-30 00:00:00' AND datetime <= TIMESTAMP '2024-01-10 12:30:00'
    """,
    ("hourly",),
)


def requirement_end_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period texts read as requirements: a day, a range of a month, a full year, or any."""
    period = F.col("period")
    start, end = date_bounds(period)
    needs = view(spark, sf_dir, "period_requests").select(
        "request_id",
        F.when(end.isNull(), "any")
        .when(F.length(period) == 4, "full_year")
        .when(F.length(period) == 7, "date_range")
        .otherwise("specific_date")
        .alias("kind"),
        start.alias("date"),
        end.alias("end"),
        F.when(F.length(period) == 4, period).try_cast("int").alias("year"),
    )
    return with_end_date(needs).select("request_id", "kind", "end_date")


register(
    "requirement_end_dates",
    requirement_end_dates,
    """
    SELECT request_id,
      CASE WHEN period = 'soon' OR period = '2023-13' THEN 'any'
        WHEN length(period) = 4 THEN 'full_year'
        WHEN length(period) = 7 THEN 'date_range' ELSE 'specific_date' END AS kind,
      CASE WHEN period = 'soon' OR period = '2023-13' THEN NULL
        WHEN length(period) = 4 THEN TRY_CAST(period || '-12-31' AS date)
        WHEN length(period) = 7 THEN last_day(TRY_CAST(period || '-01' AS date))
        ELSE TRY_CAST(period AS date) END AS end_date
    FROM period_requests
    """,
    ("period_requests",),
)

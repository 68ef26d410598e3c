"""Bulk files, the catalogue, the store and the front door, on files written by hand."""

import datetime as dt
import gzip
import json
import tempfile
import uuid
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stationlake import (
    Frequency,
    LatLon,
    NoDataForNearbyStations,
    NoDataForStation,
    NoStationWithinRadius,
    NoSuchStore,
    RequiredData,
    Store,
    UnreadableFile,
    WeatherLake,
    Year,
    schemas,
    stale_stations,
)
from stationlake.scratch import scratch_folder
from stationlake.sources import bulk
from stationlake.sources import store as store_module
from stationlake.sources.catalogue import scan_catalogue, station_name

D, T = dt.date, dt.datetime
DAILY, HOURLY = Frequency.DAILY, Frequency.HOURLY


def land(folder, frequency, station, text):
    target = folder / frequency.value
    target.mkdir(parents=True, exist_ok=True)
    (target / f"{station}.csv.gz").write_bytes(gzip.compress(text.encode()))
    return str(target)


def days(first, n, tavg=1.0):
    start = D.fromisoformat(first)
    return "".join(f"{start + dt.timedelta(days=i)},{tavg},,,,,,,,,\n" for i in range(n))


# -- bulk files


def test_hourly_file(spark, tmp_path):
    folder = land(
        tmp_path,
        HOURLY,
        "07147",
        "2023-09-01,0,12.7,12.1,96.0,0.0,,150.0,7.2,9.3,1011.5,,4.0\n"
        "2023-09-01,23,,,3.9,,-3.9,NaN,,,,1e30,\n"
        "bad,5,1.5,,,,,,,,,,\n"
        "2023-1-5,5,2.5,,,,,,,,,,\n",
    )
    df = bulk.scan(spark, HOURLY, folder)
    assert df.columns == list(schemas.table_columns(HOURLY)) and len(df.columns) == 15
    assert dict(df.dtypes) == schemas.table_columns(HOURLY)
    conditions = ("hour = 0", "hour = 23", "date = 'bad'", "date = '2023-1-5'")
    first, second, bad, short = (df.filter(condition).first() for condition in conditions)
    assert first.station == "07147" and first.datetime == T(2023, 9, 1)
    assert (first.rhum, first.wdir, first.coco, first.tsun) == (96, 150, 4, None)
    assert second.datetime == T(2023, 9, 1, 23)
    assert (second.rhum, second.snow, second.wdir, second.tsun) == (3, -3, None, None)
    assert bad.datetime is None and bad.temp == 1.5
    assert short.datetime is None


ACTIONS = {
    "all": lambda df: df.collect(),
    "one column": lambda df: df.select("tavg").collect(),
    "count": lambda df: df.count(),
}


@pytest.mark.parametrize(
    "line, noticed",
    [
        ("2020-01-01,1.0\n", ["all", "one column", "count"]),
        ("2020-01-01" + "," * 14 + "\n", ["all", "one column", "count"]),
        # A field is parsed when its column is asked for.
        ("2020-01-01,x,,,,,,,,,\n", ["all", "one column"]),
    ],
    ids=["short", "long", "no number"],
)
def test_malformed_rows(spark, tmp_path, line, noticed):
    folder = land(tmp_path, DAILY, "00001", days("2020-01-01", 3) + line)
    for action in noticed:
        with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED"):
            ACTIONS[action](bulk.scan(spark, DAILY, folder))
    assert len(bulk.scan(spark, DAILY, folder, mode="DROPMALFORMED").collect()) == 3


def test_monthly_and_climate_files(spark, tmp_path):
    months = land(tmp_path, Frequency.MONTHLY, "10384", "2020,1,1.5,,,3.0,,,12.0\n")
    row = bulk.scan(spark, Frequency.MONTHLY, months).first()
    assert (row.station, row.year, row.month, row.tavg, row.tsun) == ("10384", 2020, 1, 1.5, 12)
    normals = land(tmp_path, Frequency.CLIMATE, "10384", "1991,2020,11,2.5,7.5,,,,60.0\n")
    row = bulk.scan(spark, Frequency.CLIMATE, normals).first()
    assert (row.start_year, row.end_year, row.month, row.tmax, row.tsun) == (1991, 2020, 11, 7.5, 60)


# -- catalogue


def station(name, lat, lon, **inventory):
    return {
        "id": name,
        "country": "DE",
        "region": None,
        "timezone": "Europe/Berlin",
        "name": {"en": f"Station {name}"},
        "identifiers": {"national": None, "wmo": name, "icao": None},
        "location": {"latitude": lat, "longitude": lon, "elevation": None},
        "inventory": {
            kind: inventory.get(kind, {"start": None, "end": None})
            for kind in ("daily", "hourly", "model", "monthly", "normals")
        },
    }


SPAN = {"start": "2000-01-01", "end": "2024-12-31"}
STATIONS = [
    station("07147", 48.0, 8.0, daily=SPAN, hourly=SPAN),
    station("10384", 48.1, 8.0, daily=SPAN, normals={"start": 1991, "end": 2020}),
    station("10637", 48.2, 8.0, daily=SPAN),
]


def write_catalogue(folder, stations=STATIONS):
    path = folder / "stations.json.gz"
    path.write_bytes(gzip.compress(json.dumps(stations).encode()))
    return str(path)


def test_catalogue(spark, tmp_path):
    df = scan_catalogue(spark, write_catalogue(tmp_path))
    first, second, _ = df.orderBy("id").collect()
    assert first.id == "07147" and first.inventory.daily.start == D(2000, 1, 1)
    assert first.location.elevation is None and first.identifiers.wmo == "07147"
    assert (second.inventory.normals.start, second.inventory.monthly.end) == (1991, None)
    names = df.select(station_name("en").alias("en"), station_name("de").alias("de")).first()
    assert names.en == "Station 07147" and names.de is None


# -- store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), buckets=4)


def tavg(store, frequency=DAILY):
    rows = store.scan(frequency).groupBy("station").agg(F.max("tavg"), F.count("*")).collect()
    return {row[0]: (row[1], row[2]) for row in rows}


def written(store):
    return {(row.station, row.frequency): row.written_on for row in store.status().collect()}


def needs(spark, *rows):
    return spark.createDataFrame(
        [(s, "daily", d) for s, d in rows], "station string, frequency string, end_date date"
    )


def test_an_empty_store(store):
    assert store.scan(DAILY).isEmpty() and store.status().isEmpty() and store.stations().isEmpty()
    assert store.scan_station(DAILY, "07147").isEmpty()


def test_ingest_adds_what_is_missing(spark, store, tmp_path):
    folder = land(tmp_path, DAILY, "07147", days("2020-01-01", 3, 1.0))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    land(tmp_path, DAILY, "07147", days("2020-01-01", 9, 5.0))
    land(tmp_path, DAILY, "10384", days("2020-01-01", 4, 2.0))
    land(tmp_path, DAILY, "empty", "")
    store.ingest(folder, DAILY, D(2020, 3, 1))
    store.ingest(folder, DAILY, D(2020, 4, 1))
    assert tavg(store) == {"07147": (1.0, 3), "10384": (2.0, 4)}
    assert written(store) == {("07147", "daily"): D(2020, 2, 1), ("10384", "daily"): D(2020, 3, 1)}
    assert store.scan_station(DAILY, "07147").columns == list(schemas.table_columns(DAILY))
    assert store.scan_station(DAILY, "07147").count() == 3


def test_malformed_stations_are_left_out(spark, store, tmp_path):
    good = days("2020-01-01", 3, 1.0)
    land(tmp_path, DAILY, "good", good)
    land(tmp_path, DAILY, "short", good + "2020-01-09,1.0\n2020-01-10,1.0\n")
    land(tmp_path, DAILY, "long", good + "2020-01-09" + "," * 14 + "\n")
    folder = land(tmp_path, DAILY, "text", good + "2020-01-09,x,,,,,,,,,\n")
    store.ingest(folder, DAILY, D(2020, 2, 1))
    assert tavg(store) == {"good": (1.0, 3)}
    assert written(store) == {("good", "daily"): D(2020, 2, 1)}
    rejects = {row.station: row for row in store.rejects().collect()}
    assert set(rejects) == {"short", "long", "text"}
    short = rejects["short"]
    assert (short.frequency, short.line, short.lines) == ("daily", "2020-01-09,1.0", 2)
    assert short.path.endswith("/short.csv.gz") and short.seen_on == D(2020, 2, 1)
    # Once the file is mended the station is stored.
    land(tmp_path, DAILY, "short", days("2020-01-01", 4, 2.0))
    store.ingest(folder, DAILY, D(2020, 3, 1))
    assert tavg(store) == {"good": (1.0, 3), "short": (2.0, 4)}
    # A stale station whose new file is malformed keeps its rows; strict fails.
    land(tmp_path, DAILY, "good", days("2020-01-01", 5, 3.0) + "2020-01-09,1.0\n")
    asked = needs(spark, ("good", D(2020, 2, 2)))
    store.refresh(folder, DAILY, asked, D(2020, 4, 1))
    assert tavg(store)["good"] == (1.0, 3)
    with pytest.raises(UnreadableFile, match="a line does not fit"):
        store.refresh(folder, DAILY, asked, D(2020, 4, 1), strict=True)


def test_broken_files_cost_their_own_station(spark, store, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(store_module, "scratch_folder", lambda _, name: f"{scratch}/{name}-{uuid.uuid4().hex}")
    good = days("2020-01-01", 3, 1.0)
    land(tmp_path, DAILY, "good", good)
    land(tmp_path, DAILY, "short", good + "2020-01-09,1.0\n")
    folder = land(tmp_path, DAILY, "more", good)
    landed = tmp_path / DAILY.value
    whole = gzip.compress(days("2020-01-01", 3000).encode())
    (landed / "plain.csv.gz").write_bytes(good.encode())
    (landed / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    (landed / "damaged.csv.gz").write_bytes(whole[:900] + b"\x00" * 200 + whole[1100:])
    (landed / "members.csv.gz").write_bytes(gzip.compress(good.encode()) + gzip.compress(days("2021-01-01", 2).encode()))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    assert tavg(store) == {"good": (1.0, 3), "more": (1.0, 3), "members": (1.0, 5)}
    assert {row.station: row.reason for row in store.rejects().collect()} == {
        "short": "a line does not fit",
        "plain": "no gzip stream",
        "cut": "a gzip stream that ends early",
        "damaged": "a damaged gzip stream",
    }
    # A rejected file is not read again as long as it stays as it is.
    monkeypatch.setattr(bulk, "scan_checked", None)
    store.ingest(folder, DAILY, D(2020, 3, 1))
    assert store.rejects().count() == 4
    monkeypatch.undo()
    (landed / "plain.csv.gz").write_bytes(gzip.compress(good.encode()))
    store.ingest(folder, DAILY, D(2020, 3, 1))
    assert tavg(store)["plain"] == (1.0, 3) and store.rejects().count() == 4
    assert not scratch.exists() or not list(scratch.iterdir())
    with pytest.raises(UnreadableFile, match="ends early"):
        only = spark.createDataFrame([("cut",)], "station string")
        store.ingest(folder, DAILY, D(2020, 4, 1), only=only, strict=True)


def test_many_paths_are_looked_at_in_few_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    count = 40 + bulk.LISTING_TASKS * cores
    for i in range(count):
        folder = land(tmp_path, DAILY, f"s{i}", days("2020-01-01", 1))
    paths, tracker = [str(p) for p in Path(folder).iterdir()], spark.sparkContext.statusTracker()
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    for read in (lambda: bulk.scan_checked(spark, DAILY, paths), lambda: bulk.broken_files(spark, paths)):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "listing")
        try:
            read()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
        tasks = [tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
        assert tasks and max(tasks) <= bulk.LISTING_TASKS * cores
    assert spark.conf.get(name) == before
    assert bulk.scan_checked(spark, DAILY, paths).select("station").distinct().count() == count


def test_landed_files_are_looked_at_once(spark, store, tmp_path, monkeypatch):
    """Also when a broken file makes the others be read again, and another has a line that does not fit."""
    good = days("2020-01-01", 3)
    land(tmp_path, DAILY, "good", good)
    land(tmp_path, DAILY, "short", good + "2020-01-09,1.0\n")
    folder = land(tmp_path, DAILY, "more", good)
    (tmp_path / DAILY.value / "plain.csv.gz").write_bytes(good.encode())
    log, landed_files = str(tmp_path / "looked"), bulk.landed_files

    def look(batches):
        for batch in batches:
            with open(log, "a") as file:
                file.write("x" * batch.num_rows)
            yield batch

    def counted(spark, landing):
        files = landed_files(spark, landing)
        return files.mapInArrow(look, files.schema)

    monkeypatch.setattr(bulk, "landed_files", counted)
    store.ingest(folder, DAILY, D(2020, 2, 1))
    assert tavg(store) == {"good": (1.0, 3), "more": (1.0, 3)} and store.rejects().count() == 2
    assert Path(log).stat().st_size == 4


def test_rows_of_a_lost_job_do_not_count(spark, store, tmp_path):
    folder = land(tmp_path, DAILY, "07147", days("2020-01-01", 3, 1.0))
    # A job that was lost after the rows and the log, before the manifest.
    rows = store._write_rows(bulk.scan(spark, DAILY, folder), DAILY, "lost")
    store._write_log(rows.select("station").distinct().withColumn("written_on", F.lit(D(2020, 1, 1))), DAILY, "lost")
    assert store.status().isEmpty() and store.scan(DAILY).isEmpty()
    store.ingest(folder, DAILY, D(2020, 2, 1))
    assert tavg(store) == {"07147": (1.0, 3)}


def test_a_store_has_to_be_laid_out(spark, tmp_path):
    with pytest.raises(NoSuchStore):
        Store(spark, str(tmp_path / "mistyped"))
    assert not (tmp_path / "mistyped").exists()
    Store(spark, str(tmp_path / "new"), buckets=3)
    assert Store(spark, str(tmp_path / "new")).buckets == 3


def files_of(store, frequency=DAILY):
    return {str(p): p.stat().st_mtime_ns for p in Path(store.path(frequency)).rglob("*.parquet")}


def stations_in(spark, paths):
    return {row.station for row in spark.read.parquet(*paths).select("station").distinct().collect()}


def test_refresh_touches_no_other_station(spark, store, tmp_path):
    for name in ("a", "b", "c", "d", "e"):
        folder = land(tmp_path, DAILY, name, days("2019-12-30", 4, 1.0))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    before = files_of(store)
    land(tmp_path, DAILY, "b", days("2019-12-30", 6, 2.0))
    store.refresh(folder, DAILY, needs(spark, ("b", D(2020, 3, 1))), today=D(2020, 4, 1))
    after = files_of(store)
    assert before.items() <= after.items()
    assert stations_in(spark, set(after) - set(before)) == {"b"}
    assert tavg(store) == {"a": (1.0, 4), "b": (2.0, 6), "c": (1.0, 4), "d": (1.0, 4), "e": (1.0, 4)}
    assert store.scan_station(DAILY, "b").count() == 6
    store.drop_station(DAILY, "c")
    assert files_of(store) == after and set(tavg(store)) == set("abde")
    store.ingest(folder, DAILY, D(2020, 5, 1))  # c comes back, after it was dropped
    assert tavg(store)["c"] == (1.0, 4) and written(store)["c", "daily"] == D(2020, 5, 1)


def test_compaction(spark, store, tmp_path):
    for name in ("a", "b", "c", "d"):
        folder = land(tmp_path, DAILY, name, days("2019-12-30", 4, 1.0))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    land(tmp_path, DAILY, "b", days("2019-12-30", 6, 2.0))
    store.refresh(folder, DAILY, needs(spark, ("b", D(2020, 3, 1))), today=D(2020, 4, 1))
    store.drop_station(DAILY, "c")
    rows, status = tavg(store), written(store)
    assert len(store.live(DAILY)) == 3
    store.compact(DAILY, buckets=2)
    (one,) = store.live(DAILY)
    assert (one.kind, one.buckets, store.buckets) == ("compact", 2, 2)
    assert tavg(store) == rows and written(store) == status
    assert store.scan(DAILY).agg(F.max("bucket")).first()[0] <= 1
    assert Store(spark, store.root).buckets == 2
    assert store.scan_station(DAILY, "b").count() == 6
    assert len(store.vacuum(DAILY)) == 3 and store.vacuum(DAILY) == []
    folders = {p.name for p in Path(store.path(DAILY)).iterdir() if p.is_dir()}
    assert folders == {f"commit={one.commit}"}
    assert tavg(store) == rows and written(store) == status
    store.compact(DAILY)  # nothing to do
    assert store.live(DAILY) == [one]


def test_writers_at_the_same_time(spark, store, tmp_path):
    first, second = store, Store(spark, store.root)
    a = bulk.scan(spark, DAILY, land(tmp_path / "one", DAILY, "a", days("2020-01-01", 2, 1.0)))
    land(tmp_path / "two", DAILY, "a", days("2020-01-01", 3, 2.0))
    both = bulk.scan(spark, DAILY, land(tmp_path / "two", DAILY, "b", days("2020-01-01", 3, 2.0)))
    seen = store.live(DAILY)  # both writers decide before either has published
    first._commit(a, DAILY, D(2020, 2, 1), "append", seen)
    second._commit(both, DAILY, D(2020, 3, 1), "append", seen)
    # The later one has the station as a whole, in rows and status alike.
    assert tavg(first) == tavg(second) == {"a": (2.0, 3), "b": (2.0, 3)}
    assert set(written(first).values()) == {D(2020, 3, 1)}
    # Also if both have taken the same version: then the ids say who is later, to all readers.
    base = store._base(store.live(DAILY))
    for commit, station, n in (("x1", "a", 5), ("x2", "a", 6)):
        rows = bulk.scan(spark, DAILY, land(tmp_path / commit, DAILY, station, days("2020-01-01", n, 3.0)))
        stored = store._write_rows(rows, DAILY, commit)
        store._write_log(stored.select("station").distinct().withColumn("written_on", F.lit(D(2020, 4, 1))), DAILY, commit)
    store._publish("x2", DAILY, "refresh", base, base + 1)
    store._publish("x1", DAILY, "refresh", base, base + 1)
    assert tavg(first)["a"] == tavg(second)["a"] == (3.0, 6)


def test_a_commit_made_during_a_compaction_stays(spark, store, tmp_path, monkeypatch):
    for name in ("a", "b"):
        folder = land(tmp_path, DAILY, name, days("2020-01-01", 3, 1.0))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    land(tmp_path, DAILY, "a", days("2020-01-01", 5, 2.0))
    other = Store(spark, store.root)
    publish = store._publish

    def late(*arguments):
        other.refresh(folder, DAILY, needs(spark, ("a", D(2020, 3, 1))), today=D(2020, 4, 1))
        publish(*arguments)

    monkeypatch.setattr(store, "_publish", late)
    store.compact(DAILY, buckets=7)
    assert tavg(store) == tavg(Store(spark, store.root)) == {"a": (2.0, 5), "b": (1.0, 3)}
    assert Store(spark, store.root).scan_station(DAILY, "a").count() == 5
    assert written(store)["a", "daily"] == D(2020, 4, 1)


def test_refresh_rewrites_stale_stations_only(spark, store, tmp_path):
    names = [f"{i:05d}" for i in range(12)]
    for name in names:
        folder = land(tmp_path, DAILY, name, days("2020-01-01", 3, 1.0))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    for name in names:
        land(tmp_path, DAILY, name, days("2020-01-01", 5, 2.0))
    land(tmp_path, DAILY, "00003", "")
    asked = needs(
        spark,
        ("00001", D(2020, 2, 2)),  # after the rows were written: stale
        ("00002", D(2020, 2, 1)),  # the day they were written: fresh
        ("00003", D(2020, 2, 2)),  # stale, but the file is empty
        ("00004", D(2031, 1, 1)),  # still to come: fresh
        ("00005", None),  # any data will do
        ("99999", D(2020, 2, 2)),  # stale, but there is no file
    )
    store.refresh(folder, DAILY, asked, today=D(2020, 3, 1))
    found = tavg(store)
    assert found.pop("00001") == (2.0, 5)
    assert set(found.values()) == {(1.0, 3)} and len(found) == 11
    status = written(store)
    assert status.pop(("00001", "daily")) == D(2020, 3, 1)
    assert set(status.values()) == {D(2020, 2, 1)}


def test_staleness(spark):
    status = spark.createDataFrame(
        [("old", "daily", D(2024, 1, 5)), ("old", "hourly", D(2024, 3, 1))],
        "station string, frequency string, written_on date",
    )

    def stale(*rows):
        found = stale_stations(needs(spark, *rows), status, D(2024, 2, 1)).collect()
        return {row.station for row in found}

    assert stale(("old", D(2024, 1, 5))) == set()
    assert stale(("old", D(2024, 1, 6))) == {"old"}
    assert stale(("old", D(2024, 2, 1))) == {"old"}
    assert stale(("old", D(2024, 2, 2))) == set()
    assert stale(("old", D(2024, 2, 2)), ("old", D(2024, 1, 20))) == {"old"}
    assert stale(("old", None), ("never", None)) == set()
    assert stale(("never", D(1999, 1, 1))) == {"never"}


def test_drop(spark, store, tmp_path):
    for name in ("a", "b", "c", "d", "e"):
        folder = land(tmp_path, DAILY, name, days("2020-01-01", 3))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    store.drop_station(DAILY, "a")
    assert set(tavg(store)) == {"b", "c", "d", "e"} == {s for s, _ in written(store)}
    store.drop_station(DAILY, "never there")
    everyone = spark.createDataFrame([(s,) for s in "bcde"], "station string")
    store.drop_stations(DAILY, everyone)  # leaves buckets without any row
    assert tavg(store) == {} == written(store)
    store.ingest(folder, DAILY, D(2020, 5, 1))
    assert len(tavg(store)) == 5
    store.drop_all()
    assert tavg(store) == {} == written(store)
    store.ingest(folder, DAILY, D(2020, 6, 1))
    assert len(tavg(store)) == 5 and set(written(store).values()) == {D(2020, 6, 1)}


def test_a_store_keeps_its_number_of_buckets(spark, store, tmp_path):
    folder = land(tmp_path, DAILY, "07147", days("2020-01-01", 3))
    store.ingest(folder, DAILY, D(2020, 2, 1))
    again = Store(spark, store.root, buckets=32)
    assert again.buckets == 4 and again.scan_station(DAILY, "07147").count() == 3


def test_catalogue_table(spark, store, tmp_path):
    store.rebuild_catalogue(write_catalogue(tmp_path))
    assert store.stations().count() == 3
    store.rebuild_catalogue(write_catalogue(tmp_path, STATIONS[:1]))
    assert [row.id for row in store.stations().collect()] == ["07147"]
    store.clear_catalogue()
    assert store.stations().isEmpty()


class Session:
    """A session of which only the settings matter."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_scratch_folder():
    shared = Session(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/")
    assert scratch_folder(shared, "x").startswith("hdfs://shared/x-")
    assert scratch_folder(shared, "x") != scratch_folder(shared, "x")
    assert scratch_folder(Session(spark_master="local[2]"), "x").startswith(tempfile.gettempdir())
    with pytest.raises(ValueError):
        scratch_folder(Session(spark_master="yarn"), "x")


# -- front door


@pytest.fixture
def lake(spark, tmp_path):
    lake = WeatherLake(
        spark, str(tmp_path / "lake"), str(tmp_path / "landing"), today=D(2024, 6, 1), buckets=4
    )
    landing = tmp_path / "landing"
    land(landing, DAILY, "10384", days("2023-12-01", 60, 4.0))
    land(landing, DAILY, "10637", days("2023-12-01", 60, 6.0))
    land(landing, HOURLY, "07147", "2024-01-10,14,3.5,,81.0,,,,,,,,7.0\n")
    land(landing, Frequency.CLIMATE, "10384", "1991,2020,11,2.5,7.5,,,,60.0\n")
    lake.rebuild_station_list(write_catalogue(tmp_path))
    return lake


HERE = LatLon(48.0, 8.0)


def test_station(lake):
    frame = lake.daily().station("10384").get_for_period(Year(2023))
    assert frame.df.count() == 31
    assert set(written(lake.store)) == {("10384", "daily")}
    with pytest.raises(NoDataForStation):
        lake.daily().station("07147")


def test_station_is_refreshed_when_stale(lake, tmp_path):
    assert lake.daily().station("10384").df.count() == 60
    land(tmp_path / "landing", DAILY, "10384", days("2023-12-01", 70, 4.0))
    assert lake.daily().station("10384").df.count() == 60
    lake._today = D(2024, 7, 1)
    needed = RequiredData.specific_date(D(2024, 6, 15))
    assert lake.daily().station("10384", needed).df.count() == 70


def test_location_falls_back_to_a_station_with_data(lake):
    # The nearest station with a daily inventory, 07147, has no daily file.
    with pytest.raises(NoDataForNearbyStations) as error:
        lake.daily().location(HERE)
    assert error.value.stations_tried == 1
    record = lake.daily().location(HERE, station_limit=3).get_at("2024-01-05").single_record()
    assert (record.station, record.average_temperature) == ("10384", 4.0)
    with pytest.raises(NoStationWithinRadius):
        lake.daily().location(LatLon(0.0, 0.0))
    with pytest.raises(NoStationWithinRadius):
        lake.daily().location(HERE, RequiredData.full_year(1980), station_limit=3)
    with pytest.raises(NoStationWithinRadius):
        lake.monthly().location(HERE, station_limit=3)
    hour = lake.hourly().location(HERE).get_at("2024-01-10 13:45:00").single_record()
    assert (hour.temperature, hour.relative_humidity, hour.condition) == (3.5, 81, "LightRain")
    november = lake.climate().location(HERE).get_at(Year(1991), Year(2020), 11).single_record()
    assert november.maximum_temperature == 7.5


def test_location_passes_over_a_file_that_cannot_be_read(lake, tmp_path):
    land(tmp_path / "landing", DAILY, "07147", "2024-01-05,1.0\n")  # nearest, fields missing
    record = lake.daily().location(HERE, station_limit=3).get_at("2024-01-05").single_record()
    assert (record.station, record.average_temperature) == ("10384", 4.0)
    with pytest.raises(NoDataForNearbyStations) as error:
        lake.daily().location(HERE)
    assert error.value.__cause__ is not None


def test_tables_of_requests_use_stored_rows_only(spark, lake, tmp_path):
    lake.ingest(DAILY)
    land(tmp_path / "landing", DAILY, "07147", days("2023-12-01", 60, 9.0))  # nearer, not ingested
    wanted = spark.createDataFrame([(1, 48.0, 8.0, D(2024, 1, 5))], "request_id long, lat double, lon double, day date")
    assert [r.station for r in lake.daily().at(wanted, "day", station_limit=3).collect()] == ["10384"]
    lake.ingest(DAILY)
    assert [r.station for r in lake.daily().at(wanted, "day", station_limit=3).collect()] == ["07147"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_instants_do_not_follow_the_session_zone(spark, lake, zone, kind):
    lake.ingest(HOURLY)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = "timestamp_ntz'2024-01-10 13:40:00'" if kind == "timestamp_ntz" else "timestamp'2024-01-10 13:40:00Z'"
        wanted = spark.range(1).selectExpr("1L AS request_id", "48.0D AS lat", "8.0D AS lon", f"{text} AS at_time")
        assert [r.temp for r in lake.hourly().at(wanted, "at_time").collect()] == [3.5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_find_stations(lake):
    found = lake.find_stations(HERE, DAILY, RequiredData.any(), station_limit=2)
    assert [row.station.id for row in found.orderBy("rank").collect()] == ["07147", "10384"]
    assert lake.find_stations((0.0, 0.0), max_distance_km=1.0).isEmpty()


def test_tables_of_requests(spark, lake):
    for frequency in (DAILY, HOURLY, Frequency.CLIMATE):
        lake.ingest(frequency)
    rows = [
        (1, 48.0, 8.0, D(2023, 12, 24), "2023-12"),
        (2, 48.2, 8.0, D(2024, 1, 10), "2024-01-10"),
        (3, 48.2, 8.0, D(2025, 1, 10), "2024-13"),
        (4, 0.0, 0.0, D(2024, 1, 10), "2024"),
    ]
    wanted = spark.createDataFrame(
        rows, "request_id bigint, lat double, lon double, day date, period string"
    )
    found = lake.daily().at(wanted, "day", station_limit=3).orderBy("request_id").collect()
    assert [(r.request_id, r.station, r.tavg) for r in found] == [(1, "10384", 4.0), (2, "10637", 6.0)]
    periods = lake.daily().for_periods(wanted, station_limit=3)
    counts = {r[0]: r[1] for r in periods.groupBy("request_id").count().collect()}
    assert counts == {1: 31, 2: 1}
    normals = lake.climate().at(
        wanted,
        {
            "start_year": F.lit(1991).cast("bigint"),
            "end_year": F.lit(2020).cast("bigint"),
            "month": F.lit(11).cast("bigint"),
        },
    )
    assert {r.request_id for r in normals.collect()} == {1, 2, 3}


def test_outcomes_of_requests(spark, lake):
    lake.ingest(DAILY)
    rows = [
        (1, 48.0, 8.0, D(2024, 1, 5), "2024-01"),
        (1, 48.2, 8.0, D(2024, 1, 10), "2024-01-10"),  # shares an id
        (1, 48.2, 8.0, D(2024, 1, 10), "2024-01-10"),  # and comes twice
        (2, 48.0, 8.0, D(2025, 1, 5), "2025"),
        (3, 48.0, 8.0, None, "soon"),
        (4, 0.0, 0.0, D(2024, 1, 5), "2024"),
        (5, None, 8.0, D(2024, 1, 5), "2024"),
    ]
    wanted = spark.createDataFrame(
        rows, "request_id bigint, lat double, lon double, day date, period string"
    )
    for found, bad in (
        (lake.daily().at_outcomes(wanted, "day", station_limit=3), "bad_time"),
        (lake.daily().period_outcomes(wanted, station_limit=3), "bad_period"),
    ):
        assert sorted((r.request_id, r.station or "", r.status) for r in found.collect()) == [
            (1, "10384", "ok"),
            (1, "10637", "ok"),
            (1, "10637", "ok"),
            (2, "10384", "no_row"),
            (3, "10384", bad),
            (4, "", "no_station"),
            (5, "", "no_station"),
        ]
    near = lake.daily().at_outcomes(wanted.filter("request_id = 4 OR lat = 48.0D"), "day")
    assert {r.request_id: r.status for r in near.collect()} == {1: "no_data", 2: "no_data", 3: "bad_time", 4: "no_station"}
    assert lake.daily().at(wanted.filter("request_id = 1"), "day", station_limit=3).count() == 3


def test_clearing(lake, tmp_path):
    lake.daily().station("10384")
    lake.daily().station("10637")
    lake.clear_weather_of_station("10384", DAILY)
    assert set(written(lake.store)) == {("10637", "daily")}
    lake.clear_weather()
    assert written(lake.store) == {} and lake.store.stations().count() == 3
    lake.clear()
    assert lake.store.stations().isEmpty()
    lake.clear_and_rebuild(write_catalogue(tmp_path))
    assert lake.store.stations().count() == 3


def test_bulk_files_take_no_folder_per_station(spark, tmp_path):
    """Stations with odd names, one of them null, come back with all rows as they did; folders are those of tasks."""
    names = [*(f"{i:03d}" for i in range(40)), "a:b/c", "_x", ".y", None]
    rows = [(name, 2001 + year, 1, *[float(year), None] * 3, 1.0) for name in names for year in range(3)]
    columns = schemas.FILE_COLUMNS[Frequency.MONTHLY]
    table = spark.createDataFrame(rows, schemas.ddl({"station": "string"} | columns))
    landing = f"{tmp_path}/landing"
    bulk.write_files(table, Frequency.MONTHLY, landing)
    found = bulk.scan(spark, Frequency.MONTHLY, landing).groupBy("station").count().collect()
    assert {row.station: row["count"] for row in found} == dict.fromkeys(
        [*names[:40], "a%253Ab%252Fc", "_x", ".y", "__HIVE_DEFAULT_PARTITION__"], 3
    )
    folders = {path.parent for path in (tmp_path / "landing").rglob("0*.csv.gz")}
    assert len(folders) <= spark.sparkContext.defaultParallelism
    with pytest.raises(FileExistsError):
        bulk.write_files(table, Frequency.MONTHLY, landing)

"""The grid join against brute force, and its edges."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stationlake import Frequency, RequiredData, find_stations, nearest_stations, serving_stations
from stationlake import schemas
from stationlake.functions.geo import MAX_COPIES, Grid
from stationlake.operators import nearest

RADIUS = 6371.0


def haversine(a, b):
    lat_a, lon_a, lat_b, lon_b = map(math.radians, (*a, *b))
    h = (
        math.sin((lat_b - lat_a) / 2) ** 2
        + math.cos(lat_a) * math.cos(lat_b) * math.sin((lon_b - lon_a) / 2) ** 2
    )
    return 2 * RADIUS * math.asin(min(1.0, math.sqrt(h)))


def stations(spark, places, daily=None):
    """Catalogue of ``{id: (lat, lon)}``; ``daily`` gives inventories that differ from 2000-2020."""
    default = (dt.date(2000, 1, 1), dt.date(2020, 12, 31))
    rows = []
    for name, (lat, lon) in places.items():
        start, end = (daily or {}).get(name, default)
        rows.append(
            {
                "id": name,
                "name": {"en": f"Station {name}"},
                "location": {"latitude": float(lat), "longitude": float(lon)},
                "inventory": {"daily": {"start": start, "end": end}},
            }
        )
    return spark.createDataFrame(rows, schemas.ddl(schemas.CATALOGUE))


def requests(spark, points):
    rows = [(i, *map(float, point)) for i, point in enumerate(points)]
    return spark.createDataFrame(rows, "request_id bigint, lat double, lon double")


def result(df):
    found = {}
    for row in df.orderBy("request_id", "rank").collect():
        found.setdefault(row.request_id, []).append((row.station, row.distance_km))
    return found


def brute(places, points, k, max_km):
    expected = {}
    for i, point in enumerate(points):
        near = sorted((haversine(point, at), name) for name, at in places.items())
        near = [(name, km) for km, name in near if km <= max_km][:k]
        if near:
            expected[i] = near
    return expected


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for request, near in expected.items():
        assert [name for name, _ in found[request]] == [name for name, _ in near]
        for (_, a), (_, b) in zip(found[request], near):
            assert a == pytest.approx(b, abs=1e-7)


def spots(seed, n):
    """Points everywhere, at the poles, around the antimeridian and in one crowded place."""
    rng = random.Random(seed)
    for i in range(n):
        if i % 4 == 0:
            yield rng.uniform(-90, 90), rng.uniform(-180, 180)
        elif i % 4 == 1:
            yield rng.choice((-1, 1)) * rng.uniform(88, 90), rng.uniform(-180, 180)
        elif i % 4 == 2:
            yield rng.uniform(-60, 60), (179 + rng.uniform(0, 2) + 180) % 360 - 180
        else:
            yield 50 + rng.gauss(0, 0.2), 8 + rng.gauss(0, 0.2)


@pytest.mark.parametrize("max_km", [0.5, 50.0, 300.0, 2500.0, 12000.0, 25000.0])
@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0], ids=["broadcast", "salted"])
def test_same_as_brute_force(spark, max_km, broadcast_rows):
    places = {f"{i:05d}": spot for i, spot in enumerate(spots(1, 160))}
    points = list(spots(2, 200))
    found = nearest_stations(
        requests(spark, points),
        stations(spark, places),
        7,
        max_km,
        broadcast_rows=broadcast_rows,
    )
    assert_same(result(found), brute(places, points, 7, max_km))


def test_a_place_that_most_ask_for(spark):
    places = {f"{i:05d}": spot for i, spot in enumerate(spots(3, 80))}
    points = [(50.0, 8.0)] * 300 + list(spots(4, 60)) + [(float("nan"), 8.0)] * 40
    found = nearest_stations(
        requests(spark, points), stations(spark, places), 3, 80.0, broadcast_rows=0
    )
    expected = brute(places, points[:360], 3, 80.0)
    assert_same(result(found), expected)


def crowded_places(seed, n):
    """Most stations in a few dense places, many of them on the very same spot."""
    rng = random.Random(seed)
    for i in range(n):
        kind = i % 5
        if kind == 0:
            yield 52.0, 13.0
        elif kind in (1, 2):
            yield 52 + rng.gauss(0, 0.05), 13 + rng.gauss(0, 0.05)
        elif kind == 3:
            yield 52 + rng.gauss(0, 0.4), 13 + rng.gauss(0, 0.4)
        else:
            yield 89.9 + rng.uniform(0, 0.1), rng.uniform(-180, 180)


@pytest.mark.parametrize(
    "broadcast_rows", [1_000_000, 0], ids=["broadcast", "salted"]
)
@pytest.mark.parametrize("k", [1, 3])
def test_crowded_places(spark, k, broadcast_rows):
    places = {f"{i:05d}": spot for i, spot in enumerate(crowded_places(6, 600))}
    catalogue = stations(spark, places)
    points = list(crowded_places(7, 200)) + list(spots(8, 100)) + [(52.3, 13.3)] * 20
    found = nearest_stations(
        requests(spark, points), catalogue, k, 60.0, broadcast_rows=broadcast_rows
    )
    assert_same(result(found), brute(places, points, k, 60.0))


@pytest.mark.parametrize("broadcast_rows", [10_000_000, 0], ids=["broadcast", "salted"])
def test_bounds_save_pairs_in_crowds(spark, broadcast_rows):
    """Requests in a crowd look at some stations per wanted one, however many there are, in either branch."""
    rng = random.Random(12)

    def crowd(n):
        return [(52 + rng.gauss(0, 0.1), 13 + rng.gauss(0, 0.1)) for _ in range(n)]

    points = nearest._told_apart(requests(spark, crowd(300))).withColumns(
        dict(zip(nearest.POINT, nearest.unit_vector(F.col("lat"), F.col("lon"))))
    )
    per_request = []
    for n in (1000, 4000):
        sites = nearest._sites(stations(spark, {f"{i:05d}": at for i, at in enumerate(crowd(n))}), None)
        sites = sites.withColumns(
            dict(zip(nearest.SITE, nearest.unit_vector(F.col("site_lat"), F.col("site_lon"))))
        )
        search = nearest.Search(sites, 2, 50.0, 300, broadcast_rows, False)
        assert search.fits == bool(broadcast_rows) and len(search.grids) > 2
        cells = search.bounded(points).withColumn("cell", search.cell())
        assert cells.count() == 300
        per_request.append(cells.join(search.near(), "cell").count() / 300)
    assert max(per_request) < 150  # of 1000 and 4000
    assert per_request[1] < 2 * per_request[0]


def test_levels_get_as_fine_as_the_crowd(spark):
    """2000 stations within a few hundred metres: cells of a kilometre would pair each request with all of them."""
    rng = random.Random(13)
    crowd = [(52 + rng.random() / 300, 13 + rng.random() / 300) for _ in range(2100)]
    points = nearest._told_apart(requests(spark, crowd[2000:])).withColumns(
        dict(zip(nearest.POINT, nearest.unit_vector(F.col("lat"), F.col("lon"))))
    )
    sites = nearest._sites(stations(spark, {f"{i:05d}": at for i, at in enumerate(crowd[:2000])}), None)
    sites = sites.withColumns(dict(zip(nearest.SITE, nearest.unit_vector(F.col("site_lat"), F.col("site_lon")))))
    search = nearest.Search(sites, 2, 50.0, 100, 10_000_000, False)
    cells = search.bounded(points).withColumn("cell", search.cell())
    assert cells.join(search.near(), "cell").count() / 100 < 150


def test_no_levels_where_stations_are_sparse(spark):
    places = {f"{i:05d}": (48 + i / 10, 8.0) for i in range(60)}
    sites = nearest._sites(stations(spark, places), None).withColumns(
        dict(zip(nearest.SITE, nearest.unit_vector(F.col("site_lat"), F.col("site_lon"))))
    )
    assert len(nearest.Search(sites, 3, 50.0, 10, 1000, False).grids) == 1


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0], ids=["broadcast", "salted"])
def test_crowded_places_with_requirements_per_request(spark, broadcast_rows):
    places = {f"{i:05d}": spot for i, spot in enumerate(crowded_places(9, 400))}
    day = dt.date(2000, 1, 1)
    daily = {
        name: (day, day + dt.timedelta(days=int(name) * 37 % 2000)) for name in places
    }
    points = list(crowded_places(10, 120))
    wanted = requests(spark, points).withColumn(
        "day", F.date_add(F.lit(day), (F.col("request_id") * 53 % 2100).cast("int"))
    )
    required = RequiredData.specific_date(F.col("day"))
    found = result(
        nearest_stations(
            wanted, stations(spark, places, daily), 2, 60.0, Frequency.DAILY, required, broadcast_rows=broadcast_rows
        )
    )
    expected = {}
    for i, point in enumerate(points):
        asked = day + dt.timedelta(days=i * 53 % 2100)
        open_then = {n: at for n, at in places.items() if daily[n][1] >= asked}
        expected.update({i: near for near in brute(open_then, [point], 2, 60.0).values()})
    assert_same(found, expected)


def test_who_finds_too_few_looks_one_level_wider(spark, monkeypatch):
    """A third of the stations suit a request: none of them needs all stations of the whole radius."""
    rng = random.Random(14)
    crowd = [(52 + rng.uniform(-0.3, 0.3), 13 + rng.uniform(-0.5, 0.5)) for _ in range(1560)]
    places = {f"{i:05d}": at for i, at in enumerate(crowd[:1500])}
    day = dt.date(2000, 1, 1)
    daily = {name: (day, day + dt.timedelta(days=int(name) % 3)) for name in places}
    wanted = requests(spark, crowd[1500:]).withColumn("day", F.lit(day + dt.timedelta(days=2)))
    looked, pairs = [], nearest.Search.pairs

    def counted(self, points, condition):
        looked.append({r["level"]: r["count"] for r in points.filter("cell IS NOT NULL").groupBy("level").count().collect()})
        return pairs(self, points, condition)

    monkeypatch.setattr(nearest.Search, "pairs", counted)
    required = RequiredData.specific_date(F.col("day"))
    found = result(nearest_stations(wanted, stations(spark, places, daily), 2, 60.0, Frequency.DAILY, required))
    open_then = {n: at for n, at in places.items() if int(n) % 3 == 2}
    assert_same(found, brute(open_then, crowd[1500:], 2, 60.0))
    assert sum(looked[0].values()) == 60 and min(looked[0]) > 1
    assert looked[1] and not any(0 in levels for levels in looked)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0], ids=["broadcast", "salted"])
def test_requests_that_share_an_id(spark, broadcast_rows):
    places = {"a": (50.0, 8.0), "b": (10.0, 10.0)}
    points = [(50.0, 8.0)] * 3 + [(10.0, 10.0), (0.0, 0.0)]
    shared = requests(spark, points).withColumn("request_id", F.lit(None).cast("bigint"))
    catalogue = stations(spark, places)
    found = nearest_stations(shared, catalogue, 5, 50.0, broadcast_rows=broadcast_rows).collect()
    assert sorted((row.station, row.rank) for row in found) == [("a", 1)] * 3 + [("b", 1)]
    available = spark.createDataFrame([("a",)], "station string")
    served = serving_stations(shared, catalogue, available, Frequency.DAILY, broadcast_rows=broadcast_rows)
    assert sorted((r.station or "", r.status, r.stations_tried) for r in served.collect()) == [
        ("", "no_data", 1),
        ("", "no_station", 0),
        *[("a", "ok", 1)] * 3,
    ]


def test_every_station_has_few_copies(spark):
    places = {f"{i:05d}": spot for i, spot in enumerate(spots(5, 400))}
    places |= {"north": (90, 0), "south": (-90, 0), "almost": (89.9999, 17)}
    for radius in (1.0, 50.0, 500.0):
        sites = stations(spark, places).select("id", "location.*")
        copies = Grid.for_radius(radius).touched_cells(sites, "latitude", "longitude")
        per_station = copies.groupBy("id").agg(
            F.count("*").alias("n"), F.countDistinct("cell").alias("distinct")
        )
        for row in per_station.collect():
            assert row.n == row.distinct <= MAX_COPIES


def test_edges(spark):
    places = {
        "east": (0, 179.9),
        "west": (0, -179.9),
        "pole_a": (89.9, 0),
        "pole_b": (89.9, 180),
        "twin_b": (10, 10),
        "twin_a": (10, 10),
    }
    points = [(0, 179.95), (90, 0), (10, 10), (float("nan"), 0), (0, float("inf")), (95, 0)]
    found = result(nearest_stations(requests(spark, points), stations(spark, places)))
    assert set(found) == {0, 1, 2}
    assert [(n, round(km, 3)) for n, km in found[0]] == [("east", 5.56), ("west", 16.679)]
    assert [(n, round(km, 3)) for n, km in found[1]] == [("pole_a", 11.119), ("pole_b", 11.119)]
    assert [n for n, _ in found[2]] == ["twin_a", "twin_b"]
    null = spark.createDataFrame(
        [(1, None, 2.0)], "request_id bigint, lat double, lon double"
    )
    assert nearest_stations(null, stations(spark, places)).isEmpty()


def test_radius_is_inclusive_and_zero_finds_nothing(spark):
    places, points = {"a": (48.3, 11.2)}, [(48.1, 11.0)]
    exact = result(nearest_stations(requests(spark, points), stations(spark, places)))[0][0][1]

    def count(radius, k=5):
        return nearest_stations(requests(spark, points), stations(spark, places), k, radius).count()

    assert count(exact) == 1
    assert count(exact * (1 - 1e-12)) == 0
    assert count(exact, k=0) == 0
    assert count(1.0) == 0
    assert count(0.0) == 0
    here = nearest_stations(requests(spark, [(48.3, 11.2)]), stations(spark, places), 5, 0.0)
    assert here.count() == 1


def test_inventory_is_checked_before_ranking(spark):
    places = {"near": (50.0, 8.0), "far": (50.2, 8.0), "open": (50.1, 8.0)}
    daily = {
        "near": (dt.date(1990, 1, 1), dt.date(1995, 1, 1)),
        "open": (dt.date(1990, 1, 1), None),
    }
    catalogue = stations(spark, places, daily)
    point = requests(spark, [(50.0, 8.0)])

    def names(frequency, required=None, k=1):
        found = nearest_stations(point, catalogue, k, 50.0, frequency, required)
        return [row.station for row in found.orderBy("rank").collect()]

    assert names(None) == ["near"]
    # Without a frequency the requirement plays no part.
    assert names(None, RequiredData.specific_date(dt.date(2010, 5, 5))) == ["near"]
    assert names(Frequency.DAILY, k=5) == ["near", "far"]
    assert names(Frequency.DAILY, RequiredData.specific_date(dt.date(2010, 5, 5))) == ["far"]
    assert names(Frequency.HOURLY, k=5) == []


def test_requirements_per_request(spark):
    places = {"old": (50.0, 8.0), "new": (50.1, 8.0)}
    daily = {
        "old": (dt.date(1990, 1, 1), dt.date(1999, 12, 31)),
        "new": (dt.date(2000, 1, 1), dt.date(2020, 12, 31)),
    }
    rows = [(1, 50.0, 8.0, dt.date(1995, 1, 1)), (2, 50.0, 8.0, dt.date(2005, 1, 1)),
            (3, 50.0, 8.0, dt.date(2030, 1, 1)), (4, 50.0, 8.0, None)]
    wanted = spark.createDataFrame(rows, "request_id int, lat double, lon double, day date")
    catalogue = stations(spark, places, daily)
    for required in (
        RequiredData.specific_date(F.col("day")),
        RequiredData.full_year(F.year("day")),
        RequiredData.date_range(F.col("day"), F.date_add("day", 30)),
    ):
        found = result(nearest_stations(wanted, catalogue, 5, 50.0, Frequency.DAILY, required))
        assert {i: near[0][0] for i, near in found.items()} == {1: "old", 2: "new"}


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0], ids=["broadcast", "salted"])
def test_find_stations(spark, broadcast_rows):
    places = {f"s{i}": (50 + i / 100, 8) for i in range(9)}
    found = find_stations(
        requests(spark, [(50.0, 8.0)]), stations(spark, places), broadcast_rows=broadcast_rows
    )
    rows = found.orderBy("rank").collect()
    assert [row.station.id for row in rows] == ["s0", "s1", "s2", "s3", "s4"]
    assert rows[0].station.name == {"en": "Station s0"}
    assert rows[0].distance_km == 0.0
    nowhere = find_stations(requests(spark, [(0.0, 0.0)]), stations(spark, places), max_km=5.0)
    assert nowhere.isEmpty()


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0], ids=["broadcast", "salted"])
def test_serving(spark, broadcast_rows):
    places = {"a": (50.0, 8.0), "b": (50.1, 8.0), "c": (50.2, 8.0), "d": (10.0, 10.0)}
    points = [(50.0, 8.0), (50.19, 8.0), (10.0, 10.0), (0.0, 0.0), (float("nan"), 0.0)]
    available = spark.createDataFrame([("c",), ("c",)], "station string")

    def outcome(limit):
        served = serving_stations(
            requests(spark, points),
            stations(spark, places),
            available,
            Frequency.DAILY,
            station_limit=limit,
            broadcast_rows=broadcast_rows,
        )
        return [
            (row.station, row.stations_tried, row.status)
            for row in served.orderBy("request_id").collect()
        ]

    nothing = [(None, 0, "no_station")] * 2
    assert outcome(1) == [(None, 1, "no_data"), ("c", 1, "ok"), (None, 1, "no_data"), *nothing]
    assert outcome(2) == [(None, 2, "no_data"), ("c", 2, "ok"), (None, 1, "no_data"), *nothing]
    assert outcome(3) == [("c", 3, "ok"), ("c", 3, "ok"), (None, 1, "no_data"), *nothing]
    assert outcome(0) == [(None, 0, "no_station")] * 5

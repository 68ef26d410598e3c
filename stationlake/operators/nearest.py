"""Nearest stations for a whole table of points.

A request table has ``request_id``, ``lat`` and ``lon``. Ids should be unique; requests that share one
are answered each on its own all the same. Requests and stations meet in
the cells of a :class:`~stationlake.functions.geo.Grid` by an equi-join; the exact distance and
the inventory decide inside the join. Results are exact: nearest first, ties by station id.

Where stations are crowded, a request need not look at all of them: there are grids of several levels, each for half the radius
of the last, and for each cell the box around its stations. A request in a cell with ``k`` stations finds ``k``
of them no farther away than the far corner of their box. This bound is known before any pair is made; it says which
level's grid the request is to look into, in the one join there is.

The catalogue is the small side. When its copies are counted to fit, they are broadcast: the
requests are then shuffled once, by all their columns, so a place that many ask for is no hot spot,
and ranking needs no other shuffle. A larger catalogue is joined by cell, with hot cells spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.functions.geo import (
    MAX_COPIES,
    Grid,
    chord_square,
    chord_square_of,
    distance_of_chord,
    unit_vector,
    within,
)
from stationlake.functions.inventory import covers
from stationlake.operators.joins import salted_join
from stationlake.scratch import staged
from stationlake.sizing import BROADCAST_ROWS
from stationlake.values import Frequency, RequiredData

DEFAULT_RADIUS_KM = 50.0
DEFAULT_STATION_LIMIT = 5


#: Radii of the levels shrink by STEP. Levels are used at all where a cell of the whole radius holds more than
#: CROWDED stations per wanted one, and one below another while its cells hold more than LEAST. How fine they get follows
#: the stations, up to LEVELS; a level counts if a station has less than FEWER times the company of the level before.
STEP, LEVELS, CROWDED, LEAST, FEWER = 2, 20, 24, 6, 0.8
#: What tells a request from all others: its id, and 96 bits of hash of all its columns for those that share one.
#: (Coordinates are no keys: Spark makes zeros and NaN alike in them, and shuffles anew.)
REQUEST = ("request_id", "_row", "_row2")
SITE = ("site_x", "site_y", "site_z")
POINT = ("point_x", "point_y", "point_z")


def _sites(stations: DataFrame, frequency: Frequency | None) -> DataFrame:
    """The narrow columns of the catalogue that the search needs."""
    columns = [
        F.col("id").alias("station"),
        F.col("location.latitude").alias("site_lat"),
        F.col("location.longitude").alias("site_lon"),
    ]
    if frequency is not None:
        columns += [
            F.col(f"inventory.{frequency.value}.{end}").alias(f"inventory_{end}")
            for end in ("start", "end")
        ]
    return stations.select(*columns)


def _first_of_each_place(sites: DataFrame, k: int) -> DataFrame:
    """Of stations with the same place and inventory only the ``k`` lowest ids can be found."""
    same = [name for name in sites.columns if name != "station"]
    order = Window.partitionBy(*same).orderBy("station")
    return sites.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def _grids(max_km: float) -> list[Grid]:
    """Grids of all levels; cells stop shrinking at some size."""
    grids = [Grid.for_radius(max_km)]
    for _ in range(LEVELS - 1):
        finer = Grid.for_radius(grids[-1].radius_km / STEP)
        if finer.rows <= grids[-1].rows:
            break
        grids.append(finer)
    return grids


def _boxes(sites: DataFrame, grids: Sequence[Grid]) -> DataFrame:
    """``level, cell``, the number ``n`` of its sites, and the box around them."""
    cells = [
        F.struct(F.lit(level).alias("level"), grid.cell("site_lat", "site_lon").alias("cell"))
        for level, grid in enumerate(grids)
    ]
    sides = [side(name).alias(f"{short}_{name}") for name in SITE for short, side in (("lo", F.min), ("hi", F.max))]
    return (
        sites.select(*SITE, F.explode(F.array(*cells)).alias("at"))
        .select(*SITE, "at.*")
        .filter("cell IS NOT NULL")
        .groupBy("level", "cell")
        .agg(F.count("*").alias("n"), *sides)
    )


def _far_corner() -> Column:
    """Square of the chord from a point to the farthest corner of a box, not less than to any site in it."""
    square = F.lit(0.0)
    for point, site in zip(POINT, SITE):
        to_lo, to_hi = F.col(point) - F.col(f"lo_{site}"), F.col(point) - F.col(f"hi_{site}")
        square = square + F.greatest(to_lo * to_lo, to_hi * to_hi)
    return square * (1 + 1e-9) + 1e-24


def _key(cell: Column, level: int | Column) -> Column:
    """One number for a cell of a level."""
    return cell * LEVELS + level


def _told_apart(points: DataFrame) -> DataFrame:
    return points.withColumns({"_row": F.xxhash64(*points.columns), "_row2": F.hash(*points.columns)})


def _per_request(points: DataFrame, columns: Sequence[str], *more: Column) -> DataFrame:
    """One row per request with some columns, which are the same in all its rows, and aggregates."""
    return points.groupBy(*REQUEST).agg(*(F.first(c).alias(c) for c in columns if c not in REQUEST), *more)


class Search:
    """Requests and stations dealt to the cells in which they meet."""

    def __init__(
        self, sites: DataFrame, k: int, max_km: float, count: int, broadcast_rows: int, by_request: bool
    ):
        """``sites`` has ``site_lat, site_lon`` and the columns of ``SITE``. With ``by_request`` each request has
        needs of its own, so that not every station of a box counts for it: the bound is then a first try, and who
        finds too few looks one level wider.
        """
        self.k, self.count, self.by_request = k, count, by_request
        grids = _grids(max_km)
        sizes = self._sizes(sites, grids[:1])
        used = [0]
        if sizes[0].most > CROWDED * k:
            sites = staged(_first_of_each_place(sites, k), "sites")
            sizes = self._sizes(sites, grids)
            used = self._worth(sizes)
        self.grids = [grids[level] for level in used]
        self.limits = [chord_square_of(grid.radius_km) for grid in self.grids]
        self.sites = sites
        self.fits = sizes[0].n * MAX_COPIES * len(used) <= broadcast_rows or self.near().limit(broadcast_rows + 1).count() <= broadcast_rows
        self.few_boxes = sum(sizes[level].boxes for level in used[1:]) <= broadcast_rows

    def _sizes(self, sites: DataFrame, grids: Sequence[Grid]) -> list[Row]:
        """Of each level the stations of all cells and of the fullest one, the boxes of use, and the sum of squares, which
        is the company of all stations."""
        n = F.col("n").cast("double")
        by_level = _boxes(sites, grids).groupBy("level").agg(
            F.sum("n").alias("n"), F.max("n").alias("most"), F.count_if(F.col("n") >= self.k).alias("boxes"),
            F.sum(n * n).alias("company"),
        )
        found = {row.level: row for row in by_level.collect()}  # one row per level
        return [found.get(level, Row(n=0, most=0, boxes=0, company=0.0)) for level in range(len(grids))]

    def _worth(self, sizes: Sequence[Row]) -> list[int]:
        """Levels to use: down to the first without a crowded cell (or, where places lie too close, down to the one that
        parts them nearly as well as any), and of those the ones that part stations better than the level before."""
        least = 1.1 * min(size.company for size in sizes)
        last = next(at for at, size in enumerate(sizes) if size.most <= LEAST * self.k or size.company <= least)
        used = [0]
        for level in range(1, last + 1):
            if level == last or sizes[level].company < FEWER * sizes[used[-1]].company:
                used.append(level)
        return used

    def near(self) -> DataFrame:
        """The sites, one copy per cell of each level that its radius can reach."""
        copies = [
            grid.touched_cells(self.sites, "site_lat", "site_lon")
            .withColumn("cell", _key(F.col("cell"), level))
            .drop("site_lat", "site_lon")
            for level, grid in enumerate(self.grids)
        ]
        near = copies[0]
        for more in copies[1:]:
            near = near.unionByName(more)
        return near

    def bounded(self, points: DataFrame) -> DataFrame:
        """Points (with ``POINT``) with the ``level`` to look into and ``bound``, the square of the chord not to pass."""
        whole = F.lit(self.limits[0] * (1 + 1e-9) + 1e-24)
        if len(self.grids) == 1:
            return points.withColumns({"bound": whole, "level": F.lit(0)})
        finer = list(enumerate(self.grids))[1:]
        own = F.array(*(_key(grid.cell("lat", "lon"), level) for level, grid in finer))
        boxes = _boxes(self.sites, self.grids).filter((F.col("n") >= self.k) & (F.col("level") > 0))
        boxes = boxes.withColumn("_cell", _key(F.col("cell"), F.col("level"))).drop("level", "cell", "n")
        asked = points.withColumn("_cell", F.explode(own))
        if self.few_boxes:
            joined = asked.join(F.broadcast(boxes), "_cell", "left")
        else:
            joined = salted_join(asked, boxes, ["_cell"], self.count * len(finer), "left")
        bounded = _per_request(joined, points.columns, F.least(F.min(_far_corner()), whole).alias("bound"))
        level = F.lit(0)
        for at, _ in finer:
            level = F.when(F.col("bound") < self.limits[at] * (1 - 1e-9), at).otherwise(level)
        return bounded.withColumn("level", level)

    def cell(self) -> Column:
        """The cell in which a point of some ``level`` looks."""
        cell = _key(self.grids[0].cell("lat", "lon"), 0)
        for level, grid in list(enumerate(self.grids))[1:]:
            cell = F.when(F.col("level") == level, _key(grid.cell("lat", "lon"), level)).otherwise(cell)
        return cell

    def wider(self, points: DataFrame) -> DataFrame:
        """Points of finer levels, dealt to the next coarser one and to its whole radius. The finest level is then done with."""
        self.grids, self.limits = self.grids[:-1], self.limits[:-1]
        bound = F.lit(self.limits[0] * (1 + 1e-9) + 1e-24)
        for level, limit in list(enumerate(self.limits))[1:]:
            bound = F.when(F.col("level") == level, limit).otherwise(bound)
        coarser = points.withColumn("level", F.col("level") - 1).withColumn("bound", bound)
        return coarser.withColumn("cell", self.cell())

    def pairs(self, points: DataFrame, condition: Column) -> DataFrame:
        """Points with the stations of their ``cell`` that meet a condition, or with none."""
        near = self.near()
        if not self.fits:
            return salted_join(points, near, ["cell"], self.count, "left", condition)
        near = F.broadcast(near.withColumnRenamed("cell", "site_cell"))
        return points.join(near, (F.col("cell") == F.col("site_cell")) & condition, "left")


def _partitions(spark: SparkSession, count: int) -> int:
    """Tasks for ``count`` requests: enough to keep a cluster busy, none of them large."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, count // 1000), count // 500_000)


def ranked_candidates(
    requests: DataFrame,
    stations: DataFrame,
    k: int,
    max_km: float,
    frequency: Frequency | None,
    required: RequiredData | None,
    carry: Sequence[str] = (),
    how: str = "inner",
    available: DataFrame | None = None,
    count: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Up to ``k`` stations per request (``REQUEST``) with ``distance_km`` and ``rank``.

    Equal rows of ``requests`` are answered once; ``_times`` says how many there are. With ``how="left"`` a request without any station gets one row without
    station. With ``available`` the column ``has_data`` says whether a station is listed there. ``count`` is the
    number of requests, or an upper bound of it; without it, they are counted.
    """
    count = requests.count() if count is None else count
    sites = _sites(stations, frequency)
    if k < 1:
        sites, k = sites.filter(F.lit(False)), 1
    needs: dict[str, Column] = {}
    suitable = F.lit(True)
    if frequency is not None:
        required = required or RequiredData.any()
        start, end = F.col("inventory_start"), F.col("inventory_end")
        parts = {"start": required.start, "end": required.end, "year": required.year}
        needs = {f"need_{name}": v for name, v in parts.items() if isinstance(v, Column)}
        if needs:
            per_request = {
                name: F.col(f"need_{name}") if f"need_{name}" in needs else value
                for name, value in parts.items()
            }
            suitable = covers(frequency, RequiredData(required.kind, **per_request), start, end)
            sites = sites.filter(start.isNotNull() & end.isNotNull())
        else:
            sites = sites.filter(covers(frequency, required, start, end)).drop(
                "inventory_start", "inventory_end"
            )
    vector = unit_vector(F.col("site_lat"), F.col("site_lon"))
    sites = sites.withColumns(dict(zip(SITE, vector)))
    flags = []
    if available is not None:
        listed = available.select("station").distinct().withColumn("has_data", F.lit(True))
        sites, flags = sites.join(listed, "station", "left"), ["has_data"]
    search = Search(sites, k, max_km, count, broadcast_rows, bool(needs))
    points = requests.select(
        "request_id", "lat", "lon", *carry, *(value.alias(name) for name, value in needs.items())
    )
    told = _told_apart(points)
    if search.fits:
        told = told.repartition(_partitions(requests.sparkSession, count), *REQUEST)
    points = _per_request(told, points.columns, F.count("*").alias("_times")).withColumns(
        dict(zip(POINT, unit_vector(F.col("lat"), F.col("lon"))))
    )
    state = search.bounded(points)
    of_request = state.columns
    state = state.withColumn("cell", search.cell())
    if len(search.grids) > 1:
        # Once per request, and apart from what is done per pair: in one stage each pair took many times as long.
        state = staged(state, "requests")
    square = chord_square(tuple(map(F.col, POINT)), tuple(map(F.col, SITE)))
    order = Window.partitionBy(*REQUEST).orderBy(F.col("square").asc_nulls_last(), "station")
    found = {"station": F.col("station"), "square": square} | {flag: F.col(flag) for flag in flags}

    def ranked(pairs: DataFrame, values: dict[str, Column]) -> DataFrame:
        values = [value.alias(name) for name, value in values.items()]
        rank = F.row_number().over(order)
        return pairs.select(*of_request, *values).withColumn("rank", rank).filter(F.col("rank") <= k)

    pair = within(square, max_km) & (square <= F.col("bound")) & suitable
    best = ranked(search.pairs(state, pair), found)
    if search.by_request and len(search.grids) > 1:
        # Needs may rule out stations of the box: who has too few looks one level wider, and so on up to the whole radius.
        hits = F.count("station").over(Window.partitionBy(*REQUEST))
        more = (F.col("hits") < k) & (F.col("level") > 0)
        settled = []
        for _ in search.grids[1:]:
            tried = staged(best.withColumn("hits", hits), "tried")
            settled.append(tried.filter(~more).drop("hits"))
            few = tried.filter(more & (F.col("rank") == 1)).select(*of_request)
            again = staged(search.wider(few), "again")
            if again.isEmpty():
                break
            best = ranked(search.pairs(again, pair), found)
        else:
            settled.append(best)
        best = reduce(DataFrame.unionByName, settled)
    if how == "inner":
        best = best.filter(F.col("station").isNotNull())
    return best.select(
        *REQUEST,
        "lat",
        "lon",
        *carry,
        "_times",
        "station",
        distance_of_chord(F.col("square")).alias("distance_km"),
        *flags,
        F.col("rank").cast("bigint").alias("rank"),
    )


def _each(rows: DataFrame) -> DataFrame:
    """Rows as often as their request was asked."""
    return rows.withColumn("_times", F.explode(F.sequence(F.lit(1), "_times"))).drop("_times")


def nearest_stations(
    requests: DataFrame,
    stations: DataFrame,
    k: int = DEFAULT_STATION_LIMIT,
    max_km: float = DEFAULT_RADIUS_KM,
    frequency: Frequency | None = None,
    required: RequiredData | None = None,
    carry: Sequence[str] = (),
    count: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``request_id, lat, lon, station, distance_km, rank`` of the ``k`` nearest stations.

    Without a frequency the inventory plays no part. Requests without a station within the
    radius have no rows.
    """
    ranked = ranked_candidates(
        requests,
        stations,
        k,
        max_km,
        frequency,
        required,
        carry,
        count=count,
        broadcast_rows=broadcast_rows,
    )
    return _each(ranked).select("request_id", "lat", "lon", *carry, "station", "distance_km", "rank")


def find_stations(
    requests: DataFrame,
    stations: DataFrame,
    frequency: Frequency | None = None,
    required: RequiredData | None = None,
    max_km: float = DEFAULT_RADIUS_KM,
    k: int = DEFAULT_STATION_LIMIT,
    count: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """As :func:`nearest_stations`, with the whole catalogue entry in struct ``station``."""
    count = requests.count() if count is None else count
    found = nearest_stations(
        requests, stations, k, max_km, frequency, required, count=count, broadcast_rows=broadcast_rows
    ).withColumnRenamed("station", "station_id")
    entries = stations.select(
        F.col("id").alias("station_id"), F.struct(*stations.columns).alias("station")
    )
    # A whole entry takes about ten times the memory of the narrow rows the limit is made for.
    if stations.count() <= broadcast_rows // 10:
        joined = found.join(F.broadcast(entries), "station_id")
    else:
        joined = salted_join(found, entries, ["station_id"], count * max(k, 1))
    return joined.select("request_id", "lat", "lon", "rank", "distance_km", "station")


def serving_stations(
    requests: DataFrame,
    stations: DataFrame,
    available: DataFrame,
    frequency: Frequency,
    required: RequiredData | None = None,
    max_km: float = DEFAULT_RADIUS_KM,
    station_limit: int = 1,
    carry: Sequence[str] = (),
    count: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """For every request the nearest station that really has data, and the outcome.

    The ``station_limit`` nearest suitable stations are candidates, tried nearest first.
    ``available`` lists the stations with data. ``status`` is ``ok``, ``no_station`` (no candidate
    within the radius) or ``no_data`` (none of ``stations_tried`` candidates has data).
    """
    candidates = ranked_candidates(
        requests,
        stations,
        station_limit,
        max_km,
        frequency,
        required,
        carry,
        how="left",
        available=available,
        count=count,
        broadcast_rows=broadcast_rows,
    )
    of_request = Window.partitionBy(*REQUEST)
    served = F.min(F.when(F.col("has_data"), F.col("rank"))).over(of_request)
    ok = F.col("served").isNotNull()
    rows = (
        candidates.withColumn("served", served)
        .withColumn("stations_tried", F.count("station").over(of_request))
        .filter(F.col("rank") == F.coalesce("served", F.lit(1)))
        .select(
            "request_id",
            "lat",
            "lon",
            *carry,
            "_times",
            F.when(ok, F.col("station")).alias("station"),
            F.when(ok, F.col("distance_km")).alias("distance_km"),
            "stations_tried",
            F.when(ok, "ok")
            .when(F.col("stations_tried") == 0, "no_station")
            .otherwise("no_data")
            .alias("status"),
        )
    )
    return _each(rows)

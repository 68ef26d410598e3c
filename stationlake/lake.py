"""The front door: one object over a store, its catalogue and, optionally, a landing folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.periods import (
    instant_as_utc,
    resolve_date_periods,
    resolve_datetime_periods,
    resolve_month_periods,
)
from stationlake.operators import located, nearest
from stationlake.operators.frames import FRAMES, WeatherFrame
from stationlake.schemas import TIME_COLUMNS
from stationlake.sources.store import Store
from stationlake.values import (
    Frequency,
    LatLon,
    NoDataForNearbyStations,
    NoDataForStation,
    NoStationWithinRadius,
    RequiredData,
    UnreadableFile,
)


#: Columns with the first and the last time of a period, for each time column of a frequency.
BOUNDS = {
    Frequency.DAILY: ({"date": "start_date"}, {"date": "end_date"}),
    Frequency.HOURLY: ({"datetime": "start_at"}, {"datetime": "end_at"}),
    Frequency.MONTHLY: (
        {"year": "start_year", "month": "start_month"},
        {"year": "end_year", "month": "end_month"},
    ),
}


class WeatherLake:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: str | None = None,
        today: dt.date | None = None,
        buckets: int | None = None,
    ):
        """Open the store below ``root``; with ``buckets``, lay out a new one if there is none.

        With a ``landing`` folder, which has one folder of bulk files per frequency, a station that
        is asked for alone and is not stored yet, or is stale, is read from there first. ``today``
        is the day such rows count as written; it defaults to the current UTC day.
        """
        self.spark = spark
        self.store = Store(spark, root, buckets)
        self.landing = landing.rstrip("/") if landing else None
        self._today = today

    @property
    def today(self) -> dt.date:
        return self._today or dt.datetime.now(dt.timezone.utc).date()

    def hourly(self) -> Weather:
        return Weather(self, Frequency.HOURLY)

    def daily(self) -> Weather:
        return Weather(self, Frequency.DAILY)

    def monthly(self) -> Weather:
        return Weather(self, Frequency.MONTHLY)

    def climate(self) -> Weather:
        return Weather(self, Frequency.CLIMATE)

    def point(self, place: LatLon | Sequence[float]) -> DataFrame:
        """A request table of one row."""
        lat, lon = place
        return self.spark.range(1).select(
            F.col("id").alias("request_id"),
            F.lit(float(lat)).alias("lat"),
            F.lit(float(lon)).alias("lon"),
        )

    def find_stations(
        self,
        places: DataFrame | LatLon | Sequence[float],
        frequency: Frequency | None = None,
        required: RequiredData | None = None,
        max_distance_km: float = nearest.DEFAULT_RADIUS_KM,
        station_limit: int = nearest.DEFAULT_STATION_LIMIT,
    ) -> DataFrame:
        """Nearest stations of one place or of a request table; no station means no rows."""
        requests = places if isinstance(places, DataFrame) else self.point(places)
        return nearest.find_stations(
            requests, self.store.stations(), frequency, required, max_distance_km, station_limit
        )

    def ingest(self, frequency: Frequency, landing: str | None = None) -> None:
        """Store the landed files of stations that are not stored yet, but for malformed ones."""
        self.store.ingest(landing or self.landing_of(frequency), frequency, self.today)

    def rejects(self) -> DataFrame:
        """Stations whose files were malformed or broken, with path, reason and line."""
        return self.store.rejects()

    def compact(self, frequency: Frequency, buckets: int | None = None) -> None:
        """Rewrite a frequency as one commit, in another number of buckets if given, and remove what it replaces."""
        self.store.compact(frequency, buckets)
        self.store.vacuum(frequency)

    def refresh(self, frequency: Frequency, needs: DataFrame, landing: str | None = None) -> None:
        """Read stale stations again; ``needs`` holds ``station, frequency, end_date``."""
        folder = landing or self.landing_of(frequency)
        self.store.refresh(folder, frequency, needs, self.today)

    def landing_of(self, frequency: Frequency) -> str:
        if self.landing is None:
            raise ValueError("this lake has no landing folder")
        return f"{self.landing}/{frequency.value}"

    def rebuild_station_list(self, source: str) -> None:
        self.store.rebuild_catalogue(source)

    def clear_station_list(self) -> None:
        self.store.clear_catalogue()

    def clear_weather_of_station(self, station: str, frequency: Frequency) -> None:
        self.store.drop_station(frequency, station)

    def clear_weather(self) -> None:
        self.store.drop_all()

    def clear(self) -> None:
        """Forget the catalogue and all weather."""
        self.clear_station_list()
        self.clear_weather()

    def clear_and_rebuild(self, source: str) -> None:
        self.clear()
        self.rebuild_station_list(source)


def _instant(requests: DataFrame, at: str) -> Column:
    """The column, as a UTC date-time without zone if it holds instants of the session's zone type."""
    zoned = isinstance(requests.schema[at].dataType, T.TimestampType)
    return instant_as_utc(F.col(at)) if zoned else F.col(at)


class Weather:
    """Weather of one frequency: by station, by place, or for a table of requests."""

    def __init__(self, lake: WeatherLake, frequency: Frequency):
        self.lake, self.store, self.frequency = lake, lake.store, frequency

    def all(self) -> WeatherFrame:
        """Rows of every station."""
        return self._frame(self.store.scan(self.frequency))

    def _frame(self, rows: DataFrame) -> WeatherFrame:
        """A frame that knows the store's folders."""
        return FRAMES[self.frequency](rows, self.store.only_stations)

    def station(self, station: str, required: RequiredData | None = None) -> WeatherFrame:
        """Rows of one station.

        The requirement says only how fresh the rows must be; the inventory is not asked.
        """
        if self.lake.landing is not None:
            self._fetch(station, required or RequiredData.any())
        if self._available().filter(F.col("station") == station).isEmpty():
            raise NoDataForStation(station, self.frequency)
        return self._frame(self.store.scan_station_layout(self.frequency, station))

    def stations(self, stations: DataFrame) -> WeatherFrame:
        """Rows of the stations listed in column ``station``."""
        return self.all().stations(stations)

    def location(
        self,
        place: LatLon | Sequence[float],
        required: RequiredData | None = None,
        max_distance_km: float = nearest.DEFAULT_RADIUS_KM,
        station_limit: int = 1,
    ) -> WeatherFrame:
        """Rows of the nearest station whose inventory fits and that has data.

        With a landing folder a candidate's file is read when it is missing or stale; a candidate that
        has no data or whose file can't be read gives way to the next one, and the error raised
        when none is left has the last reason as its cause.
        """
        point = self.lake.point(place)
        if self.lake.landing is None:
            served = self.serving(point, required, max_distance_km, station_limit, count=1).first()
            if served.status == "no_station":
                raise NoStationWithinRadius(max_distance_km, *place)
            if served.status == "no_data":
                raise NoDataForNearbyStations(max_distance_km, *place, served.stations_tried)
            return self.station(served.station, required)
        candidates = nearest.nearest_stations(
            point, self.store.stations(), station_limit, max_distance_km, self.frequency, required, count=1
        ).orderBy("rank").collect()  # station_limit rows at most
        if not candidates:
            raise NoStationWithinRadius(max_distance_km, *place)
        last_error: Exception | None = None
        for candidate in candidates:
            try:
                return self.station(candidate.station, required)
            except (NoDataForStation, UnreadableFile) as error:
                last_error = error
        raise NoDataForNearbyStations(max_distance_km, *place, len(candidates)) from last_error

    # -- tables of requests

    def serving(
        self,
        requests: DataFrame,
        required: RequiredData | None = None,
        max_distance_km: float = nearest.DEFAULT_RADIUS_KM,
        station_limit: int = 1,
        carry: Sequence[str] = (),
        count: int | None = None,
    ) -> DataFrame:
        """Station, distance and outcome for every request; see ``nearest.serving_stations``.

        A station has data when rows of it are stored; files that have only landed are not asked.
        """
        return nearest.serving_stations(
            requests,
            self.store.stations(),
            self._available(),
            self.frequency,
            required,
            max_distance_km,
            station_limit,
            carry,
            count,
        )

    def at(
        self,
        requests: DataFrame,
        at: str | dict[str, Column],
        required: RequiredData | None = None,
        max_distance_km: float = nearest.DEFAULT_RADIUS_KM,
        station_limit: int = 1,
    ) -> DataFrame:
        """The row at each request's place and time.

        ``at`` names the column with the instant or day (an instant counts in UTC, whatever the session's
        zone); for normals it gives the Columns
        ``start_year``, ``end_year`` and ``month``.
        """
        served, count = self._served_at(requests, at, required, max_distance_km, station_limit)
        return self._rows_at(served, count)

    def at_outcomes(
        self,
        requests: DataFrame,
        at: str | dict[str, Column],
        required: RequiredData | None = None,
        max_distance_km: float = nearest.DEFAULT_RADIUS_KM,
        station_limit: int = 1,
    ) -> DataFrame:
        """What becomes of each request of :meth:`at`, one row per request.

        ``status`` is ``ok``, ``bad_time`` (no time is given), ``no_station``, ``no_data`` (see ``serving``) or
        ``no_row`` (the station has data, but none of that time).
        """
        served, count = self._served_at(requests, at, required, max_distance_km, station_limit)
        missing = [F.col(f"at_{name}").isNull() for name in TIME_COLUMNS[self.frequency]]
        judged = served.withColumn(
            "status", F.when(F.greatest(*missing, F.lit(False)), "bad_time").otherwise(F.col("status"))
        )
        return self._outcomes(judged, lambda own: self._rows_at(own, count))

    def _served_at(
        self,
        requests: DataFrame,
        at: str | dict[str, Column],
        required: RequiredData | None,
        max_distance_km: float,
        station_limit: int,
    ) -> tuple[DataFrame, int]:
        """The requests with the station that serves each and their time in columns ``at_…``; their count."""
        key = located.time_key(self.frequency, _instant(requests, at)) if isinstance(at, str) else at
        requests = requests.withColumns({f"at_{name}": value for name, value in key.items()})
        carry = [f"at_{name}" for name in key]
        count = requests.count()
        return self.serving(requests, required, max_distance_km, station_limit, carry, count), count

    def _rows_at(self, served: DataFrame, count: int) -> DataFrame:
        return located.weather_at(
            served,
            self.store.scan(self.frequency),
            self.frequency,
            {name: F.col(f"at_{name}") for name in TIME_COLUMNS[self.frequency]},
            count,
            self.store.bucket_of,
        )

    def _outcomes(self, judged: DataFrame, rows_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The status of each served request, with ``no_row`` where ``rows_of`` finds nothing for an ``ok`` one.

        The requests are numbered and written once, so that the search runs once and requests that share an
        id stay apart.
        """
        own = self.store.stage(judged.withColumn("row", F.monotonically_increasing_id()), "served")
        asked = own.filter("status = 'ok'").drop("request_id", "status")
        found = rows_of(asked.withColumnRenamed("row", "request_id")).select(
            F.col("request_id").alias("row"), F.lit(True).alias("found")
        )
        no_row = (F.col("status") == "ok") & F.col("found").isNull()
        return own.join(found.distinct(), "row", "left").select(
            "request_id",
            "lat",
            "lon",
            "station",
            "distance_km",
            "stations_tried",
            F.when(no_row, "no_row").otherwise(F.col("status")).alias("status"),
        )

    def for_periods(
        self,
        requests: DataFrame,
        period: str = "period",
        required: RequiredData | None = None,
        max_distance_km: float = nearest.DEFAULT_RADIUS_KM,
        station_limit: int = 1,
    ) -> DataFrame:
        """Rows over each request's own period text, at its ``station`` or else at its place.

        Requests whose text is no period have no rows.
        """
        count = requests.count()
        if "station" not in requests.columns:
            requests = self.serving(
                requests, required, max_distance_km, station_limit, [period], count
            )
        return self._rows_between(self._resolved(requests.drop("status"), period), count)

    def period_outcomes(
        self,
        requests: DataFrame,
        period: str = "period",
        required: RequiredData | None = None,
        max_distance_km: float = nearest.DEFAULT_RADIUS_KM,
        station_limit: int = 1,
    ) -> DataFrame:
        """What becomes of each request of :meth:`for_periods` at its place, one row per request.

        ``status`` is ``ok``, ``bad_period``, ``no_station``, ``no_data`` (see ``serving``) or ``no_row`` (the
        station has data, but none of the period).
        """
        count = requests.count()
        served = self.serving(requests, required, max_distance_km, station_limit, [period], count)
        judged = self._resolved(served.withColumnRenamed("status", "search"), period)
        bad = F.col("status") != "ok"
        judged = judged.withColumn("status", F.when(bad, F.col("status")).otherwise(F.col("search")))
        return self._outcomes(judged, lambda own: self._rows_between(own, count))

    def _resolved(self, requests: DataFrame, period: str) -> DataFrame:
        """The requests with the bounds of their period text and its ``status``."""
        if self.frequency is Frequency.DAILY:
            return resolve_date_periods(requests, period)
        if self.frequency is Frequency.HOURLY:
            return resolve_datetime_periods(requests, period)
        if self.frequency is Frequency.MONTHLY:
            return resolve_month_periods(requests, period)
        raise ValueError("normals have no periods")

    def _rows_between(self, resolved: DataFrame, count: int) -> DataFrame:
        start, end = (
            {name: F.col(column) for name, column in bound.items()} for bound in BOUNDS[self.frequency]
        )
        return located.weather_between(
            resolved,
            self.store.scan(self.frequency),
            self.frequency,
            start,
            end,
            self.store.bucket_of,
            12 * count,  # a period is a year at most
        )

    # -- what is stored

    def _available(self) -> DataFrame:
        return self.store.available(self.frequency)

    def _fetch(self, station: str, required: RequiredData) -> None:
        """Read one station from the landing folder when it is missing or stale."""
        wanted = self.lake.spark.range(1).select(
            F.lit(station).alias("station"),
            F.lit(self.frequency.value).alias("frequency"),
            F.lit(required.end_date()).cast("date").alias("end_date"),
        )
        landing = self.lake.landing_of(self.frequency)
        if self._available().filter(F.col("station") == station).isEmpty():
            self.store.ingest(landing, self.frequency, self.lake.today, only=wanted, strict=True)
        else:
            self.store.refresh(landing, self.frequency, wanted, self.lake.today, strict=True)

"""Weather frames: a DataFrame of one frequency with the filters that suit it.

Arguments are resolved to literals, so that every filter reaches the Parquet scan. A frame is
lazy and never changes; each filter gives a new one. The DataFrame itself is ``.df``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import ClassVar, Self

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from stationlake import schemas
from stationlake import values as V
from stationlake.functions.conditions import condition_name
from stationlake.operators.records import json_records, records
from stationlake.sizing import broadcast_if_small
from stationlake.values import ExpectedSingleRow, Frequency, Month, Year


def _instant(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


#: A function of a scan and a table of stations that gives the rows of these stations.
OnlyStations = Callable[[DataFrame, DataFrame], DataFrame]


class WeatherFrame:
    frequency: ClassVar[Frequency]

    def __init__(self, rows: DataFrame, only_stations: OnlyStations | None = None):
        """A frame of a weather table. ``rows`` may have the columns of a store's layout: time filters then
        name the years' folders too, and, with ``only_stations`` of that store, sets of stations name the buckets.
        """
        self.rows = rows
        self.only_stations = only_stations

    @property
    def df(self) -> DataFrame:
        """The rows as a DataFrame, without the columns of a layout."""
        return self.rows.drop(*schemas.LAYOUT)

    def _with(self, rows: DataFrame) -> Self:
        return type(self)(rows, self.only_stations)

    def filter(self, condition: Column | str) -> Self:
        """Keep rows that meet any condition, given as a Column or as SQL text."""
        return self._with(self.rows.filter(condition))

    def _of_years(self, first: int, last: int) -> Self:
        """Rows of some years' folders; all rows where there are no folders."""
        if "year_part" not in self.rows.columns:
            return self
        part = F.col("year_part")
        return self.filter(part == first if first == last else (part >= first) & (part <= last))

    def limit(self, n: int) -> Self:
        return self._with(self.rows.limit(n))

    def station(self, station: str) -> Self:
        return self.filter(F.col("station") == station)

    def stations(self, stations: DataFrame) -> Self:
        """Rows of the stations listed in column ``station`` of another table."""
        if self.only_stations is not None:
            return self._with(self.only_stations(self.rows, stations))
        wanted = broadcast_if_small(stations.select("station").distinct())
        return self._with(self.rows.join(wanted, "station", "left_semi"))

    def records(self) -> DataFrame:
        """All rows as records, still distributed."""
        return records(self.df, self.frequency)

    def json_records(self) -> DataFrame:
        return json_records(self.df, self.frequency)

    def single_record(self) -> Row:
        """The one record; an error unless there is exactly one row.

        Two rows are enough to see that there are too many; all are counted only to say how many.
        """
        rows = self.df.limit(2)
        found = rows.count()
        if found != 1:
            raise ExpectedSingleRow(found if found < 2 else self.df.count())
        record = records(rows, self.frequency).first()
        if record is None:
            raise ExpectedSingleRow(0)
        return record


class HourlyFrame(WeatherFrame):
    frequency = Frequency.HOURLY

    def get_range(self, start, end) -> Self:
        """From the start of ``start`` to the end of ``end``, both included."""
        return self._between(V.datetime_range_of(start)[0], V.datetime_range_of(end)[1])

    def get_at(self, at) -> Self:
        """The hour nearest to an instant, or to the start of a day, month or year."""
        hour = V.nearest_hour(V.datetime_range_of(at)[0])
        return self._of_years(hour.year, hour.year).filter(F.col("datetime") == _instant(hour))

    def get_for_period(self, period) -> Self:
        return self._between(*V.datetime_period_of(period))

    def _between(self, start: dt.datetime, end: dt.datetime) -> Self:
        at = F.col("datetime")
        return self._of_years(start.year, end.year).filter((at >= _instant(start)) & (at <= _instant(end)))

    def with_condition(self) -> DataFrame:
        """The rows with the name of their weather condition in ``condition``."""
        return self.df.withColumn("condition", condition_name(F.col("coco")))


class DailyFrame(WeatherFrame):
    frequency = Frequency.DAILY

    def get_range(self, start, end) -> Self:
        return self._between(V.date_range_of(start)[0], V.date_range_of(end)[1])

    def get_at(self, at) -> Self:
        """One day; the first day of a month or year."""
        day = V.date_range_of(at)[0]
        return self._of_years(day.year, day.year).filter(F.col("date") == F.lit(day))

    def get_for_period(self, period: Month | Year) -> Self:
        return self._between(*V.date_period_of(period))

    def _between(self, start: dt.date, end: dt.date) -> Self:
        day = F.col("date")
        return self._of_years(start.year, end.year).filter((day >= F.lit(start)) & (day <= F.lit(end)))

    def chart_series(self) -> DataFrame:
        """The columns of a temperature chart."""
        return self.df.select("station", "date", "tavg", "tmin", "tmax")


class MonthlyFrame(WeatherFrame):
    frequency = Frequency.MONTHLY

    def get_range(self, start: Month | Year, end: Month | Year) -> Self:
        return self._between(V.month_range_of(start)[0], V.month_range_of(end)[1])

    def get_at(self, at: Month | Year) -> Self:
        """One month; January of a year."""
        wanted = V.month_range_of(at)[0]
        at = (F.col("year") == wanted.year) & (F.col("month") == wanted.month)
        return self._of_years(wanted.year, wanted.year).filter(at)

    def get_for_period(self, period: Year) -> Self:
        return self._between(*V.month_period_of(period))

    def _between(self, start: Month, end: Month) -> Self:
        return self._of_years(start.year, end.year).filter(
            months_between(F.lit(start.year), F.lit(start.month), F.lit(end.year), F.lit(end.month))
        )


def months_between(
    start_year: Column, start_month: Column, end_year: Column, end_month: Column
) -> Column:
    """Row's (year, month) within two months, both included, in a form that Parquet can prune."""
    year, month = F.col("year"), F.col("month")
    not_before = (year > start_year) | ((year == start_year) & (month >= start_month))
    not_after = (year < end_year) | ((year == end_year) & (month <= end_month))
    return not_before & not_after


class ClimateFrame(WeatherFrame):
    frequency = Frequency.CLIMATE

    def get_at(self, start: Year, end: Year, month: int) -> Self:
        """One month of one normals period; the month number is not checked."""
        return self._of_years(start.year, start.year).filter(
            (F.col("start_year") == start.year)
            & (F.col("end_year") == end.year)
            & (F.col("month") == month)
        )


FRAMES: dict[Frequency, type[WeatherFrame]] = {
    frame.frequency: frame for frame in (HourlyFrame, DailyFrame, MonthlyFrame, ClimateFrame)
}

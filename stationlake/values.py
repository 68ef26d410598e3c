"""Argument values that callers hand to the engine, and the errors it raises.

These are plain Python values. They are resolved on the caller's side and enter a plan
as literals; columns of a request table are resolved by :mod:`stationlake.functions`.
"""

from __future__ import annotations

import calendar
import datetime as dt
import re
from dataclasses import dataclass
from enum import Enum
from typing import NamedTuple

from pyspark.sql import Column


class StationLakeError(Exception):
    """Base of every error raised by this package."""


class DateParsingError(StationLakeError):
    """An argument could not be read as a date, an instant or a period."""


class NoStationWithinRadius(StationLakeError):
    def __init__(self, radius: float, lat: float, lon: float):
        super().__init__(f"no station within {radius} km of {lat}, {lon}")
        self.radius, self.lat, self.lon = radius, lat, lon


class NoDataForNearbyStations(StationLakeError):
    def __init__(self, radius: float, lat: float, lon: float, stations_tried: int):
        super().__init__(
            f"none of {stations_tried} stations within {radius} km of {lat}, {lon} has data"
        )
        self.radius, self.lat, self.lon = radius, lat, lon
        self.stations_tried = stations_tried


class NoDataForStation(StationLakeError):
    def __init__(self, station: str, frequency: Frequency):
        super().__init__(f"no {frequency} data of station {station}")
        self.station, self.frequency = station, frequency


class NoSuchStore(StationLakeError):
    def __init__(self, root: str):
        super().__init__(f"there is no store at {root}; give a number of buckets to lay one out")
        self.root = root


class UnreadableFile(StationLakeError):
    def __init__(self, station: str, path: str, reason: str):
        super().__init__(f"{path} of station {station} can't be read: {reason}")
        self.station, self.path, self.reason = station, path, reason


class ExpectedSingleRow(StationLakeError):
    def __init__(self, actual: int):
        super().__init__(f"expected a single row, found {actual}")
        self.actual = actual


class Frequency(str, Enum):
    """Granularity of a weather table; the value is its folder name."""

    HOURLY = "hourly"
    DAILY = "daily"
    MONTHLY = "monthly"
    CLIMATE = "normals"

    def __str__(self) -> str:
        return self.value


class LatLon(NamedTuple):
    lat: float
    lon: float


@dataclass(frozen=True, order=True)
class Year:
    year: int

    @property
    def is_leap(self) -> bool:
        return calendar.isleap(self.year)

    def __str__(self) -> str:
        return f"{self.year:04d}"


@dataclass(frozen=True, order=True)
class Month:
    year: int
    month: int

    def __str__(self) -> str:
        return f"{self.year:04d}-{self.month:02d}"


@dataclass(frozen=True)
class RequiredData:
    """What a station's inventory has to cover.

    Every value may be a Python value or a Column of the request table, so that each
    request can carry its own requirement.
    """

    kind: str
    start: dt.date | Column | None = None
    end: dt.date | Column | None = None
    year: int | Column | None = None

    @classmethod
    def any(cls) -> RequiredData:
        return cls("any")

    @classmethod
    def specific_date(cls, date: dt.date | Column) -> RequiredData:
        return cls("specific_date", start=date, end=date)

    @classmethod
    def date_range(cls, start: dt.date | Column, end: dt.date | Column) -> RequiredData:
        return cls("date_range", start=start, end=end)

    @classmethod
    def full_year(cls, year: int | Column) -> RequiredData:
        return cls("full_year", year=year)

    def end_date(self) -> dt.date | None:
        """Last day that is needed; only for requirements made of Python values."""
        if self.kind == "full_year":
            return dt.date(self.year, 12, 31) if 1 <= self.year <= 9999 else None
        return self.end


DAY_START = dt.time(0, 0, 0)
DAY_END = dt.time(23, 59, 59, 999_999)
_DATE_TEXT = re.compile(r"\d{4}-\d{2}-\d{2}")
_ZONED_TEXT = re.compile(
    r"(\d{4}-\d{2}-\d{2})[Tt ](\d{2}:\d{2}:\d{2})(\.\d+)? ?(Z|z|UTC|[+-]\d{2}:?\d{2})"
)
_PLAIN_TEXT = re.compile(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}")


def _date_of_text(text: str) -> dt.date:
    if not _DATE_TEXT.fullmatch(text):
        raise DateParsingError(f"not a date: {text!r}")
    try:
        return dt.date.fromisoformat(text)
    except ValueError as error:
        raise DateParsingError(f"not a date: {text!r}") from error


def _days_of(value: Year | Month) -> tuple[dt.date, dt.date]:
    try:
        if isinstance(value, Year):
            return dt.date(value.year, 1, 1), dt.date(value.year, 12, 31)
        last = calendar.monthrange(value.year, value.month)[1]
        return dt.date(value.year, value.month, 1), dt.date(value.year, value.month, last)
    except (ValueError, calendar.IllegalMonthError) as error:
        raise DateParsingError(f"not a calendar period: {value}") from error


def _unsupported(value: object, what: str) -> TypeError:
    return TypeError(f"{type(value).__name__} is not accepted as {what}")


def date_range_of(value: dt.date | str | Year | Month) -> tuple[dt.date, dt.date]:
    """First and last day of a daily range or point argument."""
    if isinstance(value, (Year, Month)):
        return _days_of(value)
    if isinstance(value, str):
        value = _date_of_text(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value, value
    raise _unsupported(value, "a daily argument")


def date_period_of(value: Year | Month) -> tuple[dt.date, dt.date]:
    """First and last day of a daily period; only years and months are periods."""
    if isinstance(value, (Year, Month)):
        return _days_of(value)
    raise _unsupported(value, "a daily period")


def _instant_of_text(text: str) -> dt.datetime | None:
    zoned = _ZONED_TEXT.fullmatch(text)
    try:
        if zoned:
            day, time, fraction, zone = zoned.groups()
            zone = "+00:00" if zone in ("Z", "z", "UTC") else zone
            micros = (fraction or ".0")[:7]
            moment = dt.datetime.fromisoformat(f"{day}T{time}{micros.ljust(7, '0')}{zone}")
            return moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
        if _PLAIN_TEXT.fullmatch(text):
            return dt.datetime.fromisoformat(text)
    except (ValueError, OverflowError) as error:
        raise DateParsingError(f"not an instant: {text!r}") from error
    return None


def datetime_range_of(
    value: dt.datetime | dt.date | str | Year | Month,
) -> tuple[dt.datetime, dt.datetime]:
    """First and last UTC instant of an hourly range or point argument.

    A date-time without a zone is taken as UTC.
    """
    if isinstance(value, str):
        value = _instant_of_text(value) or _date_of_text(value)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return value, value
    if isinstance(value, dt.date):
        first = last = value
    elif isinstance(value, (Year, Month)):
        first, last = _days_of(value)
    else:
        raise _unsupported(value, "an hourly argument")
    return dt.datetime.combine(first, DAY_START), dt.datetime.combine(last, DAY_END)


def datetime_period_of(
    value: dt.date | str | Year | Month,
) -> tuple[dt.datetime, dt.datetime]:
    """First and last UTC instant of an hourly period: a day, a month or a year."""
    if isinstance(value, dt.datetime):
        raise _unsupported(value, "an hourly period")
    if isinstance(value, str):
        value = _date_of_text(value)
    return datetime_range_of(value)


def month_range_of(value: Year | Month) -> tuple[Month, Month]:
    """First and last month of a monthly argument; the month number is not checked."""
    if isinstance(value, Month):
        return value, value
    if isinstance(value, Year):
        return Month(value.year, 1), Month(value.year, 12)
    raise _unsupported(value, "a monthly argument")


def month_period_of(value: Year) -> tuple[Month, Month]:
    """First and last month of a monthly period; only a year is a period."""
    if isinstance(value, Year):
        return month_range_of(value)
    raise _unsupported(value, "a monthly period")


def nearest_hour(moment: dt.datetime) -> dt.datetime:
    """Round to the hour; half an hour and more goes up."""
    hour = moment.replace(minute=0, second=0, microsecond=0)
    try:
        return hour + dt.timedelta(hours=1) if moment.minute >= 30 else hour
    except OverflowError as error:
        raise DateParsingError(f"no hour after {moment}") from error

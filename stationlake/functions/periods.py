"""Turn period texts of a request table into bounds.

A text is a year ``YYYY``, a month ``YYYY-MM``, a day ``YYYY-MM-DD`` or, where instants are
accepted, an instant. Anything else gives null bounds.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR, MONTH, DAY, INSTANT = "year", "month", "day", "instant"

# Kinds of period that each operator accepts.
DATE_RANGE = (YEAR, MONTH, DAY)
DATE_PERIOD = (YEAR, MONTH)
DATETIME_RANGE = (YEAR, MONTH, DAY, INSTANT)
DATETIME_PERIOD = (YEAR, MONTH, DAY)
MONTH_RANGE = (YEAR, MONTH)
MONTH_PERIOD = (YEAR,)

_YEAR = r"^\d{4}$"
_MONTH = r"^\d{4}-\d{2}$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_PLAIN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_ZONED = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)? ?(Z|z|UTC|[+-]\d{2}:?\d{2})$"


def _choose(kinds: Iterable[str], branches: dict[str, tuple[Column, Column]]) -> Column:
    """First branch among the accepted kinds whose shape fits; null when none does."""
    column = F.lit(None)
    for kind, (shape, value) in reversed(branches.items()):
        if kind in kinds:
            column = F.when(shape, value).otherwise(column)
    return column


def date_bounds(text: Column, kinds: Iterable[str] = DATE_RANGE) -> tuple[Column, Column]:
    """First and last day of a period text."""
    kinds = tuple(kinds)

    def day(suffix: str) -> Column:
        return F.concat(text, F.lit(suffix)).try_cast("date")

    year, month = text.rlike(_YEAR), text.rlike(_MONTH)
    single = (text.rlike(_DAY), text.try_cast("date"))
    start = _choose(kinds, {YEAR: (year, day("-01-01")), MONTH: (month, day("-01")), DAY: single})
    end = _choose(
        kinds,
        {YEAR: (year, day("-12-31")), MONTH: (month, F.last_day(day("-01"))), DAY: single},
    )
    return start, end


def utc_instant(text: Column) -> Column:
    """Zoned text as a UTC date-time without zone, whatever the session's zone is."""
    iso = F.regexp_replace(text, r" ?(z|Z|UTC)$", "+00:00")
    iso = F.regexp_replace(iso, r" ?([+-]\d{2}):?(\d{2})$", "$1:$2")
    iso = F.regexp_replace(iso, r"^(.{10})[t ]", "$1T")
    return instant_as_utc(iso.try_cast("timestamp_ltz"))


def instant_as_utc(at: Column) -> Column:
    """A ``timestamp`` as a UTC date-time without zone, whatever the session's zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(at), epoch)


def datetime_bounds(
    text: Column, kinds: Iterable[str] = DATETIME_RANGE
) -> tuple[Column, Column]:
    """First and last UTC instant of a period text; a day ends at 23:59:59.999999."""
    kinds = tuple(kinds)
    first, last = date_bounds(text, kinds)
    start = first.cast("timestamp_ntz")
    end = F.concat(last.cast("string"), F.lit(" 23:59:59.999999")).try_cast("timestamp_ntz")
    if INSTANT not in kinds:
        return start, end
    instant = F.when(text.rlike(_ZONED), utc_instant(text)).when(
        text.rlike(_PLAIN), text.try_cast("timestamp_ntz")
    )
    return F.coalesce(instant, start), F.coalesce(instant, end)


def month_bounds(
    text: Column, kinds: Iterable[str] = MONTH_RANGE
) -> tuple[Column, Column, Column, Column]:
    """Start year, start month, end year and end month; the month number is not checked."""
    kinds = tuple(kinds)
    is_year, is_month = text.rlike(_YEAR), text.rlike(_MONTH)
    year = F.substring(text, 1, 4).try_cast("bigint")
    month = F.substring(text, 6, 2).try_cast("bigint")
    number = _choose(kinds, {YEAR: (is_year, year), MONTH: (is_month, year)})
    one, twelve = F.lit(1).cast("bigint"), F.lit(12).cast("bigint")
    first = _choose(kinds, {YEAR: (is_year, one), MONTH: (is_month, month)})
    last = _choose(kinds, {YEAR: (is_year, twelve), MONTH: (is_month, month)})
    return number, first, number, last


def _with_status(df: DataFrame, marker: str) -> DataFrame:
    status = F.when(F.col(marker).isNull(), "bad_period").otherwise("ok")
    return df.withColumn("status", status)


def resolve_date_periods(
    df: DataFrame, text: str = "period", kinds: Iterable[str] = DATE_RANGE
) -> DataFrame:
    """Add ``start_date``, ``end_date`` and ``status`` (``ok`` or ``bad_period``)."""
    start, end = date_bounds(F.col(text), kinds)
    df = df.withColumns({"start_date": start.cast("date"), "end_date": end.cast("date")})
    return _with_status(df, "start_date")


def resolve_datetime_periods(
    df: DataFrame, text: str = "period", kinds: Iterable[str] = DATETIME_RANGE
) -> DataFrame:
    """Add ``start_at``, ``end_at`` (UTC, without zone) and ``status``."""
    start, end = datetime_bounds(F.col(text), kinds)
    return _with_status(df.withColumns({"start_at": start, "end_at": end}), "start_at")


def resolve_month_periods(
    df: DataFrame, text: str = "period", kinds: Iterable[str] = MONTH_RANGE
) -> DataFrame:
    """Add start and end year and month and ``status``."""
    names = ("start_year", "start_month", "end_year", "end_month")
    bounds = month_bounds(F.col(text), kinds)
    return _with_status(df.withColumns(dict(zip(names, bounds))), "start_year")


def nearest_hour(at: Column) -> Column:
    """Round a zone-less instant to the hour; half an hour and more goes up.

    Built from the date and the hour number, since ``date_trunc`` would go through the
    session's zone.
    """
    later = at.cast("timestamp_ntz") + F.expr("interval 30 minutes")
    return F.timestamp_add("HOUR", F.hour(later), later.cast("date").cast("timestamp_ntz"))

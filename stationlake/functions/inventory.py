"""Does a station's declared inventory cover what is needed?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlake.values import Frequency, RequiredData

YEARLY = (Frequency.MONTHLY, Frequency.CLIMATE)


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def covers(
    frequency: Frequency, required: RequiredData, start: Column, end: Column
) -> Column:
    """True when the inventory ``start`` .. ``end`` of a frequency meets the requirement.

    Hourly and daily inventories are dates, monthly and normals inventories are years. A
    missing end fails every requirement.
    """
    known = start.isNotNull() & end.isNotNull()
    if required.kind == "any":
        return known
    if frequency in YEARLY:
        if required.kind == "full_year":
            first = last = _column(required.year)
        else:
            first, last = F.year(_column(required.start)), F.year(_column(required.end))
        return known & (start <= first) & (end >= last)
    if required.kind == "full_year":
        # The day before the inventory lies in an earlier year, the day after in a later one.
        year = _column(required.year)
        return known & (F.year(F.date_sub(start, 1)) < year) & (F.year(F.date_add(end, 1)) > year)
    return known & (start <= _column(required.start)) & (end >= _column(required.end))


def required_end_date(kind: Column, date: Column, end: Column, year: Column) -> Column:
    """Last day a requirement needs; null for ``any`` and for a year without a calendar."""
    year_end = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-12-31")).try_cast("date")
    return (
        F.when(kind == "specific_date", date)
        .when(kind == "date_range", end)
        .when((kind == "full_year") & year.between(1, 9999), year_end)
    )

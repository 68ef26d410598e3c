"""Columns of the input files and of the stored tables, as names with their Spark types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.values import Frequency

Columns = dict[str, str]


def _columns(kind: str, names: str) -> Columns:
    return dict.fromkeys(names.split(), kind)


# Column order of the bulk files and the integer-valued measures in them.
FILE_COLUMNS: dict[Frequency, Columns] = {
    Frequency.HOURLY: {"date": "string", "hour": "bigint"}
    | _columns("double", "temp dwpt rhum prcp snow wdir wspd wpgt pres tsun coco"),
    Frequency.DAILY: {"date": "string"}
    | _columns("double", "tavg tmin tmax prcp snow wdir wspd wpgt pres tsun"),
    Frequency.MONTHLY: _columns("bigint", "year month")
    | _columns("double", "tavg tmin tmax prcp wspd pres tsun"),
    Frequency.CLIMATE: _columns("bigint", "start_year end_year month")
    | _columns("double", "tmin tmax prcp wspd pres tsun"),
}
INTEGER_MEASURES: dict[Frequency, tuple[str, ...]] = {
    Frequency.HOURLY: ("rhum", "snow", "wdir", "tsun", "coco"),
    Frequency.DAILY: ("snow", "wdir", "tsun"),
    Frequency.MONTHLY: ("tsun",),
    Frequency.CLIMATE: ("tsun",),
}

# Columns that place a row in time; with the station they sort the stored tables.
TIME_COLUMNS: dict[Frequency, tuple[str, ...]] = {
    Frequency.HOURLY: ("datetime",),
    Frequency.DAILY: ("date",),
    Frequency.MONTHLY: ("year", "month"),
    Frequency.CLIMATE: ("start_year", "end_year", "month"),
}


def table_columns(frequency: Frequency) -> Columns:
    """Columns of the typed table that holds every station of a frequency."""
    columns = {"station": "string"} | FILE_COLUMNS[frequency]
    columns |= dict.fromkeys(INTEGER_MEASURES[frequency], "bigint")
    if frequency is Frequency.DAILY:
        columns["date"] = "date"
    if frequency is Frequency.HOURLY:
        columns["datetime"] = "timestamp_ntz"
    return columns


_DATES = "struct<start:date, end:date>"
_YEARS = "struct<start:int, end:int>"
CATALOGUE: Columns = {
    "id": "string",
    "country": "string",
    "region": "string",
    "timezone": "string",
    "name": "map<string, string>",
    "identifiers": "struct<national:string, wmo:string, icao:string>",
    "location": "struct<latitude:double, longitude:double, elevation:int>",
    "inventory": f"struct<daily:{_DATES}, hourly:{_DATES}, model:{_DATES}, "
    f"monthly:{_YEARS}, normals:{_YEARS}>",
}
STATUS_LOG: Columns = {"station": "string", "written_on": "date", "commit": "string"}
COMMITS: Columns = {
    "commit": "string",
    "frequency": "string",
    "kind": "string",
    "version": "bigint",
    "base": "bigint",
    "buckets": "int",
    "replaces": "array<string>",
}
REJECTS: Columns = {
    "station": "string",
    "frequency": "string",
    "path": "string",
    "modified": "timestamp",
    "reason": "string",
    "line": "string",
    "lines": "bigint",
    "seen_on": "date",
}

#: Columns by which a stored table is split into folders.
LAYOUT: Columns = {"bucket": "int", "year_part": "int"}


def year_part(frequency: Frequency) -> Column:
    """The year of a row, by which its table is split; of normals the year they begin with."""
    if frequency in (Frequency.HOURLY, Frequency.DAILY):
        return F.year(TIME_COLUMNS[frequency][0])
    return F.col(TIME_COLUMNS[frequency][0]).try_cast("int")


def month_of(frequency: Frequency) -> list[Column]:
    """What sorts the rows of a year before the station does."""
    return [F.month(TIME_COLUMNS[frequency][0])] if frequency in (Frequency.HOURLY, Frequency.DAILY) else []


def ddl(columns: Columns) -> str:
    """The schema text that Spark's readers take."""
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def empty(spark: SparkSession, columns: Columns) -> DataFrame:
    """A table without rows, known as such to the optimizer."""
    nulls = (F.lit(None).cast(kind).alias(name) for name, kind in columns.items())
    return spark.range(1).select(*nulls).filter(F.lit(False))

"""Records: renamed, narrowed rows with decoded weather conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.conditions import condition_name
from stationlake.values import Frequency

# Record field, table column, and whether the field is a 32-bit integer.
_TEMPERATURES = (
    ("average_temperature", "tavg", False),
    ("minimum_temperature", "tmin", False),
    ("maximum_temperature", "tmax", False),
)
FIELDS: dict[Frequency, tuple[tuple[str, str, bool], ...]] = {
    Frequency.HOURLY: (
        ("datetime", "datetime", False),
        ("temperature", "temp", False),
        ("dew_point", "dwpt", False),
        ("relative_humidity", "rhum", True),
        ("precipitation", "prcp", False),
        ("snow", "snow", True),
        ("wind_direction", "wdir", True),
        ("wind_speed", "wspd", False),
        ("peak_wind_gust", "wpgt", False),
        ("pressure", "pres", False),
        ("sunshine_minutes", "tsun", True),
    ),
    Frequency.DAILY: (
        ("date", "date", False),
        *_TEMPERATURES,
        ("precipitation", "prcp", False),
        ("snow", "snow", True),
        ("wind_direction", "wdir", True),
        ("wind_speed", "wspd", False),
        ("peak_wind_gust", "wpgt", False),
        ("pressure", "pres", False),
        ("sunshine_minutes", "tsun", True),
    ),
    Frequency.MONTHLY: (
        ("year", "year", True),
        ("month", "month", True),
        *_TEMPERATURES,
        ("precipitation", "prcp", False),
        ("wind_speed", "wspd", False),
        ("pressure", "pres", False),
        ("sunshine_minutes", "tsun", True),
    ),
    Frequency.CLIMATE: (
        ("start_year", "start_year", True),
        ("end_year", "end_year", True),
        ("month", "month", True),
        *_TEMPERATURES[1:],
        ("precipitation", "prcp", False),
        ("wind_speed", "wspd", False),
        ("pressure", "pres", False),
        ("sunshine_minutes", "tsun", True),
    ),
}


def is_valid(frequency: Frequency) -> Column:
    """A row whose time is known: only such rows become records."""
    if frequency is Frequency.HOURLY:
        return F.col("datetime").isNotNull()
    if frequency is Frequency.DAILY:
        return F.col("date").isNotNull()
    years = ("year",) if frequency is Frequency.MONTHLY else ("start_year", "end_year")
    valid = F.col("month").between(1, 12)
    for year in years:
        valid = valid & F.col(year).try_cast("int").isNotNull()
    return valid


def _fields(frequency: Frequency) -> list[Column]:
    columns = [
        (F.col(source).try_cast("int") if narrow else F.col(source)).alias(field)
        for field, source, narrow in FIELDS[frequency]
    ]
    if frequency is Frequency.HOURLY:
        columns.append(condition_name(F.col("coco")).alias("condition"))
    return columns


def records(df: DataFrame, frequency: Frequency, keep: Sequence[str] = ("station",)) -> DataFrame:
    """Records of a weather table, led by the columns of ``keep`` that it has.

    Rows without a valid time are left out; integers beyond 32 bits become null.
    """
    kept = [name for name in keep if name in df.columns]
    return df.filter(is_valid(frequency)).select(*kept, *_fields(frequency))


def _json_value(df: DataFrame, field: Column, name: str) -> Column:
    """JSON has no NaN and no infinity: they become null. Instants are UTC and say so."""
    kind = df.select(field).schema[0].dataType
    if isinstance(kind, T.DoubleType):
        finite = ~F.isnan(field) & (F.abs(field) != F.lit(float("inf")))
        return F.when(finite, field).alias(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.concat(F.translate(field.cast("string"), " ", "T"), F.lit("Z")).alias(name)
    return field


def json_records(df: DataFrame, frequency: Frequency) -> DataFrame:
    """``station`` and the record as JSON text; nulls are kept."""
    names = [field for field, _, _ in FIELDS[frequency]]
    names += ["condition"] if frequency is Frequency.HOURLY else []
    fields = [_json_value(df, f, n) for f, n in zip(_fields(frequency), names, strict=True)]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    kept = [name for name in ("station",) if name in df.columns]
    return df.filter(is_valid(frequency)).select(*kept, text.alias("record"))


def single_records(
    rows: DataFrame, requests: DataFrame, frequency: Frequency, key: str = "request_id"
) -> tuple[DataFrame, DataFrame]:
    """Requests with exactly one row, as records, and the others with their ``actual`` count.

    Rows are counted before invalid ones are left out; a request whose only row is invalid
    counts as 0. A request's rows are reduced to a count and one row before the shuffle, so one
    with very many rows costs no more than the others.
    """
    row = F.struct(*(F.col(name) for name in rows.columns if name != key))
    per_request = rows.groupBy(key).agg(
        F.count("*").alias("found"), F.first(F.when(is_valid(frequency), row)).alias("row")
    )
    counted = requests.select(key).join(per_request, key, "left")
    found = F.coalesce("found", F.lit(0).cast("bigint"))
    single = (found == 1) & F.col("row").isNotNull()
    accepted = records(
        counted.filter(single).select(key, "row.*"), frequency, keep=(key, "station")
    )
    rejected = counted.filter(~single).select(
        key, F.when(found == 1, F.lit(0).cast("bigint")).otherwise(found).alias("actual")
    )
    return accepted, rejected

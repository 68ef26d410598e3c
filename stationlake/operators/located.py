"""Weather for requests: at a point in time or over a period, at a station or at a place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions.periods import nearest_hour
from stationlake.operators.frames import months_between
from stationlake.operators.joins import FAN_OUT, join_requests, salted_join
from stationlake.schemas import LAYOUT, TIME_COLUMNS
from stationlake.scratch import staged
from stationlake.sizing import BROADCAST_ROWS
from stationlake.values import Frequency

Bucket = Callable[[Column], Column]


def stations_with_data(weather: DataFrame) -> DataFrame:
    """Stations that have at least one row. A store answers this from its status table."""
    return weather.select("station").distinct()


def time_key(frequency: Frequency, at: Column) -> dict[str, Column]:
    """Time columns of the row that an instant or a day falls on."""
    if frequency is Frequency.HOURLY:
        return {"datetime": nearest_hour(at)}
    if frequency is Frequency.DAILY:
        return {"date": at.cast("date")}
    if frequency is Frequency.MONTHLY:
        return {"year": F.year(at).cast("bigint"), "month": F.month(at).cast("bigint")}
    raise ValueError("normals have no single point in time; give their three columns")


def _values(weather: DataFrame) -> list[str]:
    return [name for name in weather.columns if name != "station" and name not in LAYOUT]


def _year_of(frequency: Frequency, at: dict[str, Column]) -> Column:
    """The year by which a store splits its table, of a row with the given time columns."""
    name = TIME_COLUMNS[frequency][0]
    return at[name].cast("int") if frequency in (Frequency.MONTHLY, Frequency.CLIMATE) else F.year(at[name])


def _served(requests: DataFrame, bucket: Bucket | None) -> tuple[DataFrame, list[str]]:
    """Requests with a station, and the station keys shared with the weather table.

    With ``bucket``, the bucket function of a store, the join also prunes its folders.
    """
    requests = requests.filter(F.col("station").isNotNull())
    if bucket is None:
        return requests, ["station"]
    # The comparison is always true; it makes Spark see that requests may narrow the buckets.
    requests = requests.withColumn("bucket", bucket(F.col("station"))).filter("bucket >= 0")
    return requests, ["bucket", "station"]


def weather_at(
    requests: DataFrame,
    weather: DataFrame,
    frequency: Frequency,
    at: dict[str, Column],
    count: int,
    bucket: Bucket | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """The weather row of each request's ``station`` at the time columns given by ``at``.

    ``requests`` holds ``request_id`` and ``station``, such as the result of
    :func:`~stationlake.operators.nearest.serving_stations`; of its other columns only the
    ``distance_km`` is kept. A request whose station has no such row has no result. ``count``
    bounds the number of requests.
    """
    requests, keys = _served(requests, bucket)
    kept = [name for name in ("distance_km",) if name in requests.columns]
    if "year_part" in weather.columns:  # the folders of the years asked for
        requests = requests.withColumn("year_part", _year_of(frequency, at)).filter("year_part IS NOT NULL")
        keys = [*keys, "year_part"]
    narrow = requests.select(
        "request_id", *kept, *keys, *(value.alias(name) for name, value in at.items())
    )
    joined = join_requests(
        narrow,
        weather,
        [*keys, *TIME_COLUMNS[frequency]],
        count,
        broadcast_rows=broadcast_rows,
        fan_out=fan_out,
    )
    return joined.select("request_id", "station", *kept, *_values(weather))


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _bins(frequency: Frequency, start: dict[str, Column], end: dict[str, Column]) -> Column:
    """Calendar bins that a range touches: months of days and hours, years of months."""
    if frequency is Frequency.MONTHLY:
        first, last = start["year"].cast("bigint"), end["year"].cast("bigint")
    else:
        name = TIME_COLUMNS[frequency][0]
        first, last = _month_number(start[name]), _month_number(end[name])
    # A range that ends before it starts has no bins and so no rows.
    return F.when(first <= last, F.sequence(first, last))


def weather_between(
    requests: DataFrame,
    weather: DataFrame,
    frequency: Frequency,
    start: dict[str, Column],
    end: dict[str, Column],
    bucket: Bucket | None = None,
    count: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Weather rows of each request's ``station`` from ``start`` to ``end``, both included.

    ``start`` and ``end`` give the time columns of the frequency as Columns of ``requests``; a null
    bound gives no rows. Requests are repeated per calendar bin of their range and meet the rows by
    (station, bin), so a station's rows outside the range are hardly looked at. ``count`` bounds the
    number of requests times bins; without it, it is counted.
    """
    requests, keys = _served(requests, bucket)
    kept = [name for name in ("distance_km",) if name in requests.columns]
    names = list(start)
    narrow = requests.select(
        "request_id",
        *kept,
        *keys,
        *(start[name].alias(f"from_{name}") for name in names),
        *(end[name].alias(f"to_{name}") for name in names),
    )
    bins = _bins(
        frequency,
        {name: F.col(f"from_{name}") for name in names},
        {name: F.col(f"to_{name}") for name in names},
    )
    if count is None:
        count = narrow.agg(F.sum(F.size(F.coalesce(bins, F.array())))).first()[0] or 0
    binned = narrow.withColumn("bin", F.explode(bins))
    if "year_part" in weather.columns:  # the folders of the years asked for
        of_bin = F.col("bin") if frequency is Frequency.MONTHLY else F.floor((F.col("bin") - 1) / 12)
        binned, keys = binned.withColumn("year_part", of_bin.cast("int")), [*keys, "year_part"]
    if frequency is Frequency.MONTHLY:
        within = months_between(*(
            F.col(name) for name in ("from_year", "from_month", "to_year", "to_month")
        ))
        rows = weather.withColumn("bin", F.col("year").cast("bigint"))
    else:
        (name,) = TIME_COLUMNS[frequency]
        within = (F.col(name) >= F.col(f"from_{name}")) & (F.col(name) <= F.col(f"to_{name}"))
        rows = weather.withColumn("bin", _month_number(F.col(name)))
    joined = join_requests(binned, rows, [*keys, "bin"], count, within, broadcast_rows, fan_out)
    return joined.select("request_id", "station", *kept, *_values(weather))


def weather_of(
    requests: DataFrame,
    weather: DataFrame,
    count: int,
    bucket: Bucket | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """All rows of ``weather`` for each request's ``station``.

    For one period that all requests share, filter the frame first: the period is then part of the
    scan. Beyond ``fan_out`` requests, weather of a table with folders by year is paired by
    (station, year), so that neither a station's requests nor its history lie in one task.
    """
    requests, keys = _served(requests, bucket)
    kept = [name for name in ("distance_km",) if name in requests.columns]
    narrow = requests.select("request_id", *kept, *keys)
    if count > min(fan_out, broadcast_rows) and "year_part" in weather.columns:
        narrow = staged(narrow, "requests")
        # Few rows a station; only the columns of the layout are read for them.
        years = weather.select(*keys, "year_part").distinct()
        years = years.join(narrow.select(*keys).distinct(), keys, "left_semi")
        narrow = salted_join(narrow, years, keys, count)
        keys = [*keys, "year_part"]
    joined = join_requests(
        narrow,
        weather,
        keys,
        count,
        broadcast_rows=broadcast_rows,
        fan_out=fan_out,
    )
    return joined.select("request_id", "station", *kept, *_values(weather))

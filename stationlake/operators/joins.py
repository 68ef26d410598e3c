"""Equi-joins of requests with larger tables that survive hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.scratch import staged
from stationlake.sizing import BROADCAST_ROWS

# A key that holds more than one in SHARES rows is hot. There can be at most SHARES such keys,
# whatever the data, which bounds the broadcast that spreads them.
SHARES = 2000

# Requests that one weather row may be paired with in the task that reads it.
FAN_OUT = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int, shares: int = SHARES) -> DataFrame:
    """Hot keys of ``df`` with the number of parts, ``_parts``, to split each into.

    ``rows`` is the number of rows of ``df`` or an upper bound of it. Counts are combined before
    the shuffle, so a hot key is no burden here.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    share = max(1.0, rows / shares)
    return counts.filter(F.col("_n") > share).select(
        *keys, F.ceil(F.col("_n") / F.lit(share)).cast("int").alias("_parts")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    rows: int,
    how: str = "inner",
    condition: Column | None = None,
    shares: int = SHARES,
) -> DataFrame:
    """Equi-join in which rows of ``left`` with a hot key are spread over several tasks.

    ``left`` has a ``request_id`` to spread by. The rows of ``right`` with a hot key are repeated
    once per part, so all pairs are kept and none comes twice. Rows of ``left`` without a key,
    which a left join keeps, match nothing and are spread as well. ``rows`` bounds the number of
    rows of ``left``.
    """
    hot = F.broadcast(hot_keys(left.dropna(subset=list(keys)), keys, rows, shares))
    parts = F.coalesce("_parts", F.lit(1))
    no_key = F.greatest(*(F.col(key).isNull() for key in keys), F.lit(False))
    spread = (
        left.join(hot, list(keys), "left")
        .withColumn(
            "_salt",
            F.pmod(F.xxhash64("request_id"), F.when(no_key, F.lit(shares)).otherwise(parts))
            .cast("int"),
        )
        .drop("_parts")
    )
    repeated = (
        right.join(hot, list(keys), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    joined = [*keys, "_salt"]
    if condition is None:
        return spread.join(repeated, joined, how).drop("_salt")
    on = condition
    for name in joined:
        repeated = repeated.withColumnRenamed(name, f"_right_{name}")
        on = on & (F.col(name) == F.col(f"_right_{name}"))
    return spread.join(repeated, on, how).drop("_salt", *(f"_right_{name}" for name in joined))


def join_requests(
    requests: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    count: int,
    condition: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Inner join of requests with weather rows; ``count`` bounds the number of requests.

    Up to ``fan_out`` requests are broadcast and paired where the weather table is scanned: no row
    can then have more pairs than that. More are written once and their different keys asked once:
    a semi-join thins out the weather, each row of it kept at most once however many requests want
    it, and only then are rows and requests paired, with hot keys of the requests spread. While the
    keys can be broadcast, the weather table itself is not shuffled.
    """
    if count <= min(fan_out, broadcast_rows):
        joined = rows.join(F.broadcast(requests), list(keys), "inner")
        return joined if condition is None else joined.filter(condition)
    requests = staged(requests, "requests")
    count = requests.count()
    if count <= broadcast_rows:
        asked = requests.select(*keys).distinct()
        if "bucket" in keys:  # always true; makes Spark see that requests may narrow the folders
            asked = asked.filter("bucket >= 0")
        rows = rows.join(F.broadcast(asked), list(keys), "left_semi")
    return salted_join(requests, rows, keys, count, "inner", condition)

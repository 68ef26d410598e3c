"""Broadcast only what was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow table (ids, coordinates, a few dates: about 100 bytes in memory) that one
# executor can hold as a broadcast, about 200 MB.
BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it is counted to be small, else leave it to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df

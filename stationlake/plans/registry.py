"""Where queries are registered, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationlake.plans.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None, views: tuple[str, ...] = ()) -> None:
    """Register a query and, where SQL can say the same, its SQL over the named views.

    SQL that starts with a comma goes on with the list of WITH terms.
    """
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = with_views(sql, *views) if views else sql.strip()

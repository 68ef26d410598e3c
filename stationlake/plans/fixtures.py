"""Weather-shaped views of the test tables.

Every view is one SELECT. Spark runs it over DataFrames, but for ``climate``, which it explodes
instead of a cross join; the SQL for cross-checking puts the SELECT into a WITH list.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("supplier", "nation", "customer", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {
    "stations": """
        SELECT lpad(cast(s.s_suppkey AS varchar(9)), 9, '0') AS station,
          substr(n.n_name, 1, 2) AS country,
          CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE n.n_name END AS region,
          s.s_name AS name_en,
          48.0 + cast((s.s_suppkey * 7919) % 401 AS double) / 100 AS latitude,
          5.0 + cast((s.s_suppkey * 104729) % 809 AS double) / 100 AS longitude,
          CASE WHEN s.s_suppkey % 10 = 0 THEN NULL ELSE cast(s.s_suppkey * 3 % 2500 AS int) END AS elevation,
          CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE date '1992-01-01' + cast((s.s_suppkey * 13) % 2000 AS int) END AS daily_start,
          CASE WHEN s.s_suppkey % 13 = 0 THEN NULL ELSE date '1999-01-01' + cast((s.s_suppkey * 17) % 2000 AS int) END AS daily_end,
          CASE WHEN s.s_suppkey % 11 = 0 THEN NULL ELSE date '2000-01-01' + cast((s.s_suppkey * 131) % 9000 AS int) END AS hourly_start,
          CASE WHEN s.s_suppkey % 13 = 0 THEN NULL ELSE date '2023-06-01' + cast((s.s_suppkey * 17) % 900 AS int) END AS hourly_end,
          CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE cast(1990 + s.s_suppkey % 8 AS int) END AS monthly_start,
          CASE WHEN s.s_suppkey % 17 = 0 THEN NULL ELSE cast(1999 + s.s_suppkey % 5 AS int) END AS monthly_end,
          CASE WHEN s.s_suppkey % 6 = 0 THEN NULL ELSE 1961 END AS normals_start,
          CASE WHEN s.s_suppkey % 6 = 0 THEN NULL ELSE 2020 END AS normals_end
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
    """,
    "requests": """
        SELECT c.c_custkey AS request_id,
          48.0 + cast((c.c_custkey * 6151) % 4001 AS double) / 1000 AS lat,
          5.0 + cast((c.c_custkey * 3571) % 8009 AS double) / 1000 AS lon,
          e.ts AS at,
          cast(o.o_orderdate AS date) AS on_date
        FROM customer c
        JOIN events e ON e.event_id = c.c_custkey
        JOIN orders o ON o.o_orderkey = c.c_custkey
    """,
    "hot_place": """
        SELECT min(s.station) AS station FROM stations s JOIN daily d ON d.station = s.station
        WHERE s.daily_start IS NOT NULL AND s.daily_end IS NOT NULL
    """,
    "hot_requests": """
        SELECT r.request_id, CASE WHEN r.request_id % 3 = 0 THEN p.lat ELSE r.lat END AS lat,
          CASE WHEN r.request_id % 3 = 0 THEN p.lon ELSE r.lon END AS lon, r.at,
          CASE WHEN r.request_id % 3 = 0 THEN p.on_date ELSE r.on_date END AS on_date
        FROM requests r JOIN (
          SELECT 1 AS one, max(s.latitude) AS lat, max(s.longitude) AS lon, min(d.date) AS on_date
          FROM hot_place h JOIN stations s ON s.station = h.station JOIN daily d ON d.station = h.station) p
          ON p.one = CASE WHEN r.request_id IS NULL THEN 0 ELSE 1 END
    """,
    "hourly": """
        SELECT station, cast(cast(datetime AS date) AS varchar(10)) AS date,
          cast(extract(hour FROM datetime) AS bigint) AS hour,
          temp, dwpt, rhum, prcp, snow, wdir, wspd, wpgt, pres, tsun, coco, datetime
        FROM (
          SELECT lpad(cast(user_id % (SELECT count(*) FROM supplier) AS varchar(9)), 9, '0') AS station,
            date_trunc('hour', ts) AS datetime,
            max(value) / 10 - 10 AS temp, min(value) / 10 - 12 AS dwpt,
            max(event_id % 101) AS rhum,
            CASE WHEN max(event_type) = 'view' THEN NULL ELSE min(value) END AS prcp,
            CASE WHEN max(event_id) % 3 = 0 THEN NULL ELSE max(event_id % 50) END AS snow,
            max(event_id * 7 % 361) AS wdir, max(value) / 20 AS wspd, max(value) / 8 AS wpgt,
            980.0 + cast(max(event_id % 600) AS double) / 10 AS pres,
            max(event_id % 61) AS tsun, max(event_id % 30) AS coco
          FROM events WHERE (user_id % (SELECT count(*) FROM supplier)) % 9 <> 0
          GROUP BY 1, 2) h
    """,
    "daily": """
        SELECT lpad(cast(l_suppkey AS varchar(9)), 9, '0') AS station, cast(l_shipdate AS date) AS date,
          (max(l_quantity) + min(l_quantity)) / 2 - 15 AS tavg, min(l_quantity) - 20 AS tmin, max(l_quantity) - 10 AS tmax,
          CASE WHEN max(l_linestatus) = 'O' THEN NULL ELSE max(l_tax) * 100 END AS prcp,
          CASE WHEN max(l_orderkey) % 4 = 0 THEN NULL ELSE max(l_partkey % 30) END AS snow,
          max(l_partkey * 7 % 361) AS wdir, max(l_discount) * 100 AS wspd, max(l_extendedprice) / 1000 AS wpgt,
          980.0 + cast(max(l_orderkey % 600) AS double) / 10 AS pres, max(l_orderkey % 900) AS tsun
        FROM lineitem WHERE l_suppkey % 9 <> 0 GROUP BY 1, 2
    """,
    "monthly": """
        SELECT lpad(cast(l_suppkey AS varchar(9)), 9, '0') AS station,
          cast(extract(year FROM l_shipdate) AS bigint) AS year, cast(extract(month FROM l_shipdate) AS bigint) AS month,
          (max(l_quantity) + min(l_quantity)) / 2 - 15 AS tavg, min(l_quantity) - 20 AS tmin, max(l_quantity) - 10 AS tmax,
          CASE WHEN max(l_orderkey) % 4 = 0 THEN NULL ELSE max(l_tax) * 100 END AS prcp,
          max(l_discount) * 100 AS wspd, 980.0 + cast(max(l_orderkey % 600) AS double) / 10 AS pres,
          max(l_orderkey % 20000) AS tsun
        FROM lineitem WHERE l_suppkey % 9 <> 0 GROUP BY 1, 2, 3
    """,
    "climate": """
        SELECT lpad(cast(s_suppkey AS varchar(9)), 9, '0') AS station,
          cast(p.start_year AS bigint) AS start_year, cast(p.end_year AS bigint) AS end_year, cast(m.month AS bigint) AS month,
          cast((s_suppkey * m.month) % 40 AS double) - 20 AS tmin, cast((s_suppkey * m.month) % 40 AS double) AS tmax,
          CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE cast((s_suppkey * 3 + m.month) % 200 AS double) END AS prcp,
          cast(s_suppkey % 30 AS double) AS wspd, 1000.0 + cast(s_suppkey % 30 AS double) AS pres,
          s_suppkey * m.month % 9000 AS tsun
        FROM supplier
        CROSS JOIN (VALUES (1961, 1990), (1991, 2020)) AS p(start_year, end_year)
        CROSS JOIN (VALUES (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13)) AS m(month)
        WHERE s_suppkey % 5 <> 0
    """,
    "period_requests": """
        SELECT c.c_custkey AS request_id,
          lpad(cast(c.c_custkey % (SELECT count(*) FROM supplier) AS varchar(9)), 9, '0') AS station,
          CASE WHEN c.c_custkey % 7 = 0 THEN '2023-13' WHEN c.c_custkey % 11 = 0 THEN 'soon'
               WHEN c.c_custkey % 3 = 0 THEN substr(cast(cast(o.o_orderdate AS date) AS varchar(10)), 1, 4)
               WHEN c.c_custkey % 3 = 1 THEN substr(cast(cast(o.o_orderdate AS date) AS varchar(10)), 1, 7)
               ELSE cast(cast(o.o_orderdate AS date) AS varchar(10)) END AS period
        FROM customer c JOIN orders o ON o.o_orderkey = c.c_custkey
    """,
    "store_status": """
        SELECT station, 'daily' AS frequency,
          CASE WHEN cast(station AS int) % 9 = 0 THEN NULL
               ELSE date '2024-01-01' + cast((cast(station AS int) * 37) % 400 AS int) END AS written_on
        FROM stations
    """,
}


def _tables_of(name: str) -> list[str]:
    """Base tables and other views that a view reads."""
    words = set(re.findall(r"\b(?:FROM|JOIN) (\w+)", VIEWS[name]))
    return [table for table in (*BASE_TABLES, *VIEWS) if table in words]


def with_views(body: str, *names: str) -> str:
    """A query that may use the named views, as SQL over the base tables alone."""
    needed: list[str] = []

    def add(name: str) -> None:
        for table in _tables_of(name):
            if table in VIEWS:
                add(table)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    terms = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    return f"WITH {terms} {body.strip()}"


def _climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The climate view: each station row is exploded into two periods of thirteen months."""
    key, month = F.col("s_suppkey"), F.col("month")
    periods = F.array(*(
        F.struct(F.lit(start).alias("start_year"), F.lit(start + 29).alias("end_year"))
        for start in (1961, 1991)
    ))
    low = (key * month % 40).cast("double")
    return (
        spark.read.parquet(f"{sf_dir}/supplier.parquet")
        .filter("s_suppkey % 5 <> 0")
        .select("s_suppkey", F.inline(periods))
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(13))))
        .select(
            F.lpad(key.cast("string"), 9, "0").alias("station"),
            F.col("start_year").cast("bigint").alias("start_year"),
            F.col("end_year").cast("bigint").alias("end_year"),
            month.cast("bigint").alias("month"),
            (low - 20).alias("tmin"),
            low.alias("tmax"),
            F.when(key % 4 != 0, ((key * 3 + month) % 200).cast("double")).alias("prcp"),
            (key % 30).cast("double").alias("wspd"),
            (1000.0 + (key % 30).cast("double")).alias("pres"),
            (key * month % 9000).alias("tsun"),
        )
    )


#: Tests of the largest text of a group, and the same of numbers in its place: a largest text is kept by sorting all rows, a
#: largest number by hashing.
HASHED = {
    f"max({column}) = '{value}'": f"max(CASE WHEN {column} > '{value}' THEN 2 WHEN {column} = '{value}' THEN 1 WHEN {column} < '{value}' THEN 0 END) = 1"
    for column, value in (("event_type", "view"), ("l_linestatus", "O"))
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views over the tables in ``sf_dir``."""
    if name == "climate":
        return _climate(spark, sf_dir)
    inputs = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if table in BASE_TABLES
        else view(spark, sf_dir, table)
        for table in _tables_of(name)
    }
    text = VIEWS[name]
    for plain, hashed in HASHED.items():
        text = text.replace(plain, hashed)
    for table in inputs:
        text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
    df = spark.sql(text, **inputs)
    if name == "hourly":
        df = df.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    return df


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations view in the nested form of the catalogue."""

    def span(name: str, start: str = "", end: str = "") -> Column:
        return F.struct(
            (F.col(start) if start else F.lit(None).cast("date")).alias("start"),
            (F.col(end) if end else F.lit(None).cast("date")).alias("end"),
        ).alias(name)

    text = F.lit(None).cast("string")
    return view(spark, sf_dir, "stations").select(
        F.col("station").alias("id"),
        "country",
        "region",
        text.alias("timezone"),
        F.create_map(F.lit("en"), F.col("name_en")).alias("name"),
        F.struct(text.alias("national"), text.alias("wmo"), text.alias("icao")).alias(
            "identifiers"
        ),
        F.struct("latitude", "longitude", "elevation").alias("location"),
        F.struct(
            span("daily", "daily_start", "daily_end"),
            span("hourly", "hourly_start", "hourly_end"),
            span("model"),
            span("monthly", "monthly_start", "monthly_end"),
            span("normals", "normals_start", "normals_end"),
        ).alias("inventory"),
    )

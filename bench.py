"""Time the headline queries and print one JSON line.

The test tables are written once into a store, as an ingest would leave them. Each case then runs
over all requests (or all rows) at once, without the views that shape the test tables; results are
computed in full and thrown away. Times are medians of warm runs.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import time

import pyspark
from pyspark.sql import functions as F

from stationlake import Frequency, LatLon, Month, RequiredData, WeatherLake, Year
from stationlake.operators import located, nearest
from stationlake.plans.fixtures import catalogue, view
from stationlake.plans.store_queries import VIEW_OF, WRITTEN
from stationlake.scratch import scratch_folder
from tests.compare import make_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
PLACE = LatLon(50.038, 8.559)
ONE_STATION = "000000007"


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def prepare(spark):
    """The lake and the request table, both as Parquet."""
    lake = WeatherLake(spark, scratch_folder(spark, "bench"), buckets=8)
    lake.store.save_catalogue(catalogue(spark, SF_DIR))
    ingest = {}
    for frequency, name in VIEW_OF.items():
        started = time.perf_counter()
        lake.store.append(view(spark, SF_DIR, name), frequency, WRITTEN)
        ingest[f"store.{name}"] = round(time.perf_counter() - started, 3)
    folder = scratch_folder(spark, "requests")
    requests = view(spark, SF_DIR, "requests").withColumn("at", F.col("at").cast("timestamp_ntz"))
    requests.write.parquet(folder)
    return lake, spark.read.parquet(folder), ingest


def cases(lake, requests, count):
    hourly, daily, monthly, climate = lake.hourly(), lake.daily(), lake.monthly(), lake.climate()
    bucket = lake.store.bucket_of
    on_day = RequiredData.specific_date(F.col("on_date"))
    on_hour = RequiredData.specific_date(F.col("at").cast("date"))

    def over(weather, frame):
        served = weather.serving(requests, station_limit=3, count=count)
        return located.weather_of(served, frame.rows, count, bucket)

    normals = {
        "start_year": F.lit(1991).cast("bigint"),
        "end_year": F.lit(2020).cast("bigint"),
        "month": F.month("on_date").cast("bigint"),
    }
    return {
        "catalogue": lambda: compute(lake.store.stations()),
        "from_station.hourly": lambda: compute(hourly.station(ONE_STATION).df),
        "from_location.hourly": lambda: compute(hourly.serving(requests, count=count)),
        "from_location.daily": lambda: compute(daily.serving(requests, count=count)),
        "from_location.monthly": lambda: compute(monthly.serving(requests, count=count)),
        "from_location.climate": lambda: compute(climate.serving(requests, count=count)),
        "from_location.hourly+day": lambda: compute(
            over(hourly, hourly.all().get_for_period(dt.date(2024, 1, 15)))
        ),
        "from_location.daily+year": lambda: compute(
            over(daily, daily.all().get_for_period(Year(1996)))
        ),
        "from_location.monthly+range": lambda: compute(
            over(monthly, monthly.all().get_range(Month(year=1995, month=11), Year(1997)))
        ),
        "from_location.climate+at": lambda: compute(climate.at(requests, normals)),
        "from_location.hourly+single": lambda: compute(
            hourly.at(requests, "at", on_hour, station_limit=3)
        ),
        "from_location.daily+single": lambda: compute(
            daily.at(requests, "on_date", on_day, station_limit=3)
        ),
        "find_stations": lambda: compute(
            nearest.find_stations(
                requests,
                lake.store.stations(),
                Frequency.HOURLY,
                RequiredData.full_year(2023),
                k=3,
            )
        ),
        "one_call.find_stations": lambda: lake.find_stations(
            PLACE, Frequency.HOURLY, RequiredData.full_year(2023), station_limit=3
        ).collect(),
        "one_call.daily+year": lambda: daily.location(PLACE, station_limit=3)
        .get_for_period(Year(1996))
        .df.collect(),
        "daily_records": lambda: compute(daily.all().records()),
    }


def main() -> None:
    spark = make_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    lake, requests, ingest = prepare(spark)
    count = requests.count()
    times = {}
    for name, run in cases(lake, requests, count).items():
        run()
        taken = []
        for _ in range(RUNS):
            started = time.perf_counter()
            run()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "ingest": ingest,
                "requests": count,
                "requests_per_sec": {
                    name: round(count / taken)
                    for name, taken in times.items()
                    if name.startswith(("from_location", "find_stations"))
                },
                "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
                "cpus": int(CPUS),
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

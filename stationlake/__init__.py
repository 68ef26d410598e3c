"""Historical weather observations on Spark."""

from stationlake.lake import Weather, WeatherLake
from stationlake.operators.frames import ClimateFrame, DailyFrame, HourlyFrame, MonthlyFrame
from stationlake.operators.located import weather_at, weather_between, weather_of
from stationlake.operators.nearest import find_stations, nearest_stations, serving_stations
from stationlake.operators.records import json_records, records, single_records
from stationlake.sources.store import Store, stale_stations
from stationlake.values import (
    DateParsingError,
    ExpectedSingleRow,
    Frequency,
    LatLon,
    Month,
    NoDataForNearbyStations,
    NoDataForStation,
    NoStationWithinRadius,
    NoSuchStore,
    RequiredData,
    StationLakeError,
    UnreadableFile,
    Year,
)

__all__ = [
    "ClimateFrame",
    "DailyFrame",
    "DateParsingError",
    "ExpectedSingleRow",
    "Frequency",
    "HourlyFrame",
    "LatLon",
    "Month",
    "MonthlyFrame",
    "NoDataForNearbyStations",
    "NoDataForStation",
    "NoStationWithinRadius",
    "NoSuchStore",
    "RequiredData",
    "StationLakeError",
    "Store",
    "UnreadableFile",
    "Weather",
    "WeatherLake",
    "Year",
    "find_stations",
    "json_records",
    "nearest_stations",
    "records",
    "serving_stations",
    "single_records",
    "stale_stations",
    "weather_at",
    "weather_between",
    "weather_of",
]

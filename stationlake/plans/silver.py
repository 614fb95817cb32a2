"""Silver tables (C5 weather, C6 stations, C7 availability) from raw text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import rules as R
from stationlake.operators.cleaning import CleanRule, SilverResult, to_silver

WEATHER_RULES = (
    CleanRule("timestamp", R.clean_date),
    CleanRule("temperature_c", R.clean_temperature),
    CleanRule("rain_mm", R.clean_rain_mm),
    CleanRule("weather_condition", R.clean_weather),
)

STATION_RULES = (
    CleanRule("station_id", R.clean_positive_int),
    CleanRule("station_name", R.clean_station_name),
    CleanRule("lat", R.clean_latitude),
    CleanRule("lon", R.clean_longitude),
    CleanRule("capacity", R.clean_positive_int),
)

# Order matters: bikes are checked against the raw free slots first, then the free
# slots against the cleaned bikes, so the second column wins.
AVAILABILITY_RULES = (
    CleanRule("station_id", R.staged_positive_int),
    CleanRule("timestamp", R.clean_date),
    CleanRule("bikes_available", R.staged_bike_count, ("slots_free", "capacity")),
    CleanRule("slots_free", R.staged_bike_count, ("bikes_available", "capacity")),
)


def weather_silver(raw_weather: DataFrame, *, observe: bool = False,
                   days: tuple[str, str] | None = None) -> SilverResult:
    """Clean weather readings; adds ``date_partition``; no dedup."""
    return to_silver(raw_weather, WEATHER_RULES, partition_col="timestamp", observe=observe, days=days)


def station_silver(raw_stations: DataFrame, *, observe: bool = False) -> SilverResult:
    """Clean the station list; no dedup, no date."""
    return to_silver(raw_stations, STATION_RULES, observe=observe)


def raw_capacity(raw_stations: DataFrame) -> DataFrame:
    """The raw capacity of each raw station id (J1); of an id listed twice the smaller text, so a
    reading stays one row."""
    return raw_stations.groupBy("station_id").agg(F.min("capacity").alias("capacity"))


def availability_silver(raw_availability: DataFrame, raw_stations: DataFrame, *,
                        observe: bool = False, days: tuple[str, str] | None = None,
                        counted: bool = False) -> SilverResult:
    """Clean availability readings.

    The raw readings get the raw station capacity (left join on the raw station id),
    are cleaned, scored by completeness and deduplicated on ``(station_id, timestamp)``
    keeping the most complete reading. No broadcast hint: the station list grows with
    the data, so the join strategy is left to AQE's runtime size check, which broadcasts
    it when small and splits skewed station partitions otherwise.
    """
    capacity = raw_capacity(raw_stations)
    joined = raw_availability.join(capacity, on="station_id", how="left")
    return to_silver(joined, AVAILABILITY_RULES, score=True,
                     dedup_keys=("station_id", "timestamp"), partition_col="timestamp",
                     drop_cols=("capacity", "score"), observe=observe, days=days, counted=counted)

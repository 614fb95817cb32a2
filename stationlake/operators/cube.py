"""Station-day cube: one mergeable pre-aggregate from which the daily facts and checks are projected.

A single pass over the readings (with the capacity of their station) and one shuffle give, for every
(station, day), sums and counts. Average bikes (C12), saturation (C15), the top stations (C16, C17), the
daily gold table (C18), negative and incoherent counts (C20, C21) and the daily quality table (B3) are small
queries over it, equal to their direct forms in :mod:`facts` and :mod:`quality`.

Every measure is a sum of whole numbers or of decimals, so cubes of disjoint readings add up exactly
(:func:`merge_cubes`) and a cube is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions.numeric import pct, round2
from stationlake.operators.dimensions import date_key
from stationlake.operators.facts import TOP_N, fact_dominant_weather
from stationlake.operators.quality import incoherent_capacity, with_capacity

KEYS = ("station_id", "date_partition")
MEASURES = ("n_readings", "n_matched", "n_bikes", "sum_bikes", "n_full", "n_occupancy", "sum_occupancy", "nb_neg_bikes_available",
            "nb_neg_slots_free", "nb_incoherent_capacity")
OCCUPANCY = "decimal(28,2)"  # occupancies have two decimals: their sums are exact


def station_day_cube(availability: DataFrame, stations: DataFrame) -> DataFrame:
    """The measures of every (station, day). ``n_matched`` are the readings of known stations (all or none):
    only they have a capacity, an occupancy and a saturation."""
    b, s, c, known = F.col("bikes_available"), F.col("slots_free"), F.col("capacity"), F.col("__matched")
    occupancy = F.when(known, pct(b, b + s)).cast(OCCUPANCY)
    rows = with_capacity(availability, stations).select(*KEYS, "bikes_available", "slots_free", "capacity", "__matched",
                                                        occupancy.alias("occ"))
    return rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_readings"), F.count_if(known).alias("n_matched"),
        F.count(b).alias("n_bikes"), F.coalesce(F.sum(b.cast("bigint")), F.lit(0)).alias("sum_bikes"),
        F.count_if(known & (b == c)).alias("n_full"),
        F.count("occ").alias("n_occupancy"), F.coalesce(F.sum("occ"), F.lit(0)).cast(OCCUPANCY).alias("sum_occupancy"),
        F.count_if(b < 0).alias("nb_neg_bikes_available"), F.count_if(s < 0).alias("nb_neg_slots_free"),
        F.count_if(known & incoherent_capacity(b, s, c)).alias("nb_incoherent_capacity"))


def merge_cubes(*cubes: DataFrame) -> DataFrame:
    """The cube of the readings of several cubes (none counted twice)."""
    rows = cubes[0]
    for c in cubes[1:]:
        rows = rows.unionByName(c)
    return rows.groupBy(*KEYS).agg(*[F.sum(m).cast(rows.schema[m].dataType).alias(m) for m in MEASURES])


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("date_key", date_key(F.col("date_partition")))


def cube_avg_bikes(cube: DataFrame) -> DataFrame:
    """As :func:`facts.fact_avg_bikes` over a calendar that covers the data."""
    key = F.when(F.col("n_matched") > 0, F.col("station_id").cast("bigint"))
    return _day(cube).select(round2(F.try_divide(F.col("sum_bikes").cast("double"), F.col("n_bikes").cast("double")))
                             .alias("avg_bikes_available"), "date_key", key.alias("station_key"))


def cube_saturation(cube: DataFrame) -> DataFrame:
    """As :func:`facts.fact_saturation`."""
    return _day(cube.where("n_matched > 0")).select(pct(F.col("n_full"), F.col("n_matched")).alias("saturation_pct"), "date_key",
                                                    F.col("station_id").cast("bigint").alias("station_key"))


def cube_top(cube: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` most saturated stations per day with their rank."""
    w = Window.partitionBy("date_key").orderBy(F.col("saturation_pct").desc_nulls_last(), F.col("station_key").asc_nulls_first())
    return cube_saturation(cube).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def cube_top_array(cube: DataFrame, n: int = TOP_N) -> DataFrame:
    """C17: the same as an ordered array of (station_key, saturation_pct) per day."""
    arr = F.array_sort(F.collect_list(F.struct("rank", "station_key", "saturation_pct")))
    return cube_top(cube, n).groupBy("date_key").agg(F.transform(arr, lambda x: F.struct(
        x["station_key"].alias("station_key"), x["saturation_pct"].alias("saturation_pct"))).alias("top_stations"))


def cube_gold_daily(cube: DataFrame, weather: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """As :func:`facts.gold_daily` over a calendar that covers the data."""
    bikes = cube_avg_bikes(cube).groupBy("date_key").agg(F.avg("avg_bikes_available").alias("__bikes"))
    occupancy = (_day(cube.where("n_matched > 0")).groupBy("date_key")
                 .agg(F.try_divide(F.sum("sum_occupancy").cast("double"), F.sum("n_occupancy").cast("double")).alias("__occ")))
    dominant = fact_dominant_weather(weather, None, dim_weather).select(
        "date_key", F.col("weather_condition_key").alias("weather_condition_key_day"))
    top = cube_top_array(cube).withColumnRenamed("top_stations", "top_stations_day")
    days = bikes.join(dominant, "date_key").join(occupancy, "date_key").join(top, "date_key")
    return days.select("date_key", round2(F.col("__bikes")).alias("avg_bikes_available_day"),
                       round2(F.col("__occ")).alias("occupancy_pct_day"), "weather_condition_key_day", "top_stations_day")


def cube_negatives(cube: DataFrame, target_col: str, *group_cols: str) -> DataFrame:
    """C20 for the readings' counts: as :func:`quality.count_negatives`, by station, day, both or neither."""
    name = f"nb_neg_{target_col}"
    return cube.groupBy(*group_cols).agg(F.sum(name).alias(name))


def cube_capacity_coherence(cube: DataFrame, *group_cols: str) -> DataFrame:
    """As :func:`quality.capacity_coherence`, by station, day, both or neither."""
    return cube.where("n_matched > 0").groupBy(*group_cols).agg(F.sum("nb_incoherent_capacity").alias("nb_incoherent_capacity"))


def cube_daily_quality(cube: DataFrame, frozen: DataFrame) -> DataFrame:
    """As :func:`quality.daily_quality`."""
    runs = frozen.groupBy("station_id", F.to_date("start_time").alias("date_partition")).agg(
        F.count(F.lit(1)).alias("n_frozen_runs"), F.sum("n_readings").alias("n_frozen_readings"))
    return cube.join(runs, list(KEYS), "left").select(
        *KEYS, "n_readings", "nb_neg_bikes_available", "nb_neg_slots_free", "nb_incoherent_capacity",
        F.coalesce("n_frozen_runs", F.lit(0)).alias("n_frozen_runs"), F.coalesce("n_frozen_readings", F.lit(0)).alias("n_frozen_readings"))

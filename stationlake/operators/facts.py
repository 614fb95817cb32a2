"""Facts and the daily gold table (C12–C18) and the silver enrichment.

Input conventions (silver column names):

* availability: ``station_id, timestamp, bikes_available, slots_free, date_partition``
* availability ⋈ stations (``join_stations``): the same plus ``capacity`` ...
* weather: ``timestamp, temperature_c, rain_mm, weather_condition, date_partition``

Scale notes. Dimension joins on the calendar, the weather conditions and the minute of
the day are broadcast: their size has a fixed bound (days in the range, the condition
whitelist, 1,440 minutes). The station dimension grows with the data, so its joins carry
no hint and AQE picks broadcast or sort-merge from the measured size (and splits skewed
stations). Aggregations run before joins wherever the result allows it, and top-N and
mode selections run on already aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions.numeric import pct, round2
from stationlake.operators.dimensions import date_key, one_per_station

TOP_N = 5


def reading_time(ts: Column) -> Column:
    """Cleaned timestamp text → TIMESTAMP_NTZ (NULL when the time part is not a time)."""
    return ts.try_cast("timestamp_ntz")


def _date_key(df: DataFrame, dim_date: DataFrame | None, date_col: str = "date_partition") -> DataFrame:
    """Attach ``date_key`` for ``date_col``.

    With a calendar: a (broadcast) left join — dates outside it get a NULL key. With
    ``dim_date=None`` the calendar is taken to cover the data (as ``dim_date_for`` builds
    it), and the key is computed directly: the same value, no join per row.
    """
    if dim_date is None:
        return df.withColumn("date_key", date_key(F.col(date_col))).drop(date_col)
    dates = F.broadcast(dim_date.select(F.col("date").alias("__date"), "date_key"))
    return df.join(dates, df[date_col] == dates["__date"], "left").drop("__date", date_col)


def _station_key(df: DataFrame, dim_station: DataFrame | None) -> DataFrame:
    """Attach ``station_key`` for ``station_id``. Without a dimension the key is computed: rows
    joined with the stations have an id that the dimension holds under exactly this key."""
    if dim_station is None:
        return df.withColumn("station_key", F.col("station_id").cast("bigint")).drop("station_id")
    st = dim_station.select(F.col("station_id").alias("__sid"), "station_key")
    return df.join(st, df["station_id"] == st["__sid"], "left").drop("__sid", "station_id")


def join_stations(availability: DataFrame, stations: DataFrame) -> DataFrame:
    """Availability readings with their station's attributes (inner join on the id; a station
    that is listed twice counts once, so a reading stays one row)."""
    return availability.join(one_per_station(stations.drop("date_partition")), "station_id", "inner")


def fact_avg_bikes(availability: DataFrame, dim_date: DataFrame | None, dim_station: DataFrame) -> DataFrame:
    """Average bikes per day and station."""
    agg = (availability.groupBy("date_partition", "station_id")
           .agg(round2(F.avg("bikes_available")).alias("avg_bikes_available")))
    return _station_key(_date_key(agg, dim_date), dim_station).select(
        "avg_bikes_available", "date_key", "station_key")


def fact_occupancy(joined: DataFrame, dim_date: DataFrame | None, dim_station: DataFrame | None = None,
                   dim_time: DataFrame | None = None) -> DataFrame:
    """Occupancy ``bikes / (bikes + free slots) * 100`` per reading.

    ``time_key`` is ``hour * 60 + minute`` of the reading. Without ``dim_time`` it is
    computed directly — the same value the left join with the minute dimension gives,
    since that dimension holds every minute under exactly this key — which saves a join
    per reading.
    """
    t = reading_time(F.col("timestamp"))
    df = joined.select(
        "station_id", "date_partition",
        pct(F.col("bikes_available"), F.col("bikes_available") + F.col("slots_free"))
        .alias("occupancy_pct"),
        F.hour(t).alias("hour"), F.minute(t).alias("minute"))
    df = _date_key(df, dim_date)
    if dim_time is None:
        df = df.withColumn("time_key", (F.col("hour") * 60 + F.col("minute")).cast("bigint"))
    else:
        df = df.join(F.broadcast(dim_time), ["hour", "minute"], "left")
    return _station_key(df, dim_station).select("occupancy_pct", "date_key", "time_key",
                                                "station_key")


def fact_dominant_weather(weather: DataFrame, dim_date: DataFrame | None,
                          dim_weather: DataFrame) -> DataFrame:
    """C14: most frequent condition per day (ties: the smaller condition, NULL first).

    Counting runs first (combined map-side); the ranking window then sees at most one
    row per condition and day.
    """
    counts = weather.groupBy("date_partition", "weather_condition").agg(
        F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("date_partition").orderBy(
        F.col("count").desc(), F.col("weather_condition").asc_nulls_first())
    top = counts.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    top = _date_key(top, dim_date)
    dw = F.broadcast(dim_weather.select(F.col("weather_condition").alias("__cond"),
                                        "weather_condition_key"))
    return (top.join(dw, top["weather_condition"] == dw["__cond"], "left")
            .select("count", "date_key", "weather_condition_key"))


def fact_saturation(joined: DataFrame, dim_date: DataFrame | None,
                    dim_station: DataFrame | None = None) -> DataFrame:
    """Share (%) of a station's readings of the day where bikes == capacity."""
    agg = joined.groupBy("date_partition", "station_id").agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(F.col("bikes_available") == F.col("capacity")).alias("__full"))
    agg = agg.select("date_partition", "station_id",
                     pct(F.col("__full"), F.col("__n")).alias("saturation_pct"))
    return _station_key(_date_key(agg, dim_date), dim_station).select(
        "saturation_pct", "date_key", "station_key")


def fact_top_saturated(joined: DataFrame, dim_date: DataFrame | None, dim_station: DataFrame | None = None,
                       n: int = TOP_N, with_rank: bool = False) -> DataFrame:
    """The ``n`` most saturated stations per day (ties: smaller station key first).

    ``row_number() <= n`` lets Spark insert a partial ``WindowGroupLimit`` before the
    shuffle, so each map task forwards at most ``n`` rows per day.
    """
    w = Window.partitionBy("date_key").orderBy(F.col("saturation_pct").desc_nulls_last(),
                                               F.col("station_key").asc_nulls_first())
    ranked = (fact_saturation(joined, dim_date, dim_station)
              .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))
    cols = ["saturation_pct", "date_key", "station_key"] + (["rank"] if with_rank else [])
    return ranked.select(*cols)


def fact_top_array(joined: DataFrame, dim_date: DataFrame | None, dim_station: DataFrame | None = None,
                   n: int = TOP_N) -> DataFrame:
    """C17: the top-``n`` per day as an ordered ``ARRAY<STRUCT<station_key, saturation_pct>>``.

    The order is made inside the array (sort on rank) — an ``orderBy`` before a
    ``groupBy`` does not survive the shuffle.
    """
    top = fact_top_saturated(joined, dim_date, dim_station, n, with_rank=True)
    arr = F.array_sort(F.collect_list(F.struct("rank", "station_key", "saturation_pct")))
    return top.groupBy("date_key").agg(
        F.transform(arr, lambda x: F.struct(x["station_key"].alias("station_key"),
                                            x["saturation_pct"].alias("saturation_pct")))
        .alias("top_stations"))


def explode_top_array(df: DataFrame, col: str = "top_stations") -> DataFrame:
    """Flat form ``date_key, rank, station_key, saturation_pct`` of a top-N array."""
    return df.select("date_key", F.posexplode(col).alias("__pos", "__item")).select(
        "date_key", (F.col("__pos") + 1).alias("rank"),
        F.col("__item.station_key").alias("station_key"),
        F.col("__item.saturation_pct").alias("saturation_pct"))


def gold_daily(availability: DataFrame, weather: DataFrame, joined: DataFrame,
               dim_date: DataFrame | None, dim_station: DataFrame,
               dim_weather: DataFrame, dim_time: DataFrame | None = None) -> DataFrame:
    """One row per day present in all four facts (``dim_date=None`` computes the keys of
    the dates, and those of stations wherever a reading was joined with its station).

    ``avg_bikes_available_day`` is the mean of the per-station daily averages,
    ``occupancy_pct_day`` the mean of the per-reading occupancies, with the day's
    dominant condition and top-5 array. Each fact is reduced to one row per day *before*
    the joins: joining the raw facts on the day (stations × readings rows per day) and
    averaging gives the same means, because every station row is repeated equally often
    and so is every reading.
    """
    avg_bikes = (fact_avg_bikes(availability, dim_date, dim_station)
                 .groupBy("date_key").agg(F.avg("avg_bikes_available").alias("__bikes")))
    key = None if dim_date is None else dim_station
    occupancy = (fact_occupancy(joined, dim_date, key, dim_time)
                 .groupBy("date_key").agg(F.avg("occupancy_pct").alias("__occ")))
    dominant = fact_dominant_weather(weather, dim_date, dim_weather).select(
        "date_key", F.col("weather_condition_key").alias("weather_condition_key_day"))
    top = fact_top_array(joined, dim_date, key).withColumnRenamed(
        "top_stations", "top_stations_day")
    days = (avg_bikes.join(dominant, "date_key").join(occupancy, "date_key")
            .join(top, "date_key"))
    return days.select(
        "date_key",
        round2(F.col("__bikes")).alias("avg_bikes_available_day"),
        round2(F.col("__occ")).alias("occupancy_pct_day"),
        "weather_condition_key_day", "top_stations_day")


def nearest_hour(ts_text: Column) -> Column:
    """Cleaned timestamp text → the nearest hour (half past rounds up) as TIMESTAMP_NTZ."""
    t = reading_time(ts_text)
    return F.date_trunc("hour", t + F.expr("INTERVAL 30 MINUTES")).cast("timestamp_ntz")


def nearest_hour_text(ts_text: Column) -> Column:
    """:func:`nearest_hour` as text."""
    return F.date_format(nearest_hour(ts_text), "yyyy-MM-dd HH:mm:ss")


def enrich_with_weather(joined: DataFrame, weather: DataFrame) -> DataFrame:
    """Readings with the weather of the nearest hour (left join on the hour).

    An hour with several weather rows counts once: the row first by timestamp text, condition,
    temperature and rain (NULL first), so a reading stays one row."""
    cols = ["timestamp", "weather_condition", "temperature_c", "rain_mm"]
    t = reading_time(F.col("timestamp"))
    wx = (weather.select(*cols, t.alias("__wh")).where(F.col("__wh").isNotNull() & (F.date_trunc("hour", "__wh") == F.col("__wh")))
          .groupBy("__wh").agg(F.min(F.struct(*cols)).alias("w"))
          .select("__wh", F.col("w.timestamp").alias("weather_timestamp"), "w.temperature_c", "w.rain_mm",
                  "w.weather_condition"))
    r = joined.withColumn("__hour", nearest_hour(F.col("timestamp")))
    r = r.withColumn("timestamp_rounded", F.date_format("__hour", "yyyy-MM-dd HH:mm:ss"))
    return r.join(wx, r["__hour"] == wx["__wh"], "left").drop("__hour", "__wh")

"""Dimensions of the star schema (C8 station, C9 weather, C10 date, C11 time).

Keys are deterministic (the same input gives the same keys on every run and in every
engine), unlike ``monotonically_increasing_id`` whose values depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Station name parts, as the reference reads them.
CITY_PATTERN = r"^([A-Za-z\-]+) - Station"
STATION_NUMBER_PATTERN = r"Station (\d+)"
MINUTES_PER_DAY = 24 * 60

UNKNOWN_STATION = -1
STATION_COLUMNS = ("station_name", "lat", "lon", "capacity")


def date_key(d) -> "F.Column":
    """yyyymmdd as BIGINT (sortable, readable, stable).

    Written with a single reference to ``d``: when Catalyst pushes a filter on the key
    down through the cleaning steps, ``d`` (a cleaned value) is inlined once, not three
    times.
    """
    return F.date_format(d, "yyyyMMdd").cast("bigint")


def one_per_station(station_silver: DataFrame) -> DataFrame:
    """One row per known station id: the one with the fewest missing attributes, ties to the
    smaller attribute values (NULL first). Rows whose id was rejected are left out."""
    cols = [c for c in STATION_COLUMNS if c in station_silver.columns]
    missing = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    best = (station_silver.where(F.col("station_id").isNotNull()).groupBy("station_id")
            .agg(F.min(F.struct(missing.alias("__missing"), *cols)).alias("b")))
    return best.select("station_id", *[F.col(f"b.{c}").alias(c) for c in cols])


def dim_station(station_silver: DataFrame) -> DataFrame:
    """One row per station with city and number parsed from the name; ``station_key`` is the
    station id. Rows whose id was rejected are one member, key -1, without attributes."""
    known = one_per_station(station_silver.select("station_id", *STATION_COLUMNS))
    unknown = (station_silver.where(F.col("station_id").isNull()).limit(1)
               .select("station_id", *[F.lit(None).cast(known.schema[c].dataType).alias(c) for c in STATION_COLUMNS]))
    name = F.col("station_name")
    return (known.unionByName(unknown)
            .withColumns({"city": F.regexp_extract(name, CITY_PATTERN, 1),
                          "station_number": F.regexp_extract(name, STATION_NUMBER_PATTERN, 1),
                          "station_key": F.coalesce(F.col("station_id").cast("bigint"),
                                                    F.lit(UNKNOWN_STATION).cast("bigint"))}))


def station_key_check(station_silver: DataFrame, dim: DataFrame) -> DataFrame:
    """One row: silver rows, dimension rows and keys, keys held twice, ids repeated in the silver
    table, and silver rows without an id."""
    keys = dim.groupBy("station_key").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_members"), F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated_keys"))
    ids = station_silver.groupBy("station_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_silver_rows"),
        F.count_if(F.col("station_id").isNotNull() & (F.col("n") > 1)).alias("n_repeated_ids"),
        F.coalesce(F.sum(F.when(F.col("station_id").isNull(), F.col("n"))), F.lit(0)).alias("n_without_id"))
    both = ids.unionByName(keys, allowMissingColumns=True)  # one row each, put side by side
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def dim_weather(weather_silver: DataFrame) -> DataFrame:
    """Distinct conditions (NULL included) keyed by their rank, NULL first.

    The ranking window has no partition: it runs over the distinct conditions only,
    whose number is bounded by the condition whitelist (plus NULL).
    """
    distinct = weather_silver.select("weather_condition").distinct()
    w = Window.orderBy(F.col("weather_condition").asc_nulls_first())
    return (distinct.withColumn("weather_condition_key", F.dense_rank().over(w).cast("bigint"))
            .orderBy("weather_condition_key"))


def _calendar(dates: DataFrame) -> DataFrame:
    d = F.col("date")
    return dates.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEE").alias("day_of_week"),
        (F.weekday(d) + 1).alias("day_of_week_num"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.weekofyear(d).alias("week_of_year"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        date_key(d).alias("date_key"),
    )


def dim_date(spark: SparkSession, start: str = "2025-01-01", end: str = "2025-12-31") -> DataFrame:
    """Calendar for ``[start, end]`` (ISO week and ISO year included)."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)),
                                                      F.to_date(F.lit(end)))).alias("date"))
    return _calendar(days)


def dim_date_for(*frames_and_cols: tuple[DataFrame, str]) -> DataFrame:
    """Calendar covering every date found in the given (frame, date column) pairs.

    The range comes from a global min/max aggregate (combined map-side), so the calendar
    follows the data instead of a hard-coded year.
    """
    bounds = None
    for df, col in frames_and_cols:
        b = df.select(F.col(col).alias("d")).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
        bounds = b if bounds is None else bounds.unionByName(b)
    rng = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where(F.col("lo").isNotNull())
    return _calendar(rng.select(F.explode(F.sequence("lo", "hi")).alias("date")))


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day; ``time_key = hour * 60 + minute``."""
    return (spark.range(MINUTES_PER_DAY)
            .select((F.col("id") / 60).cast("int").alias("hour"),
                    (F.col("id") % 60).cast("int").alias("minute"),
                    F.col("id").alias("time_key"))
            .orderBy("hour", "minute"))

"""Raw station, availability and weather tables derived from the shared test tables.

The driver's data set is TPC-H-like (``customer``, ``events`` ...). We read it as the
raw landing zone of a bike-share system, as text columns full of the faults the
cleaning rules exist for. The derivation is deterministic and uses only integer
arithmetic and fixed timestamp formats, so the DuckDB oracle restates it exactly
(:mod:`stationlake.oracle`). Every row of the source tables is used.

* stations     ← ``customer``: ``station_id = c_custkey + 1``, ``capacity = 20 + c_custkey % 30``
* availability ← ``events``: one reading per event, ``station_id = user_id + 1``,
                 bikes from ``value``, timestamp text in 8 formats; a share of events is
                 delivered twice (a second, less complete or different copy)
* weather      ← ``events``: one reading per hour, made of all events of the hour (their mean
                 value, their most frequent type)
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c: Column) -> Column:
    return c.cast("string")


def _m(c: Column, k: int, r: int) -> Column:
    return (c % F.lit(k)) == F.lit(r)


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    num = F.lpad(_s(c % 100), 2, "0")
    return table(spark, sf_dir, "customer").select(
        F.when(_m(c, 101, 50), F.concat(F.lit("-"), _s(c + 1)))
         .when(_m(c, 103, 51), F.lit("abc"))
         .otherwise(_s(c + 1)).alias("station_id"),
        F.when(_m(c, 53, 7), F.concat(F.lit("Lille Station "), num))
         .when(_m(c, 59, 11), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Lille - Station "), num)).alias("station_name"),
        F.when(_m(c, 61, 3), F.lit("91.5")).when(_m(c, 67, 4), F.lit(""))
         .otherwise(F.concat(F.lit("50."), F.lpad(_s(c * 37 % 10000), 4, "0"))).alias("lat"),
        F.when(_m(c, 71, 5), F.lit("-181")).when(_m(c, 73, 6), F.lit("abc"))
         .otherwise(F.concat(F.lit("3."), F.lpad(_s(c * 91 % 10000), 4, "0"))).alias("lon"),
        F.when(_m(c, 79, 7), F.lit("0")).when(_m(c, 83, 8), F.lit("x"))
         .otherwise(_s(c % 30 + 20)).alias("capacity"),
    )


def _ts_text(ts: Column, k: Column) -> Column:
    """Timestamp written in one of eight formats (by event id)."""
    f = lambda p: F.date_format(ts, p)
    return (F.when(_m(k, 8, 0), f("yyyy-MM-dd HH:mm:ss"))
            .when(_m(k, 8, 1), f("yyyy-MM-dd'T'HH:mm:ss"))
            .when(_m(k, 8, 2), f("dd/MM/yyyy HH:mm"))
            .when(_m(k, 8, 3), f("dd-MM-yyyy HH:mm:ss"))
            .when(_m(k, 8, 4), f("yyyy-MM-dd HH:mm"))
            .when(_m(k, 8, 5), F.concat(f("yyyy-MM-dd HH:mm:ss"), F.lit(".123Z")))
            .when(_m(k, 8, 6), f("dd.MM.yyyy"))
            .when(_m(k, 64, 7), F.lit("not-a-date"))
            .when(_m(k, 64, 15), F.lit(""))
            .otherwise(f("yyyy/MM/dd HH:mm:ss")))


def raw_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event; every tenth event (``event_id % 10 = 3``) is delivered a
    second time (copy 1) for the same station and second with another bikes value,
    and half of those copies lost the free-slot count. One scan, no self-union."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    k, u = F.col("event_id"), F.col("user_id")
    copies = F.when(_m(k, 10, 3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = e.withColumn("copy", F.explode(copies))
    again = F.col("copy") == 1
    bikes = F.floor(F.col("value") / F.lit(8.0)).cast("bigint")
    cap = u % 30 + 20
    station = F.when(_m(k, 211, 17), F.concat(F.lit("x"), _s(u + 1))).otherwise(_s(u + 1))
    return e.select(
        station.alias("station_id"),
        F.when(again, F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"))
         .otherwise(_ts_text(F.col("ts"), k)).alias("timestamp"),
        F.when(again, _s(bikes + 1))
         .when(_m(k, 23, 1), F.lit("n/a")).when(_m(k, 29, 2), F.lit("-3"))
         .when(_m(k, 31, 4), F.lit(None).cast("string")).when(_m(k, 37, 5), F.lit(""))
         .otherwise(_s(bikes)).alias("bikes_available"),
        F.when(again & _m(k, 20, 3), F.lit(None).cast("string"))
         .when(again, _s(F.greatest(cap - bikes - 1, F.lit(0))))
         .when(_m(k, 41, 6), F.lit(None).cast("string")).when(_m(k, 43, 7), F.lit("5.0"))
         .when(_m(k, 47, 8), _s(F.greatest(cap - bikes, F.lit(0)) + 3))
         .otherwise(_s(F.greatest(cap - bikes, F.lit(0)))).alias("slots_free"),
    )


def weather_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour, from every event of the hour: ``hour``, ``k`` (the smallest event id),
    ``v`` (mean of the values' whole parts, rounded down), ``kind`` (the most frequent type, ties
    to the smaller one) and ``n_events``.

    Counted by hour and type first (combined map-side), so a busy hour is a few rows."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    by_type = (e.groupBy(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("hour"), "event_type")
               .agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor("value")).alias("s"), F.min("event_id").alias("k")))
    return by_type.groupBy("hour").agg(
        F.min("k").alias("k"),
        F.floor(F.sum("s") / F.sum("n")).cast("bigint").alias("v"),
        F.min(F.struct((-F.col("n")).alias("n"), "event_type"))["event_type"].alias("kind"),
        F.sum("n").alias("n_events"))


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, h, v, kind = F.col("k"), F.col("hour"), F.col("v"), F.col("kind")
    return weather_hours(spark, sf_dir).select(
        F.when(_m(k, 5, 0), F.date_format(h, "yyyy-MM-dd'T'HH:mm:ss"))
         .when(_m(k, 7, 1), F.date_format(h, "dd/MM/yyyy HH:mm"))
         .otherwise(F.date_format(h, "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.concat(_s(v % 80 - 25), F.when(_m(k, 3, 0), F.lit(",")).otherwise(F.lit(".")),
                 _s(k % 10)).alias("temperature_c"),
        F.when(_m(k, 13, 0), F.lit("abc"))
         .otherwise(F.concat(_s(v % 9 - 1), F.lit("."), _s(k % 10))).alias("rain_mm"),
        F.when(kind == "view", F.lit("Clear")).when(kind == "click", F.lit("Cloudy"))
         .when(kind == "purchase", F.lit("Rain")).when(kind == "signup", F.lit("Drizzle"))
         .when(_m(k, 2, 0), F.lit("Fog")).otherwise(F.lit("Sunny")).alias("weather_condition"),
    )

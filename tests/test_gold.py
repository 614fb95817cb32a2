"""Dimensions, facts and the daily gold table (FIXTURES.md §4 plus equivalence checks)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from stationlake.operators import dimensions as D
from stationlake.operators import facts as FX
from stationlake.functions.numeric import round2

D1, D2 = dt.date(2025, 12, 1), dt.date(2025, 12, 2)


def dims(spark):
    dim_date = spark.createDataFrame([(D1, 1000), (D2, 1001)], "date date, date_key long")
    dim_station = spark.createDataFrame([(100 + i, 2000 + i - 1) for i in range(1, 8)],
                                        "station_id int, station_key long")
    return dim_date, dim_station


def test_dim_station(spark):
    st = spark.createDataFrame(
        [(11, "Aix-Nord - Station 7", 43.5, 5.5, 18), (12, "Brest - Station 0040", 48.25, -4.5, 25),
         (12, "Brest - Station 0040", 48.25, -4.5, 25), (13, None, 1.0, None, 9), (13, "Port", 2.0, 3.0, 8),
         (None, "Brest - Station 41", 1.0, 1.0, 1), (None, None, None, None, 2)],
        "station_id int, station_name string, lat double, lon double, capacity int")
    out = D.dim_station(st)
    assert out.columns == ["station_id", "station_name", "lat", "lon", "capacity", "city",
                           "station_number", "station_key"]
    # one member per id (the most complete row), one for all rows without an id
    assert rows(out.select("station_id", "city", "station_number", "capacity", "station_key")) == [
        (11, "Aix-Nord", "7", 18, 11), (12, "Brest", "0040", 25, 12), (13, "", "", 8, 13), (None, None, None, None, -1)]
    assert out.schema["station_key"].nullable is False
    check = D.station_key_check(st, out).first().asDict()
    assert check == {"n_silver_rows": 7, "n_repeated_ids": 2, "n_without_id": 2, "n_members": 4, "n_keys": 4,
                     "n_repeated_keys": 0}


def test_dim_weather(spark):
    w = spark.createDataFrame([(c,) for c in ["Sunny", "Rainy", "Cloudy", "Snowy", "Rainy", None]],
                              "weather_condition string")
    out = D.dim_weather(w)
    assert [tuple(r) for r in out.collect()] == [(None, 1), ("Cloudy", 2), ("Rainy", 3), ("Snowy", 4),
                                                 ("Sunny", 5)]


def test_dim_date(spark):
    out = D.dim_date(spark, "2025-01-01", "2025-01-03").orderBy("date").collect()
    assert len(out) == 3
    first, last = out[0], out[2]
    assert (first.year, first.month, first.day, first.quarter, first.day_of_week, first.day_of_week_num,
            first.is_weekend, first.week_of_year, first.iso_year, first.date_key) == (
        2025, 1, 1, 1, "Wed", 3, False, 1, 2025, 20250101)
    assert (last.day_of_week, last.day_of_week_num) == ("Fri", 5)
    edge = D.dim_date(spark, "2024-12-29", "2024-12-30").orderBy("date").collect()
    assert [(r.day_of_week, r.is_weekend, r.week_of_year, r.iso_year) for r in edge] == [
        ("Sun", True, 52, 2024), ("Mon", False, 1, 2025)]


def test_dim_date_for_covers_data(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 30),), (dt.date(2024, 2, 2),), (None,)], "date_partition date")
    out = D.dim_date_for((a, "date_partition"))
    assert out.count() == 4


def test_dim_time(spark):
    t = D.dim_time(spark)
    assert t.count() == 1440
    assert t.where(F.col("time_key") != F.col("hour") * 60 + F.col("minute")).count() == 0


def test_fact_avg_bikes(spark):
    dd, ds = dims(spark)
    av = spark.createDataFrame([(D1, 101, 5), (D1, 101, 7), (D1, 101, 3), (D1, 102, 7), (D2, 101, 3),
                                (D2, 102, None)], "date_partition date, station_id int, bikes_available int")
    assert rows(FX.fact_avg_bikes(av, dd, ds)) == [(3.0, 1001, 2000), (5.0, 1000, 2000),
                                                   (7.0, 1000, 2001), (None, 1001, 2001)]


def test_fact_occupancy(spark):
    dd, ds = dims(spark)
    data = [(101, "2025-12-01 08:30:00", 5, 15, D1), (101, "2025-12-01 09:15:00", 7, 13, D1),
            (102, "2025-12-02 08:30:00", 10, 10, D2), (102, "2025-12-02 09:15:59", 0, 0, D2),
            (103, "2025-12-02 10:00:00", 1, 2, D2)]
    j = spark.createDataFrame(data, "station_id int, timestamp string, bikes_available int, "
                                    "slots_free int, date_partition date")
    got = rows(FX.fact_occupancy(j, dd, ds))
    assert got == [(25.0, 1000, 510, 2000), (33.33, 1001, 600, 2002), (35.0, 1000, 555, 2000),
                   (50.0, 1001, 510, 2001), (None, 1001, 555, 2001)]
    with_dim = rows(FX.fact_occupancy(j, dd, ds, D.dim_time(spark)))
    assert with_dim == got


def test_fact_dominant_weather(spark):
    dd, _ = dims(spark)
    dw = spark.createDataFrame([("Sunny", 2000), ("Rain", 2001), ("Cloudy", 2002)],
                               "weather_condition string, weather_condition_key long")
    wx = spark.createDataFrame([(D1, "Sunny"), (D1, "Sunny"), (D1, "Rain"), (D2, "Cloudy"), (D2, "Cloudy"),
                                (D2, "Rain"), (D2, "Rain")], "date_partition date, weather_condition string")
    # 12-02 is a tie (2 Cloudy, 2 Rain): the smaller condition wins
    assert rows(FX.fact_dominant_weather(wx, dd, dw)) == [(2, 1000, 2000), (2, 1001, 2002)]


def test_saturation_and_top(spark):
    dd, ds = dims(spark)
    data = []
    # day 1: seven stations full in 1/8, 7/8, 1/8, 4/8, 0, 8/8, 1/8 of their readings
    for sid, full in zip(range(101, 108), (1, 7, 1, 4, 0, 8, 1)):
        data += [(D1, sid, 14 if i < full else 2, 14) for i in range(8)]
    # day 2: three stations only; one reading in three of 105, none of the others
    for sid, full, n in [(105, 1, 3), (103, 0, 2), (107, 0, 1)]:
        data += [(D2, sid, 14 if i < full else 2, 14) for i in range(n)]
    j = spark.createDataFrame(data, "date_partition date, station_id int, bikes_available int, capacity int")
    sat = rows(FX.fact_saturation(j, dd, ds).where("date_key = 1001"))
    assert sat == [(0.0, 1001, 2002), (0.0, 1001, 2006), (33.33, 1001, 2004)]
    top = FX.fact_top_saturated(j, dd, ds, with_rank=True).orderBy("date_key", "rank").collect()
    assert [(r.date_key, r.station_key, r.saturation_pct) for r in top] == [
        (1000, 2005, 100.0), (1000, 2001, 87.5), (1000, 2003, 50.0), (1000, 2000, 12.5), (1000, 2002, 12.5),
        (1001, 2004, 33.33), (1001, 2002, 0.0), (1001, 2006, 0.0)]
    arr = FX.fact_top_array(j, dd, ds).orderBy("date_key").collect()
    assert [s.station_key for s in arr[1].top_stations] == [2004, 2002, 2006]
    assert FX.fact_top_array(j, dd, ds).schema["top_stations"].dataType.simpleString() == \
        "array<struct<station_key:bigint,saturation_pct:double>>"


def test_gold_daily_equals_many_to_many_join(spark):
    """The pre-aggregated daily table equals the join-all-facts-then-average form."""
    import random
    rnd = random.Random(7)
    dd, ds = dims(spark)
    dw = spark.createDataFrame([("Rain", 1), ("Fog", 2), (None, 0)], "weather_condition string, weather_condition_key long")
    av, wx = [], []
    for day in (D1, D2, dt.date(2025, 12, 3)):
        for _ in range(40):
            sid = rnd.choice([101, 102, 103, 104, 999])
            b = rnd.choice([None, 0, 3, 10, 20])
            s = rnd.choice([None, 0, 5, 10])
            av.append((sid, f"{day} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00", b, s, day))
        wx += [(day, rnd.choice(["Rain", "Fog", None])) for _ in range(5)]
    av_df = spark.createDataFrame(av, "station_id int, timestamp string, bikes_available int, slots_free int, "
                                      "date_partition date")
    wx_df = spark.createDataFrame(wx, "date_partition date, weather_condition string")
    st = spark.createDataFrame([(101, 10), (102, 20), (103, 10), (104, 30)], "station_id int, capacity int")
    plan = FX.fact_occupancy(FX.join_stations(av_df, st), None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # the station key is computed
    joined = FX.join_stations(av_df, st)
    got = FX.gold_daily(av_df, wx_df, joined, dd, ds, dw)
    naive = (FX.fact_avg_bikes(av_df, dd, ds)
             .join(FX.fact_dominant_weather(wx_df, dd, dw), "date_key")
             .join(FX.fact_occupancy(joined, dd, ds), "date_key")
             .join(FX.fact_top_array(joined, dd, ds), "date_key")
             .groupBy("date_key").agg(round2(F.avg("avg_bikes_available")).alias("a"),
                                      round2(F.avg("occupancy_pct")).alias("o"),
                                      F.first("weather_condition_key").alias("w"),
                                      F.first("top_stations").alias("t")))
    assert rows(got) == rows(naive)
    assert got.count() == 2  # 12-03 is not in the calendar: dropped like the reference

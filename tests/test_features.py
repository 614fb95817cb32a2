"""Nearest-hour join, hourly features, baselines and SQL reports on small fixtures."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stationlake.operators import facts as FX
from stationlake.operators import features as FT
from stationlake.plans import sql_reports


def test_nearest_hour_boundaries(spark):
    df = spark.createDataFrame([("2025-11-01 08:29:59",), ("2025-11-01 08:30:00",), ("2025-11-01 23:45:00",),
                                ("2025-11-01 abc",), (None,)], "t string")
    got = [r[0] for r in df.select(FX.nearest_hour_text(F.col("t"))).collect()]
    assert got == ["2025-11-01 08:00:00", "2025-11-01 09:00:00", "2025-11-02 00:00:00", None, None]


def test_enrich_with_weather_left_join(spark):
    joined = spark.createDataFrame([(1, "2025-11-01 08:40:00", 3), (1, "2025-11-01 10:10:00", 4)],
                                   "station_id int, timestamp string, bikes_available int")
    wx = spark.createDataFrame([("2025-11-01 09:00:00", 12.5, 0.0, "Rain")],
                               "timestamp string, temperature_c double, rain_mm double, weather_condition string")
    got = sorted((r.timestamp_rounded, r.weather_condition) for r in FX.enrich_with_weather(joined, wx).collect())
    assert got == [("2025-11-01 09:00:00", "Rain"), ("2025-11-01 10:00:00", None)]


def _features(spark):
    rows = [(1, "2025-11-01 08:10:00", 5, 15), (1, "2025-11-01 08:40:00", 10, 10),  # hour 8: 25, 50 -> 37.5
            (1, "2025-11-01 09:05:00", 0, 20),                                        # hour 9: 0
            (1, "2025-11-01 11:00:00", 20, 0),                                        # hour 11: 100
            (1, "2025-11-01 12:30:00", 10, 30),                                       # hour 12: 25
            (2, "2025-11-01 08:00:00", 0, 0)]                                         # hour 8: NULL
    joined = spark.createDataFrame(rows, "station_id int, timestamp string, bikes_available int, slots_free int")
    wx = spark.createDataFrame([("2025-11-01 08:00:00", 10.0, 0.5, "Rain")],
                               "timestamp string, temperature_c double, rain_mm double, weather_condition string")
    return FT.hourly_features(joined, wx)


def test_hourly_features(spark):
    f = {(r.station_id, r.hour.hour): r for r in _features(spark).collect()}
    s8, s9, s11, s12 = f[(1, 8)], f[(1, 9)], f[(1, 11)], f[(1, 12)]
    assert (s8.occupancy_pct, s8.n_readings, s8.lag_1, s8.moving_avg_3) == (37.5, 2, None, None)
    assert (s8.weather_condition, s8.temperature_c, s8.hour_of_day, s8.is_weekend) == ("Rain", 10.0, 8, True)
    assert (s9.occupancy_pct, s9.lag_1, s9.moving_avg_3, s9.weather_condition) == (0.0, 37.5, 37.5, None)
    assert (s11.lag_1, s11.moving_avg_3) == (0.0, 18.75)
    assert (s12.occupancy_pct, s12.lag_1, s12.moving_avg_3) == (25.0, 100.0, round((37.5 + 0 + 100) / 3, 6))
    assert f[(2, 8)].occupancy_pct is None


def test_baseline_errors_by_hand(spark):
    got = {r.baseline: r for r in FT.baseline_errors(_features(spark)).collect()}
    pers = [(37.5, 0.0), (0.0, 100.0), (100.0, 25.0)]                   # (prediction, actual)
    mov = [(37.5, 0.0), (18.75, 100.0), (round(137.5 / 3, 6), 25.0)]
    for name, pairs in (("persistence", pers), ("moving_average_3", mov)):
        e = [p - a for p, a in pairs]
        assert got[name].n == 3
        assert got[name].mae == pytest.approx(sum(map(abs, e)) / 3, abs=1e-6)
        assert got[name].rmse == pytest.approx(math.sqrt(sum(x * x for x in e) / 3), abs=1e-6)


def test_sql_hourly_profile(spark):
    occ = spark.createDataFrame([(10.0, 20251101, 8 * 60 + 5, 1), (30.0, 20251101, 8 * 60 + 50, 2),
                                 (50.0, 20251102, 9 * 60, 1), (None, 20251102, None, 1)],
                                "occupancy_pct double, date_key long, time_key long, station_key long")
    dd = spark.createDataFrame([(dt.date(2025, 11, 1), 20251101, True), (dt.date(2025, 11, 2), 20251102, True)],
                               "date date, date_key long, is_weekend boolean")
    out = sql_reports.run_report(spark, {"fact_occupancy": occ, "dim_date": dd}, "hourly_profile")
    assert sorted(tuple(r) for r in out.collect()) == [(8, True, 2, 20.0), (9, True, 1, 50.0)]


def test_next_day_scoring_and_model_errors(spark):
    """The model is fitted on earlier days and scores the last day only; on a target that
    is an exact linear function of the features it recovers it."""
    import random

    rnd = random.Random(11)
    rows = []
    for day in range(1, 6):
        for h in range(24):
            lag, ma, t, r = rnd.uniform(0, 100), rnd.uniform(0, 100), rnd.uniform(-5, 30), rnd.uniform(0, 5)
            wk = day in (4, 5)
            y = 3 + 0.5 * lag + 0.25 * ma - 0.1 * t + 2 * r + 0.2 * h + (4 if wk else 0)
            rows.append((1, dt.datetime(2024, 1, day, h), h, wk, t, r, lag, ma, y))
    feats = spark.createDataFrame(rows, "station_id int, hour timestamp_ntz, hour_of_day int, is_weekend boolean, "
                                        "temperature_c double, rain_mm double, lag_1 double, moving_avg_3 double, "
                                        "occupancy_pct double")
    model, scored = FT.train_and_score(feats)
    got = scored.collect()
    assert len(got) == 24 and {r.hour.day for r in got} == {5}
    assert max(abs(r.predicted_occupancy_pct - r.occupancy_pct) for r in got) < 1e-6
    errs = {r.model: r for r in FT.model_errors(scored).collect()}
    assert errs["linear_regression"].mae < 1e-6 and errs["persistence"].mae > 1
    assert {r.n for r in errs.values()} == {24}


def test_sql_station_ranking_and_weather_impact(spark):
    occ = spark.createDataFrame([(10.0, 1, 60, 7), (30.0, 1, 61, 7), (50.0, 2, 62, 8), (None, 2, 63, 8),
                                 (20.0, 3, 64, None)],
                                "occupancy_pct double, date_key long, time_key long, station_key long")
    dom = spark.createDataFrame([(5, 1, 11), (4, 2, 12), (3, 3, 11)],
                                "count long, date_key long, weather_condition_key long")
    dw = spark.createDataFrame([("Rain", 11), ("Fog", 12)], "weather_condition string, weather_condition_key long")
    tables = {"fact_occupancy": occ, "fact_dominant_weather": dom, "dim_weather": dw}
    rank = sorted(tuple(r) for r in sql_reports.run_report(spark, tables, "station_ranking").collect())
    assert rank == [(7, 2, 20.0), (8, 2, 50.0)]
    impact = sorted(tuple(r) for r in sql_reports.run_report(spark, tables, "weather_impact").collect())
    assert impact == [("Fog", 1, 2, 50.0), ("Rain", 2, 3, 20.0)]

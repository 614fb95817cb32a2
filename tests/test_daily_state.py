"""State carried from day to day: equal to one run over everything, and reading the asked days only."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField

from helpers import SF_SMALL, rows
from stationlake.operators import cube as CB
from stationlake.operators import facts as FX
from stationlake.operators import features as FT
from stationlake.operators import quality as Q
from stationlake.operators.runs import value_runs
from stationlake.plans import batch_job, silver
from stationlake.plans.daily_state import DailyRuns, read_days, snapshots, stored_days
from stationlake.sources import testdata as td

READINGS = "station_id int, reading_time timestamp_ntz, v int"


def readings(seed=4, stations=5, days=9):
    """Long equal stretches, silent days, a station that begins late, and one with a reading a day."""
    rng, out = random.Random(seed), []
    for s in range(1, stations + 1):
        for d in range(1 if s < 4 else 4, days + 1):
            if rng.random() < 0.25 and s != 5:
                continue
            for h in sorted(rng.sample(range(24), 1 if s == 5 else rng.randint(1, 6))):
                out.append((s, dt.datetime(2024, 3, d, h), 1 if s == 5 else rng.choice([1, 1, 1, 2, None])))
    return out


def daily(base):
    return DailyRuns(base, (StructField("v", IntegerType()),), lambda: F.col("n_readings") >= 2)


def whole(spark, data):
    runs = value_runs(spark.createDataFrame(data, READINGS), "station_id", "reading_time", ["v"])
    return runs.where("n_readings >= 2").select("station_id", "v", "start", "end", "n_readings")


def day_of(x):
    return str(x.date())


def test_runs_taken_day_by_day(spark, tmp_dir):
    data, state = readings(), daily(os.path.join(tmp_dir, "s"))
    table = {}
    for k, (lo, hi) in enumerate([("2024-03-01", "2024-03-03"), ("2024-03-04", "2024-03-04"), ("2024-03-05", "2024-03-09")]):
        own = [r for r in data if lo <= day_of(r[1]) <= hi]
        days = None if k == 0 else (lo, hi)
        state.take(spark.createDataFrame(own, READINGS), days)
        if days:
            began, now = state.earlier(spark, days)
            for r in began.collect():
                table.pop((r.station_id, r.start), None)
            table.update({(r.station_id, r.start): tuple(r) for r in now.collect()})
        table.update({(r.station_id, r.start): tuple(r) for r in state.runs(spark, days).collect()})
        upto = [r for r in data if day_of(r[1]) <= hi]
        assert sorted(table.values(), key=repr) == sorted((tuple(r) for r in whole(spark, upto).collect()), key=repr)


def test_days_in_the_middle_taken_again(spark, tmp_dir):
    data, state = readings(seed=9), daily(os.path.join(tmp_dir, "s"))
    state.take(spark.createDataFrame(data, READINGS))
    again = [r for r in data if "2024-03-04" <= day_of(r[1]) <= "2024-03-05"]
    changed = [(s, t, 1) for s, t, _ in again]
    state.take(spark.createDataFrame(changed, READINGS), ("2024-03-04", "2024-03-05"))
    want = whole(spark, [r for r in data if r not in again] + changed)
    assert sorted((tuple(r) for r in state.runs(spark).collect()), key=repr) == sorted((tuple(r) for r in want.collect()), key=repr)
    # the carry of the last day is what a state built at once holds
    once = daily(os.path.join(tmp_dir, "once"))
    once.take(spark.createDataFrame([r for r in data if r not in again] + changed, READINGS))
    last = [read_days(spark, os.path.join(s.base, "carry"), s.schema, ["2024-03-09"]) for s in (state, once)]
    assert rows(last[0]) == rows(last[1]) and len(rows(last[0])) == 5


def test_snapshots(spark):
    d = lambda n: dt.date(2024, 3, n)
    df = spark.createDataFrame([("a", 1, d(1)), ("a", 2, d(3)), ("a", 3, d(3)), ("b", 1, d(4))], "k string, o int, day date")
    got = {}
    for r in snapshots(df, "k", ["o"], 2, [str(d(n)) for n in range(1, 6)]).collect():
        got.setdefault((r.k, r.day.day), []).append(r.o)
    assert {x: sorted(v) for x, v in got.items()} == {("a", 1): [1], ("a", 2): [1], ("a", 3): [2, 3], ("a", 4): [2, 3], ("a", 5): [2, 3],
                                                      ("b", 4): [1], ("b", 5): [1]}


@pytest.fixture(scope="module")
def raw(spark):
    return batch_job.RawTables(td.raw_stations(spark, SF_SMALL), td.raw_availability(spark, SF_SMALL), td.raw_weather(spark, SF_SMALL))


def test_a_day_is_run_without_the_readings_of_others(spark, tmp_dir, raw):
    """The availability files of all other days are unreadable when the day is run again."""
    batch_job.run_silver(spark, raw, tmp_dir)
    batch_job.run_gold(spark, tmp_dir, only=("frozen_runs", "critical_episodes", "features_hourly", "quality_daily"))
    names = ("frozen_runs", "critical_episodes", "features_hourly", "quality_daily", "predictions_gold")
    read = lambda: {n: rows(spark.read.parquet(os.path.join(tmp_dir, "gold", n))) for n in names}
    before, day = read(), "2024-01-10"
    silver_dir = os.path.join(tmp_dir, "silver", "availability")
    for d in os.listdir(silver_dir):
        if d.startswith("date_partition=") and d != f"date_partition={day}":
            for f in os.listdir(os.path.join(silver_dir, d)):
                if f.endswith(".parquet"):
                    with open(os.path.join(silver_dir, d, f), "wb") as out:
                        out.write(b"not a parquet file")
    for f in [os.path.join(silver_dir, d, f) for d in os.listdir(silver_dir) if os.path.isdir(os.path.join(silver_dir, d))
              for f in os.listdir(os.path.join(silver_dir, d)) if f.endswith(".crc")]:
        os.remove(f)
    spark.catalog.clearCache()
    spark.catalog.refreshByPath(tmp_dir)
    assert len(stored_days(spark, silver_dir, "date_partition")) > 20
    own = spark.read.parquet(os.path.join(silver_dir, f"date_partition={day}"))
    assert own.count() > 0
    schema = own.withColumn("date_partition", F.lit(None).cast("date")).schema
    # the schema is given, as a catalog table would: inferring it would open any file
    real = batch_job.silver_tables
    batch_job.silver_tables = lambda s, o, days=None: (
        s.read.parquet(os.path.join(o, "silver", "stations")), real_weather(s, o, days),
        batch_job.in_days(s.read.schema(schema).parquet(silver_dir), "date_partition", days))

    def real_weather(s, o, days):
        return batch_job.in_days(s.read.parquet(os.path.join(o, "silver", "weather")), "date_partition", days)

    try:
        batch_job.run_gold(spark, tmp_dir, days=(day, day), only=("frozen_runs", "critical_episodes", "features_hourly", "quality_daily"))
    finally:
        batch_job.silver_tables = real
    assert read() == before


def test_cubes_of_parts_add_up_to_the_direct_facts(spark, raw):
    st = silver.station_silver(raw.stations).df
    av = silver.availability_silver(raw.availability, raw.stations).df.persist()
    wx = silver.weather_silver(raw.weather).df
    from stationlake.operators import dimensions as D

    part = F.coalesce(F.hash("timestamp") % 3, F.lit(0))
    cube = CB.merge_cubes(*[CB.station_day_cube(av.where(part == k), st) for k in (-2, -1, 0, 1, 2)]).persist()
    joined, dim = FX.join_stations(av, st), D.dim_station(st)
    assert rows(cube) == rows(CB.station_day_cube(av, st))
    assert rows(CB.cube_avg_bikes(cube)) == rows(FX.fact_avg_bikes(av, None, dim))
    assert rows(CB.cube_saturation(cube)) == rows(FX.fact_saturation(joined, None))
    assert rows(CB.cube_top_array(cube)) == rows(FX.fact_top_array(joined, None))
    assert rows(CB.cube_gold_daily(cube, wx, D.dim_weather(wx))) == rows(FX.gold_daily(av, wx, joined, None, dim, D.dim_weather(wx)))
    assert rows(CB.cube_negatives(cube, "slots_free", "station_id")) == rows(Q.count_negatives(av, "slots_free", "station_id"))
    for by in (["station_id", "date_partition"], ["date_partition"], []):
        assert rows(CB.cube_capacity_coherence(cube, *by)) == rows(Q.capacity_coherence(av, st, *by))
    av.unpersist()
    cube.unpersist()


def test_moments_solve_the_normal_equations(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6)).round(3)
    x[:, 1] = x[:, 1] > 0
    y = (x @ [1, 2, 3, 4, 5, 6] + 7 + rng.normal(size=200)).round(3)
    data = [(1, dt.datetime(2024, 3, 1 + i % 7, i % 24), int(r[0] * 0) + i % 24, bool(r[1]), *map(float, r[2:]), float(v))
            for i, (r, v) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(data, "station_id int, hour timestamp_ntz, hour_of_day int, is_weekend boolean, temperature_c double, "
                               "rain_mm double, lag_1 double, moving_avg_3 double, occupancy_pct double")
    moments = FT.day_moments(df)
    assert moments.count() == 7
    base, weights = FT.solve_moments(moments)
    full = np.column_stack([np.ones(200), np.arange(200) % 24, x[:, 1:]])
    want = np.linalg.lstsq(full, y, rcond=None)[0]
    assert np.allclose([base, *weights], want, atol=1e-6)
    scored = FT.score_last_days(df, moments)
    direct = FT.train_and_score(df)[1]
    a = {r.hour: r.predicted_occupancy_pct for r in scored.collect()}
    b = {r.hour: r.predicted_occupancy_pct for r in direct.collect()}
    assert a.keys() == b.keys() and all(abs(a[h] - b[h]) < 1e-6 for h in a)
    with pytest.raises(FT.NoTrainingRows):
        FT.score_last_days(df.where("false"), moments.where("false"))


def test_chains_are_made_once_a_take(spark, tmp_dir):
    """What follows a take reads its chains: no window over the edges again. Other days are chained anew, with equal runs."""
    data, state = readings(), daily(os.path.join(tmp_dir, "s"))
    days = ("2024-03-05", "2024-03-09")
    state.take(spark.createDataFrame([r for r in data if day_of(r[1]) < days[0]], READINGS))
    state.take(spark.createDataFrame([r for r in data if day_of(r[1]) >= days[0]], READINGS), days)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for df in (state.runs(spark, days), state.earlier(spark, days)[1]):
        assert "Window" not in plan(df)
    everything = state.runs(spark)
    assert "Window" in plan(everything) and rows(everything) == rows(whole(spark, data))
    of_days = whole(spark, data).where(F.to_date("start").between(*[F.lit(d).cast("date") for d in days]))
    assert rows(state.runs(spark, days).where(F.to_date("start") >= F.lit(days[0]).cast("date"))) == rows(of_days)


def test_lags_go_through_the_shuffle_without_the_weather(spark):
    joined = spark.createDataFrame([(1, "2024-03-01 05:00:00", 3, 7)], "station_id int, timestamp string, bikes_available int, slots_free int")
    weather = spark.createDataFrame([("2024-03-01 05:00:00", 4.0, 0.5, "Rain")],
                                    "timestamp string, temperature_c double, rain_mm double, weather_condition string")
    df = FT.hourly_features(joined, weather)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, line in enumerate(lines) if "Window" in line)
    assert any("Join" in line for line in lines[:window]) and not any("Join" in line for line in lines[window:window + 3])
    assert [(r.station_id, r.temperature_c, r.occupancy_pct, r.n_readings, r.lag_1) for r in df.collect()] == [(1, 4.0, 30.0, 1, None)]

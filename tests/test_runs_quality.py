"""Run detection (split for hot keys) and quality checks."""

import datetime as dt
import random

from helpers import rows
from stationlake.operators import facts as FX
from stationlake.operators import quality as Q
from stationlake.operators.runs import value_runs, with_run_start


def brute_runs(data):
    out = []
    by_key = {}
    for k, t, v in sorted(data, key=lambda r: (r[0], r[1], (r[2] is not None, r[2]))):
        by_key.setdefault(k, []).append((t, v))
    for k, seq in by_key.items():
        start = 0
        for i in range(1, len(seq) + 1):
            if i == len(seq) or seq[i][1] != seq[start][1]:
                out.append((k, seq[start][1], seq[start][0], seq[i - 1][0], i - start))
                start = i
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_value_runs_hot_key_split_across_partitions(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    data = []
    # key 1 holds most rows (a hot station); values change rarely so runs cross midnight
    v = 0
    for i in range(3000):
        if rnd.random() < 0.02:
            v = rnd.choice([0, 1, 2, None])
        data.append((1, t0 + dt.timedelta(minutes=11 * i), v))
    for k in range(2, 40):
        for i in range(rnd.randint(1, 30)):
            data.append((k, t0 + dt.timedelta(minutes=7 * i), rnd.choice([0, 1, None])))
    df = spark.createDataFrame(data, "k int, t timestamp, v int")
    runs = value_runs(df, "k", "t", ["v"])
    assert rows(runs.select("k", "v", "start", "end", "n_readings")) == brute_runs(data)
    assert any(a.date() < b.date() for _, _, a, b, _ in brute_runs(data))
    # windows by key and day, no Python and no range exchange
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "rangepartitioning" not in plan
    assert "hashpartitioning(k" in plan and "__day" in plan
    # each row knows where its run started
    first = {(k, t): s for k, _, s, e, _ in brute_runs(data) for kk, t, _ in data if kk == k and s <= t <= e}
    got = with_run_start(df, "k", "t", ["v"]).collect()
    assert len(got) == len(data) and all(first[r.k, r.t] == r.run_start for r in got)


def test_critical_alerts_by_hand(spark):
    t = dt.datetime(2030, 6, 17, 23, 40)
    at = lambda m: (t + dt.timedelta(minutes=m)).strftime("%Y-%m-%d %H:%M:%S")
    data = [(1, at(m), b, 50) for m, b in [(0, 9), (30, 8), (31, 7), (45, 5), (50, 30), (60, 1), (80, 1)]]
    data += [(2, at(0), 1, 50), (2, at(30), 1, 50), (2, at(60), None, 50), (2, at(90), 1, 50), (3, at(0), 1, None)]
    j = spark.createDataFrame(data, "station_id int, timestamp string, bikes_available int, capacity int")
    got = sorted(tuple(r) for r in Q.critical_alerts(Q.critical_readings(j)).collect())
    # station 1: over 30 minutes at +31 (after midnight), once; its second run lasts 20 minutes.
    # station 2: a reading that cannot be judged does not end the run
    assert got == [(1, t, t + dt.timedelta(minutes=31), 31.0, 7, 50), (2, t, t + dt.timedelta(minutes=90), 90.0, 1, 50)]


def test_stations_listed_twice_do_not_multiply_readings(spark):
    d = dt.date(2030, 6, 17)
    av = spark.createDataFrame([(5, d, "2030-06-17 05:00:00", 4, 6)],
                               "station_id int, date_partition date, timestamp string, bikes_available int, slots_free int")
    st = spark.createDataFrame([(5, "Lille - Station 05", 1.0, 1.0, 10), (5, None, 1.0, 1.0, 99)],
                               "station_id int, station_name string, lat float, lon float, capacity int")
    joined = FX.join_stations(av, st)
    # the more complete station row counts
    assert [r.capacity for r in joined.collect()] == [10]
    assert FX.fact_occupancy(joined, None).count() == 1
    assert rows(Q.capacity_coherence(av, st, "station_id")) == [(5, 0)]
    assert Q.with_capacity(av, st).count() == 1


def test_count_negatives_and_capacity(spark):
    av = spark.createDataFrame(
        [(1, dt.date(2025, 1, 1), -1, 5), (1, dt.date(2025, 1, 1), 3, 7), (2, dt.date(2025, 1, 1), 2, None),
         (3, dt.date(2025, 1, 2), 1, 1)],
        "station_id int, date_partition date, bikes_available int, slots_free int")
    st = spark.createDataFrame([(1, "10"), (2, "8")], "station_id int, capacity string")
    assert rows(Q.count_negatives(av, "bikes_available", "station_id")) == [(1, 1), (2, 0), (3, 0)]
    assert rows(Q.capacity_coherence(av, st, "station_id")) == [(1, 1), (2, 1)]


def test_report_lines(spark):
    rep = spark.createDataFrame([(10, 2, 1, 0)], "rows_raw long, rows_corrected long, rows_invalid long, "
                                                 "rows_removed long")
    lines = [r.line for r in Q.report_lines(rep, "x").orderBy("line_no").collect()]
    assert lines == ["Quality report - x", "-------------------------------------", "- Raw rows : 10",
                     "- Corrected rows : 2", "- Invalid rows (values replaced by NULL) : 1",
                     "- Removed rows : 0"]


def test_critical_episodes_exact_threshold(spark):
    t = dt.datetime(2024, 1, 1, 8)
    data = [(1, (t + dt.timedelta(minutes=m)).strftime("%Y-%m-%d %H:%M:%S"), b, 35)
            for m, b in [(0, 7), (10, 6), (31, 6), (40, 20), (50, 1), (60, 1)]]
    j = spark.createDataFrame(data, "station_id int, timestamp string, bikes_available int, capacity int")
    # 7 of 35 is exactly 20 %: not critical (7.000000000000001 in floating point would say it is)
    got = [(r.start_time.minute, r.n_readings) for r in Q.critical_episodes(j).collect()]
    assert got == []
    data[0] = (1, data[0][1], 6, 35)
    j = spark.createDataFrame(data, "station_id int, timestamp string, bikes_available int, capacity int")
    got = [(r.start_time.strftime("%H:%M"), r.n_readings, r.duration_minutes)
           for r in Q.critical_episodes(j).collect()]
    assert got == [("08:00", 3, 31.0)]


def test_null_audit_profile_and_daily_quality(spark):
    d = dt.date(2025, 1, 1)
    j = spark.createDataFrame([(1, None, None, 10), (1, 3, None, 10), (2, None, 4, None), (2, 1, 1, None)],
                              "station_id int, bikes_available int, slots_free int, capacity int")
    assert tuple(Q.null_audit(j).first()) == (1, 2, 2, 2)
    w = spark.createDataFrame([("Rain",), ("Rain",), (None,), ("Sunny",)], "weather_condition string")
    assert rows(Q.value_profile(w, "weather_condition")) == [("Rain", 2), ("Sunny", 1), (None, 1)]
    av = spark.createDataFrame(
        [(1, d, "2025-01-01 08:00:00", 5, 5), (1, d, "2025-01-01 08:05:00", 5, 5), (1, d, "2025-01-01 08:10:00", 5, 5),
         (1, d, "2025-01-01 08:15:00", 2, 9), (3, d, "2025-01-01 09:00:00", 1, 1)],
        "station_id int, date_partition date, timestamp string, bikes_available int, slots_free int")
    st = spark.createDataFrame([(1, 10)], "station_id int, capacity int")
    out = rows(Q.daily_quality(Q.with_capacity(av, st), Q.frozen_stations(av)))
    # station 1: 4 readings, one (2 + 9) incoherent, one frozen run of 3; station 3: no station row
    assert out == [(1, d, 4, 0, 0, 1, 1, 3), (3, d, 1, 0, 0, 0, 0, 0)]

"""State between batches, and the merge of late copies into the day silver."""

import datetime as dt
import os

from pyspark.sql import functions as F

from helpers import rows
from stationlake.plans.daily_state import stored_days
from stationlake.streaming.ingest import DAY_SILVER, merge_readings, publish
from stationlake.streaming.state import leave, left_by_last_batch

SCHEMA = "k int, v string"


def test_two_slots_hold_the_last_state(spark, tmp_dir):
    path = os.path.join(tmp_dir, "state")
    assert rows(left_by_last_batch(spark, path, SCHEMA, 0)) == []
    for n in range(5):
        before = rows(left_by_last_batch(spark, path, SCHEMA, n))
        assert before == ([(n - 1, "x")] if n not in (0, 4) else [])
        state = spark.createDataFrame([] if n == 3 else [(n, "x")], SCHEMA)
        leave(state, path, SCHEMA, n)
        leave(state, path, SCHEMA, n)  # a repeated batch replaces its own
        assert rows(left_by_last_batch(spark, path, SCHEMA, n)) == before
    assert stored_days(spark, path, "slot") == ["0", "1"]
    files = [f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 2


def test_a_published_batch_stays(spark, tmp_dir):
    folder, hidden = os.path.join(tmp_dir, "intake", "batch_id=0"), os.path.join(tmp_dir, "intake", "_batch-0")
    df = spark.createDataFrame([(1, "late"), (2, "on_time")], "k int, status string")
    publish(df, folder, hidden)
    publish(df.limit(0), folder, hidden)
    assert rows(spark.read.parquet(folder)) == [(1, "late"), (2, "on_time")] and not os.path.exists(hidden)


def test_late_copies_merge_by_completeness(spark, tmp_dir):
    path = os.path.join(tmp_dir, "days")

    def put(*readings):
        data = [(s, t, b, f, score, "20", None) for s, t, b, f, score in readings]
        merge_readings(spark.createDataFrame(data, DAY_SILVER), path)

    put((1, "2024-03-01 10:00:00", None, 5, 1), (1, "2024-03-02 10:00:00", 3, 5, 0), (None, None, 1, 1, 2))
    second = [f for f in os.listdir(os.path.join(path, "date_partition=2024-03-02")) if f.endswith(".parquet")]
    late = [(1, "2024-03-01 10:00:00", 7, 5, 0), (2, "2024-03-01 11:00:00", 1, 1, 0), (2, "2024-03-01 xx", 9, 9, 0)]
    for _ in range(2):  # merging twice changes nothing
        put(*late)
        got = [tuple(r) for r in spark.read.schema(DAY_SILVER).parquet(path).select("station_id", "timestamp", "bikes_available", "date_partition").collect()]
        assert sorted(got, key=repr) == sorted([
            (1, "2024-03-01 10:00:00", 7, dt.date(2024, 3, 1)), (2, "2024-03-01 11:00:00", 1, dt.date(2024, 3, 1)),
            (2, "2024-03-01 xx", 9, dt.date(2024, 3, 1)), (1, "2024-03-02 10:00:00", 3, dt.date(2024, 3, 2)), (None, None, 1, None)], key=repr)
    assert second == [f for f in os.listdir(os.path.join(path, "date_partition=2024-03-02")) if f.endswith(".parquet")]
    put((1, "2024-03-01 10:00:00", 1, None, 1), (None, None, None, 1, 3))  # less complete copies change nothing
    assert spark.read.schema(DAY_SILVER).parquet(path).where("bikes_available = 7").count() == 1
    assert spark.read.schema(DAY_SILVER).parquet(path).where("date_partition is null").select(F.sum("bikes_available")).first()[0] == 1

"""The streams' input is cleaned once, and every text is parsed once."""

import re

from helpers import SF_SMALL as SF
from pyspark.sql import functions as F

from stationlake.operators.cleaning import apply_rules
from stationlake.operators.quality import CRITICAL_MINUTES
from stationlake.plans import registry
from stationlake.plans.silver import AVAILABILITY_RULES
from stationlake.streaming import alerts, jobs


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_landed_folders_read_cleaned_rows(spark, monkeypatch):
    """No landed folder runs the date rule again."""
    plans = []
    monkeypatch.setattr(registry, "land_csv", lambda df, path, **_: plans.append(plan(df)))
    monkeypatch.setattr(jobs, "run_streams", lambda *_, **__: None)
    monkeypatch.setattr(registry, "_STREAMS", {})
    registry._streams(spark, SF)
    assert len(plans) == 6 and not any("regexp_replace" in p for p in plans)


def test_counts_are_parsed_once(spark):
    raw = spark.createDataFrame([("1", "2024-01-01 00:00:00", "3", "4", "20")],
                                "station_id string, timestamp string, bikes_available string, slots_free string, capacity string")
    p = plan(apply_rules(raw.repartition(1), AVAILABILITY_RULES, score=True))
    assert len(re.findall(r"RLIKE\([^()]*(?:\([^()]*\))?[^()]*, \^\\d\+\\z\)", p)) == 6


def test_alert_step_finds_run_starts_once(spark):
    rows = [(1, f"2024-01-01 00:{m:02d}:00", 1, 9) for m in (0, 20, 40)]
    silver = spark.createDataFrame(rows, "station_id int, timestamp string, bikes_available int, slots_free int").selectExpr(
        "*", "cast(timestamp as timestamp) AS reading_time", "cast('2024-01-01' as date) AS date_partition")
    stations = spark.createDataFrame([(1, 20)], "station_id int, capacity int").withColumn("date_partition", F.lit(None).cast("date"))
    staged = []

    def stage(df):
        staged.append(df.collect())
        return spark.createDataFrame(staged[-1], df.schema)

    new, still = alerts.step(silver, stations, spark.createDataFrame([], alerts.OPEN_SCHEMA), 20, CRITICAL_MINUTES, stage)
    assert [(r.station_id, r.minutes_critical) for r in new.collect()] == [(1, 40.0)]
    assert [(r.station_id, r.alerted) for r in still.collect()] == [(1, True)]
    assert len(staged) == 1 and len(staged[0]) == 3
    assert not any("Window" in plan(df) for df in (new, still))

"""Critical-station alerts (fewer than 20 % bikes for more than 30 minutes) from a stream.

Each micro-batch of the silver stream joins the runs left open by the batches before: a small
table with one row per station inside a critical run (its start, and whether it already raised
its alert), kept in two slots (:mod:`stationlake.streaming.state`). An open run enters the batch as a critical
reading at its start; then the batch operators :func:`stationlake.operators.runs.with_run_start`
(its rows are written once a batch) and :func:`stationlake.operators.quality.run_alerts` find runs and alerts
with windows by station and day — no Python per row, and a station's rows are cut by day. Open runs that have raised their alert raise no second one.

The silver stream emits readings in watermark order, so no batch holds a reading older than those
of the batch before, and the alerts are those of the batch twin. Alerts are written by batch id:
a repeated batch replaces its own, and finds the open runs that it started from.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationlake.operators.facts import join_stations
from stationlake.operators.quality import (CRITICAL_MINUTES, CRITICAL_SHARE_PCT, critical_readings,
                                           run_alerts)
from stationlake.operators.runs import with_run_start
from stationlake.session import scratch_path
from stationlake.streaming.state import leave, left_by_last_batch

OPEN_SCHEMA = "station_id int, run_start timestamp_ntz, alerted boolean"


def step(silver: DataFrame, stations: DataFrame, open_: DataFrame, share_pct: int = CRITICAL_SHARE_PCT,
         minutes: int = CRITICAL_MINUTES, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """New alerts, and the runs open afterwards, from one batch of silver readings. ``stage`` may write the readings
    with the start of their run, which both are made from."""
    rows = critical_readings(join_stations(silver.drop("date_partition", "reading_time"), stations), share_pct)
    carried = open_.select("station_id", F.col("run_start").alias("reading_time"), F.lit(True).alias("critical"),
                           F.lit(None).cast("int").alias("bikes_available"), F.lit(None).cast("int").alias("capacity"))
    rows = rows.unionByName(carried)
    started = stage(with_run_start(rows, "station_id", "reading_time", ["critical"]))
    alerts = run_alerts(started, minutes)
    raised = open_.where("alerted").select("station_id", "run_start")
    new = alerts.join(raised, ["station_id", "run_start"], "left_anti")
    # the run of each station's last reading stays open if it is critical
    last = (started.groupBy("station_id")
            .agg(F.max(F.struct("reading_time", "critical", "run_start")).alias("x"))
            .where("x.critical").select("station_id", "x.run_start"))
    done = alerts.select("station_id", "run_start").withColumn("alerted", F.lit(True)).unionByName(
        raised.withColumn("alerted", F.lit(True))).distinct()
    still = last.join(done, ["station_id", "run_start"], "left").withColumn("alerted", F.coalesce("alerted", F.lit(False)))
    return new, still


def start_alerts(silver: DataFrame, stations: DataFrame, out_path: str, open_path: str, checkpoint: str, *,
                 share_pct: int = CRITICAL_SHARE_PCT, minutes: int = CRITICAL_MINUTES, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Alerts to ``out_path`` by batch id, the runs open after the last batch to ``open_path``."""

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def stage(rows: DataFrame) -> DataFrame:
            path = scratch_path(spark, f"run-starts-{uuid.uuid4().hex}")
            rows.write.parquet(path)
            return spark.read.schema(rows.schema).parquet(path)

        new, still = step(batch, stations, left_by_last_batch(spark, open_path, OPEN_SCHEMA, batch_id), share_pct, minutes, stage)
        new.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))
        leave(still, open_path, OPEN_SCHEMA, batch_id)

    writer = silver.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start()

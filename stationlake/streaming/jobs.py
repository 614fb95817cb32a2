"""Streaming job: raw files → intake → silver table (B9) → alert table.

The three streams are chained through parquet tables, each with its own checkpoint, so each
query holds at most one stateful operator and can be restarted independently.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (DateType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

from stationlake.operators.cleaning import SCORE
from stationlake.streaming.alerts import start_alerts
from stationlake.streaming.ingest import (WATERMARK, close_input, read_raw_stream, set_aside_stream, silver_stream,
                                          start_day_silver, start_intake, start_silver)

SILVER_STREAM_SCHEMA = StructType([
    StructField("station_id", IntegerType()), StructField("timestamp", StringType()),
    StructField("bikes_available", IntegerType()), StructField("slots_free", IntegerType()),
    StructField("reading_time", TimestampType()), StructField("date_partition", DateType()),
    StructField(SCORE, IntegerType()), StructField("capacity", StringType()),
])


@dataclass(frozen=True)
class StreamPaths:
    """The tables of a streaming job under one folder."""

    base: str

    @property
    def intake(self) -> str:
        return os.path.join(self.base, "intake")

    @property
    def silver(self) -> str:
        return os.path.join(self.base, "silver")

    @property
    def day_silver(self) -> str:
        return os.path.join(self.base, "day_silver")

    @property
    def alerts(self) -> str:
        return os.path.join(self.base, "alerts")

    def checkpoint(self, name: str) -> str:
        return os.path.join(self.base, f"_checkpoint_{name}")


def run_streams(spark: SparkSession, raw_dir: str, raw_stations: DataFrame, stations: DataFrame,
                base: str, *, available_now: bool = True, watermark: str = WATERMARK, header: bool = True,
                max_files_per_trigger: int | None = None, close: bool = False,
                state_partitions: int | None = None) -> StreamPaths:
    """Run intake, silver and alerts; with ``available_now`` every file present is processed and
    the streams end, else they keep running. The day silver is merged at the end of an ``available_now`` run (beside
    running streams, such a run on a schedule does it: :func:`settle_days`).

    ``close`` marks the end of a finite input, so that its last readings are emitted too.
    ``state_partitions`` (fixed when a stream first starts) is set in a session of the streams' own."""
    paths = StreamPaths(base)
    own = spark.newSession()
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    raw = read_raw_stream(own, raw_dir, header=header, max_files_per_trigger=max_files_per_trigger)
    intake = start_intake(raw, raw_stations, paths.intake, paths.checkpoint("intake"), watermark=watermark,
                          available_now=available_now)
    _settle(intake, available_now)  # the next stream's folder exists before it is read
    if close and available_now:
        close_input(own, paths.intake, watermark)
    silver = start_silver(silver_stream(own, paths.intake, watermark), paths.silver, paths.checkpoint("silver"),
                          available_now=available_now)
    _settle(silver, available_now)
    readings = own.readStream.schema(SILVER_STREAM_SCHEMA).parquet(paths.silver).drop(SCORE, "capacity")
    alerts = start_alerts(readings, stations, paths.alerts, os.path.join(base, "open_runs"), paths.checkpoint("alerts"),
                          available_now=available_now)
    _settle(alerts, available_now)
    if available_now:
        settle_days(own, paths)
    return paths


def settle_days(spark: SparkSession, paths: StreamPaths) -> None:
    """Merge what the silver stream has emitted since the last time, then what the intake has set aside, into
    the day silver. The table has one writer at a time."""
    emitted = spark.readStream.schema(SILVER_STREAM_SCHEMA).parquet(paths.silver)
    for name, rows in (("days", emitted), ("late", set_aside_stream(spark, paths.intake))):
        start_day_silver(rows, paths.day_silver, paths.checkpoint(name)).awaitTermination()


def _settle(query, available_now: bool) -> None:
    if available_now:
        query.awaitTermination()
    else:
        query.processAllAvailable()


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m stationlake.streaming.jobs --raw R --stations S --out O
    [--continuous] [--watermark "2 hours"] [--max-files N]``

    ``--raw``: folder receiving availability CSV files (``;``); ``--stations``: the raw
    station CSV (``,``). Without ``--continuous`` every file present is processed once
    (``availableNow``); with it the streams keep running on a one-minute trigger.
    """
    import argparse

    from stationlake.plans.silver import station_silver
    from stationlake.schemas import RAW_STATION_COLUMNS
    from stationlake.sources.csv import read_raw

    p = argparse.ArgumentParser(description="availability files -> intake -> silver stream -> alerts")
    p.add_argument("--raw", required=True)
    p.add_argument("--stations", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--continuous", action="store_true")
    p.add_argument("--close", action="store_true", help="the input is complete: emit its last readings too")
    p.add_argument("--watermark", default=WATERMARK)
    p.add_argument("--max-files", type=int, default=200, help="files a micro-batch")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("stationlake-stream").getOrCreate()
    raw_st = read_raw(spark, a.stations, RAW_STATION_COLUMNS, sep=",").rows
    run_streams(spark, a.raw, raw_st, station_silver(raw_st).df, a.out, available_now=not a.continuous,
                watermark=a.watermark, max_files_per_trigger=a.max_files, close=a.close)
    if a.continuous:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()

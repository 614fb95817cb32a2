"""Batch job: raw tables → silver parquet (+ quality reports) → gold star schema.

Silver tables are written once and read back for the gold step: the write cuts the
lineage (a lost executor re-reads parquet instead of recomputing the cleaning). The quality
counters of the readings are columns of that same write, summed over the committed files: exact even where
tasks or stages ran again. The two small tables are counted by an aggregation.

With ``days`` (first and last day) only those days are cleaned, read and replaced: readings, daily
facts and daily tables are partitioned by day and written with dynamic overwrite. What looks
across days (frozen runs, critical episodes, lags, the model) is carried from day to day in the small tables
of ``state/`` (:mod:`stationlake.plans.daily_state`), and runs that go on from earlier days are corrected there,
so a partial run equals a full one without reading the silver of any other day. The daily facts and checks
are projected from one station-day cube, written by day too.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField

from stationlake.operators import cube as CB
from stationlake.operators import dimensions as D
from stationlake.operators import facts as FX
from stationlake.operators import features as FT
from stationlake.operators import quality as Q
from stationlake.operators.cleaning import ROW_COUNTS, counted_report
from stationlake.plans import silver, sql_reports
from stationlake.plans.daily_state import DailyHours, DailyRuns, Days, merge_days, read_days, stored_days
from stationlake.schemas import RAW_AVAILABILITY_COLUMNS, RAW_STATION_COLUMNS, RAW_WEATHER_COLUMNS
from stationlake.sources.csv import RawRead, read_raw
from stationlake.sources.sinks import write_partitioned, write_table

COUNTERS = ("rows_raw", "rows_malformed", "rows_corrected", "rows_invalid", "rows_removed")
REPORT_SCHEMA = ("run_id string, run_time timestamp, table_name string, "
                 + ", ".join(f"{c} long" for c in COUNTERS))


@dataclass
class RawTables:
    stations: DataFrame
    availability: DataFrame
    weather: DataFrame
    reads: dict[str, RawRead] = field(default_factory=dict)  # where the tables come from CSV


def read_raw_files(spark: SparkSession, stations: str, availability: str, weather: str) -> RawTables:
    """Raw CSV landing files: stations comma-separated, readings ``;``-separated, all text. The
    tables hold the well-formed lines, ``reads`` the malformed ones too."""
    reads = {"stations": read_raw(spark, stations, RAW_STATION_COLUMNS, sep=","),
             "availability": read_raw(spark, availability, RAW_AVAILABILITY_COLUMNS),
             "weather": read_raw(spark, weather, RAW_WEATHER_COLUMNS)}
    return RawTables(reads["stations"].rows, reads["availability"].rows, reads["weather"].rows, reads)


def in_parallel(jobs: list, workers: int) -> None:
    """Independent jobs submitted together share the executors instead of leaving cores idle."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def run_silver(spark: SparkSession, raw: RawTables, out: str, *, stations_csv: bool = False,
               days: Days | None = None, run_id: str | None = None) -> DataFrame:
    """Write the three silver tables; return this run's quality report (one row a table).

    Malformed lines go to ``rejected/<table>`` and are counted. ``stations_csv`` also exports the
    station silver as CSV with a header (S5) — a distributed write, not a collect to the driver."""
    st = silver.station_silver(raw.stations)
    wx = silver.weather_silver(raw.weather, days=days)
    av = silver.availability_silver(raw.availability, raw.stations, days=days, counted=True)
    base = os.path.join(out, "silver")
    dynamic = days is not None
    jobs = [lambda: write_table(st.df, os.path.join(base, "stations")),
            lambda: write_partitioned(wx.df, os.path.join(base, "weather"), dynamic=dynamic),
            lambda: write_partitioned(av.df, os.path.join(base, "availability"), dynamic=dynamic)]
    if stations_csv:
        jobs.append(lambda: write_table(st.df, os.path.join(out, "export", "stations_csv"), "csv", header="true"))
    for name, r in raw.reads.items():
        jobs.append(lambda name=name, r=r: write_table(r.rejected, os.path.join(out, "rejected", name)))
    in_parallel(jobs, len(jobs))
    run_id, now, rows = run_id or uuid.uuid4().hex, dt.datetime.now(), []
    written = in_days(spark.read.schema(av.df.schema).parquet(os.path.join(base, "availability")), "date_partition", days)
    for name, report in (("stations", st.report), ("weather", wx.report), ("availability", counted_report(written))):
        counts = report.first().asDict()
        bad = raw.reads[name].counts().first().rows_malformed if name in raw.reads else 0
        rows.append((run_id, now, f"{name}_silver", *[{**counts, "rows_malformed": bad}[c] for c in COUNTERS]))
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    write_partitioned(report, os.path.join(out, "quality_report"), "run_id")
    return report


def latest_run(report: DataFrame) -> DataFrame:
    """The rows of the run that is last by time (then id)."""
    last = report.agg(F.max(F.struct("run_time", "run_id")).alias("x")).select(F.col("x.run_id").alias("run_id"))
    return report.join(F.broadcast(last), "run_id", "left_semi")


def report_text(report: DataFrame) -> DataFrame:
    """Formatted report lines of the latest run, for every table."""
    report = latest_run(report)
    frames = [Q.report_lines(report.where(F.col("table_name") == n), n)
              .select(F.lit(n).alias("table_name"), "line_no", "line")
              for n in ("stations_silver", "weather_silver", "availability_silver")]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@dataclass
class GoldTable:
    df: DataFrame
    day: str | None = None  # the column that it is partitioned by


def silver_tables(spark: SparkSession, out: str, days: Days | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Station, weather and availability silver; with ``days`` only their day folders are read."""
    st, wx, av = (spark.read.parquet(os.path.join(out, "silver", n)) for n in ("stations", "weather", "availability"))
    av = av.drop(*ROW_COUNTS)
    return st, in_days(wx, "date_partition", days), in_days(av, "date_partition", days)


def in_days(df: DataFrame, col: str, days: Days | None) -> DataFrame:
    return df if days is None else df.where(F.col(col).between(*[F.lit(d).cast("date") for d in days]))


def next_day(day: str) -> str:
    d = dt.date.fromisoformat(day)
    return str(d + dt.timedelta(1)) if d < dt.date.max else day


def frozen_state(out: str) -> DailyRuns:
    """B2 by day: runs of equal counts, listed from ``FROZEN_MIN_READINGS`` readings on."""
    return DailyRuns(os.path.join(out, "state", "frozen"), (StructField("bikes_available", IntegerType()), StructField("slots_free", IntegerType())),
                     lambda: F.col("n_readings") >= Q.FROZEN_MIN_READINGS)


def critical_state(out: str) -> DailyRuns:
    """B10 by day: runs of critical readings, listed beyond ``CRITICAL_MINUTES``."""
    return DailyRuns(os.path.join(out, "state", "critical"), (StructField("critical", BooleanType()),),
                     lambda: F.col("critical") & (Q.run_minutes(F.col("start"), F.col("end")) > Q.CRITICAL_MINUTES))


def frozen_readings(availability: DataFrame) -> DataFrame:
    return availability.select("station_id", FX.reading_time(F.col("timestamp")).alias("reading_time"), "bikes_available", "slots_free")


def frozen_rows(runs: DataFrame) -> DataFrame:
    return runs.select("station_id", "bikes_available", "slots_free", F.col("start").alias("start_time"),
                       F.col("end").alias("end_time"), "n_readings")


def critical_rows(runs: DataFrame) -> DataFrame:
    return runs.select("station_id", F.col("start").alias("start_time"), F.col("end").alias("end_time"), "n_readings",
                       Q.run_minutes(F.col("start"), F.col("end")).alias("duration_minutes"))


def gold_tables(spark: SparkSession, out: str, days: Days | None = None) -> dict[str, GoldTable]:
    """The star schema (lazy) over the silver parquet tables written by :func:`run_silver`, and over the cube and the
    states that :func:`take_days` has written for the same days. Only the given days' readings are read."""
    st, wx, av = silver_tables(spark, out, days)
    _, all_wx, _ = silver_tables(spark, out)
    dim_station = D.dim_station(st)
    dim_weather = D.dim_weather(all_wx)
    dates = sorted(d for n in ("availability", "weather") for d in stored_days(spark, os.path.join(out, "silver", n), "date_partition"))
    dim_date = D.dim_date(spark, dates[0], dates[-1]) if dates else D.dim_date_for((all_wx, "date_partition"))
    near_wx = in_days(all_wx, "date_partition", days and (days[0], next_day(days[1])))
    joined = FX.join_stations(av, st)
    cal = None  # dim_date covers every date of the silver data: keys computed, not joined
    # the schemas are given: a table without any row has no file to read it from
    cube = in_days(spark.read.schema(CB.station_day_cube(av, st).schema).parquet(os.path.join(out, "state", "station_day")), "date_partition", days)
    frozen = frozen_rows(frozen_state(out).runs(spark, days))
    day = lambda df, col: df.withColumn("day", F.to_date(col))
    before = DailyHours(os.path.join(out, "state", "hours")).before(spark, days)
    return {
        "dim_station": GoldTable(dim_station), "dim_weather": GoldTable(dim_weather),
        "dim_date": GoldTable(dim_date), "dim_time": GoldTable(D.dim_time(spark)),
        "fact_avg_bikes": GoldTable(CB.cube_avg_bikes(cube), "date_key"),
        "fact_occupancy": GoldTable(FX.fact_occupancy(joined, cal), "date_key"),
        "fact_dominant_weather": GoldTable(FX.fact_dominant_weather(wx, cal, dim_weather), "date_key"),
        "fact_saturation": GoldTable(CB.cube_saturation(cube), "date_key"),
        "fact_top_array": GoldTable(CB.cube_top_array(cube), "date_key"),
        "availability_daily_gold": GoldTable(CB.cube_gold_daily(cube, wx, dim_weather), "date_key"),
        "quality_daily": GoldTable(CB.cube_daily_quality(cube, frozen), "date_partition"),
        "enriched_readings": GoldTable(FX.enrich_with_weather(joined, near_wx.drop("date_partition")), "date_partition"),
        "frozen_runs": GoldTable(day(frozen, "start_time"), "day"),
        "critical_episodes": GoldTable(day(critical_rows(critical_state(out).runs(spark, days)), "start_time"), "day"),
        "features_hourly": GoldTable(day(FT.hourly_features(joined, wx, before), "hour"), "day"),
    }


def take_days(spark: SparkSession, out: str, days: Days | None = None, max_parallel_jobs: int = 4) -> None:
    """Write the given days' cube, and take their readings into the run states."""
    st, _, av = silver_tables(spark, out, days)
    joined = FX.join_stations(av, st)
    in_parallel([
        lambda: write_partitioned(CB.station_day_cube(av, st), os.path.join(out, "state", "station_day"), dynamic=days is not None),
        lambda: frozen_state(out).take(frozen_readings(av), days),
        lambda: critical_state(out).take(Q.critical_readings(joined).select("station_id", "reading_time", "critical"), days),
    ], max_parallel_jobs)


def correct_earlier_days(spark: SparkSession, out: str, days: Days) -> None:
    """Bring the rows of runs that began before the given days up to date: in the listed runs, and the frozen counts
    of the daily quality table. Reads the run tables' folders of those first days, rewrites those that change."""
    gold = lambda name: os.path.join(out, "gold", name)
    for name, state, rows in (("frozen_runs", frozen_state(out), frozen_rows), ("critical_episodes", critical_state(out), critical_rows)):
        began, now = state.earlier(spark, days)
        began = began.withColumnRenamed("start", "start_time")
        listed = rows(now).withColumn("day", F.to_date("start_time"))
        first_days = [str(r.day) for r in began.select(F.to_date("start_time").alias("day")).distinct().collect()]
        was = read_days(spark, gold(name), listed.schema, first_days).join(began, ["station_id", "start_time"], "left_semi").select(listed.columns)
        differ = was.exceptAll(listed).unionByName(listed.exceptAll(was))
        touched = sorted(str(r.day) for r in differ.select("day").distinct().collect())
        if not touched:
            continue
        in_touched = F.col("day").isin([dt.date.fromisoformat(d) for d in touched])
        merge_days(spark, gold(name), listed.schema, listed.where(in_touched), began, ["station_id", "start_time"], touched)
        if name == "frozen_runs":
            path = os.path.join(out, "state", "station_day")
            cube = read_days(spark, path, spark.read.parquet(path).schema, touched, "date_partition")
            write_partitioned(CB.cube_daily_quality(cube, read_days(spark, gold(name), listed.schema, touched).drop("day")), gold("quality_daily"))


def run_gold(spark: SparkSession, out: str, max_parallel_jobs: int = 4, days: Days | None = None,
             only: tuple[str, ...] | None = None) -> dict[str, str]:
    """Build and write the gold tables, then the model's moments and predictions and the SQL reports, which
    read the written ones. ``only`` names the gold tables to write (then without reports); it must hold
    ``frozen_runs``, ``critical_episodes``, ``features_hourly`` and ``quality_daily``, which later days go on from."""
    take_days(spark, out, days, max_parallel_jobs)
    tables = {n: t for n, t in gold_tables(spark, out, days).items() if only is None or n in only}
    paths = {name: os.path.join(out, "gold", name) for name in tables}

    def write(name: str) -> None:
        t = tables[name]
        if t.day is None:
            write_table(t.df, paths[name])
        else:
            write_partitioned(t.df, paths[name], t.day, dynamic=days is not None)

    in_parallel([lambda n=n: write(n) for n in tables], max_parallel_jobs)
    if days:
        correct_earlier_days(spark, out, days)
    DailyHours(os.path.join(out, "state", "hours")).take(spark, paths["features_hourly"], days)
    paths["predictions_gold"] = os.path.join(out, "gold", "predictions_gold")
    moments = os.path.join(out, "state", "moments")
    features = spark.read.schema(tables["features_hourly"].df.schema).parquet(paths["features_hourly"])
    of_days = FT.day_moments(in_days(features, "day", days))
    write_partitioned(of_days, moments, "day", dynamic=days is not None)
    try:
        scored = FT.score_last_days(features, spark.read.schema(of_days.schema).parquet(moments))
        write_partitioned(scored.withColumn("day", F.to_date("hour")), paths["predictions_gold"], "day")
    except FT.NoTrainingRows:  # fewer than two days of complete features: nothing to score
        del paths["predictions_gold"]
    if only is not None:
        return paths
    star = {n: spark.read.parquet(paths[n]) for n in ("fact_occupancy", "fact_dominant_weather", "dim_weather", "dim_date")}
    for name in sql_reports.REPORTS:
        paths[f"report_{name}"] = os.path.join(out, "gold", f"report_{name}")
        write_table(sql_reports.run_report(spark, star, name), paths[f"report_{name}"])
    return paths


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m stationlake.plans.batch_job --stations S --availability A --weather W --out O
    [--from D1 --to D2]``"""
    import argparse

    p = argparse.ArgumentParser(description="raw CSV -> silver parquet -> gold star schema")
    p.add_argument("--stations", required=True)
    p.add_argument("--availability", required=True)
    p.add_argument("--weather", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--from", dest="first", help="first day to rebuild (yyyy-mm-dd); with --to")
    p.add_argument("--to", dest="last", help="last day to rebuild")
    a = p.parse_args(argv)
    if bool(a.first) != bool(a.last):
        p.error("--from and --to go together")
    days = (a.first, a.last) if a.first else None
    spark = SparkSession.builder.appName("stationlake-batch").getOrCreate()
    raw = read_raw_files(spark, a.stations, a.availability, a.weather)
    run_silver(spark, raw, a.out, days=days)
    run_gold(spark, a.out, days=days)


if __name__ == "__main__":
    main()

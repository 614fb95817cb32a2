"""Registered queries: every operator of the survey as a query over the shared tables.

Each query takes ``(spark, sf_dir)``, derives the raw tables from the given data set
(every row), and returns a DataFrame; the silver tables it reads are written once per session
and data set (see :func:`build_star`). The DuckDB restatement of each is in
:mod:`stationlake.oracle` (wired in ``__spark_entry__.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators import cube as CB
from stationlake.operators import dimensions as D
from stationlake.operators import facts as FX
from stationlake.operators import features as FT
from stationlake.operators import quality as Q
from stationlake.plans import batch_job, sql_reports
from stationlake.functions import rules as R
from stationlake.operators.cleaning import CleanRule, SilverResult, apply_rules, strip_flags
from stationlake.plans import silver
from stationlake.schemas import RAW_AVAILABILITY_COLUMNS, RAW_STATION_COLUMNS, RAW_WEATHER_COLUMNS
from stationlake.session import scratch_path
from stationlake.sources import testdata as td
from stationlake.sources.csv import RawRead, land_csv, read_raw
from stationlake.sources.sinks import write_partitioned


#: A calendar narrower than the data.
FIXED_CALENDAR = ("2024-01-05", "2024-01-12")


@dataclass
class Star:
    stations: SilverResult
    weather: SilverResult
    availability: SilverResult
    dim_station: DataFrame
    dim_weather: DataFrame
    dim_date: DataFrame
    joined: DataFrame
    # Facts use calendar=None: ``dim_date`` is built to cover every date of the data, so
    # the date key is computed from the date instead of joined (same values).
    calendar: DataFrame | None = None


_STARS: dict[tuple[str, str], Star] = {}
_FEATURES: dict[tuple[str, str], DataFrame] = {}
_STREAMS: dict = {}
_CUBES: dict[tuple[str, str], DataFrame] = {}
_DAILY: dict[tuple[str, str], str] = {}
_SILVER_JOBS: dict[tuple[str, str], str] = {}


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    """Silver tables (written on the first call), dimensions and the availability ⋈ stations
    frame over them: built once per session and data set, shared by every query."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STARS:
        _STARS[key] = _build_star(spark, sf_dir)
    return _STARS[key]


def _build_star(spark: SparkSession, sf_dir: str) -> Star:
    """Silver tables written once as parquet into the shared checkpoint folder.

    Every query of the session reads them. Without the cut, each fact would carry the
    whole cleaning lineage, and Catalyst pushes different filters into each copy (e.g.
    ``isnotnull(station_id)`` inferred from an inner join), so the copies differ and their
    shuffles cannot be reused: the cleaning would run once per fact. A parquet table
    (rather than an RDD checkpoint) is computed once, keeps column pruning and filter
    pushdown for every reader, and survives lost executors.
    """
    base = scratch_path(spark, f"star-{uuid.uuid4().hex}")
    raw_st = td.raw_stations(spark, sf_dir)
    st = silver.station_silver(raw_st)
    wx = silver.weather_silver(td.raw_weather(spark, sf_dir))
    av = silver.availability_silver(td.raw_availability(spark, sf_dir), raw_st)

    def cut(result: SilverResult, name: str) -> SilverResult:
        path = f"{base}/{name}"
        result.df.write.parquet(path)
        return replace(result, df=spark.read.parquet(path))

    st, wx, av = cut(st, "stations"), cut(wx, "weather"), cut(av, "availability")
    return Star(
        stations=st, weather=wx, availability=av,
        dim_station=D.dim_station(st.df),
        dim_weather=D.dim_weather(wx.df),
        dim_date=D.dim_date_for((av.df, "date_partition"), (wx.df, "date_partition")),
        joined=FX.join_stations(av.df, st.df),
    )


def _silver_stations(spark, sf):
    return build_star(spark, sf).stations.df


def _silver_weather(spark, sf):
    return build_star(spark, sf).weather.df


def _silver_availability(spark, sf):
    return build_star(spark, sf).availability.df


def _report_stations(spark, sf):
    return build_star(spark, sf).stations.report


def _report_weather(spark, sf):
    return build_star(spark, sf).weather.report


def _report_availability(spark, sf):
    return build_star(spark, sf).availability.report


def _dim_station(spark, sf):
    return build_star(spark, sf).dim_station


def _dim_weather(spark, sf):
    return build_star(spark, sf).dim_weather


def _dim_date(spark, sf):
    return build_star(spark, sf).dim_date


def _fact_avg_bikes(spark, sf):
    s = build_star(spark, sf)
    return FX.fact_avg_bikes(s.availability.df, s.calendar, s.dim_station)


def _fact_occupancy(spark, sf):
    s = build_star(spark, sf)
    return FX.fact_occupancy(s.joined, s.calendar)


def _fact_occupancy_time_join(spark, sf):
    """J5 + J6 as joins: the station and minute dimensions instead of computed keys."""
    s = build_star(spark, sf)
    return FX.fact_occupancy(s.joined, s.calendar, s.dim_station, D.dim_time(spark))


def _fact_avg_bikes_calendar(spark, sf):
    """A fixed calendar; days outside it get a NULL key."""
    s = build_star(spark, sf)
    return FX.fact_avg_bikes(s.availability.df, D.dim_date(spark, *FIXED_CALENDAR), s.dim_station)


def _gold_daily_calendar(spark, sf):
    """C18 under the fixed calendar: days outside it vanish from the daily table."""
    s = build_star(spark, sf)
    return _flat_gold(FX.gold_daily(s.availability.df, s.weather.df, s.joined, D.dim_date(spark, *FIXED_CALENDAR),
                                    s.dim_station, s.dim_weather))


def _dim_station_key_check(spark, sf):
    s = build_star(spark, sf)
    return D.station_key_check(s.stations.df, s.dim_station)


def _weather_hours(spark, sf):
    return td.weather_hours(spark, sf).select("hour", "n_events", "k", "v", "kind")


def _landed(spark, sf) -> dict[str, RawRead]:
    """S1 + B1: the derived raw tables landed as CSV lines, some malformed, and read back."""
    base = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    out = {}
    for name, df, columns, sep in (
            ("stations", td.raw_stations(spark, sf), RAW_STATION_COLUMNS, ","),
            ("availability", td.raw_availability(spark, sf), RAW_AVAILABILITY_COLUMNS, ";"),
            ("weather", td.raw_weather(spark, sf), RAW_WEATHER_COLUMNS, ";")):
        land_csv(df, f"{base}/{name}", sep=sep, malformed=landed_malformed(name))
        out[name] = read_raw(spark, f"{base}/{name}", columns, sep=sep, header=False)
    return out


def landed_malformed(name: str):
    """Which rows are landed as malformed lines, told by their own text."""
    if name == "stations":
        return F.col("capacity") == F.lit("23")
    if name == "availability":
        return F.col("bikes_available") == F.lit("7")
    return F.col("weather_condition") == F.lit("Fog")


def _csv_stations(spark, sf):
    return _landed(spark, sf)["stations"].rows


def _csv_rejects(spark, sf):
    frames = [r.counts().select(F.lit(name).alias("table_name"), "rows_read", "rows_malformed")
              for name, r in _landed(spark, sf).items()]
    return reduce(DataFrame.unionByName, frames)


def _csv_silver_availability(spark, sf):
    """S2 + J1 + C7 from the landed files: both sides see the same well-formed lines."""
    landed = _landed(spark, sf)
    return silver.availability_silver(landed["availability"].rows, landed["stations"].rows).df


def _silver_partition_readback(spark, sf):
    """The availability silver written by day and read back with two days pruned."""
    path = scratch_path(spark, f"partitioned-{uuid.uuid4().hex}")
    write_partitioned(build_star(spark, sf).availability.df, path)
    lo, hi = FIXED_CALENDAR
    return (spark.read.parquet(path).where(F.col("date_partition").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
            .select("station_id", "timestamp", "bikes_available", "slots_free", "date_partition"))


def _fact_dominant_weather(spark, sf):
    s = build_star(spark, sf)
    return FX.fact_dominant_weather(s.weather.df, s.calendar, s.dim_weather)


def _fact_saturation(spark, sf):
    s = build_star(spark, sf)
    return FX.fact_saturation(s.joined, s.calendar)


def _fact_top_saturated(spark, sf):
    s = build_star(spark, sf)
    return FX.fact_top_saturated(s.joined, s.calendar)


def _fact_top_array(spark, sf):
    s = build_star(spark, sf)
    return FX.explode_top_array(FX.fact_top_array(s.joined, s.calendar))


def _gold_daily(spark, sf):
    s = build_star(spark, sf)
    return _flat_gold(FX.gold_daily(s.availability.df, s.weather.df, s.joined, s.calendar, s.dim_station,
                                    s.dim_weather))


def _flat_gold(g: DataFrame) -> DataFrame:
    flat = g.select("date_key", "avg_bikes_available_day", "occupancy_pct_day",
                    "weather_condition_key_day", F.posexplode("top_stations_day").alias("__p", "__t"))
    return flat.select("date_key", "avg_bikes_available_day", "occupancy_pct_day",
                       "weather_condition_key_day", (F.col("__p") + 1).alias("rank"),
                       F.col("__t.station_key").alias("station_key"),
                       F.col("__t.saturation_pct").alias("saturation_pct"))


def _enriched_weather(spark, sf):
    s = build_star(spark, sf)
    return FX.enrich_with_weather(s.joined, s.weather.df).select(
        "station_id", "timestamp", "bikes_available", "timestamp_rounded", "weather_timestamp",
        "temperature_c", "rain_mm", "weather_condition")


def _quality_negatives(spark, sf):
    return Q.count_negatives(build_star(spark, sf).weather.df, "temperature_c", "date_partition")


def _quality_capacity(spark, sf):
    s = build_star(spark, sf)
    return Q.capacity_coherence(s.availability.df, s.stations.df, "station_id", "date_partition")


def _quality_report_lines(spark, sf):
    return Q.report_lines(build_star(spark, sf).availability.report, "availability_silver")


def _null_audit(spark, sf):
    return Q.null_audit(build_star(spark, sf).joined)


def _weather_profile(spark, sf):
    return Q.value_profile(td.raw_weather(spark, sf), "weather_condition")


def _frozen_stations(spark, sf):
    return Q.frozen_stations(build_star(spark, sf).availability.df)


def _critical_episodes(spark, sf):
    return Q.critical_episodes(build_star(spark, sf).joined)


def _quality_daily(spark, sf):
    s = build_star(spark, sf)
    return Q.daily_quality(Q.with_capacity(s.availability.df, s.stations.df),
                           Q.frozen_stations(s.availability.df))


def _features(spark, sf) -> DataFrame:
    """The hourly features, written once per session and data set (the model reads them three times)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FEATURES:
        s = build_star(spark, sf)
        path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
        FT.hourly_features(s.joined, s.weather.df).write.parquet(path)
        _FEATURES[key] = spark.read.parquet(path)
    return _FEATURES[key]


def _features_hourly(spark, sf):
    return _features(spark, sf)


def _baseline_errors(spark, sf):
    return FT.baseline_errors(_features(spark, sf))


def _predictions(spark, sf):
    scored = FT.train_and_score(_features(spark, sf))[1]
    return scored.withColumn("predicted_occupancy_pct", F.round("predicted_occupancy_pct", 3))


def _model_errors(spark, sf):
    return FT.model_errors(FT.train_and_score(_features(spark, sf))[1])


def _critical_alerts(spark, sf):
    return Q.critical_alerts(Q.critical_readings(build_star(spark, sf).joined))


#: Where the raw files of the streams are cut: each part is landed and run before the next one.
STREAM_CUTS = ("2024-01-12 00:00:00", "2024-01-20 00:00:00")
LATE_DAY = "2024-01-05"  # its readings are landed a second time with the second part, long past the watermark
LATE_STATION = "999999999"  # and a reading of this station exactly at the watermark


def _streams(spark, sf):
    """B9 + B10 as streams over three parts of the derived raw availability, landed one after the other as CSV files
    (some lines malformed, some late) in the shared scratch folder: intake, silver, alerts, day silver."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STREAMS:
        from stationlake.streaming.ingest import WATERMARK
        from stationlake.streaming.jobs import run_streams

        base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
        raw_st = td.raw_stations(spark, sf)
        raw = td.raw_availability(spark, sf)
        # cleaned once and written: a filter on the cleaned time would be pushed below the rule's steps and read every row
        # through copies of all of them, once a landed folder
        timed = strip_flags(apply_rules(raw.withColumn("t", F.col("timestamp")), [CleanRule("t", R.clean_date)]))
        timed.withColumn("t", F.col("t").try_cast("timestamp")).write.parquet(f"{base}/timed")
        timed = spark.read.parquet(f"{base}/timed")
        t = F.col("t")
        cuts = [F.lit(c).cast("timestamp") for c in STREAM_CUTS]
        part = F.when(t >= cuts[1], 2).when(t >= cuts[0], 1).otherwise(0)
        at_limit = timed.where(part == 0).agg(F.max(t).alias("m")).select(
            F.lit(LATE_STATION).alias("station_id"),
            F.date_format(F.col("m") - F.expr(f"INTERVAL {WATERMARK}"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            F.lit("").alias("bikes_available"), F.lit("").alias("slots_free"))
        for k in range(3):
            land_csv(timed.where(part == k).select(*RAW_AVAILABILITY_COLUMNS), f"{base}/raw/part-{k}")
            if k == 0:
                # some lines again with a field too many: set apart by the intake, they change nothing else
                land_csv(timed.where(landed_malformed("availability")).select(*RAW_AVAILABILITY_COLUMNS), f"{base}/raw/again", malformed=F.lit(True))
            if k == 1:
                land_csv(timed.where(F.to_date(t) == F.lit(LATE_DAY).cast("date")).select(*RAW_AVAILABILITY_COLUMNS), f"{base}/raw/late")
                land_csv(at_limit, f"{base}/raw/limit")
            _STREAMS[key] = run_streams(spark, f"{base}/raw/*", raw_st, build_star(spark, sf).stations.df, f"{base}/out",
                                        header=False, close=k == 2, state_partitions=2 * spark.sparkContext.defaultParallelism)
    return _STREAMS[key]


def _stream_alerts(spark, sf):
    return spark.read.parquet(_streams(spark, sf).alerts).drop("batch_id")


def _stream_silver(spark, sf):
    return spark.read.parquet(_streams(spark, sf).silver).select(
        "station_id", "timestamp", "bikes_available", "slots_free", "date_partition")


def _stream_day_silver(spark, sf):
    return spark.read.parquet(_streams(spark, sf).day_silver).select("station_id", "timestamp", "bikes_available", "slots_free",
                                                                     "date_partition")


def _stream_intake(spark, sf):
    from stationlake.streaming.ingest import intake_counts

    return intake_counts(spark, _streams(spark, sf).intake).groupBy("status").agg(F.sum("n").alias("n"))


def _cube(spark, sf) -> DataFrame:
    """The station-day cube, built in two halves of the readings and merged."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CUBES:
        s = build_star(spark, sf)
        path = scratch_path(spark, f"cube-{uuid.uuid4().hex}")
        first = F.hash("station_id", "timestamp") % 2 == 0
        halves = [CB.station_day_cube(s.availability.df.where(h), s.stations.df) for h in (first, ~first)]
        CB.merge_cubes(*halves).write.parquet(path)
        _CUBES[key] = spark.read.parquet(path)
    return _CUBES[key]


def _station_day_cube(spark, sf):
    return _cube(spark, sf).withColumn("sum_occupancy", F.col("sum_occupancy").cast("double"))


def _cube_gold_daily(spark, sf):
    s = build_star(spark, sf)
    return _flat_gold(CB.cube_gold_daily(_cube(spark, sf), s.weather.df, s.dim_weather))


def _cube_quality_daily(spark, sf):
    return CB.cube_daily_quality(_cube(spark, sf), Q.frozen_stations(build_star(spark, sf).availability.df))


#: Where the daily runs cut the data: the first run takes all days up to the first date, the others go on from there.
RUN_ENDS = ("2024-01-15", "2024-01-16", "9999-12-31")
DAILY_TABLES = ("frozen_runs", "critical_episodes", "features_hourly", "quality_daily")


def _daily_job(spark, sf) -> str:
    """The batch job over the silver of this data, run once and then day range by day range: every range reads its own
    days and the states left by the ones before."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DAILY:
        s = build_star(spark, sf)
        out = scratch_path(spark, f"daily-{uuid.uuid4().hex}")
        begin = "0001-01-01"
        for k, end in enumerate(RUN_ENDS):
            between = F.col("date_partition").between(F.lit(begin).cast("date"), F.lit(end).cast("date"))
            write_partitioned(s.availability.df.where(between), f"{out}/silver/availability")
            if k == 0:
                s.stations.df.write.parquet(f"{out}/silver/stations")
                write_partitioned(s.weather.df, f"{out}/silver/weather")
            batch_job.run_gold(spark, out, days=None if k == 0 else (begin, end), only=DAILY_TABLES)
            begin = batch_job.next_day(end)
        _DAILY[key] = out
    return _DAILY[key]


def _daily(name: str, *cols: str):
    return lambda spark, sf: spark.read.parquet(f"{_daily_job(spark, sf)}/gold/{name}").select(*cols)


def _daily_predictions(spark, sf):
    """The last run's scored day (the table keeps those of the runs before)."""
    scored = spark.read.parquet(f"{_daily_job(spark, sf)}/gold/predictions_gold")
    scored = scored.where(F.col("day") == F.lit(scored.agg(F.max("day")).first()[0])).drop("day")
    return scored.withColumn("predicted_occupancy_pct", F.round("predicted_occupancy_pct", 3))


def _silver_job(spark, sf) -> str:
    """The silver half of the batch job over the landed CSV files, with its report and the station export."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SILVER_JOBS:
        out = scratch_path(spark, f"silver-{uuid.uuid4().hex}")
        landed = _landed(spark, sf)
        raw = batch_job.RawTables(*(landed[n].rows for n in ("stations", "availability", "weather")), landed)
        batch_job.run_silver(spark, raw, out, stations_csv=True)
        _SILVER_JOBS[key] = out
    return _SILVER_JOBS[key]


def _batch_report(spark, sf):
    """The report table of one run."""
    return spark.read.parquet(f"{_silver_job(spark, sf)}/quality_report").select("table_name", *batch_job.COUNTERS)


def _station_export(spark, sf):
    """The exported station CSV read back."""
    schema = build_star(spark, sf).stations.df.schema
    return spark.read.schema(schema).option("header", True).csv(f"{_silver_job(spark, sf)}/export/stations_csv")


def _star_tables(spark, sf) -> dict[str, DataFrame]:
    s = build_star(spark, sf)
    return {
        "fact_occupancy": FX.fact_occupancy(s.joined, s.calendar),
        "fact_dominant_weather": FX.fact_dominant_weather(s.weather.df, s.calendar, s.dim_weather),
        "dim_weather": s.dim_weather, "dim_date": s.dim_date, "dim_station": s.dim_station,
    }


def _sql(name):
    return lambda spark, sf: sql_reports.run_report(spark, _star_tables(spark, sf), name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_stations": _silver_stations,
    "silver_weather": _silver_weather,
    "silver_availability": _silver_availability,
    "report_stations": _report_stations,
    "report_weather": _report_weather,
    "report_availability": _report_availability,
    "dim_station": _dim_station,
    "dim_weather": _dim_weather,
    "dim_date": _dim_date,
    "fact_avg_bikes": _fact_avg_bikes,
    "fact_occupancy": _fact_occupancy,
    "fact_occupancy_time_join": _fact_occupancy_time_join,
    "fact_avg_bikes_calendar": _fact_avg_bikes_calendar,
    "gold_daily_calendar": _gold_daily_calendar,
    "dim_station_key_check": _dim_station_key_check,
    "weather_hours": _weather_hours,
    "csv_stations": _csv_stations,
    "csv_rejects": _csv_rejects,
    "csv_silver_availability": _csv_silver_availability,
    "silver_partition_readback": _silver_partition_readback,
    "fact_dominant_weather": _fact_dominant_weather,
    "fact_saturation": _fact_saturation,
    "fact_top_saturated": _fact_top_saturated,
    "fact_top_array": _fact_top_array,
    "gold_daily": _gold_daily,
    "enriched_weather": _enriched_weather,
    "quality_negatives": _quality_negatives,
    "quality_capacity": _quality_capacity,
    "quality_report_lines": _quality_report_lines,
    "null_audit": _null_audit,
    "weather_profile": _weather_profile,
    "frozen_stations": _frozen_stations,
    "critical_episodes": _critical_episodes,
    "quality_daily": _quality_daily,
    "features_hourly": _features_hourly,
    "baseline_errors": _baseline_errors,
    "sql_station_ranking": _sql("station_ranking"),
    "sql_weather_impact": _sql("weather_impact"),
    "sql_hourly_profile": _sql("hourly_profile"),
    "predictions": _predictions,
    "model_errors": _model_errors,
    "critical_alerts": _critical_alerts,
    "batch_report": _batch_report,
    "station_export": _station_export,
    "station_day_cube": _station_day_cube,
    "cube_gold_daily": _cube_gold_daily,
    "cube_quality_daily": _cube_quality_daily,
    "daily_frozen_runs": _daily("frozen_runs", "station_id", "bikes_available", "slots_free", "start_time", "end_time", "n_readings"),
    "daily_critical_episodes": _daily("critical_episodes", "station_id", "start_time", "end_time", "n_readings", "duration_minutes"),
    "daily_features": _daily("features_hourly", "station_id", "hour", "hour_of_day", "day_of_week_num", "is_weekend", "temperature_c",
                             "rain_mm", "weather_condition", "occupancy_pct", "n_readings", "lag_1", "moving_avg_3"),
    "daily_quality": _daily("quality_daily", "station_id", "date_partition", "n_readings", "nb_neg_bikes_available", "nb_neg_slots_free",
                            "nb_incoherent_capacity", "n_frozen_runs", "n_frozen_readings"),
    "daily_predictions": _daily_predictions,
    "stream_alerts": _stream_alerts,
    "stream_silver": _stream_silver,
    "stream_intake": _stream_intake,
    "stream_day_silver": _stream_day_silver,
}

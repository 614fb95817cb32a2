"""Quality checks and reports (C20–C22, P6, S9, B2, B3, B10 batch twin)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.operators.dimensions import one_per_station
from stationlake.operators.facts import reading_time
from stationlake.operators.runs import value_runs, with_run_start

# Fixed report layout (one line each; counters filled in order).
REPORT_TITLE = "Quality report - {}"
REPORT_RULE = "-------------------------------------"
REPORT_LINES = (
    ("- Raw rows : {}", "rows_raw"),
    ("- Corrected rows : {}", "rows_corrected"),
    ("- Invalid rows (values replaced by NULL) : {}", "rows_invalid"),
    ("- Removed rows : {}", "rows_removed"),
)

CRITICAL_SHARE_PCT = 20
CRITICAL_MINUTES = 30
FROZEN_MIN_READINGS = 3


def count_negatives(df: DataFrame, target_col: str, *group_cols: str) -> DataFrame:
    """C20: number of negative ``target_col`` values per group, as ``nb_neg_<col>``."""
    return df.groupBy(*group_cols).agg(
        F.count_if(F.col(target_col) < 0).alias(f"nb_neg_{target_col}"))


def incoherent_capacity(bikes: Column, slots: Column, capacity: Column) -> Column:
    """Bikes + free slots differ from the capacity, or any of them is unknown."""
    return ~(bikes + slots).eqNullSafe(capacity) | bikes.isNull() | slots.isNull() | capacity.isNull()


def capacity_coherence(availability: DataFrame, stations: DataFrame, *group_cols: str) -> DataFrame:
    """Readings whose counts do not add up to the station capacity, per group."""
    cap = one_per_station(stations.select("station_id", F.col("capacity").try_cast("int").alias("capacity")))
    df = availability.join(cap, "station_id", "inner")
    return df.groupBy(*group_cols).agg(F.count_if(incoherent_capacity(
        F.col("bikes_available"), F.col("slots_free"), F.col("capacity")))
        .alias("nb_incoherent_capacity"))


def report_lines(report: DataFrame, table_name: str) -> DataFrame:
    """The quality report as ordered text lines ``line_no, line`` (6 rows)."""
    lines = [F.lit(REPORT_TITLE.format(table_name)), F.lit(REPORT_RULE)]
    lines += [F.format_string(fmt.replace("{}", "%d"), F.col(c)) for fmt, c in REPORT_LINES]
    return report.select(F.posexplode(F.array(*lines)).alias("line_no", "line")).select(
        (F.col("line_no") + 1).alias("line_no"), "line")


def null_audit(joined: DataFrame) -> DataFrame:
    """One-row count of missing counts in availability readings."""
    b, s, c = F.col("bikes_available"), F.col("slots_free"), F.col("capacity")
    return joined.agg(
        F.count_if(b.isNull() & s.isNull() & c.isNotNull()).alias("n_both_null_capacity_known"),
        F.count_if(s.isNull()).alias("n_slots_null"),
        F.count_if(b.isNull()).alias("n_bikes_null"),
        F.count_if(c.isNull()).alias("n_capacity_null"))


def value_profile(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` with their counts (NULL included)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def frozen_stations(availability: DataFrame, min_readings: int = FROZEN_MIN_READINGS) -> DataFrame:
    """B2: runs of at least ``min_readings`` consecutive readings of a station reporting
    the same bikes and free-slot counts (a stuck sensor)."""
    rows = availability.select("station_id", reading_time(F.col("timestamp")).alias("reading_time"),
                               "bikes_available", "slots_free")
    runs = value_runs(rows, "station_id", "reading_time", ["bikes_available", "slots_free"])
    return (runs.where(F.col("n_readings") >= min_readings)
            .select("station_id", "bikes_available", "slots_free",
                    F.col("start").alias("start_time"), F.col("end").alias("end_time"),
                    "n_readings"))


def is_critical(bikes: Column, capacity: Column, share_pct: int = CRITICAL_SHARE_PCT) -> Column:
    """Bikes under ``share_pct`` % of the capacity, in exact integer arithmetic
    (``35 * 0.2`` is 7.000000000000001 in floating point)."""
    return bikes.cast("bigint") * 100 < capacity.cast("bigint") * share_pct


def run_minutes(start: Column, end: Column) -> Column:
    """Minutes from a run's first to its last reading."""
    return (F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))) / 60.0


def critical_episodes(joined: DataFrame, share_pct: int = CRITICAL_SHARE_PCT,
                      minutes: int = CRITICAL_MINUTES) -> DataFrame:
    """B10 (batch): episodes where a station stays under ``share_pct`` % of its capacity
    in bikes for more than ``minutes`` (first to last critical reading of the run)."""
    rows = joined.select(
        "station_id", reading_time(F.col("timestamp")).alias("reading_time"),
        is_critical(F.col("bikes_available"), F.col("capacity"), share_pct).alias("critical"))
    runs = value_runs(rows.where(F.col("critical").isNotNull()), "station_id", "reading_time",
                      ["critical"])
    span = run_minutes(F.col("start"), F.col("end"))
    return (runs.where(F.col("critical") & (span > minutes))
            .select("station_id", F.col("start").alias("start_time"),
                    F.col("end").alias("end_time"), "n_readings",
                    span.alias("duration_minutes")))


def critical_readings(joined: DataFrame, share_pct: int = CRITICAL_SHARE_PCT) -> DataFrame:
    """station_id, reading_time, critical, bikes_available, capacity of the readings that can be judged."""
    return (joined.select(
        "station_id", reading_time(F.col("timestamp")).alias("reading_time"),
        is_critical(F.col("bikes_available"), F.col("capacity"), share_pct).alias("critical"),
        "bikes_available", "capacity")
        .where(F.col("critical").isNotNull() & F.col("reading_time").isNotNull() & F.col("station_id").isNotNull()))


def critical_alerts(readings: DataFrame, minutes: int = CRITICAL_MINUTES) -> DataFrame:
    """One alert a critical run, at its first reading more than ``minutes`` after its start
    (of several readings at that time the one with the fewest bikes)."""
    return run_alerts(with_run_start(readings, "station_id", "reading_time", ["critical"]), minutes)


def run_alerts(started: DataFrame, minutes: int = CRITICAL_MINUTES) -> DataFrame:
    """:func:`critical_alerts` of readings that have the start of their run (``run_start``)."""
    rows = started.where("critical")
    waited = (F.unix_timestamp(F.col("reading_time").cast("timestamp"))
              - F.unix_timestamp(F.col("run_start").cast("timestamp"))) / 60.0
    return (rows.withColumn("minutes_critical", waited).where(F.col("minutes_critical") > minutes)
            .groupBy("station_id", "run_start")
            .agg(F.min(F.struct("reading_time", "bikes_available", "capacity", "minutes_critical")).alias("a"))
            .select("station_id", "run_start", F.col("a.reading_time").alias("alert_time"), "a.minutes_critical",
                    "a.bikes_available", "a.capacity"))


def daily_quality(joined_left: DataFrame, frozen: DataFrame) -> DataFrame:
    """Per station and day — readings, negative counts, incoherent capacities and
    frozen runs (by start day). One aggregation pass over the readings (the three
    checks share the grouping), then a join with the (small) frozen-run summary."""
    b, s, c = F.col("bikes_available"), F.col("slots_free"), F.col("capacity")
    checks = joined_left.groupBy("station_id", "date_partition").agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.count_if(b < 0).alias("nb_neg_bikes_available"),
        F.count_if(s < 0).alias("nb_neg_slots_free"),
        F.count_if(F.col("__matched") & incoherent_capacity(b, s, c)).alias("nb_incoherent_capacity"))
    fz = frozen.groupBy("station_id", F.to_date("start_time").alias("date_partition")).agg(
        F.count(F.lit(1)).alias("n_frozen_runs"), F.sum("n_readings").alias("n_frozen_readings"))
    return (checks.join(fz, ["station_id", "date_partition"], "left")
            .select("station_id", "date_partition", "n_readings", "nb_neg_bikes_available",
                    "nb_neg_slots_free", "nb_incoherent_capacity",
                    F.coalesce("n_frozen_runs", F.lit(0)).alias("n_frozen_runs"),
                    F.coalesce("n_frozen_readings", F.lit(0)).alias("n_frozen_readings")))


def with_capacity(availability: DataFrame, stations: DataFrame) -> DataFrame:
    """Availability ⟕ station capacity, with ``__matched`` telling whether a station row
    was found (used by :func:`daily_quality`)."""
    cap = one_per_station(stations.select("station_id", F.col("capacity").try_cast("int").alias("capacity"))
                          ).withColumn("__matched", F.lit(True))
    return (availability.join(cap, "station_id", "left")
            .withColumn("__matched", F.coalesce("__matched", F.lit(False))))

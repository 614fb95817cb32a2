"""State carried from day to day (B2, B5, B10): a run over some days reads those days and one small table.

What looks across days needs little of the past: of every station the run that its last reading
left open, and its last three hours.  Each day's folder of a ``carry`` table holds that, for every station
seen so far (one row, or three): the folder before the first asked day stands for all history.

``DailyRuns`` keeps runs of equal values.  Per asked day it writes the day's ``pieces`` (each station's
first and last run of the day, and the complete ones worth listing) from that day's readings, the only
rows it reads; then it chains first and last pieces to the carried runs and, where later days exist,
to their pieces.  The chains are made once for a range of days and kept (``chains``, of the last range taken):
the carry, the listed runs and the corrections are all read from them.  ``DailyHours`` keeps the last hours for lags and moving averages.

Runs are listed under their first day.  A run that began before the asked days and goes on into them
changes a row of an earlier day: :meth:`DailyRuns.earlier` gives those rows for :func:`merge_days`, so the whole
table equals a full rebuild.  A day whose readings all vanish keeps its folders, like the silver.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegerType, LongType, StructField, StructType, TimestampNTZType

from stationlake.operators.features import MOVING_WINDOW
from stationlake.operators.runs import PIECE, chained, day_pieces
from stationlake.session import scratch_path
from stationlake.sources.sinks import write_partitioned

Days = tuple[str, str]
ALL = "all"  # the chains of all days


def stored_days(spark: SparkSession, path: str, col: str = "day") -> list[str]:
    """The day folders of a table, in order: one listing, no file is read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{col}=") and "__HIVE" not in n)


def read_days(spark: SparkSession, path: str, schema: StructType, days: Sequence[str], col: str = "day") -> DataFrame:
    """The given day folders of a table; days that it lacks have no rows."""
    here = set(stored_days(spark, path, col))
    folders = [os.path.join(path, f"{col}={d}") for d in days if d in here]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def snapshots(rows: DataFrame, key: str, order: Sequence[str], k: int, days: Sequence[str]) -> DataFrame:
    """Each key's last ``k`` rows as of the end of every day of ``days``: a row of day d stands from d until
    the day of its k-th successor. ``day`` becomes the day of the snapshot."""
    w = Window.partitionBy(key).orderBy(*order)
    return standing(rows.withColumn("__until", F.lead("day", k).over(w)), "__until", days)


def standing(rows: DataFrame, until: str, days: Sequence[str]) -> DataFrame:
    """Each row once for every day of ``days`` from its ``day`` to the one before ``until`` (null: to the last)."""
    all_days = F.array(*[F.lit(d).cast("date") for d in days])
    return (rows.withColumn("day", F.explode(F.filter(
        all_days, lambda d: (d >= F.col("day")) & (F.col(until).isNull() | (d < F.col(until)))))).drop(until))


def merge_days(spark: SparkSession, path: str, schema: StructType, rows: DataFrame, replaced: DataFrame, keys: Sequence[str],
               days: Sequence[str], col: str = "day") -> None:
    """In the given day folders of a table, take out the rows with a key of ``replaced`` and add ``rows``.

    The folders' new content is written beside the table first, then over them: a day is replaced as a whole."""
    kept = read_days(spark, path, schema, days, col).join(replaced.select(*keys).distinct(), list(keys), "left_anti")
    staged = scratch_path(spark, f"merge-{uuid.uuid4().hex}")
    kept.select(*schema.fieldNames()).unionByName(rows.select(*schema.fieldNames())).write.parquet(staged)
    write_partitioned(spark.read.schema(schema).parquet(staged), path, col)


@dataclass(frozen=True)
class DailyRuns:
    """Runs of consecutive rows of a key with equal values, kept by day under ``base``.

    ``values`` are the compared columns with their types; ``keep`` tells, from ``n_readings``, ``start``, ``end``
    and the values, which runs are listed."""

    base: str
    values: tuple[StructField, ...]
    keep: Callable[[], Column]
    key: str = "station_id"
    order: str = "reading_time"

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.values]

    @property
    def schema(self) -> StructType:
        times = [StructField(n, TimestampNTZType()) for n in ("start", "end")]
        return StructType([StructField(self.key, IntegerType()), *self.values, *times, StructField("n_readings", LongType()),
                           StructField("run", IntegerType()), StructField("head", BooleanType()),
                           StructField("tail", BooleanType()), StructField("day", DateType())])

    def _path(self, name: str) -> str:
        return os.path.join(self.base, name)

    def _before(self, spark: SparkSession, first: str | None) -> DataFrame:
        """The runs open before a day, as pieces that the next ones may go on from."""
        days = [d for d in stored_days(spark, self._path("carry")) if first and d < first]
        return read_days(spark, self._path("carry"), self.schema, days[-1:])

    def take(self, rows: DataFrame, days: Days | None = None) -> None:
        """Take the readings of the given days (all without): their pieces, then the runs open after every
        day from the first of them on. Reads no other readings."""
        spark = rows.sparkSession
        pieces = day_pieces(rows, self.key, self.order, self.names)
        listed = F.col("head") | F.col("tail") | self.keep()
        write_partitioned(pieces.where(listed), self._path("pieces"), "day", dynamic=days is not None)
        first = days[0] if days else None
        later = [d for d in stored_days(spark, self._path("pieces")) if not first or d >= first]
        if not later:
            return
        (self._linked(spark, first, later).withColumn("since", F.lit(first or ALL)).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("since").parquet(self._path("chains")))
        open_ = standing(self._links(spark, days).where("tail").drop("last"), "until", later).withColumns(
            {"run": F.lit(0), "head": F.lit(False)}).select(*self.schema.fieldNames())
        write_partitioned(open_, self._path("carry"), "day", dynamic=days is not None)

    def _linked(self, spark: SparkSession, first: str | None, later: Sequence[str]) -> DataFrame:
        """What the edges of the days from the first asked one on and the carried runs make: each run up to the last reading
        of every day (``tail``; it stands until the key's next day, ``until``), and the whole ones worth listing (``last``)."""
        chain = chained(self._edges(spark, later).unionByName(self._before(spark, first)), self.key, self.names)
        w = Window.partitionBy(self.key).orderBy("chain", "day", "run")  # the order by day, as the chains are numbered in it
        rows = chain.select(self.key, *self.names, F.col("run_start").alias("start"), "end", F.col("n_so_far").alias("n_readings"),
                            "tail", "day", F.lead("day").over(w).alias("until"),
                            F.coalesce(F.lead("chain").over(w) != F.col("chain"), F.lit(True)).alias("last"))
        rows = rows.withColumn("last", F.col("last") & F.coalesce(self.keep(), F.lit(False)))
        return rows.where("tail or last")

    def _links(self, spark: SparkSession, days: Days | None) -> DataFrame:
        """:meth:`_linked` as kept by the last :meth:`take`, made anew if that took other days."""
        first = days[0] if days else None
        later = [d for d in stored_days(spark, self._path("pieces")) if not first or d >= first]
        path, since = self._path("chains"), first or ALL
        if not later or stored_days(spark, path, "since") != [since]:
            return self._linked(spark, first, later)
        schema = StructType([*(f for f in self.schema if f.name not in ("run", "head")), StructField("until", DateType()),
                             StructField("last", BooleanType())])
        return spark.read.schema(schema).parquet(os.path.join(path, f"since={since}"))

    def _edges(self, spark: SparkSession, days: Sequence[str]) -> DataFrame:
        return read_days(spark, self._path("pieces"), self.schema, days).where("head or tail")

    def _chains(self, spark: SparkSession, days: Days | None) -> DataFrame:
        """The listed runs that the edges of the days from the first asked one on and the carried runs make."""
        return self._links(spark, days).where("last").select(self.key, *self.names, "start", "end", "n_readings")

    def runs(self, spark: SparkSession, days: Days | None = None) -> DataFrame:
        """The listed runs that begin on the given days: ``key, *values, start, end, n_readings``."""
        asked = [d for d in stored_days(spark, self._path("pieces")) if not days or days[0] <= d <= days[1]]
        inner = read_days(spark, self._path("pieces"), self.schema, asked).where("not head and not tail")
        chains = self._chains(spark, days)
        if days:
            chains = chains.where(F.to_date("start").between(*[F.lit(d).cast("date") for d in days]))
        return inner.select(*chains.columns).unionByName(chains).where(self.keep())

    def earlier(self, spark: SparkSession, days: Days) -> tuple[DataFrame, DataFrame]:
        """The runs open before the given days whose keys have readings since: all of them (key, start), and how
        those that are listed stand now."""
        later = [d for d in stored_days(spark, self._path("pieces")) if d >= days[0]]
        since = self._edges(spark, later).select(self.key).distinct()
        began = self._before(spark, days[0]).select(self.key, "start").join(since, self.key, "left_semi")
        now = self._chains(spark, days).where((F.to_date("start") < F.lit(days[0]).cast("date")) & self.keep())
        return began, now.join(since, self.key, "left_semi")


@dataclass(frozen=True)
class DailyHours:
    """Each station's last hours (``station_id, hour, occupancy_pct``) as of every day, under ``base``."""

    base: str
    schema = "station_id int, hour timestamp_ntz, occupancy_pct double, day date"

    def _schema(self) -> StructType:
        return StructType.fromDDL(self.schema)

    def before(self, spark: SparkSession, days: Days | None) -> DataFrame:
        """The last hours of every station before the given days."""
        here = [d for d in stored_days(spark, self.base) if days and d < days[0]]
        return read_days(spark, self.base, self._schema(), here[-1:]).drop("day")

    def take(self, spark: SparkSession, features_path: str, days: Days | None = None) -> None:
        """Write the last hours after every day from the first asked one on, from the written features."""
        later = [d for d in stored_days(spark, features_path) if not days or d >= days[0]]
        if not later:
            return
        rows = read_days(spark, features_path, self._schema(), later).unionByName(
            self.before(spark, days).withColumn("day", F.to_date("hour")))
        write_partitioned(snapshots(rows, "station_id", ["hour"], MOVING_WINDOW, later), self.base, "day", dynamic=days is not None)

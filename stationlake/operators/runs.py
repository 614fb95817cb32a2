"""Runs of consecutive equal values per key (gaps and islands), split by day for hot keys.

``value_runs(df, key, order, values)`` returns one row per maximal run of consecutive
rows (per ``key``, in ``order``) whose ``values`` are all equal:
``key, *values, start, end, n_readings``.

A window partitioned by the key would put every row of a key in one task; one station
holding a third of all readings would make that task a third of the job. Instead:

1. windows run by (key, day): a hot key is cut by day, and each day is collapsed to its
   runs (one shuffle of the rows; the aggregation reuses its partitioning);
2. a day's first and last run may continue in the neighbouring day. Only these (at most
   two per key and day) are stitched, by a window over the key: a piece continues the
   one before if that one ended its day, this one starts the next day with rows, and both
   hold the same values. Runs inside a day are complete and pass by.

Everything is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _changed(values: Sequence[str], w) -> Column:
    """True where a row differs from the one before in the window (and on its first row)."""
    same = F.row_number().over(w) > 1
    for v in values:
        same = same & F.lag(v).over(w).eqNullSafe(F.col(v))
    return ~same


def _numbered(df: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """Rows with a key and an order, their day and the number of their run in that day."""
    rows = (df.where(F.col(key).isNotNull() & F.col(order).isNotNull()).withColumn("__day", F.to_date(order)))
    w = Window.partitionBy(key, "__day").orderBy(order, *values)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn("__new", _changed(values, w))
            .withColumn("__run", F.sum(F.col("__new").cast("int")).over(running)).drop("__new"))


def _pieces(numbered: DataFrame, key: str, order: str, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """A day's runs that are complete, and those that touch its first or last row, the latter with
    the group of pieces that make one run."""
    pieces = (numbered.groupBy(key, "__day", "__run")
              .agg(*[F.first(v).alias(v) for v in values], F.min(order).alias("start"),
                   F.max(order).alias("end"), F.count(F.lit(1)).alias("n_readings")))
    day = Window.partitionBy(key, "__day")
    pieces = (pieces.withColumn("__head", F.col("__run") == 1)
              .withColumn("__tail", F.col("__run") == F.max("__run").over(day)))
    edge = F.col("__head") | F.col("__tail")
    w = Window.partitionBy(key).orderBy("__day", "__run")
    follows = F.lag("__tail").over(w) & F.col("__head") & ~_changed(values, w)
    edges = (pieces.where(edge).withColumn("__new", ~F.coalesce(follows, F.lit(False)))
             .withColumn("__group", F.sum(F.col("__new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return pieces.where(~edge), edges


def value_runs(df: DataFrame, key: str, order: str, values: Sequence[str]) -> DataFrame:
    values = list(values)
    inner, edges = _pieces(_numbered(df.select(key, order, *values), key, order, values), key, order, values)
    out = [key, *values, "start", "end", "n_readings"]
    merged = (edges.groupBy(key, "__group")
              .agg(*[F.first(v).alias(v) for v in values], F.min("start").alias("start"),
                   F.max("end").alias("end"), F.sum("n_readings").alias("n_readings")))
    return inner.select(*out).unionByName(merged.select(*out))


def with_run_start(df: DataFrame, key: str, order: str, values: Sequence[str]) -> DataFrame:
    """The rows that have a key and an order, with ``run_start``: the time of their run's first row."""
    values = list(values)
    rows = _numbered(df, key, order, values)
    inner, edges = _pieces(rows, key, order, values)
    first = F.min("start").over(Window.partitionBy(key, "__group"))
    starts = (inner.select(key, "__day", "__run", F.col("start").alias("run_start"))
              .unionByName(edges.select(key, "__day", "__run", first.alias("run_start"))))
    return rows.join(starts, [key, "__day", "__run"]).drop("__day", "__run")


# ------------------------------------------------------------------ runs kept by day
PIECE = ("start", "end", "n_readings", "run", "head", "tail", "day")


def day_pieces(df: DataFrame, key: str, order: str, values: Sequence[str]) -> DataFrame:
    """The runs of every (key, day) by themselves: ``key, *values`` and :data:`PIECE`. ``head`` and ``tail`` mark
    those that hold the day's first and last row: only they can be parts of longer runs."""
    values = list(values)
    numbered = _numbered(df.select(key, order, *values), key, order, values)
    pieces = (numbered.groupBy(key, F.col("__day").alias("day"), F.col("__run").cast("int").alias("run"))
              .agg(*[F.first(v).alias(v) for v in values], F.min(order).alias("start"),
                   F.max(order).alias("end"), F.count(F.lit(1)).alias("n_readings")))
    return (pieces.withColumn("head", F.col("run") == 1)
            .withColumn("tail", F.col("run") == F.max("run").over(Window.partitionBy(key, "day"))).select(key, *values, *PIECE))


def chained(edges: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """First and last pieces of days (at most two a key and day), in order, with the number of their run (``chain``)
    and what the run holds up to each piece (``run_start``, ``n_so_far``)."""
    w = Window.partitionBy(key).orderBy("day", "run")
    follows = F.coalesce(F.lag("tail").over(w) & F.col("head") & ~_changed(list(values), w), F.lit(False))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    numbered = edges.withColumn("__new", (~follows).cast("int")).withColumn("chain", F.sum("__new").over(upto)).drop("__new")
    own = Window.partitionBy(key, "chain").orderBy("day", "run").rowsBetween(Window.unboundedPreceding, 0)
    return numbered.withColumn("run_start", F.min("start").over(own)).withColumn("n_so_far", F.sum("n_readings").over(own))

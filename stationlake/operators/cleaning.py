"""Rule framework: apply cleaning rules, report, keep the best row per key, build silver.

All operators take and return DataFrames; nothing is collected. The quality report is
a one-row DataFrame computed from the same lineage (lazy), and can alternatively be
captured in the same pass as the silver write with :class:`pyspark.sql.Observation`.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stationlake.functions.rules import Staged

ROW_CORRECTED = "row_corrected"
VALUE_INVALID = "value_invalid"
SCORE = "score"
DATE_PARTITION = "date_partition"


@dataclass(frozen=True)
class CleanRule:
    """Clean column ``col`` with ``fn(col, *args, **kwargs)``.

    ``args`` are column names (or Columns); they are resolved against the frame as it is
    when the rule runs, so a rule sees the cleaned output of the rules before it.
    """

    col: str
    fn: Callable[..., Column]
    args: Sequence[str | Column] = ()
    kwargs: dict = field(default_factory=dict)


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def apply_rules(df: DataFrame, rules: Sequence[CleanRule], *, score: bool = False,
                drop: Sequence[str] | None = None) -> DataFrame:
    """Apply ``rules`` in order; each cleaned value replaces its column in place.

    Adds ``row_corrected`` / ``value_invalid`` (OR of the rules' cell flags) and, with
    ``score``, the number of the input columns that are NULL (or empty text) after
    cleaning — lower is more complete.
    """
    original = list(df.columns)
    out = df.withColumns({ROW_CORRECTED: F.lit(False), VALUE_INVALID: F.lit(False)})
    for i, rule in enumerate(rules):
        tmp = f"__clean_{i}"
        cell = rule.fn(F.col(rule.col), *[_as_col(a) for a in rule.args], **rule.kwargs)
        out = cell.apply(out, tmp) if isinstance(cell, Staged) else out.withColumn(tmp, cell)
        updated = {
            rule.col: F.col(f"{tmp}.value"),
            ROW_CORRECTED: F.col(ROW_CORRECTED) | F.col(f"{tmp}.corrected"),
            VALUE_INVALID: F.col(VALUE_INVALID) | F.col(f"{tmp}.invalid"),
        }
        out = out.select(*[updated[c].alias(c) if c in updated else F.col(c)
                           for c in out.columns if c != tmp])
    if score:
        types = {f.name: f.dataType for f in out.schema.fields}
        terms = []
        for c in original:
            missing = F.col(c).isNull()
            if isinstance(types[c], StringType):
                missing = missing | (F.col(c) == F.lit(""))
            terms.append(F.when(missing, 1).otherwise(0))
        out = out.withColumn(SCORE, functools.reduce(operator.add, terms, F.lit(0)))
    if drop:
        out = out.drop(*drop)
    return out


def flag_report(df: DataFrame) -> DataFrame:
    """One-row report of a flagged frame: rows corrected / rows with an invalid cell."""
    return df.agg(F.count_if(F.col(ROW_CORRECTED)).alias("rows_corrected"),
                  F.count_if(F.col(VALUE_INVALID)).alias("rows_invalid"))


def strip_flags(df: DataFrame) -> DataFrame:
    return df.drop(ROW_CORRECTED, VALUE_INVALID)


def report_and_strip(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frame without flag columns, one-row flag report) — both lazy."""
    return strip_flags(df), flag_report(df)


def keep_best(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the smallest by ``order_by`` (ascending, NULLs first),
    ties broken by the remaining columns so the result is deterministic.

    Written as a grouped ``min(struct(...))`` rather than ``row_number()``: the minimum
    is combined map-side, so a key holding a large share of the rows is reduced before
    the shuffle instead of landing whole in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = list(order_by) + rest
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c)
                         for c in df.columns])


#: Columns that :func:`keep_best_counted` adds: the raw rows that a kept row stands for, and their flags.
ROW_COUNTS = ("n_raw", "n_corrected", "n_invalid")


def keep_best_counted(flagged: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """:func:`keep_best` over flagged rows, which also counts, in the same aggregation, the rows that each kept one
    stands for (:data:`ROW_COUNTS`)."""
    keys = list(keys)
    cols = [c for c in flagged.columns if c not in (ROW_CORRECTED, VALUE_INVALID)]
    ranked = list(order_by) + [c for c in cols if c not in keys and c not in order_by]
    best = flagged.groupBy(*keys).agg(
        F.min(F.struct(*ranked)).alias("__best"), F.count(F.lit(1)).cast("int").alias("n_raw"),
        F.count_if(F.col(ROW_CORRECTED)).cast("int").alias("n_corrected"), F.count_if(F.col(VALUE_INVALID)).cast("int").alias("n_invalid"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in cols], *ROW_COUNTS)


def counted_report(written: DataFrame) -> DataFrame:
    """The one-row report of a written table with :data:`ROW_COUNTS`: sums over its committed files, so a task or stage that
    ran twice counts once."""
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0))
    return written.agg(total("n_raw").alias("rows_raw"), total("n_corrected").alias("rows_corrected"),
                       total("n_invalid").alias("rows_invalid"), (total("n_raw") - F.count(F.lit(1))).alias("rows_removed"))


def all_null(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    cols = list(cols or df.columns)
    return functools.reduce(operator.and_, [F.col(c).isNull() for c in cols])


@dataclass
class SilverResult:
    """A silver table with its quality report.

    ``df``      the cleaned table (lazy);
    ``report``  one-row DataFrame ``rows_raw, rows_corrected, rows_invalid, rows_removed``
                (lazy; evaluates the cleaning once more if used separately);
    ``observations`` filled by the first action on ``df`` (e.g. the silver write), giving
                the same counters without a second pass — see :meth:`observed_report`. A stage
                that Spark runs again after losing its shuffle output can add its rows a second
                time: where the counters must be exact even then, evaluate ``report``.
    """

    df: DataFrame
    report: DataFrame
    observations: tuple[Observation, Observation] | None = None

    def observed_report(self) -> dict[str, int]:
        if self.observations is None:
            raise ValueError("built without observe=True")
        pre, post = (o.get for o in self.observations)
        return {
            "rows_raw": int(pre["rows_raw"]),
            "rows_corrected": int(pre["rows_corrected"]),
            "rows_invalid": int(pre["rows_invalid"]),
            "rows_removed": int(pre["rows_raw"]) - int(post["rows_final"]),
        }


def to_silver(df: DataFrame, rules: Sequence[CleanRule], *, score: bool = False,
              dedup_keys: Sequence[str] | None = None, partition_col: str | None = None,
              drop_cols: Sequence[str] | None = None, observe: bool = False,
              days: tuple[str, str] | None = None, counted: bool = False) -> SilverResult:
    """Raw → silver: clean, add ``date_partition``, report, dedup, drop empty rows.

    ``days`` (first and last, inclusive) keeps only rows of those days, before the counters. ``counted`` (of a table
    with dedup) leaves :data:`ROW_COUNTS` in the rows, for :func:`counted_report` over the written table.

    Dedup (keep the lowest ``score`` per ``dedup_keys``) runs only when ``score`` is on,
    rows NULL in every column are removed, then ``drop_cols`` are dropped.
    """
    flagged = apply_rules(df, rules, score=score)
    if partition_col:
        flagged = flagged.withColumn(
            DATE_PARTITION, F.substring(F.col(partition_col), 1, 10).try_cast("date"))
        if days:
            flagged = flagged.where(F.col(DATE_PARTITION).between(*[F.lit(d).cast("date") for d in days]))
    obs_pre = obs_post = None
    staged = flagged
    if observe:
        obs_pre = Observation("silver_pre")
        staged = flagged.observe(obs_pre, F.count(F.lit(1)).alias("rows_raw"),
                                 F.count_if(F.col(ROW_CORRECTED)).alias("rows_corrected"),
                                 F.count_if(F.col(VALUE_INVALID)).alias("rows_invalid"))
    clean = strip_flags(staged)
    dedup = bool(dedup_keys) and score
    if dedup and counted:
        clean = keep_best_counted(staged, dedup_keys, [SCORE])
    elif dedup:
        clean = keep_best(clean, dedup_keys, [SCORE])
    if not score:
        # with a score column (never NULL) no row can be NULL everywhere: nothing to drop
        clean = clean.dropna(how="all")
    if observe:
        obs_post = Observation("silver_post")
        clean = clean.observe(obs_post, F.count(F.lit(1)).alias("rows_final"))
    if drop_cols:
        clean = clean.drop(*drop_cols)

    # Lazy report from the same lineage, as aggregations only (no collect, no join).
    kept_cols = [c for c in flagged.columns if c not in (ROW_CORRECTED, VALUE_INVALID)]
    if dedup:
        per_key = flagged.groupBy(*dedup_keys).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(ROW_CORRECTED)).alias("c"),
            F.count_if(F.col(VALUE_INVALID)).alias("i"))
        report = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_raw"),
            F.coalesce(F.sum("c"), F.lit(0)).alias("rows_corrected"),
            F.coalesce(F.sum("i"), F.lit(0)).alias("rows_invalid"),
            (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("rows_removed"))
    else:
        report = flagged.agg(
            F.count(F.lit(1)).alias("rows_raw"),
            F.count_if(F.col(ROW_CORRECTED)).alias("rows_corrected"),
            F.count_if(F.col(VALUE_INVALID)).alias("rows_invalid"),
            F.count_if(all_null(flagged, kept_cols)).alias("rows_removed"))
    observations = (obs_pre, obs_post) if observe else None
    return SilverResult(clean, report, observations)

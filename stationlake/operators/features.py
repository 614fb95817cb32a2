"""Features, baselines and their errors (B5, B6, B7) and batch scoring.

The unit is a station-hour: readings are first reduced to one row per station and hour,
so the per-station windows below see at most one row per hour of the covered period,
however many readings a (hot) station produces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions.numeric import pct, round2
from stationlake.operators.facts import reading_time

MOVING_WINDOW = 3
FEATURE_COLUMNS = ("hour_of_day", "is_weekend", "temperature_c", "rain_mm", "lag_1", "moving_avg_3")


def _round6(c):
    return F.round(c.try_cast("decimal(38,10)"), 6).cast("double")


def hourly_features(joined: DataFrame, weather: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """One row per station and hour with the mean occupancy, calendar features, the
    weather of that hour and lagged occupancy (previous observed hour, moving average
    of the previous three observed hours).

    ``before`` (station_id, hour, occupancy_pct): each station's last hours ahead of the readings given,
    where those are only some days' (see :mod:`stationlake.plans.daily_state`); they only feed the lags."""
    t = reading_time(F.col("timestamp"))
    hourly = (joined.select(
        "station_id",
        F.date_trunc("hour", t).cast("timestamp_ntz").alias("hour"),
        pct(F.col("bikes_available"), F.col("bikes_available") + F.col("slots_free")).alias("occ"))
        .where(F.col("hour").isNotNull())
        .groupBy("station_id", "hour")
        .agg(round2(F.avg("occ")).alias("occupancy_pct"), F.count(F.lit(1)).alias("n_readings")))
    wx = weather.select(reading_time(F.col("timestamp")).alias("__wh"), "temperature_c",
                        "rain_mm", "weather_condition").where(F.col("__wh").isNotNull())
    # one weather row per hour (the first by condition, then temperature) — the table
    # holds one reading per hour; this keeps the join one-to-one if it does not
    wx = wx.groupBy("__wh").agg(F.min(F.struct("weather_condition", "temperature_c", "rain_mm"))
                                .alias("__w")).select(
        "__wh", "__w.weather_condition", "__w.temperature_c", "__w.rain_mm")
    w = Window.partitionBy("station_id").orderBy("hour")
    prev = w.rowsBetween(-MOVING_WINDOW, -1)
    if before is not None:
        hourly = hourly.unionByName(before.withColumn("n_readings", F.lit(None).cast("bigint")))
    # lags first: only what they need goes through the stations' shuffle
    rows = hourly.select("station_id", "hour", "occupancy_pct", "n_readings",
                         F.lag("occupancy_pct").over(w).alias("lag_1"),
                         _round6(F.avg("occupancy_pct").over(prev)).alias("moving_avg_3"))
    if before is not None:
        rows = rows.where("n_readings is not null")
    return (rows.join(wx, rows["hour"] == wx["__wh"], "left")
            .select("station_id", "hour",
                    F.hour("hour").alias("hour_of_day"),
                    (F.weekday("hour") + 1).alias("day_of_week_num"),
                    (F.weekday("hour") >= 5).alias("is_weekend"),
                    "temperature_c", "rain_mm", "weather_condition",
                    "occupancy_pct", "n_readings", "lag_1", "moving_avg_3"))


def baseline_errors(features: DataFrame) -> DataFrame:
    """B6 + B7: MAE and RMSE of the persistence (previous hour) and moving-average
    baselines, over the rows where the baseline exists."""
    long = features.select(
        F.explode(F.array(
            F.struct(F.lit("persistence").alias("baseline"), F.col("lag_1").alias("pred"),
                     F.col("occupancy_pct").alias("actual")),
            F.struct(F.lit("moving_average_3").alias("baseline"), F.col("moving_avg_3").alias("pred"),
                     F.col("occupancy_pct").alias("actual")))).alias("r"))
    err = F.col("r.pred") - F.col("r.actual")
    return (long.where(F.col("r.pred").isNotNull() & F.col("r.actual").isNotNull())
            .groupBy(F.col("r.baseline").alias("baseline"))
            .agg(F.count(F.lit(1)).alias("n"),
                 _round6(F.avg(F.abs(err))).alias("mae"),
                 _round6(F.sqrt(F.avg(err * err))).alias("rmse")))


class NoTrainingRows(ValueError):
    """There is no complete feature row before the held-out days."""


def train_and_score(features: DataFrame, label: str = "occupancy_pct", holdout_days: int = 1):
    """Next-day batch scoring. A linear regression (normal-equation solver: one
    distributed aggregation pass) is fitted on every station-hour before the last
    ``holdout_days`` days of the data and scores those days. ``features`` is read three times
    (last day, fit, score): pass a written table, not a long plan. Returns
    ``(model, predictions)``; ``predictions`` holds the scored (held-out) hours with
    their baselines, for :func:`model_errors`."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    usable = features.select(
        "station_id", "hour", label, F.to_date("hour").alias("day"),
        *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS]).dropna()
    # the split day: one scalar from a global max (combined map-side)
    last = usable.agg(F.max("day")).first()[0]
    cutoff = F.date_sub(F.lit(last), holdout_days - 1)
    if last is None or not usable.where(F.col("day") < cutoff).limit(1).count():
        raise NoTrainingRows("no complete feature rows to train on")
    assembler = VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features")
    train = assembler.transform(usable.where(F.col("day") < cutoff))
    test = assembler.transform(usable.where(F.col("day") >= cutoff))
    model = LinearRegression(featuresCol="features", labelCol=label, solver="normal",
                             regParam=0.0).fit(train)
    scored = model.transform(test).select(
        "station_id", "hour", label, "lag_1", "moving_avg_3",
        F.col("prediction").alias("predicted_occupancy_pct"))
    return model, scored


# ------------------------------------------------------------------ mergeable normal equations
MOMENT_TERMS = (*FEATURE_COLUMNS, "occupancy_pct")


def _usable(features: DataFrame) -> DataFrame:
    """The complete rows, every term as a double."""
    return features.select("station_id", "hour", F.to_date("hour").alias("day"),
                           *[F.col(c).cast("double").alias(c) for c in MOMENT_TERMS]).dropna()


def day_moments(features: DataFrame) -> DataFrame:
    """What the normal equations need of every day: number, sums and products of the features and the label
    (``n``, ``s_i``, ``p_i_j``). Days add up: a new day is one new row, and no old day is read again."""
    k = len(MOMENT_TERMS)
    x = [F.col(c) for c in MOMENT_TERMS]
    return _usable(features).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s_{i}") for i in range(k)],
        *[F.sum(x[i] * x[j]).alias(f"p_{i}_{j}") for i in range(k) for j in range(i, k)])


def solve_moments(moments: DataFrame) -> tuple[float, list[float]]:
    """Intercept and coefficients of the least-squares fit over the given days: the sums of all days are one row of
    36 numbers, solved on the driver. Features that are sums of others get the smallest weights."""
    import numpy as np

    k = len(MOMENT_TERMS)
    r = moments.agg(*[F.sum(c).alias(c) for c in moments.columns if c != "day"]).first()
    if not r["n"]:
        raise NoTrainingRows("no complete feature rows to train on")
    mean = np.array([r[f"s_{i}"] for i in range(k)]) / r["n"]
    prod = np.array([[r[f"p_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / r["n"] - np.outer(mean, mean)
    weights = np.linalg.lstsq(prod[:-1, :-1], prod[:-1, -1], rcond=1e-12)[0]
    return float(mean[-1] - mean[:-1] @ weights), weights.tolist()


def score_last_days(features: DataFrame, moments: DataFrame, holdout_days: int = 1) -> DataFrame:
    """B8 from the days' moments: fitted on the days before the last ``holdout_days``, scoring those days, as
    :func:`train_and_score` does with a pass over all features."""
    last = moments.agg(F.max("day")).first()[0]
    cutoff = F.date_sub(F.lit(last), holdout_days - 1)
    if last is None:
        raise NoTrainingRows("no complete feature rows to train on")
    base, weights = solve_moments(moments.where(F.col("day") < cutoff))
    fitted = sum((F.col(c) * F.lit(w) for c, w in zip(FEATURE_COLUMNS, weights, strict=True)), F.lit(base))
    return (_usable(features).where(F.col("day") >= cutoff)
            .select("station_id", "hour", "occupancy_pct", "lag_1", "moving_avg_3", fitted.alias("predicted_occupancy_pct")))


def model_errors(scored: DataFrame, label: str = "occupancy_pct") -> DataFrame:
    """B7 on the held-out day: MAE / RMSE of the regression next to the persistence and
    moving-average baselines, on the same rows."""
    long = scored.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(col).alias("pred"), F.col(label).alias("actual"))
        for name, col in (("linear_regression", "predicted_occupancy_pct"),
                          ("persistence", "lag_1"), ("moving_average_3", "moving_avg_3"))])).alias("r"))
    err = F.col("r.pred") - F.col("r.actual")
    return (long.groupBy(F.col("r.model").alias("model"))
            .agg(F.count(F.lit(1)).alias("n"), _round6(F.avg(F.abs(err))).alias("mae"),
                 _round6(F.sqrt(F.avg(err * err))).alias("rmse")))

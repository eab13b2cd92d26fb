"""Monthly series: features, holdout, baselines, accuracy and recursion.

Every function takes ``keys``, the columns that name a series; none means one series
for the company. A frame holds one row per series and month (``period``, ``y``), so a
window over a series is as long as its months, never as long as the ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dbl, safe_div

LAGS = (1, 2, 3, 12)
WINDOWS = (3, 6)
NAIVE = "Naive (last value)"
MOVING_AVERAGE = "Moving Average (3mo)"
TREND = "Linear Trend (time-only)"
BASELINES = (NAIVE, MOVING_AVERAGE, TREND)


def feature_names(lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS) -> list[str]:
    return [
        "t", "month", "quarter",
        *[f"lag_{k}" for k in lags],
        *[f"rolling_mean_{k}" for k in windows],
    ]


FEATURES = feature_names()


def monthly_series(fact: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of ``value`` per series and month, as ``y``."""
    return fact.groupBy(*keys, "period").agg(dbl(F.sum(value)).alias("y"))


def indexed(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add the position ``t`` of each month in its series, from 0."""
    order = Window.partitionBy(*keys).orderBy("period")
    return series.withColumn("t", F.row_number().over(order) - 1)


def forecast_features(
    series: DataFrame,
    keys: Sequence[str] = (),
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    complete: bool = True,
) -> DataFrame:
    """Time index, calendar parts, lags and means of the months before.

    A mean is NULL until its window is full. ``complete`` drops rows with a gap.
    """
    order = Window.partitionBy(*keys).orderBy("period")
    cols: dict[str, Column] = {
        "t": F.row_number().over(order) - 1,
        "month": F.month("period"),
        "quarter": F.quarter("period"),
    }
    for k in lags:
        cols[f"lag_{k}"] = F.lag("y", k).over(order)
    for k in windows:
        before = order.rowsBetween(-k, -1)
        full = F.count("y").over(before) == k
        cols[f"rolling_mean_{k}"] = F.when(full, F.avg("y").over(before))
    out = series.withColumns(cols)
    return out.dropna(subset=["y", *feature_names(lags, windows)]) if complete else out


def holdout_split(features: DataFrame, n: int = 6, keys: Sequence[str] = ()) -> DataFrame:
    """Mark the last ``n`` rows of each series as ``test`` and number the train rows back.

    ``train_age`` is 1 for the last training row, NULL in the test rows.
    """
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("period")))
    return features.withColumn("age", back).select(
        *features.columns,
        F.when(F.col("age") <= n, "test").otherwise("train").alias("split"),
        F.when(F.col("age") > n, F.col("age") - n).alias("train_age"),
    )


def baseline_predictions(
    split: DataFrame, keys: Sequence[str] = (), k: int = 3, models: Sequence[str] = BASELINES
) -> DataFrame:
    """Holdout predictions of the three baselines in long form.

    Naive carries the last training value forward, the moving average the mean of the
    last ``k``, the trend a straight line over time. All three are window aggregates
    over the series, so one sort serves them and no train/test join is needed.
    """
    whole = Window.partitionBy(*keys)
    train = F.col("split") == "train"
    y, t = F.when(train, F.col("y")), F.when(train, dbl("t"))
    recent = F.when(F.col("train_age") <= k, F.col("y"))
    last = F.when(F.col("train_age") == 1, F.col("y"))
    slope, level = F.regr_slope(y, t).over(whole), F.regr_intercept(y, t).over(whole)
    predictions = {
        NAIVE: F.max(last).over(whole),
        MOVING_AVERAGE: F.avg(recent).over(whole),
        TREND: level + slope * F.col("t"),
    }
    wide = split.select(
        *keys, "period", "split", F.col("y").alias("actual"),
        *[predictions[m].alias(m) for m in models],
    ).filter(F.col("split") == "test")
    return to_long(wide, keys, models)


def to_long(wide: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """One row per series, month and model from one column per model."""
    cell = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.col(f"`{m}`").alias("prediction"))
                for m in models
            ]
        )
    )
    return wide.select(*keys, "period", "actual", cell.alias("c")).select(
        *keys, "period", "actual", "c.model", "c.prediction"
    )


def accuracy(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MAPE, RMSE and MAE per model (and series); a zero actual is left out of the MAPE."""
    error = F.col("prediction") - F.col("actual")
    return predictions.groupBy(*keys, "model").agg(
        F.avg(F.abs(safe_div(error, "actual"))).alias("MAPE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.avg(F.abs(error)).alias("MAE"),
    )


def leaderboard(accuracies: DataFrame) -> DataFrame:
    """Models from the lowest MAPE up, equal ones by name."""
    return accuracies.orderBy("MAPE", "model")


def best_model(accuracies: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The model with the lowest MAPE (per series), the first by name among equals."""
    rank = F.struct("MAPE", "model")
    return accuracies.groupBy(*keys).agg(F.min_by("model", rank).alias("model"))


def holdout_wide(
    predictions: DataFrame, models: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Actual and one column per model, by month."""
    return (
        predictions.groupBy(*keys, "period", "actual")
        .pivot("model", list(models))
        .agg(F.first("prediction"))
    )


# ---------------------------------------------------------------- projection

def history(series: DataFrame, keys: Sequence[str] = (), depth: int = 12) -> DataFrame:
    """One row per series: the last ``depth`` values, the last month and its index."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("period")))
    kept = indexed(series, keys).withColumn("age", back).filter(F.col("age") <= depth)
    return (
        kept.groupBy(*keys)
        .agg(
            F.max("t").alias("last_t"),
            F.max("period").alias("last_period"),
            F.sort_array(F.collect_list(F.struct("t", "y"))).alias("h"),
        )
        .select(*keys, "last_t", "last_period", F.transform("h", lambda r: r["y"]).alias("recent"))
    )


def _tail_mean(values: Column, k: int) -> Column:
    """Mean of the last ``k`` values, or of all of them where there are fewer."""
    n = F.least(F.size(values), F.lit(k))
    tail = F.slice(values, F.size(values) - n + 1, n)
    return F.aggregate(tail, F.lit(0.0), lambda a, v: a + v) / n


def next_features(
    recent: Column, t: Column, period: Column,
    lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS,
) -> list[Column]:
    """Feature values of the month after ``recent``, in ``feature_names`` order.

    A lag deeper than the history takes its oldest value.
    """
    return [
        dbl(t),
        dbl(F.month(period)),
        dbl(F.quarter(period)),
        *[F.element_at(recent, -F.least(F.lit(k), F.size(recent))) for k in lags],
        *[_tail_mean(recent, k) for k in windows],
    ]


def forecast_recursive(
    hist: DataFrame,
    intercept: Column | str,
    coefficients: Column | str,
    horizon: int,
    keys: Sequence[str] = (),
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """Months ahead of a linear model, each prediction feeding the next month's lags.

    ``hist`` comes from :func:`history`, with the model's intercept and coefficient array
    (in ``feature_names`` order) attached. The recursion folds over the horizon inside
    one expression; series run in parallel.
    """
    depth = max(*lags, *windows)
    rows = hist.select(
        *keys, "last_t", "last_period", "recent",
        dbl(intercept).alias("b0"),
        (F.col(coefficients) if isinstance(coefficients, str) else coefficients).alias("b"),
    )

    def step(acc: Column, i: Column) -> Column:
        x = F.array(*next_features(acc["recent"], F.col("last_t") + i,
                                   F.add_months("last_period", i), lags, windows))
        products = F.zip_with(x, F.col("b"), lambda u, v: u * v)
        y = F.col("b0") + F.aggregate(products, F.lit(0.0), lambda a, v: a + v)
        kept = F.slice(
            acc["recent"],
            F.greatest(F.size(acc["recent"]) - depth + 2, F.lit(1)),
            F.lit(depth - 1),
        )
        # the new value is read twice, so it is bound once through a one-element array
        return F.element_at(
            F.transform(
                F.array(y),
                lambda v: F.struct(
                    F.concat(kept, F.array(v)).alias("recent"),
                    F.concat(acc["out"], F.array(v)).alias("out"),
                ),
            ),
            1,
        )

    start = F.struct(
        F.col("recent").alias("recent"), F.expr("CAST(array() AS array<double>)").alias("out")
    )
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step, lambda a: a["out"])
    return rows.select(*keys, "last_period", F.posexplode(path).alias("i", "forecast")).select(
        *keys,
        F.add_months("last_period", F.col("i") + 1).alias("period"),
        "forecast",
    )


def forecast_baselines(
    series: DataFrame, horizon: int, keys: Sequence[str] = (), k: int = 3
) -> DataFrame:
    """Months ahead of the three baselines refitted on the whole series, in long form."""
    rows = indexed(series, keys)
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("period")))
    aged = rows.withColumn("age", back)
    fitted = aged.groupBy(*keys).agg(
        F.max("t").alias("last_t"),
        F.max("period").alias("last_period"),
        F.max(F.when(F.col("age") == 1, F.col("y"))).alias("last"),
        F.avg(F.when(F.col("age") <= k, F.col("y"))).alias("mean"),
        F.regr_slope(F.col("y"), dbl("t")).alias("slope"),
        F.regr_intercept(F.col("y"), dbl("t")).alias("level"),
    )
    ahead = fitted.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("i"))
    wide = ahead.select(
        *keys,
        F.add_months("last_period", F.col("i")).alias("period"),
        F.lit(None).cast("double").alias("actual"),
        F.col("last").alias(NAIVE),
        F.col("mean").alias(MOVING_AVERAGE),
        (F.col("level") + F.col("slope") * (F.col("last_t") + F.col("i"))).alias(TREND),
    )
    return to_long(wide, keys, BASELINES).select(
        *keys, "period", "model", F.col("prediction").alias("forecast")
    )


def pick_best(forecasts: DataFrame, best: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Keep each series' forecast of its best model."""
    same = F.col("f.model") == F.col("b.model")
    for k in keys:
        same = same & F.col(f"f.{k}").eqNullSafe(F.col(f"b.{k}"))
    return forecasts.alias("f").join(best.alias("b"), same, "left_semi")

"""Regression models over the monthly features: linear, random forest, boosted trees."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, IntegerType, StructField, StructType

from ..functions.numeric import dbl
from . import trees
from .forecast import (
    BASELINES,
    FEATURES,
    LAGS,
    WINDOWS,
    baseline_predictions,
    forecast_baselines,
    forecast_recursive,
    history,
)

LINEAR = "Linear Regression"
POOLED = "Pooled Linear Regression"
FOREST = "Random Forest"
BOOSTING = "Gradient Boosting"
MODELS = (LINEAR, FOREST, BOOSTING)
TREES = {FOREST: 300, BOOSTING: 250}
# tasks that share the trees of one series
FOREST_DEALS = 10
# share of a column's variance below which the columns before it explain it
REDUNDANT = 1e-9


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[StructField]:
    return [df.schema[k] for k in keys]


def _least_squares(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and coefficients (least norm in standard units when undetermined).

    Columns are brought to mean 0 and deviation 1, so that which of them are redundant
    does not depend on whether they count months or money.
    """
    mx, my = x.mean(axis=0), y.mean()
    spread = x.std(axis=0)
    spread[spread == 0] = 1.0
    b = np.linalg.lstsq((x - mx) / spread, y - my, rcond=1e-10)[0] / spread
    return float(my - mx @ b), b


def linear_coefficients(
    features: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = tuple(FEATURES)
) -> DataFrame:
    """Least-squares fit per series: intercept and coefficient array, one row each.

    A group is the months of one series, so the small solve runs inside a task while
    Spark spreads the series.
    """
    names, cols = list(keys), list(columns)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        b0, b = _least_squares(pdf[cols].to_numpy(float), pdf["y"].to_numpy(float))
        head = {k: [pdf[k].iloc[0]] for k in names}
        return pd.DataFrame({**head, "intercept": [b0], "coefficients": [b.tolist()]})

    schema = StructType(
        [
            *_key_fields(features, keys),
            StructField("intercept", DoubleType()),
            StructField("coefficients", ArrayType(DoubleType())),
        ]
    )
    # sorted by month inside the group, so that a refit sums in the same order
    ordered = features.select(*names, "period", *cols, "y")
    return ordered.groupBy(*names).applyInPandas(
        lambda pdf: fit(pdf.sort_values("period")), schema
    )


def _eliminate(system: Column, n: int) -> Column:
    """Solution of n equations (rows of n coefficients and a right side) by pivots in order.

    A pivot of nothing is a column that those before it explain; it gets 0.
    """
    def step(m: Column, k: Column) -> Column:
        top, pivot = F.get(m, k), F.get(F.get(m, k), k)
        cleared = F.transform(m, lambda row, i: F.when(i == k, F.transform(row, lambda v: v / pivot)).otherwise(
            F.zip_with(row, top, lambda a, b: a - F.get(row, k) * (b / pivot))
        ))
        return F.when(pivot > REDUNDANT, cleared).otherwise(m)

    solved = F.aggregate(F.array(*map(F.lit, range(n))), system, step)
    return F.transform(solved, lambda row, i: F.when(F.get(row, i) > 0.5, F.get(row, F.lit(n))).otherwise(0.0))


def pooled_coefficients(
    features: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = tuple(FEATURES)
) -> DataFrame:
    """``linear_coefficients`` without Python, for groups of any size, all rows included.

    Means and deviations are summed first, then the products of the columns in standard
    units (a row of sums per group, combined before the shuffle), and the equations are
    solved in the row. Redundant columns get 0 instead of the least norm, so coefficients
    may differ there; predictions don't.
    """
    names = [*columns, "y"]
    n = len(columns)
    units = features.groupBy(*keys).agg(
        *[F.avg(dbl(c)).alias(f"_m{i}") for i, c in enumerate(names)],
        *[F.stddev_pop(dbl(c)).alias(f"_s{i}") for i, c in enumerate(names)],
    )
    spread = {f"_s{i}": F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).otherwise(1.0) for i in range(n + 1)}
    units = units.withColumns(spread)
    scaled = attach(features.select(*keys, *names), units, keys)
    z = [(dbl(c) - F.col(f"_m{i}")) / F.col(f"_s{i}") for i, c in enumerate(names)]
    products = scaled.groupBy(*keys, *[f"_m{i}" for i in range(n + 1)], *[f"_s{i}" for i in range(n + 1)]).agg(
        *[F.avg(z[i] * z[j]).alias(f"_g{i}_{j}") for i in range(n) for j in range(i, n + 1)]
    )
    rows = [[F.col(f"_g{min(i, j)}_{max(i, j)}") for j in range(n)] + [F.col(f"_g{i}_{n}")] for i in range(n)]
    system = F.array(*[F.array(*row) for row in rows])
    slopes = F.zip_with(
        _eliminate(system, n), F.array(*[F.col(f"_s{n}") / F.col(f"_s{i}") for i in range(n)]), lambda b, u: b * u
    )
    means = F.array(*[F.col(f"_m{i}") for i in range(n)])
    shift = F.aggregate(F.zip_with("coefficients", means, lambda b, m: b * m), F.lit(0.0), lambda a, v: a + v)
    return products.withColumn("coefficients", slopes).select(
        *keys, (F.col(f"_m{n}") - shift).alias("intercept"), "coefficients"
    )


def linear_predictions(
    split: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = tuple(FEATURES), pooled: bool = False
) -> DataFrame:
    """Holdout predictions of a linear model fitted on the train rows of each series.

    ``pooled`` fits one model on the train rows of all series.
    """
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    if pooled:
        fitted = attach(test, pooled_coefficients(train, columns=columns), ())
    else:
        fitted = attach(test, linear_coefficients(train, keys, columns), keys)
    x = F.array(*[dbl(c) for c in columns])
    products = F.zip_with(x, F.col("coefficients"), lambda u, v: u * v)
    predicted = F.col("intercept") + F.aggregate(products, F.lit(0.0), lambda a, v: a + v)
    return fitted.select(
        *keys,
        "period",
        F.col("y").alias("actual"),
        F.lit(POOLED if pooled else LINEAR).alias("model"),
        predicted.alias("prediction"),
    )


def attach(rows: DataFrame, per_series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring one row per series to the rows of that series.

    A NULL in a key is a series of its own. Without keys both sides are the one company
    series, matched on a constant.
    """
    if not keys:
        one = F.lit(1).alias("_one")
        return rows.select("*", one).join(per_series.select("*", one), "_one").drop("_one")
    own = {k: f"_own_{k}" for k in keys}
    same = F.lit(True)
    for k, name in own.items():
        same = same & F.col(k).eqNullSafe(F.col(name))
    return rows.join(per_series.withColumnsRenamed(own), same).drop(*own.values())


def _fit(model_name: str, x: np.ndarray, y: np.ndarray, count: int) -> Callable[[np.ndarray], np.ndarray]:
    """Fit the months of one series; gives a prediction for rows of features."""
    if model_name == FOREST:
        return trees.fit_forest(x, y, count).predict
    return trees.fit_boosting(x, y, count).predict


def tree_predictions(
    model_name: str, split: DataFrame, keys: Sequence[str] = (), count: int | None = None
) -> DataFrame:
    """Holdout predictions of ``count`` trees fitted on the train rows of each series.

    A series meets in one task, or in ``FOREST_DEALS`` for a forest, whose trees are dealt
    over them. Series without train rows have no predictions.
    """
    names, total = list(keys), TREES[model_name] if count is None else count
    deals = min(FOREST_DEALS, total) if model_name == FOREST else 1

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        known, asked = pdf[pdf["split"] == "train"], pdf[pdf["split"] == "test"]
        x, y = known[FEATURES].to_numpy(float), known["y"].to_numpy(float)
        deal = int(pdf["deal"].iloc[0])
        if not len(y) or not len(asked):
            part = np.empty(0)
            asked = asked.iloc[:0]
        elif model_name == FOREST:
            first, last = (total * k // deals for k in (deal, deal + 1))
            part = trees.fit_forest(x, y, last - first, first, total).predict(asked[FEATURES].to_numpy(float))
        else:
            part = _fit(model_name, x, y, total)(asked[FEATURES].to_numpy(float))
        return asked[[*names, "period", "deal"]].assign(actual=asked["y"], part=part)

    schema = StructType(
        [
            *_key_fields(split, keys),
            split.schema["period"],
            StructField("deal", IntegerType()),
            StructField("actual", DoubleType()),
            StructField("part", DoubleType()),
        ]
    )
    rows = split.select(*names, "period", *FEATURES, "y", "split", F.explode(F.array(*map(F.lit, range(deals)))).alias("deal"))
    parts = rows.groupBy(*names, "deal").applyInPandas(run, schema)
    # added in the order of the deals, so that the sum is the same on any partitioning
    in_order = F.array_sort(F.collect_list(F.struct("deal", "part")))
    return (
        parts.groupBy(*names, "period", "actual").agg(in_order.alias("parts"))
        .select(
            *names,
            "period",
            "actual",
            F.lit(model_name).alias("model"),
            F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["part"]).alias("prediction"),
        )
    )


def fit_predict(
    model_name: str, split: DataFrame, keys: Sequence[str] = (), count: int | None = None
) -> DataFrame:
    """Long-form holdout predictions of any model by its name."""
    if model_name in BASELINES:
        return baseline_predictions(split, keys, models=[model_name])
    if model_name == LINEAR:
        return linear_predictions(split, keys)
    return tree_predictions(model_name, split, keys, count)


def forecast_linear_recursive(
    series: DataFrame, features: DataFrame, horizon: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Months ahead of a linear model refitted on every complete row."""
    hist = attach(history(series, keys), linear_coefficients(features, keys), keys)
    return forecast_recursive(hist, "intercept", "coefficients", horizon, keys)


def refit_forecast(
    model_name: str,
    series: DataFrame,
    features: DataFrame,
    horizon: int,
    keys: Sequence[str] = (),
    count: int | None = None,
) -> DataFrame:
    """Months ahead of any model by its name, refitted on every complete row."""
    if model_name in BASELINES:
        ahead = forecast_baselines(series, horizon, keys)
        return ahead.filter(F.col("model") == model_name)
    if model_name == LINEAR:
        ahead = forecast_linear_recursive(series, features, horizon, keys)
    else:
        ahead = forecast_tree_recursive(model_name, series, features, horizon, keys, count)
    return ahead.select(*keys, "period", F.lit(model_name).alias("model"), "forecast")


def _next_row(recent: Sequence[float], t: int, period: dt.date) -> list[float]:
    """``next_features`` of one series, as numbers."""
    tails = [recent[-min(k, len(recent)):] for k in WINDOWS]
    return [
        t, period.month, (period.month + 2) // 3,
        *[recent[-min(k, len(recent))] for k in LAGS],
        *[sum(v) / len(v) for v in tails],
    ]


def forecast_tree_recursive(
    model_name: str,
    series: DataFrame,
    features: DataFrame,
    horizon: int,
    keys: Sequence[str] = (),
    count: int | None = None,
) -> DataFrame:
    """Months ahead of a tree model refitted on every complete row of each series.

    Each prediction is appended to the series' recent values before the next. A series
    meets in one task; one without complete rows has no forecast.
    """
    names, total = list(keys), TREES[model_name] if count is None else count

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        predict = _fit(model_name, pdf[FEATURES].to_numpy(float), pdf["y"].to_numpy(float), total)
        recent, last_t, last = list(pdf["recent"].iloc[0]), int(pdf["last_t"].iloc[0]), pdf["last_period"].iloc[0]
        months = [(pd.Timestamp(last) + pd.DateOffset(months=i)).date() for i in range(1, horizon + 1)]
        for i, month in enumerate(months, 1):
            recent.append(float(predict(np.array([_next_row(recent, last_t + i, month)], float))[0]))
        head = {k: [pdf[k].iloc[0]] * horizon for k in names}
        return pd.DataFrame({**head, "period": months, "forecast": recent[len(recent) - horizon :]})

    schema = StructType(
        [*_key_fields(series, keys), StructField("period", DateType()), StructField("forecast", DoubleType())]
    )
    known = attach(features.select(*names, "period", *FEATURES, "y"), history(series, keys), keys)
    return known.groupBy(*names).applyInPandas(run, schema)


def refit_best(
    best: DataFrame,
    series: DataFrame,
    features: DataFrame,
    horizon: int,
    keys: Sequence[str] = (),
    models: Sequence[str] = (*BASELINES, *MODELS),
    count: Mapping[str, int] = TREES,
) -> DataFrame:
    """Months ahead of each series by its own model of ``best``, ``(keys, model)``.

    Series are routed to their models first, so a model is refitted for the series it has
    won and for no other. Cut ``best``, ``series`` and ``features`` first.
    """
    out: DataFrame | None = None
    for name in models:
        won = best.filter(F.col("model") == name).select(*keys)
        own = attach(series, won, keys), attach(features, won, keys)
        ahead = refit_forecast(name, *own, horizon, keys, count.get(name))
        out = ahead if out is None else out.unionByName(ahead)
    return out

"""Trees and ensembles against plain loops, and the routing of series to their models."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerframe.operators import forecast, models, trees


def brute_tree(x, y, w, depth, number=0, nodes=None):
    """A predicting function, from trying every cut of every feature."""
    nodes = itertools.count() if nodes is None else nodes
    liked = trees.feature_order(number, next(nodes), x.shape[1])
    mean = float(np.average(y, weights=w))
    error = lambda m: float((w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum())
    best = None
    for f in liked:
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            fall = error(np.full(len(y), True)) - error(low) - error(~low)
            if depth and fall > 1e-9 and (best is None or fall > best[0] * (1 + 1e-9)):
                best = fall, f, cut
    if best is None:
        return lambda row: mean
    _, f, cut = best
    low = x[:, f] <= cut
    below, above = (brute_tree(x[m], y[m], w[m], depth - 1, number, nodes) for m in (low, ~low))
    return lambda row: below(row) if row[f] <= cut else above(row)


def sample(seed, rows=40, features=4):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (rows, features)).astype(float)  # ties in every feature
    return x, x[:, 0] * 3 + np.sin(x[:, 1]) * 20 + rng.standard_normal(rows)


@pytest.mark.parametrize("depth", [0, 1, 3, 5])
@pytest.mark.parametrize("seed", range(5))
def test_a_tree_agrees_with_brute_force(seed, depth):
    x, y = sample(seed)
    for w in (np.ones(len(y)), trees.drawn_counts(seed, len(y))):
        tree = trees.grow(x, y, w, depth, trees.sorted_rows(x))
        taken = w > 0
        want = brute_tree(x[taken], y[taken], w[taken], depth)
        assert np.allclose(tree.predict(x), [want(row) for row in x])


def test_boosting_agrees_with_a_plain_loop():
    x, y = sample(9)
    out = np.full(len(y), y.mean())
    for k in range(12):
        tree = brute_tree(x, y - out, np.ones(len(y)), trees.BOOSTING_DEPTH, k)
        out += trees.STEP * np.array([tree(row) for row in x])
    assert np.allclose(trees.fit_boosting(x, y, 12).predict(x), out)


def test_a_forest_agrees_with_a_plain_loop():
    x, y = sample(11)
    grown = []
    for k in range(8):
        w = trees.drawn_counts(k, len(y))
        tree = brute_tree(x[w > 0], y[w > 0], w[w > 0], trees.FOREST_DEPTH, k)
        grown.append([tree(row) for row in x])
    assert np.allclose(trees.fit_forest(x, y, 8).predict(x), np.mean(grown, axis=0))
    parts = [trees.fit_forest(x, y, n, first, 8).predict(x) for first, n in ((0, 3), (3, 5))]
    assert np.allclose(sum(parts), np.mean(grown, axis=0))


def test_draws_have_the_counts_of_a_bootstrap():
    counts = np.concatenate([trees.drawn_counts(k, 100) for k in range(200)])
    assert abs(counts.mean() - 1) < 0.02 and abs((counts == 0).mean() - np.exp(-1)) < 0.01 and abs(counts.var() - 1) < 0.05


def test_single_rows_and_constant_features():
    one = trees.fit_boosting(np.ones((1, 3)), np.array([7.0]), 4)
    assert one.predict(np.zeros((2, 3))).tolist() == [7.0, 7.0]
    flat = trees.fit_forest(np.ones((6, 2)), np.arange(6.0), 4)
    assert len(set(flat.predict(np.arange(8.0).reshape(4, 2)))) == 1


def panel(spark, series=6, months=40):
    rng = np.random.default_rng(5)
    rows = [
        (f"k{s}" if s else None, 2000 + m // 12, m % 12 + 1, float(100 + s * m + 30 * np.sin(m) + rng.standard_normal()))
        for s in range(series) for m in range(months)
    ]
    return spark.createDataFrame(rows, "k string, y0 int, m int, y double").select("k", F.make_date("y0", "m", F.lit(1)).alias("period"), "y")


@pytest.mark.parametrize("model", [models.FOREST, models.BOOSTING])
def test_series_are_fitted_apart_on_any_partitioning(spark, model):
    series = panel(spark)
    split = forecast.holdout_split(forecast.forecast_features(series, ["k"]), 4, ["k"])
    rows = lambda df: {(r["k"], r["period"]): r["prediction"] for r in df.collect()}
    got = rows(models.tree_predictions(model, split, ["k"], 12))
    assert got == rows(models.tree_predictions(model, split.repartition(3, "month"), ["k"], 12))
    assert len(got) == 24
    known = split.filter("k = 'k2' AND split = 'train'").orderBy("period").toPandas()
    asked = split.filter("k = 'k2' AND split = 'test'").orderBy("period").toPandas()
    fit = trees.fit_forest if model == models.FOREST else trees.fit_boosting
    alone = fit(known[forecast.FEATURES].to_numpy(float), known["y"].to_numpy(float), 12)
    want = alone.predict(asked[forecast.FEATURES].to_numpy(float))
    assert np.allclose([got["k2", d] for d in asked["period"]], want)


def test_each_series_is_refitted_by_its_own_model_only(spark, monkeypatch):
    series = panel(spark)
    features = forecast.forecast_features(series, ["k"])
    names = [None, "k1", "k2", "k3", "k4", "k5"]
    won = dict(zip(names, (*forecast.BASELINES, *models.MODELS)))
    best = spark.createDataFrame(list(won.items()), "k string, model string")
    fits = spark.sparkContext.accumulator(0)
    boosting, forest = trees.fit_boosting, trees.fit_forest
    monkeypatch.setattr(trees, "fit_boosting", lambda *a: fits.add(1) or boosting(*a))
    monkeypatch.setattr(trees, "fit_forest", lambda *a: fits.add(100) or forest(*a))
    counts = {models.FOREST: 6, models.BOOSTING: 6}
    got = {(r["k"], r["period"]): r for r in models.refit_best(best, series, features, 3, ["k"], count=counts).collect()}
    assert fits.value == 101
    assert {k: r["model"] for (k, _), r in got.items()} == won and len(got) == 18
    for k, name in won.items():
        own = F.col("k").eqNullSafe(F.lit(k))
        alone = models.refit_forecast(name, series.filter(own), features.filter(own), 3, ["k"], counts.get(name)).collect()
        assert [got[k, r["period"]]["forecast"] for r in alone] == [r["forecast"] for r in alone]


def test_rows_ahead_are_those_of_the_linear_recursion(spark):
    recent = [float(v) for v in (3, 1, 4, 1, 5)]
    import datetime as dt

    month = dt.date(2024, 11, 1)
    cols = forecast.next_features(F.array(*map(F.lit, recent)), F.lit(7), F.lit(month))
    row = spark.range(1).select(F.array(*cols).alias("x")).first()["x"]
    assert np.allclose(models._next_row(recent, 7, month), row)

"""Operators against published inputs and outputs."""

from __future__ import annotations

import datetime as dt

import golden as g
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerframe.operators import commentary, drivers, forecast, linkage, models, pnl, scenarios, trees
from ledgerframe.operators.variance import variance_rollup
from ledgerframe.sources import dimensions

CUTOFF = "2026-06-01"


def close(got, want, rel=1e-9, absolute=0.0):
    assert got == pytest.approx(want, rel=rel, abs=absolute)


def series(spark, cutoff=None):
    rows = [(m, r) for m, r, _, _ in g.MONTHLY_PNL if cutoff is None or m <= cutoff]
    return spark.createDataFrame(rows, "period string, y double").withColumn(
        "period", F.col("period").cast("date")
    )


def split_at(spark, cutoff):
    return forecast.holdout_split(forecast.forecast_features(series(spark, cutoff)))


def by_period(df, column):
    return {str(r["period"]): r[column] for r in df.collect()}


@pytest.mark.parametrize(
    "model, column",
    [
        (models.LINEAR, 1),
        (forecast.NAIVE, 2),
        (forecast.MOVING_AVERAGE, 3),
        (forecast.TREND, 4),
    ],
)
def test_holdout_predictions(spark, model, column):
    got = by_period(models.fit_predict(model, split_at(spark, CUTOFF)), "prediction")
    assert len(got) == 6
    for row in g.HOLDOUT:
        close(got[row[0]], row[column], rel=1e-6)


def test_accuracy_and_leaderboard(spark):
    split = split_at(spark, CUTOFF)
    preds = forecast.baseline_predictions(split).unionByName(models.linear_predictions(split))
    board = forecast.leaderboard(forecast.accuracy(preds)).collect()
    assert [r["model"] for r in board] == [
        models.LINEAR, forecast.TREND, forecast.NAIVE, forecast.MOVING_AVERAGE
    ]
    published = {m: rest for m, *rest in g.ACCURACY}
    for r in board:
        close([r["MAPE"], r["RMSE"], r["MAE"]], published[r["model"]], rel=1e-4)
    assert forecast.best_model(forecast.accuracy(preds)).collect()[0]["model"] == models.LINEAR


def test_no_cutoff_holdout(spark):
    # without a cutoff the holdout is the second half of the last year
    split = split_at(spark, None)
    preds = forecast.baseline_predictions(split).unionByName(models.linear_predictions(split))
    mape = {r["model"]: r["MAPE"] for r in forecast.accuracy(preds).collect()}
    close(mape[models.LINEAR], 0.016534, absolute=1e-6)
    close(mape[forecast.TREND], 0.026469, absolute=1e-6)
    close(mape[forecast.NAIVE], 0.026556, absolute=1e-6)
    close(mape[forecast.MOVING_AVERAGE], 0.029617, absolute=1e-6)


def test_recursive_forecast(spark):
    s = series(spark, CUTOFF)
    out = models.forecast_linear_recursive(s, forecast.forecast_features(s), 6)
    got = by_period(out, "forecast")
    for month, value in g.RECURSIVE:
        close(got[month], value, rel=1e-5)


@pytest.mark.parametrize("model, margin", [(models.BOOSTING, 0.05), (models.FOREST, 0.1)])
def test_trees_at_their_published_size(spark, model, margin):
    preds = models.tree_predictions(model, split_at(spark, CUTOFF))
    row = forecast.accuracy(preds).collect()[0]
    published = {m: rest for m, *rest in g.ACCURACY}[model]
    assert preds.count() == 6
    close(row["MAPE"], published[0], rel=margin)


def test_refit_by_name(spark):
    s = series(spark, CUTOFF)
    features = forecast.forecast_features(s)
    low, high = min(r[1] for r in g.MONTHLY_PNL), max(r[1] for r in g.MONTHLY_PNL)
    for name in (models.FOREST, models.BOOSTING):
        rows = models.refit_forecast(name, s, features, 6, count=5).orderBy("period").collect()
        assert [str(r["period"])[:7] for r in rows] == [f"2026-{m:02d}" for m in range(7, 13)]
        assert all(low <= r["forecast"] <= high for r in rows)
        # the first step sees the true history: same as one prediction by hand
        known = features.orderBy("period").toPandas()
        fit = {models.FOREST: trees.fit_forest, models.BOOSTING: trees.fit_boosting}[name]
        model = fit(known[forecast.FEATURES].to_numpy(float), known["y"].to_numpy(float), 5)
        recent = [r[1] for r in g.MONTHLY_PNL if r[0] <= CUTOFF][-12:]
        x = [42, 7, 3, recent[-1], recent[-2], recent[-3], recent[0],
             sum(recent[-3:]) / 3, sum(recent[-6:]) / 6]
        close(rows[0]["forecast"], model.predict(np.array([x], float))[0])
    naive = models.refit_forecast(forecast.NAIVE, s, features, 2).collect()
    assert [r["forecast"] for r in naive] == [4915846.84] * 2


def test_scenarios(spark):
    rows = [(m, line, v) for m, line, v in g.FORECAST_TOTALS]
    fc = spark.createDataFrame(rows, "period string, line_type string, forecast_amount double")
    fc = fc.select(
        F.col("period").cast("date"), "line_type", F.col("forecast_amount").cast("decimal(18,2)")
    )
    flexed = scenarios.scenario_pnl(fc, scenarios.scenarios_from(dimensions.SCENARIOS))
    got = {(r["scenario"], str(r["period"])): r for r in flexed.collect()}
    assert len(got) == 18
    for name, month, revenue, opex, ebitda in g.SCENARIO_PNL:
        r = got[name, month]
        close([r["revenue"], r["opex"], r["ebitda_proxy"]], [revenue, opex, ebitda], absolute=0.01)
    totals = scenarios.scenario_summary(flexed).collect()
    assert [r["scenario"] for r in totals] == ["Downside", "Base", "Upside"]
    close([r["revenue"] / 1e6 for r in totals], [28.78, 30.78, 32.35], absolute=0.005)
    close([r["ebitda_proxy"] / 1e6 for r in totals], [1.48, 2.93, 4.08], absolute=0.005)


def test_lrp_scenarios(spark):
    lrp = spark.createDataFrame(g.LRP, "fiscal_year int, plan_revenue double, plan_opex double")
    out = scenarios.lrp_scenarios(lrp, scenarios.scenarios_from(dimensions.SCENARIOS))
    got = {(r["scenario"], r["fiscal_year"]): r for r in out.collect()}
    for name, year, revenue, opex, margin in g.LRP_SCENARIOS:
        r = got[name, year]
        close([r["plan_revenue"], r["plan_opex"]], [revenue, opex], absolute=0.01)
        close(r["plan_ebitda_margin"], margin, absolute=1e-6)


def test_quarterly_pnl(spark):
    rows = spark.createDataFrame(
        g.MONTHLY_PNL,
        "period string, total_revenue double, total_cogs double, total_opex_below_gm double",
    ).withColumn("period", F.col("period").cast("date"))
    out = {(r["fiscal_year"], r["fiscal_quarter"]): r for r in pnl.pnl_quarterly(rows).collect()}
    last = out[2026, "Q2"]
    close([last["total_revenue"], last["ebitda"]], [14677009, 1257247], absolute=0.5)
    close([last["yoy_growth"], last["ebitda_margin_pct"]], [0.137, 0.086], absolute=0.0005)
    close(out[2023, "Q1"]["total_revenue"], 8156629, absolute=0.5)
    close(out[2023, "Q1"]["ebitda"], -311169, absolute=0.5)
    assert out[2023, "Q1"]["yoy_growth"] is None


def test_driver_ratios(spark):
    rows = [
        (r[0], r[1], r[2], r[3], r[4], r[5]) for r in g.DRIVERS
    ]
    fact = spark.createDataFrame(
        rows,
        "period string, profit_center string, customers double, revenue double, "
        "new_logos double, churned_customers double",
    )
    got = {(r["period"], r["profit_center"]): r for r in drivers.driver_model(fact).collect()}
    for row in g.DRIVERS:
        r = got[row[0], row[1]]
        close([r["arpu_implied"], r["net_new_customers"], r["churn_rate_implied"]], row[6:])


def test_opex_per_head(spark):
    opex = spark.createDataFrame([r[:2] for r in g.OPEX_PER_HEAD], "period string, amount double")
    heads = spark.createDataFrame(
        [(r[0], r[2]) for r in g.OPEX_PER_HEAD], "period string, headcount double"
    )
    got = {r["period"]: r for r in drivers.opex_per_headcount(opex, heads).collect()}
    for month, _, _, per_head in g.OPEX_PER_HEAD:
        close(got[month]["opex_per_headcount_monthly"], per_head)


def test_executive_variance(spark):
    detail = spark.createDataFrame(
        [r[:4] for r in g.EXEC_VARIANCE],
        "period string, line_type string, budget_amount double, actual_amount double",
    )
    out = variance_rollup(detail, ["period", "line_type"], "budget_amount").collect()
    got = {(r["period"], r["line_type"]): r for r in out}
    for month, line, _, _, diff, share in g.EXEC_VARIANCE:
        close(got[month, line]["variance_abs"], diff, absolute=0.005)
        close(got[month, line]["variance_pct"], share, absolute=1e-6)


def test_topic_summary(spark):
    scored = spark.createDataFrame(g.CLUSTERED, "topic_cluster int, sentiment_score double")
    out = commentary.topic_summary(scored.withColumn("topic_cluster_label", F.lit("x")))
    got = {r["topic_cluster"]: r for r in out.collect()}
    for cluster, n, mean in g.CLUSTERS:
        assert got[cluster]["comment_count"] == n
        close(got[cluster]["avg_sentiment"], mean)


def test_tone_correlation(spark):
    link = spark.createDataFrame(
        g.LINK, "fiscal_quarter string, cost_center string, s double, v double"
    )
    row = linkage.correlation(link, "s", "v").collect()[0]
    assert row["n"] == 50
    close(row["correlation"], -0.14822, absolute=1e-5)


def test_calendar(spark):
    bounds = spark.createDataFrame(
        [(dt.date(2023, 1, 1), dt.date(2026, 12, 1))], "start date, end date"
    )
    rows = pnl.calendar_dim(bounds, dt.date(2026, 6, 1)).orderBy("period").collect()
    assert len(rows) == 48
    assert tuple(rows[0]) == (dt.date(2023, 1, 1), 2023, "Q1", "Jan-2023", True)
    assert [r["is_actual"] for r in rows] == [True] * 42 + [False] * 6


def test_a_null_key_is_a_series(spark):
    one = series(spark, CUTOFF)
    panel = one.withColumn("k", F.lit("a")).unionByName(
        one.withColumn("k", F.lit(None).cast("string"))
    )
    features = forecast.forecast_features(panel, ["k"])
    ahead = models.refit_forecast(models.LINEAR, panel, features, 6, ["k"])
    assert {r["k"]: r["count"] for r in ahead.groupBy("k").count().collect()} == {"a": 6, None: 6}
    best = forecast.best_model(
        forecast.accuracy(
            forecast.baseline_predictions(forecast.holdout_split(features, 6, ["k"]), ["k"]), ["k"]
        ),
        ["k"],
    )
    picked = forecast.pick_best(forecast.forecast_baselines(panel, 2, ["k"]), best, ["k"])
    assert picked.count() == 4

"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from ledgerframe.operators import models
from ledgerframe.plans import params

PATH = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
REGISTERED_TREES = params.FOREST_TREES, params.BOOSTING_ROUNDS  # before few_trees


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    """The number of trees changes how long the tree queries take, not what they do."""
    monkeypatch.setattr(params, "FOREST_TREES", 10)
    monkeypatch.setattr(params, "BOOSTING_ROUNDS", 3)


@pytest.fixture(scope="module")
def duck():
    return compare.connect(PATH)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, duck, name):
    problems, _ = compare.check(spark, duck, PATH, QUERIES[name], ORACLES[name])
    assert not problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, PATH).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "period" and df.count() > 0


@pytest.mark.parametrize("name", ["variance_budget", "variance_forecast"])
def test_plan_and_actuals_share_one_ledger_pass(spark, name):
    df = QUERIES[name](spark, PATH)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert final.count("FileScan parquet [l_orderkey") == 1


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["opex_per_headcount", "dq_null_dimensions", "latest_kpis"])
def test_lines_are_read_once(spark, name):
    assert final_plan(QUERIES[name](spark, PATH)).count("FileScan parquet [l_orderkey") == 1


def test_registered_tree_queries_take_the_references_counts():
    assert REGISTERED_TREES == (models.TREES[models.FOREST], models.TREES[models.BOOSTING]) == (300, 250)


@pytest.mark.parametrize("name", ["forecast_rf", "forecast_gbt", "forecast_best_of_all"])
def test_trees_do_not_read_the_ledger_again(spark, name):
    df = QUERIES[name](spark, PATH)
    assert "FileScan parquet [l_orderkey" not in df._jdf.queryExecution().executedPlan().toString()
    series = QUERIES["forecast_linear"](spark, PATH).select("profit_center", "company_code").distinct()
    assert df.select("profit_center", "company_code").distinct().count() == series.count()


def test_documents_are_numbered_once(spark):
    numbers = QUERIES["gl_journal"](spark, PATH).agg(
        F.count("document_number"), F.count_distinct("document_number"),
        F.min("document_number"), F.max("document_number"),
    ).first()
    assert numbers[0] == numbers[1] == numbers[3] and numbers[2] == 1


def test_quality_checks_find_something(spark):
    assert QUERIES["dq_negative_revenue"](spark, PATH).count() > 0
    off = QUERIES["recon_revenue"](spark, PATH).filter("variance <> 0").collect()
    assert [r["period"] for r in off] == [params.LEDGER_GAP[0]]


def test_filters_reach_the_scan(spark):
    df = QUERIES["pnl_monthly_filtered"](spark, PATH)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "l_shipdate" not in plan and "l_quantity" not in plan


def test_documents_are_weighed_in_their_row(spark):
    # only words and n-grams are shuffled; nothing is by document
    df = QUERIES["doc_top_keywords"](spark, PATH)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_topics_are_nearest_and_repeatable(spark):
    first = {tuple(r) for r in QUERIES["topic_clusters"](spark, PATH).collect()}
    again = {tuple(r) for r in QUERIES["topic_clusters"](spark, PATH).collect()}
    assert first == again and {c for _, c in first} == set(range(5))

"""Every operator as a query over the order tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import dbl, from_cents
from ..functions.periods import add_months
from ..operators import commentary as text
from ..operators import drivers, forecast, linkage, models, planning, pnl, recon, scenarios
from ..operators import variance as var
from ..sources import dimensions, extracts, order_ledger, store, tables
from ..sources.order_ledger import OrderTables
from . import params as p

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PANEL = ("profit_center", "company_code")
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def query(build: Callable[[OrderTables], DataFrame]) -> Callable[[OrderTables], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(OrderTables(spark, sf_dir))
    return build


def _rounded(df: DataFrame, digits: int, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _accounts(t: OrderTables) -> DataFrame:
    return dimensions.chart_of_accounts(t.spark)


def _closed() -> date:
    """Day after the last closed month."""
    return add_months(p.AS_OF, 1)


# ---------------------------------------------------------------- sources

@query
def table_profile(t: OrderTables) -> DataFrame:
    return tables.table_profile({name: t[name] for name in TABLES})


@query
def revenue_fact(t: OrderTables) -> DataFrame:
    return order_ledger.revenue_fact(t).withColumn("revenue", dbl("revenue"))


@query
def opex_fact(t: OrderTables) -> DataFrame:
    return order_ledger.opex_fact(t).withColumn("amount", dbl("amount"))


@query
def headcount_fact(t: OrderTables) -> DataFrame:
    return order_ledger.headcount_fact(t)


@query
def calendar_dim(t: OrderTables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    bounds = t["orders"].agg(F.min(day).alias("start"), F.max(day).alias("end"))
    return pnl.calendar_dim(bounds, p.AS_OF)


def _scratch(t: OrderTables, name: str) -> str:
    """A new folder below the cluster's shared one."""
    shared = t.spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/ledgerframe/{name}-{uuid.uuid4().hex}"


@query
def csv_round_trip(t: OrderTables) -> DataFrame:
    """The expense fact written as CSV and read again by its declared schema."""
    fact = order_ledger.opex_fact(t)
    path = _scratch(t, "csv")
    tables.write_csv(fact, path)
    return tables.read_csv(t.spark, path, fact.schema).withColumn("amount", dbl("amount"))


@query
def csv_text_round_trip(t: OrderTables) -> DataFrame:
    """The documents, texts with line breaks and quotes included, through splittable CSV."""
    docs = t["documents"].select("doc_id", "text", "lang", "source", "n_chars")
    path = _scratch(t, "csv_text")
    tables.write_csv(docs, path)
    return tables.read_text_csv(t.spark, path, docs.schema)


@query
def table_round_trip(t: OrderTables) -> DataFrame:
    """The expense fact stored by fiscal year, one year of it replaced by itself, and all
    years read through a view."""
    path = _scratch(t, "table")
    fact = order_ledger.opex_fact(t)
    store.replace_table(fact, path)
    year = store.read_stored(t.spark, path).filter(F.col("fiscal_year") == p.FILTER_YEARS[0])
    store.replace_table(year, path, only_years=True)
    tables.create_views({"stored_opex": store.read_stored(t.spark, path)})
    return t.spark.sql(
        "SELECT period, cost_center, company_code, gl_account, CAST(amount AS DOUBLE) AS amount "
        "FROM stored_opex"
    )


def _extract(t: OrderTables) -> DataFrame:
    """The expense fact written as a ledger extract and read by the data source."""
    fact = order_ledger.opex_fact(t)
    path = _scratch(t, "extract")
    extracts.write_extract(fact, path)
    return extracts.read_extract(t.spark, path, fact.schema)


@query
def ledger_extract(t: OrderTables) -> DataFrame:
    return _extract(t).drop("fiscal_year").withColumn("amount", dbl("amount"))


@query
def ledger_extract_by_year(t: OrderTables) -> DataFrame:
    """Expense by year and account of some years, whose folders alone are opened."""
    years = _extract(t).filter(F.col("fiscal_year").isin(*p.FILTER_YEARS))
    return years.groupBy("fiscal_year", "gl_account").agg(
        dbl(F.sum("amount")).alias("amount"), F.count(F.lit(1)).alias("n_rows")
    )


# ---------------------------------------------------------------- ledger and checks

def _journal(t: OrderTables) -> DataFrame:
    return recon.gl_journal(order_ledger.line_postings(t))


@query
def gl_journal(t: OrderTables) -> DataFrame:
    return _journal(t).withColumn("amount", dbl("amount"))


def _ledger(t: OrderTables) -> DataFrame:
    """Journal columns that the checks read, without the dimension joins."""
    side = F.when(F.col("line_type") == "Revenue", "C").otherwise("D")
    return order_ledger.account_postings(t).select(
        "period", "gl_account", "amount", side.alias("debit_credit")
    )


@query
def gl_recon_check(t: OrderTables) -> DataFrame:
    return recon.gl_check(_ledger(t), dimensions.chart_of_accounts(t.spark, [p.ORPHAN_ACCOUNT]))


@query
def gl_orphan_accounts(t: OrderTables) -> DataFrame:
    return recon.orphan_accounts(
        _ledger(t), dimensions.chart_of_accounts(t.spark, [p.ORPHAN_ACCOUNT])
    )


@query
def recon_revenue(t: OrderTables) -> DataFrame:
    """Two facts that are built apart: the ledger, with its gap, and the revenue fact with
    its dimensions."""
    month, account = p.LEDGER_GAP
    gap = (F.col("period") == F.lit(month)) & (F.col("gl_account") == account)
    return recon.recon_revenue(_ledger(t).filter(~gap), order_ledger.revenue_fact(t))


@query
def dq_negative_revenue(t: OrderTables) -> DataFrame:
    """Lines with negative revenue; returned goods count as credit notes here."""
    returned = F.col("revenue_account") == order_ledger.REVENUE_ACCOUNTS["R"]
    amount = from_cents("revenue_cents")
    lines = order_ledger.order_lines(t, {"profit_center"}).select(
        F.col("l_orderkey").alias("document_number"),
        F.col("l_linenumber").alias("document_line"),
        "period",
        "profit_center",
        F.col("revenue_account").alias("gl_account"),
        F.when(returned, -amount).otherwise(amount).alias("revenue"),
    )
    return recon.dq_negative(lines, "revenue").withColumn("revenue", dbl("revenue"))


@query
def dq_negative_net_new(t: OrderTables) -> DataFrame:
    """Segment months that lost more customers than they won."""
    net = _drivers(t)
    return recon.dq_negative(net, "net_new_customers").select(
        "period", "profit_center", "net_new_customers"
    )


@query
def dq_null_dimensions(t: OrderTables) -> DataFrame:
    """Lines without a dimension or an order, from one pass over them; unlabelled texts."""
    counts = order_ledger.line_gaps(t)
    named = F.array(*[
        F.struct(F.lit(c).alias("table_name"), F.col(c).alias("null_rows")) for c in counts.columns
    ])
    labels = recon.dq_nulls(
        {
            "authored_label": (
                t["documents"].select("doc_id").join(
                    order_ledger.authored_labels(t), "doc_id", "left"
                ),
                "authored_tone_label",
            ),
        }
    )
    return counts.select(F.explode(named).alias("x")).select("x.*").unionByName(labels)


# ---------------------------------------------------------------- profit and loss

@query
def pnl_cube(t: OrderTables) -> DataFrame:
    return pnl.pnl_cube(
        pnl.monthly_actuals(order_ledger.postings(t)),
        order_ledger.entities(t),
        order_ledger.segments(t),
        order_ledger.cost_centers(t),
        _accounts(t),
    )


def _pnl(
    t: OrderTables, since: date | Column | None = None, until: date | None = None
) -> DataFrame:
    postings = order_ledger.postings(t, dims=False, since=since, until=until)
    return pnl.pnl_monthly(postings, _accounts(t))


@query
def pnl_monthly(t: OrderTables) -> DataFrame:
    return _pnl(t)


@query
def pnl_monthly_filtered(t: OrderTables) -> DataFrame:
    """Chosen years; the outer bounds reach the scan, the year list the aggregation."""
    first, last = min(p.FILTER_YEARS), max(p.FILTER_YEARS)
    postings = order_ledger.postings(
        t, dims=False, since=date(first, 1, 1), until=date(last + 1, 1, 1)
    )
    return pnl.pnl_monthly(postings, _accounts(t), years=p.FILTER_YEARS).orderBy("period")


@query
def pnl_quarterly(t: OrderTables) -> DataFrame:
    return pnl.pnl_quarterly(_pnl(t, until=_closed()))


@query
def pnl_levels(t: OrderTables) -> DataFrame:
    """P&L of months, quarters and years in one table."""
    return pnl.pnl_levels(_pnl(t, until=_closed()))


@query
def yoy_revenue(t: OrderTables) -> DataFrame:
    sums = order_ledger.revenue_monthly(t).withColumn("revenue", dbl("revenue"))
    return pnl.yoy(sums, "revenue", ["profit_center"])


@query
def latest_kpis(t: OrderTables) -> DataFrame:
    """Only the last closed month on record and the year before it are read."""
    closed = t["orders"].filter(F.col("o_orderdate") < F.lit(_closed()))
    month = F.trunc(F.max("o_orderdate").cast("date"), "month")
    since = closed.agg(F.add_months(month, -12).alias("since")).scalar()
    return pnl.latest_kpis(_pnl(t, since=since, until=_closed()))


@query
def qbr_segment_quarterly(t: OrderTables) -> DataFrame:
    months = order_ledger.revenue_monthly(t, until=_closed())
    return pnl.qbr_segment_quarterly(months, order_ledger.segments(t), p.AS_OF)


@query
def segment_mix(t: OrderTables) -> DataFrame:
    months = order_ledger.revenue_monthly(
        t, since=date(min(p.MIX_YEARS), 1, 1), until=date(max(p.MIX_YEARS) + 1, 1, 1)
    )
    return pnl.segment_mix(months, order_ledger.segments(t), p.MIX_YEARS)


@query
def segment_mix_quarterly(t: OrderTables) -> DataFrame:
    months = order_ledger.revenue_monthly(t)
    return pnl.segment_mix(months, order_ledger.segments(t), by_quarter=True)


# ---------------------------------------------------------------- plans and variance

def _actuals(t: OrderTables) -> DataFrame:
    return pnl.monthly_actuals(order_ledger.postings(t))


def _budget(actuals: DataFrame) -> DataFrame:
    return planning.budget_build(actuals, p.BUDGET_GROWTH)


def _forecast(t: OrderTables) -> DataFrame:
    recent = order_ledger.postings(t, since=add_months(p.AS_OF, -2), until=_closed())
    return _run_rate(pnl.monthly_actuals(recent))


def _run_rate(actuals: DataFrame) -> DataFrame:
    return planning.run_rate_forecast(actuals, p.AS_OF, p.HORIZON, p.RUN_RATE_GROWTH)


@query
def budget_build(t: OrderTables) -> DataFrame:
    """Only the years before a budgeted one are read."""
    years = [y - 1 for y in p.BUDGET_GROWTH]
    base = order_ledger.postings(t, since=date(min(years), 1, 1), until=date(max(years) + 1, 1, 1))
    return planning.as_money(_budget(pnl.monthly_actuals(base)), "budget_amount")


@query
def run_rate_forecast(t: OrderTables) -> DataFrame:
    return planning.as_money(_forecast(t), "forecast_amount")


@query
def lrp_plan(t: OrderTables) -> DataFrame:
    return _lrp(t)


def _lrp(t: OrderTables) -> DataFrame:
    postings = order_ledger.postings(
        t, dims=False, since=date(p.LRP_BASE_YEAR, 1, 1), until=_closed()
    )
    return planning.lrp_plan(postings, p.LRP_GROWTH, p.LRP_BASE_YEAR)


def _variance_budget(t: OrderTables) -> DataFrame:
    actuals = _actuals(t)
    return var.variance(_budget(actuals), actuals, "budget_amount")


def _variance_forecast(t: OrderTables) -> DataFrame:
    """Months after the cutoff that have postings play the later actuals.

    One frame of months, from the first trailing one on, feeds both sides.
    """
    actuals = pnl.monthly_actuals(order_ledger.postings(t, since=add_months(p.AS_OF, -2)))
    return var.variance(_run_rate(actuals), actuals, "forecast_amount")


@query
def variance_budget(t: OrderTables) -> DataFrame:
    return _variance_budget(t)


@query
def variance_forecast(t: OrderTables) -> DataFrame:
    return _variance_forecast(t)


@query
def variance_budget_filtered(t: OrderTables) -> DataFrame:
    """Variance of chosen years and segments, sorted; the bounds reach the scan, a year
    before included, which the budget is made from."""
    first, last = min(p.FILTER_YEARS), max(p.FILTER_YEARS)
    actuals = pnl.monthly_actuals(
        order_ledger.postings(t, since=date(first - 1, 1, 1), until=date(last + 1, 1, 1))
    )
    out = var.variance(_budget(actuals), actuals, "budget_amount")
    chosen = F.year("period").isin(*p.FILTER_YEARS) & F.col("dim1").isin(*p.FILTER_SEGMENTS)
    return out.filter(chosen).orderBy("period", "dim1", "dim2", "gl_account", "line_type")


@query
def variance_rollup_budget(t: OrderTables) -> DataFrame:
    return var.variance_rollup(_variance_budget(t), ["period", "line_type"], "budget_amount")


@query
def variance_rollup_forecast(t: OrderTables) -> DataFrame:
    return var.variance_rollup(_variance_forecast(t), ["period", "line_type"], "forecast_amount")


@query
def variance_levels(t: OrderTables) -> DataFrame:
    """Budget variance of months, quarters, years and all together, by line."""
    return var.variance_levels(_variance_budget(t), "budget_amount")


@query
def variance_quarterly(t: OrderTables) -> DataFrame:
    return var.variance_quarterly(_variance_budget(t), "budget_amount")


# ---------------------------------------------------------------- drivers

def _drivers(t: OrderTables) -> DataFrame:
    return drivers.driver_model(order_ledger.revenue_fact(t, ["profit_center"]))


@query
def driver_model_filtered(t: OrderTables) -> DataFrame:
    """Drivers of chosen years and segments, sorted. Who is new or gone depends on all
    months, so the years are chosen from the result."""
    chosen = F.year("period").isin(*p.FILTER_YEARS) & F.col("profit_center").isin(*p.FILTER_SEGMENTS)
    return _drivers(t).filter(chosen).orderBy("period", "profit_center")


@query
def driver_model_revenue(t: OrderTables) -> DataFrame:
    return _drivers(t)


def _whatif(t: OrderTables) -> DataFrame:
    return drivers.whatif(_drivers(t), p.WHATIF_ARPU_PCT, p.WHATIF_CHURN_PP)


@query
def whatif_drivers(t: OrderTables) -> DataFrame:
    return _whatif(t)


@query
def whatif_impact(t: OrderTables) -> DataFrame:
    return drivers.whatif_impact(_whatif(t), ["profit_center"])


@query
def opex_per_headcount(t: OrderTables) -> DataFrame:
    return drivers.opex_per_headcount(order_ledger.cost_and_heads(t))


@query
def opex_allocate(t: OrderTables) -> DataFrame:
    out = drivers.opex_allocate(
        order_ledger.headcount_fact(t), dimensions.PAYROLL_SPLIT, order_ledger.cost_ratios(t)
    )
    return planning.as_money(out, "amount")


@query
def services_attach(t: OrderTables) -> DataFrame:
    months = order_ledger.revenue_monthly(t)
    return drivers.services_attach(months, order_ledger.segments(t), p.SERVICES_RATE)


@query
def allocate_by_mix(t: OrderTables) -> DataFrame:
    months = order_ledger.revenue_monthly(t)
    return _rounded(drivers.allocate_by_mix(months, "revenue", p.COMPANY_MIX), 4, ["revenue"])


@query
def customer_rollforward(t: OrderTables) -> DataFrame:
    return drivers.customer_rollforward(
        order_ledger.revenue_fact(t, ["profit_center"]), ["profit_center"], p.OPENING_CUSTOMERS
    )


# ---------------------------------------------------------------- scenarios

def _scenarios() -> list[scenarios.Scenario]:
    return scenarios.scenarios_from(dimensions.SCENARIOS)


@query
def scenario_pnl(t: OrderTables) -> DataFrame:
    return scenarios.scenario_pnl(_forecast(t), _scenarios())


@query
def scenario_summary(t: OrderTables) -> DataFrame:
    return scenarios.scenario_summary(scenarios.scenario_pnl(_forecast(t), _scenarios()))


@query
def lrp_scenarios(t: OrderTables) -> DataFrame:
    return scenarios.lrp_scenarios(_lrp(t), _scenarios())


# ---------------------------------------------------------------- forecasting

def _panel(t: OrderTables) -> DataFrame:
    """Closed months of revenue per segment and company."""
    return forecast.monthly_series(
        order_ledger.revenue_monthly(t, PANEL, until=_closed()), "revenue", PANEL
    )


def _split(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return forecast.holdout_split(forecast.forecast_features(series, keys), p.HOLDOUT, keys)


def _baselines(t: OrderTables) -> DataFrame:
    return forecast.baseline_predictions(_split(_panel(t), PANEL), PANEL)


MEANS = ["rolling_mean_3", "rolling_mean_6"]


@query
def forecast_features(t: OrderTables) -> DataFrame:
    return _rounded(forecast.forecast_features(_panel(t), PANEL), 4, MEANS)


@query
def holdout_split(t: OrderTables) -> DataFrame:
    return _split(_panel(t), PANEL).select(
        *PANEL, "period", "t", "y", "split", F.coalesce("train_age", F.lit(0)).alias("train_age")
    )


def _one_baseline(t: OrderTables, model: str) -> DataFrame:
    out = forecast.baseline_predictions(_split(_panel(t), PANEL), PANEL, models=[model])
    return _rounded(out, 4, ["prediction"])


@query
def baseline_naive(t: OrderTables) -> DataFrame:
    return _one_baseline(t, forecast.NAIVE)


@query
def baseline_moving_avg(t: OrderTables) -> DataFrame:
    return _one_baseline(t, forecast.MOVING_AVERAGE)


@query
def baseline_trend(t: OrderTables) -> DataFrame:
    return _one_baseline(t, forecast.TREND)


METRICS = {"MAPE": 6, "RMSE": 4, "MAE": 4}


def _metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in METRICS.items()})


@query
def forecast_accuracy(t: OrderTables) -> DataFrame:
    return _metrics(forecast.accuracy(_baselines(t), PANEL))


@query
def baseline_leaderboard(t: OrderTables) -> DataFrame:
    return forecast.leaderboard(_metrics(forecast.accuracy(_baselines(t))))


@query
def holdout_wide(t: OrderTables) -> DataFrame:
    wide = forecast.holdout_wide(_baselines(t), forecast.BASELINES, PANEL)
    names = dict(zip(forecast.BASELINES, ("naive", "moving_average", "trend"), strict=True))
    return _rounded(wide.withColumnsRenamed(names), 4, list(names.values()))


@query
def forecast_best_baseline(t: OrderTables) -> DataFrame:
    """Each series forecast by the baseline that won its holdout."""
    panel = _panel(t)
    holdout = forecast.baseline_predictions(_split(panel, PANEL), PANEL)
    best = forecast.best_model(
        _rounded(forecast.accuracy(holdout, PANEL), 9, ["MAPE"]), PANEL
    )
    ahead = forecast.forecast_baselines(panel, p.HORIZON, PANEL)
    return _rounded(forecast.pick_best(ahead, best, PANEL), 4, ["forecast"])


@query
def forecast_recursive_fixed(t: OrderTables) -> DataFrame:
    """Recursion of a linear model with given coefficients."""
    hist = forecast.history(_panel(t), PANEL)
    coefficients = F.array(*[F.lit(c) for c in p.FIXED_COEFFICIENTS])
    out = forecast.forecast_recursive(
        hist, F.lit(p.FIXED_INTERCEPT), coefficients, p.HORIZON, PANEL
    )
    return _rounded(out, 4, ["forecast"])


@query
def forecast_linear(t: OrderTables) -> DataFrame:
    return _rounded(
        models.linear_predictions(_split(_panel(t), PANEL), PANEL), 1, ["prediction"]
    )


@query
def forecast_linear_pooled(t: OrderTables) -> DataFrame:
    """One linear model over all series, fitted without grouped Python."""
    out = models.linear_predictions(_cut_split(t), PANEL, pooled=True)
    return _rounded(out, 0, ["prediction"])


@query
def forecast_best(t: OrderTables) -> DataFrame:
    """Each series forecast by the model, baseline or linear, that won its holdout."""
    panel = text.cut(_panel(t))
    features = text.cut(forecast.forecast_features(panel, PANEL))
    split = forecast.holdout_split(features, p.HOLDOUT, PANEL)
    holdout = forecast.baseline_predictions(split, PANEL).unionByName(
        models.linear_predictions(split, PANEL)
    )
    scores = _rounded(forecast.accuracy(holdout, PANEL), 9, ["MAPE"])
    best = text.cut(forecast.best_model(scores, PANEL))
    exact = (*forecast.BASELINES, models.LINEAR)
    return _rounded(models.refit_best(best, panel, features, p.HORIZON, PANEL, exact), 1, ["forecast"])


def _cut_split(t: OrderTables) -> DataFrame:
    """The panel's feature rows, written once: every fit reads them, none the ledger."""
    return text.cut(_split(_panel(t), PANEL))


TREES = {models.FOREST: lambda: p.FOREST_TREES, models.BOOSTING: lambda: p.BOOSTING_ROUNDS}


def _tree(t: OrderTables, model: str) -> DataFrame:
    out = models.tree_predictions(model, _cut_split(t), PANEL, TREES[model]())
    return _rounded(out, 2, ["prediction"])


@query
def forecast_rf(t: OrderTables) -> DataFrame:
    """A forest for each segment and company."""
    return _tree(t, models.FOREST)


@query
def forecast_gbt(t: OrderTables) -> DataFrame:
    return _tree(t, models.BOOSTING)


@query
def forecast_tree_recursive(t: OrderTables) -> DataFrame:
    """Boosting refitted on every complete row and rolled forward month by month."""
    panel = text.cut(_panel(t))
    out = models.forecast_tree_recursive(
        models.BOOSTING, panel, forecast.forecast_features(panel, PANEL), p.HORIZON, PANEL,
        p.BOOSTING_ROUNDS,
    )
    return _rounded(out, 2, ["forecast"])


@query
def forecast_recursive(t: OrderTables) -> DataFrame:
    """Linear model refitted per series, each prediction feeding the next month."""
    panel = _panel(t)
    out = models.forecast_linear_recursive(
        panel, forecast.forecast_features(panel, PANEL), p.HORIZON, PANEL
    )
    return _rounded(out, 1, ["forecast"])


def _six(split: DataFrame) -> DataFrame:
    """Holdout predictions of all six models."""
    out = forecast.baseline_predictions(split, PANEL)
    for name in models.MODELS:
        trees = TREES[name]() if name in TREES else None
        out = out.unionByName(models.fit_predict(name, split, PANEL, trees))
    return out


@query
def model_leaderboard(t: OrderTables) -> DataFrame:
    """All six models over all series."""
    return forecast.leaderboard(_metrics(forecast.accuracy(_six(_cut_split(t)))))


SHORT = {
    forecast.NAIVE: "naive", forecast.MOVING_AVERAGE: "moving_average", forecast.TREND: "trend",
    models.LINEAR: "linear", models.FOREST: "forest", models.BOOSTING: "boosting",
}


@query
def holdout_wide_all(t: OrderTables) -> DataFrame:
    """Actuals beside the predictions of all six models."""
    wide = forecast.holdout_wide(_six(_cut_split(t)), list(SHORT), PANEL)
    return _rounded(wide.withColumnsRenamed(SHORT), 2, list(SHORT.values()))


@query
def forecast_best_of_all(t: OrderTables) -> DataFrame:
    """Each series forecast by the one of six models that won its holdout, refitted."""
    panel = text.cut(_panel(t))
    features = text.cut(forecast.forecast_features(panel, PANEL))
    holdout = _six(forecast.holdout_split(features, p.HOLDOUT, PANEL))
    best = text.cut(forecast.best_model(forecast.accuracy(holdout, PANEL), PANEL))
    counts = {name: count() for name, count in TREES.items()}
    ahead = models.refit_best(best, panel, features, p.HORIZON, PANEL, count=counts)
    return _rounded(ahead, 2, ["forecast"])


# ---------------------------------------------------------------- commentary

def _scored(t: OrderTables, keep_text: bool = False) -> DataFrame:
    return text.sentiment(
        order_ledger.commentary(t), "commentary_text",
        p.TONE_POSITIVE, p.TONE_NEGATIVE, p.TONE_NEGATIONS, keep_text=keep_text,
    )


def _weights(t: OrderTables) -> DataFrame:
    return text.term_weights(
        order_ledger.commentary(t), "doc_id", "commentary_text", p.STOP_WORDS, p.MAX_FEATURES
    )


@query
def doc_tokens(t: OrderTables) -> DataFrame:
    return text.tokens(t["documents"].select("doc_id", "text"), "text").select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"),
        F.array_join("tokens", " ").alias("tokens_joined"),
    )


@query
def sentiment_scored(t: OrderTables) -> DataFrame:
    return _scored(t)


@query
def tone_agreement(t: OrderTables) -> DataFrame:
    matched = text.label_match(_scored(t), order_ledger.authored_labels(t), "doc_id")
    return text.tone_agreement(matched)


@query
def tfidf_terms(t: OrderTables) -> DataFrame:
    rows = _weights(t).select("doc_id", F.explode("w").alias("x"))
    return _rounded(rows.select("doc_id", "x.*"), 6, ["weight"])


@query
def doc_top_keywords(t: OrderTables) -> DataFrame:
    return text.row_top_terms(_weights(t), "doc_id")


def _topics(t: OrderTables) -> tuple[DataFrame, DataFrame]:
    vectors, listed = text.term_vectors(
        order_ledger.commentary(t), "doc_id", "commentary_text", p.STOP_WORDS, p.MAX_FEATURES
    )
    return text.topics(vectors, "doc_id", listed)


@query
def topic_clusters(t: OrderTables) -> DataFrame:
    return _topics(t)[0]


@query
def topic_labels(t: OrderTables) -> DataFrame:
    return _topics(t)[1]


@query
def topic_summary(t: OrderTables) -> DataFrame:
    clusters, labels = _topics(t)
    scored = _scored(t).join(clusters, "doc_id").join(labels, "topic_cluster")
    return _rounded(text.topic_summary(scored), 9, ["avg_sentiment"])


@query
def sentiment_by_department(t: OrderTables) -> DataFrame:
    """Commentary detail with department, keywords and label."""
    named = linkage.attach_department(_scored(t), order_ledger.cost_centers(t))
    keywords = text.row_top_terms(_weights(t), "doc_id")
    return text.label_match(named, order_ledger.authored_labels(t), "doc_id").join(
        keywords, "doc_id", "left"
    )


@query
def commentary_detail(t: OrderTables) -> DataFrame:
    """The texts with department, score, tone and keywords."""
    scored = _scored(t, keep_text=True)
    named = linkage.attach_department(scored, order_ledger.cost_centers(t))
    keywords = text.row_top_terms(_weights(t), "doc_id")
    return named.join(keywords, "doc_id", "left").select(
        "doc_id", "fiscal_quarter", "department", "commentary_text", "sentiment_score",
        "predicted_tone", "top_keywords",
    )


@query
def tone_distribution(t: OrderTables) -> DataFrame:
    named = linkage.attach_department(_scored(t), order_ledger.cost_centers(t))
    return linkage.tone_distribution(named, p.TONE_DEPARTMENTS)


# ---------------------------------------------------------------- tone and variance

def _opex_variance(t: OrderTables) -> DataFrame:
    return linkage.quarterly_opex_variance(_variance_budget(t))


def _link(t: OrderTables) -> DataFrame:
    return linkage.link_tone(linkage.quarterly_sentiment(_scored(t)), _opex_variance(t))


@query
def quarterly_opex_variance(t: OrderTables) -> DataFrame:
    return _opex_variance(t)


@query
def quarterly_sentiment(t: OrderTables) -> DataFrame:
    return _rounded(linkage.quarterly_sentiment(_scored(t)), 9, ["avg_sentiment"])


@query
def sentiment_variance_link(t: OrderTables) -> DataFrame:
    return _rounded(_link(t), 9, ["avg_sentiment"])


@query
def tone_variance_corr(t: OrderTables) -> DataFrame:
    out = linkage.correlation(_link(t), "avg_sentiment", "variance_pct")
    return _rounded(out, 6, ["correlation"])


@query
def tone_variance_trend(t: OrderTables) -> DataFrame:
    out = linkage.ols(_link(t), "avg_sentiment", "variance_pct", ["cost_center"])
    return _rounded(out, 6, ["slope", "intercept", "r2"])

"""Edge cases and invariants of the planning operators."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ledgerframe.operators import drivers, forecast, models, planning, pnl, recon, scenarios
from ledgerframe.operators.variance import variance, variance_levels
from ledgerframe.sources import dimensions, extracts, schemas, store, tables

D = dt.date
KEYS = "period date, dim1 string, dim2 string, gl_account string, line_type string"


def money(x):
    return Decimal(str(x))


def test_variance_edges(spark):
    plan = spark.createDataFrame(
        [
            (D(2024, 1, 1), "a", "x", "1", "Revenue", money(10)),
            (D(2024, 1, 1), "b", "x", "1", "Revenue", money(0)),
            (D(2024, 1, 1), None, "x", "1", "Revenue", money(7)),
            (D(2024, 1, 1), "d", "x", "1", "Revenue", money(4)),
        ],
        KEYS + ", budget_amount decimal(18,2)",
    )
    actual = spark.createDataFrame(
        [
            (D(2024, 1, 1), "b", "x", "1", "Revenue", money(5)),
            (D(2024, 1, 1), None, "x", "1", "Revenue", money(9)),
            (D(2024, 1, 1), "z", "x", "1", "Revenue", money(1)),
            (D(2024, 1, 1), "d", "x", "1", "Revenue", money(5)),
        ],
        KEYS + ", actual_amount decimal(20,2)",
    )
    got = {r["dim1"]: r for r in variance(plan, actual, "budget_amount").collect()}
    assert set(got) == {"a", "b", None, "d"}
    assert (got["a"]["actual_amount"], got["a"]["variance_abs"]) == (None, -10.0)
    assert (got["b"]["variance_abs"], got["b"]["variance_pct"]) == (5.0, None)
    assert got[None]["actual_amount"] is None and got[None]["variance_abs"] == -7.0
    assert got["d"]["variance_pct"] == 0.25
    filled = variance(plan, actual, "budget_amount", fill_actual=True)
    assert filled.filter("dim1 = 'a'").first()["actual_amount"] == 0.0


def ledger(spark, rows):
    return spark.createDataFrame(
        rows, "period date, debit_credit string, gl_account string, amount decimal(18,2)"
    )


def test_checks_find_seeded_faults(spark):
    accounts = dimensions.chart_of_accounts(spark)
    gl = ledger(
        spark,
        [
            (D(2024, 1, 1), "C", "400000", money(10)),
            (D(2024, 1, 1), "C", "999999", money(1)),
            (D(2024, 2, 1), "C", "400000", money(3)),
        ],
    )
    check = {r["pnl_category"]: r for r in recon.gl_check(gl, accounts).filter("month(period) = 1").collect()}
    assert check[None]["txn_count"] == 1 and check["Revenue"]["gl_total_amount"] == 10.0
    assert [r[0] for r in recon.orphan_accounts(gl, accounts).collect()] == ["999999"]
    source = spark.createDataFrame(
        [(D(2024, 1, 1), money(11)), (D(2024, 3, 1), money(2))], "period date, revenue decimal(18,2)"
    )
    tie = {r["period"].month: r for r in recon.recon_revenue(gl, source).collect()}
    assert tie[1]["variance"] == 0.0
    assert (tie[2]["source_revenue"], tie[2]["variance"]) == (None, 3.0)
    assert (tie[3]["gl_revenue"], tie[3]["variance"]) == (None, -2.0)
    fact = spark.createDataFrame([("a", -1.0), (None, 2.0)], "cost_center string, revenue double")
    assert recon.dq_negative(fact, "revenue").count() == 1
    assert recon.dq_nulls({"f": (fact, "cost_center")}).first()["null_rows"] == 1


def postings(spark, rows):
    return spark.createDataFrame(
        rows,
        "period date, line_type string, dim1 string, dim2 string, gl_account string, "
        "amount decimal(18,2)",
    )


def test_monthly_pnl_and_as_of(spark):
    rows = [
        (D(2024, 1, 1), "Revenue", "p", "c", "400000", money(100)),
        (D(2024, 1, 1), "Opex", "k", "c", "500000", money(30)),
        (D(2024, 1, 1), "Opex", "k", "c", "600000", money(20)),
        (D(2024, 1, 1), "Opex", "k", "c", "999999", money(5)),
        (D(2024, 2, 1), "Opex", "k", "c", "600000", money(8)),
    ]
    out = pnl.pnl_monthly(postings(spark, rows), dimensions.chart_of_accounts(spark))
    jan, feb = out.orderBy("period").collect()
    assert (jan["gross_profit"], jan["ebitda"], jan["gross_margin_pct"]) == (70.0, 50.0, 0.7)
    assert (feb["total_revenue"], feb["ebitda"], feb["ebitda_margin_pct"]) == (0.0, -8.0, None)
    cut = pnl.pnl_monthly(postings(spark, rows), dimensions.chart_of_accounts(spark), D(2024, 1, 1))
    assert cut.count() == 1


def test_cube_agrees_with_monthly_pnl(spark):
    rev = spark.createDataFrame(
        [(D(2024, 1, 1), "PC", "E", "400000", money(100))],
        "period date, profit_center string, company_code string, gl_account string, "
        "revenue decimal(18,2)",
    )
    opx = spark.createDataFrame(
        [(D(2024, 1, 1), "CC", "E", "500000", money(40)), (D(2024, 1, 1), "CC", "E", "600000", money(25))],
        "period date, cost_center string, company_code string, gl_account string, "
        "amount decimal(18,2)",
    )
    both = pnl.actuals_all(rev, opx)
    accounts = dimensions.chart_of_accounts(spark)
    cube = pnl.pnl_cube(
        pnl.monthly_actuals(both),
        dimensions.literal_table(spark, [("E", "Entity", "R", "USD")], schemas.ENTITIES),
        dimensions.literal_table(spark, [("PC", "Seg", "T")], schemas.SEGMENTS),
        dimensions.literal_table(spark, [("CC", "Dep", "F")], schemas.COST_CENTERS),
        accounts,
    )
    assert cube.agg(F.sum("amount")).first()[0] == 35.0
    assert pnl.pnl_monthly(both, accounts).first()["ebitda"] == 35.0
    assert {r["pnl_line"] for r in cube.collect()} == {"Revenue", "COGS", "Opex"}


def test_journal_sides(spark):
    rows = [
        (D(2024, 1, 1), "Revenue", "p", "c", "400000", money(1)),
        (D(2024, 1, 1), "Opex", "k", "c", "600000", money(2)),
    ]
    got = {r["debit_credit"]: r for r in recon.gl_journal(postings(spark, rows)).collect()}
    assert (got["C"]["profit_center"], got["C"]["cost_center"]) == ("p", None)
    assert (got["D"]["profit_center"], got["D"]["cost_center"]) == (None, "k")


def test_budget_and_run_rate(spark):
    actual = spark.createDataFrame(
        [
            (D(2023, 1, 1), "a", "x", "1", "Revenue", money("10.01")),
            (D(2023, 2, 1), "a", "x", "1", "Opex", money(4)),
            (D(2022, 1, 1), "a", "x", "1", "Revenue", money(99)),
        ],
        KEYS + ", actual_amount decimal(20,2)",
    )
    out = planning.budget_build(actual, {2024: {"Revenue": 0.25, "Opex": 0.5}}).collect()
    got = {(r["period"], r["line_type"]): r["budget_amount"] for r in out}
    assert got == {(D(2024, 1, 1), "Revenue"): money("12.51"), (D(2024, 2, 1), "Opex"): money("6.00")}
    months = spark.createDataFrame(
        [(D(2024, m, 1), "a", "x", "1", "Revenue", money(v)) for m, v in
         ((1, 1000), (4, 100), (6, 200), (7, 5))],
        KEYS + ", actual_amount decimal(20,2)",
    )
    ahead = planning.run_rate_forecast(months, D(2024, 6, 1), 2, {"Revenue": 0.1})
    rows = ahead.orderBy("period").collect()
    assert [r["period"] for r in rows] == [D(2024, 7, 1), D(2024, 8, 1)]
    assert [r["forecast_amount"] for r in rows] == [money("165.00"), money("181.50")]


def test_lrp_factors(spark):
    rows = [
        (D(2026, m, 1), line, "a", "b", "1", money(v))
        for m in range(1, 7) for line, v in (("Revenue", 100), ("Opex", 60))
    ]
    growth = [(2027, 0.5, 0.0), (2028, 0.2, 0.1)]
    first, second = planning.lrp_plan(postings(spark, rows), growth, 2026).orderBy("fiscal_year").collect()
    assert (first["plan_revenue"], first["plan_opex"]) == (1800.0, 720.0)
    assert (second["plan_revenue"], second["plan_opex"], second["plan_ebitda"]) == (2160.0, 792.0, 1368.0)
    assert first["revenue_cagr"] == 0.5
    fixed = planning.lrp_plan(postings(spark, rows), growth, 2026, annualize_factor=1.0)
    assert fixed.orderBy("fiscal_year").first()["plan_revenue"] == 900.0


def test_rollforward_floor(spark):
    rng = random.Random(3)
    months = [D(2020 + m // 12, m % 12 + 1, 1) for m in range(30)]
    rows = [(k, m, float(rng.randint(0, 5)), float(rng.randint(0, 6))) for k in "ab" for m in months]
    flows = spark.createDataFrame(
        rows, "s string, period date, new_logos double, churned_customers double"
    )
    got = {
        (r["s"], r["period"]): r["customers"]
        for r in drivers.customer_rollforward(flows, ["s"], 4.0).collect()
    }
    for k in "ab":
        c = 4.0
        for s, m, new, gone in rows:
            if s == k:
                c = max(0.0, c + new - gone)
                assert got[k, m] == c


def test_whatif_clips_churn(spark):
    row = [(D(2024, 1, 1), "s", 100.0, 1000.0, 10.0, 1.0)]
    base = drivers.driver_model(
        spark.createDataFrame(
            row, "period date, profit_center string, customers double, revenue double, "
                 "new_logos double, churned_customers double",
        )
    )
    out = drivers.whatif(base, arpu_pct=10, churn_pp=-5)
    r = out.first()
    assert r["churn_rate_adjusted"] == 0.0
    assert r["customers_adjusted"] == pytest.approx(101.0)
    assert r["revenue_adjusted"] == pytest.approx(1111.0)
    same = drivers.whatif_impact(drivers.whatif(base)).first()
    assert same["impact"] == 0.0


def test_allocation_keeps_totals(spark):
    totals = spark.createDataFrame([("m", 100.0)], "period string, revenue double")
    out = drivers.allocate_by_mix(totals, "revenue", dimensions.ENTITY_MIX)
    assert {r["company_code"]: r["revenue"] for r in out.collect()} == pytest.approx(
        {"1000": 55.0, "2000": 30.0, "3000": 15.0}
    )
    with pytest.raises(ValueError):
        drivers.allocate_by_mix(totals, "revenue", [("a", 0.5)])
    heads = spark.createDataFrame(
        [(D(2024, 1, 1), "k", "e", 3.0, 120000.0)],
        "period date, cost_center string, company_code string, headcount double, "
        "avg_fully_loaded_cost double",
    )
    ratios = spark.createDataFrame([("k", "610000", 0.35)], "cost_center string, gl_account string, ratio double")
    parts = drivers.opex_allocate(heads, dimensions.PAYROLL_SPLIT, ratios)
    assert {r["gl_account"]: float(r["amount"]) for r in parts.collect()} == {
        "600000": 23400.0, "600100": 4800.0, "600200": 1800.0, "610000": 10500.0
    }


def test_scenario_inputs(spark):
    fc = spark.createDataFrame(
        [(D(2024, 1, 1), "Revenue", money("10.50"))],
        "period date, line_type string, forecast_amount decimal(18,2)",
    )
    chosen = scenarios.scenarios_from(dimensions.SCENARIOS)
    base = scenarios.scenario_pnl(fc, chosen).filter("scenario = 'Base'").first()
    assert (base["revenue"], base["opex"]) == (10.5, 0.0)


def months_series(spark, values, skip=()):
    rows = [
        (D(2020 + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(values) if i not in skip
    ]
    return spark.createDataFrame(rows, "period date, y double")


def test_features_guard_short_windows(spark):
    out = forecast.forecast_features(months_series(spark, range(1, 6)), complete=False)
    means = [r["rolling_mean_3"] for r in out.orderBy("period").collect()]
    assert means == [None, None, None, 2.0, 3.0]
    assert forecast.forecast_features(months_series(spark, range(5))).count() == 0


def test_yoy_with_a_missing_month(spark):
    out = pnl.yoy(months_series(spark, range(100, 126), skip={1}), "y").collect()
    got = {r["period"]: r["yoy_growth"] for r in out}
    assert got[D(2021, 1, 1)] == 0.12 and got[D(2021, 2, 1)] is None


def test_recursion_matches_a_loop(spark):
    values = [100 + 3 * i + (i % 5) for i in range(20)]
    b = [0.5, 0.1, 0.2, 0.4, 0.1, 0.05, 0.2, 0.15, 0.1]
    hist = forecast.history(months_series(spark, values))
    out = forecast.forecast_recursive(hist, F.lit(2.0), F.array(*[F.lit(x) for x in b]), 5)
    got = [r["forecast"] for r in out.orderBy("period").collect()]
    run = [float(v) for v in values]
    for i in range(5):
        m = (20 + i) % 12 + 1
        x = [20 + i, m, (m - 1) // 3 + 1, run[-1], run[-2], run[-3], run[-12],
             sum(run[-3:]) / 3, sum(run[-6:]) / 6]
        run.append(2.0 + sum(u * v for u, v in zip(x, b, strict=True)))
    assert got == pytest.approx(run[20:])
    # fewer months than the deepest lag: the oldest value stands in
    short = forecast.history(months_series(spark, [5.0, 7.0]))
    only_lag_12 = [0.0] * 6 + [1.0, 0.0, 0.0]
    first = forecast.forecast_recursive(
        short, F.lit(0.0), F.array(*[F.lit(x) for x in only_lag_12]), 1
    ).first()
    assert first["forecast"] == 5.0


def test_files_round_trip(spark, tmp_path):
    rows = [(D(2024, 1, 1), "a, \"b\"", "01", "400000", money("1.10"))]
    df = spark.createDataFrame(rows, schemas.OPEX)
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), schemas.OPEX)
    assert back.collect() == df.collect()
    tables.write_table(df, str(tmp_path / "table"))
    assert (tmp_path / "table" / "fiscal_year=2024").is_dir()
    assert tables.read_table(spark, str(tmp_path / "table"), "period").first()["amount"] == money("1.10")
    tables.create_views({"opex_view": df})
    assert spark.sql("SELECT count(*) FROM opex_view").first()[0] == 1
    profile = tables.table_profile({"opex": df}).first()
    assert (profile["row_count"], profile["column_count"]) == (1, 5)


TEXTS = [
    'plain', 'two\nlines', 'quotes "in" it', '"', '""\n"', ' blanks at both ends ', 'a,b', 'crlf\r\ninside',
    '\n', 'ends with a break\n', '', None, 'x' * 700, 'long\n' * 400, '"\n' * 150, 'back\\slash',
]


@pytest.mark.parametrize("split_bytes", [64, 1000, 1 << 20])
def test_free_text_csv_is_read_by_many_tasks(spark, tmp_path, split_bytes):
    rows = [(n, TEXTS[n % len(TEXTS)], n * 2) for n in range(90)]
    df = spark.createDataFrame(rows, "id INT, text STRING, n LONG")
    tables.write_csv(df.coalesce(1), str(tmp_path / "one"))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = tables.read_text_csv(spark, str(tmp_path / "one"), df.schema).collect()
        if split_bytes < 1 << 20:
            assert spark.read.option("lineSep", "\n").text(str(tmp_path / "one")).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.files.openCostInBytes", kept[1])
    want = tables.read_csv(spark, str(tmp_path / "one"), df.schema, multi_line=True).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) == [(a, b or None, c) for a, b, c in rows]


def test_free_text_csv_of_several_files(spark, tmp_path):
    df = spark.createDataFrame([(n, TEXTS[n % len(TEXTS)]) for n in range(64)], "id INT, text STRING")
    tables.write_csv(df.repartition(5), str(tmp_path / "five"))
    got = tables.read_text_csv(spark, str(tmp_path / "five"), df.schema)
    assert sorted(map(tuple, got.collect())) == sorted((a, b or None) for a, b in df.collect())
    tables.write_csv(df.limit(0), str(tmp_path / "none"))
    assert tables.read_text_csv(spark, str(tmp_path / "none"), df.schema).collect() == []


def _opex(spark, rows):
    return spark.createDataFrame([(day, "CC", "01", "400000", money(x)) for day, x in rows], schemas.OPEX)


def test_stored_table_is_replaced_whole_or_by_year(spark, tmp_path):
    path = str(tmp_path / "stored")
    amounts = lambda: sorted((str(r["period"]), str(r["amount"])) for r in store.read_stored(spark, path).collect())
    store.replace_table(_opex(spark, [(D(2023, 1, 1), "1.00"), (D(2024, 1, 1), "2.00"), (None, "3.00")]), path)
    assert amounts() == [("2023-01-01", "1.00"), ("2024-01-01", "2.00"), ("None", "3.00")]
    store.replace_table(_opex(spark, [(D(2024, 5, 1), "9.00")]), path, only_years=True)
    assert amounts() == [("2023-01-01", "1.00"), ("2024-05-01", "9.00"), ("None", "3.00")]
    one = store.read_stored(spark, path).filter("fiscal_year = 2024")
    assert len(one.inputFiles()) == 3 and "PartitionFilters: [isnotnull(fiscal_year" in one._jdf.queryExecution().toString()
    store.replace_table(_opex(spark, [(D(2022, 1, 1), "5.00")]), path)
    assert amounts() == [("2022-01-01", "5.00")]
    store.replace_table(_opex(spark, []), path)
    assert amounts() == [] and store.read_stored(spark, path).columns == [*schemas.OPEX.names, "fiscal_year"]


def test_a_write_that_stops_half_way_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "stored")
    store.replace_table(_opex(spark, [(D(2023, 1, 1), "1.00")]), path)
    broken = _opex(spark, [(D(2023, 1, 1), "7.00"), (D(2024, 1, 1), "8.00")]).withColumn(
        "amount", F.when(F.year("period") == 2024, F.raise_error("stopped").cast(schemas.OPEX["amount"].dataType))
        .otherwise(F.col("amount"))
    )
    with pytest.raises(Exception, match="stopped"):
        store.replace_table(broken, path)
    assert [r["amount"] for r in store.read_stored(spark, path).collect()] == [money("1.00")]


def test_levels_add_up(spark):
    rows = [(D(2024, m, 1), "Revenue", 10.0 * m, 11.0 * m) for m in range(1, 7)] + [(None, "Revenue", 1.0, None)]
    detail = spark.createDataFrame(rows, "period DATE, line_type STRING, budget_amount DOUBLE, actual_amount DOUBLE")
    got = variance_levels(detail, "budget_amount").collect()
    by = lambda level: {(r["fiscal_year"], r["fiscal_quarter"], r["period"]): r for r in got if r["level"] == level}
    assert [len(by(x)) for x in ("month", "quarter", "year", "all")] == [7, 3, 2, 1]
    assert by("quarter")[2024, "Q2", None]["budget_amount"] == 150.0
    assert by("month")[None, None, None]["actual_amount"] == 0.0
    assert by("all")[None, None, None]["variance_abs"] == 20.0
    assert by("year")[2024, None, None]["variance_pct"] == 0.1


def test_pooled_fit_equals_the_fit_of_one_series(spark):
    random.seed(4)
    rows = []
    for key in ("a", "b"):
        for n in range(60):
            x, z = random.random() * 1e6, random.random()
            rows.append((key, D(2020 + n // 12, n % 12 + 1, 1), x, z, x / 2 - 3, 3 * x + 1e5 * z + random.random()))
    df = spark.createDataFrame(rows, "k STRING, period DATE, x DOUBLE, z DOUBLE, w DOUBLE, y DOUBLE")
    for columns in (["x", "z"], ["x", "w", "z"]):
        plain = {r["k"]: r for r in models.linear_coefficients(df, ["k"], columns).collect()}
        pooled = {r["k"]: r for r in models.pooled_coefficients(df, ["k"], columns).collect()}
        at = [5e5, 0.5] if len(columns) == 2 else [5e5, 5e5 / 2 - 3, 0.5]
        value = lambda r: r["intercept"] + sum(b * x for b, x in zip(r["coefficients"], at, strict=True))  # noqa: E731,B023
        assert plain.keys() == pooled.keys()
        for k in plain:
            assert value(pooled[k]) == pytest.approx(value(plain[k]), rel=1e-9)
    plan = models.pooled_coefficients(df, ["k"], ["x", "z"])._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan


@pytest.mark.parametrize("split_bytes", [70, 1 << 20])
def test_extract_is_read_by_years_and_splits(spark, tmp_path, split_bytes):
    path = str(tmp_path / "extract")
    days = [D(2022 + n % 3, 1 + n % 12, 1) for n in range(200)] + [None]
    rows = [(day, f'c"{n},' if n % 7 else None, " 01", "0400", money(f"{n}.25")) for n, day in enumerate(days)]
    extracts.write_extract(spark.createDataFrame(rows, schemas.OPEX), path)
    got = extracts.read_extract(spark, path, schemas.OPEX, split_bytes)
    plain = lambda found: sorted(map(str, (tuple(r)[:5] for r in found)))
    assert plain(got.collect()) == plain(rows)
    assert {(r["period"] and r["period"].year, r["fiscal_year"]) for r in got.collect()} == {
        (None, None), (2022, 2022), (2023, 2023), (2024, 2024)
    }
    for condition, years in (
        ("fiscal_year = 2023", {2023}), ("fiscal_year IN (2022, 2024)", {2022, 2024}),
        ("fiscal_year > 2022 AND fiscal_year <= 2023 AND amount > 3", {2023}), ("fiscal_year < 2000", set()),
    ):
        some = got.filter(condition)
        assert plain(some.collect()) == plain(r for r in rows if r[0] and r[0].year in years and (r[4] > 3 or "amount" not in condition))
        plan = some._jdf.queryExecution().explainString(some._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        pushed, left = (
            [line for line in plan.splitlines() if line.startswith(start)] for start in ("PushedFilters", "Condition")
        )
        assert "fiscal_year" in pushed[0] and "fiscal_year" not in "".join(left), (condition, plan)


def test_extract_of_another_layout_fails(spark, tmp_path):
    path = str(tmp_path / "extract")
    extracts.write_extract(_opex(spark, [(D(2023, 1, 1), "1.00")]), path)
    with pytest.raises(Exception, match="declared are"):
        extracts.read_extract(spark, path, schemas.HEADCOUNT).collect()
    with pytest.raises(Exception, match="no columns of type"):
        extracts.read_extract(spark, path, StructType([*schemas.OPEX.fields[:-1], StructField("amount", BinaryType())])).collect()

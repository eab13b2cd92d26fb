"""Budget, run-rate forecast and long-range plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MONEY, dbl, or_zero, ratio, safe_div, to_money
from ..functions.periods import add_months
from ..functions.rows import literal_rows

PLAN_KEYS = ["dim1", "dim2", "gl_account", "line_type"]


def _by_line(rates: Mapping[str, float]) -> Column:
    """Rate of the row's line type; NULL for a line without one."""
    out: Column | None = None
    for line, rate in rates.items():
        cond, value = F.col("line_type") == line, F.lit(Decimal(str(rate)))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out


def budget_build(
    actuals: DataFrame, growth: Mapping[int, Mapping[str, float]]
) -> DataFrame:
    """Budget of each target year from the prior year's months and a growth per line.

    ``actuals`` are monthly actuals and ``growth`` maps a target year to the rate of
    each line type. Years without prior months come out empty.
    """
    target = F.year("period") + 1
    rate: Column | None = None
    for year, rates in growth.items():
        cond, value = target == year, _by_line(rates)
        rate = F.when(cond, value) if rate is None else rate.when(cond, value)
    # filtered on the amount, not on the rate: see variance() on sharing the actuals
    return actuals.select(
        F.add_months("period", 12).alias("period"),
        *PLAN_KEYS,
        to_money(F.col("actual_amount") * (1 + rate)).alias("budget_amount"),
    ).filter(F.col("budget_amount").isNotNull())


def run_rate_forecast(
    actuals: DataFrame,
    as_of: date,
    horizon: int,
    growth: Mapping[str, float],
    trailing: int = 3,
) -> DataFrame:
    """Mean of the last months carried forward with monthly growth, per plan key.

    ``actuals`` are monthly actuals; give it those from the first trailing month on. The
    mean is over the months in which the key has postings. Future months are unfolded
    from a sequence, not joined. Months outside the trailing ones are masked rather than
    filtered: see variance() on sharing the actuals.
    """
    recent = (F.col("period") > F.lit(add_months(as_of, -trailing))) & (
        F.col("period") <= F.lit(as_of)
    )
    amount = F.when(recent, F.col("actual_amount"))
    base = actuals.groupBy(*PLAN_KEYS).agg(
        safe_div(F.sum(amount), F.count(amount)).alias("run_rate")
    )
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("i")
    grown = F.col("run_rate") * F.pow(1 + dbl(_by_line(growth)), F.col("i"))
    return (
        base.select("*", ahead)
        .select(
            F.add_months(F.lit(as_of), F.col("i")).alias("period"),
            *PLAN_KEYS,
            to_money(grown).alias("forecast_amount"),
        )
        .filter(F.col("forecast_amount").isNotNull())
    )


def lrp_plan(
    postings: DataFrame,
    growth: Sequence[tuple[int, float, float]],
    base_year: int,
    annualize_factor: float | None = None,
) -> DataFrame:
    """Yearly plan from an annualised base, compounded with a rate per year.

    ``growth`` holds (year, revenue growth, opex growth) in year order. The base year is
    scaled by 12 / (months it has), or by ``annualize_factor``.
    """
    revenue = list(accumulate((1 + r for _, r, _ in growth), lambda a, b: a * b))
    opex = list(accumulate((1 + o for _, _, o in growth), lambda a, b: a * b))
    steps = [
        (year, n, rev, opx)
        for n, ((year, _, _), rev, opx) in enumerate(zip(growth, revenue, opex, strict=True), 1)
    ]
    sale = F.col("line_type") == "Revenue"
    base = (
        postings.filter(F.year("period") == base_year)
        .groupBy("period")
        .agg(
            or_zero(F.sum(F.when(sale, F.col("amount")))).alias("revenue"),
            or_zero(F.sum(F.when(~sale, F.col("amount")))).alias("opex"),
        )
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("opex").alias("opex"),
            F.count(F.lit(1)).alias("months"),
        )
    )
    if annualize_factor is None:
        factor = safe_div(F.lit(12), "months")
    else:
        factor = F.lit(float(annualize_factor))
    plan = base.select(
        (dbl("revenue") * factor).alias("base_revenue"),
        (dbl("opex") * factor).alias("base_opex"),
        literal_rows(("fiscal_year", "n", "rev", "opx"), steps).alias("s"),
    ).select(
        "base_revenue",
        "s.*",
        (F.col("base_revenue") * F.col("s.rev")).alias("revenue"),
        (F.col("base_opex") * F.col("s.opx")).alias("opex"),
    )
    ebitda = F.col("revenue") - F.col("opex")
    growth_rate = F.pow(safe_div("revenue", "base_revenue"), 1 / F.col("n")) - 1
    return plan.select(
        "fiscal_year",
        F.round("revenue", 0).alias("plan_revenue"),
        F.round("opex", 0).alias("plan_opex"),
        F.round(ebitda, 0).alias("plan_ebitda"),
        ratio(ebitda, "revenue", 4).alias("plan_ebitda_margin"),
        F.round(growth_rate, 6).alias("revenue_cagr"),
    )


def as_money(plan: DataFrame, column: str) -> DataFrame:
    """Plan rows with the amount as DOUBLE, the form in which results leave."""
    return plan.withColumn(column, dbl(F.col(column).cast(MONEY)))

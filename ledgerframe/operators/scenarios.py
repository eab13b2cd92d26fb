"""Scenario flexing of a forecast and of a long-range plan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dbl, or_zero, ratio
from ..functions.rows import literal_rows

ORDER = ("Downside", "Base", "Upside")


class Scenario(NamedTuple):
    scenario: str
    rev_growth_delta: float
    churn_delta: float
    opex_growth_delta: float


def scenarios_from(rows: Iterable[Sequence]) -> list[Scenario]:
    """Scenarios from literal rows; what follows the four fields is left out.

    Assumptions are parameters of a plan: a table of them is read by its owner.
    """
    return [Scenario(*tuple(r)[:4]) for r in rows]


def _factors(scenarios: Iterable[Scenario], years: int) -> Column:
    """Scenario name with its revenue and opex factor, exact in decimal."""

    def d(x: float) -> Decimal:
        return Decimal(str(x)) * years

    rows = [
        (
            s.scenario,
            (1 + d(s.rev_growth_delta) - d(s.churn_delta)).quantize(Decimal("0.000001")),
            (1 + d(s.opex_growth_delta)).quantize(Decimal("0.000001")),
        )
        for s in scenarios
    ]
    return literal_rows(("scenario", "rev_factor", "opex_factor"), rows)


def scenario_pnl(forecast: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """Forecast months under each scenario: revenue, opex and an EBITDA proxy.

    A month without one of the two lines has 0 there.
    """
    wide = forecast.groupBy("period").pivot("line_type", ["Revenue", "Opex"]).agg(
        F.sum("forecast_amount")
    )
    flexed = wide.select("period", "Revenue", "Opex", _factors(scenarios, 1).alias("s")).select(
        "s.scenario",
        "period",
        (or_zero("Revenue") * F.col("s.rev_factor")).alias("rev"),
        (or_zero("Opex") * F.col("s.opex_factor")).alias("opx"),
    )
    return flexed.select(
        "scenario",
        "period",
        dbl(F.round("rev", 2)).alias("revenue"),
        dbl(F.round("opx", 2)).alias("opex"),
        dbl(F.round(F.col("rev") - F.col("opx"), 2)).alias("ebitda_proxy"),
    )


def lrp_scenarios(lrp: DataFrame, scenarios: Sequence[Scenario], years: int = 3) -> DataFrame:
    """Long-range plan under each scenario; the deltas count ``years`` times in every year."""
    amount = "decimal(20,2)"
    flexed = lrp.select("fiscal_year", "plan_revenue", "plan_opex", _factors(scenarios, years).alias("s"))
    flexed = flexed.select(
        "s.scenario",
        "fiscal_year",
        (F.col("plan_revenue").cast(amount) * F.col("s.rev_factor")).alias("rev"),
        (F.col("plan_opex").cast(amount) * F.col("s.opex_factor")).alias("opx"),
    )
    ebitda = F.col("rev") - F.col("opx")
    return flexed.select(
        "scenario",
        "fiscal_year",
        dbl(F.round("rev", 2)).alias("plan_revenue"),
        dbl(F.round("opx", 2)).alias("plan_opex"),
        dbl(F.round(ebitda, 2)).alias("plan_ebitda"),
        ratio(ebitda, "rev").alias("plan_ebitda_margin"),
    )


def scenario_summary(scenario_months: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Totals and margin per scenario, in label order (``scenario_rank``)."""
    exact = "decimal(28,2)"
    sums = scenario_months.groupBy("scenario").agg(
        *[
            F.sum(F.col(c).cast(exact)).alias(c)
            for c in ("revenue", "opex", "ebitda_proxy")
        ]
    )
    rank = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("scenario"))
    return sums.select(
        F.when(rank > 0, rank).otherwise(len(order) + 1).cast("int").alias("scenario_rank"),
        "scenario",
        dbl("revenue").alias("revenue"),
        dbl("opex").alias("opex"),
        dbl("ebitda_proxy").alias("ebitda_proxy"),
        ratio("ebitda_proxy", "revenue").alias("ebitda_margin"),
    ).orderBy("scenario_rank", "scenario")

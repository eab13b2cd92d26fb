"""Revenue and cost drivers, what-if adjustments, allocations and roll-forwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import MONEY, dbl, or_zero, ratio, safe_div
from ..functions.rows import literal_rows


def driver_model(revenue: DataFrame) -> DataFrame:
    """Customers, revenue per customer and churn by month and segment.

    ``revenue`` should be at segment grain: customers of finer cells are added up.

    Rows without a customer count are left out. Churn is over the closing base.
    """
    sums = (
        revenue.dropna(subset=["customers"])
        .groupBy("period", "profit_center")
        .agg(
            F.sum("customers").alias("customers"),
            F.sum("revenue").alias("revenue"),
            F.sum("new_logos").alias("new_logos"),
            F.sum("churned_customers").alias("churned"),
        )
    )
    return sums.select(
        "period",
        "profit_center",
        "customers",
        dbl("revenue").alias("revenue"),
        "new_logos",
        "churned",
        safe_div("revenue", "customers").alias("arpu_implied"),
        (F.col("new_logos") - F.col("churned")).alias("net_new_customers"),
        safe_div("churned", "customers").alias("churn_rate_implied"),
    )


def whatif(drivers: DataFrame, arpu_pct: float = 0.0, churn_pp: float = 0.0) -> DataFrame:
    """Drivers under a changed revenue per customer (%) and churn rate (points)."""
    churn = F.greatest(F.col("churn_rate_implied") + churn_pp / 100, F.lit(0.0))
    return (
        drivers.withColumns(
            {
                "arpu_adjusted": F.col("arpu_implied") * (1 + arpu_pct / 100),
                "churn_rate_adjusted": churn,
            }
        )
        .withColumn(
            "customers_adjusted",
            F.col("customers")
            * (1 - (F.col("churn_rate_adjusted") - F.col("churn_rate_implied"))),
        )
        .withColumn("revenue_adjusted", F.col("customers_adjusted") * F.col("arpu_adjusted"))
    )


def whatif_impact(adjusted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total revenue before and after, with the change and its share."""
    sums = adjusted.groupBy(*keys).agg(
        F.sum(F.round("revenue", 2).cast("decimal(28,2)")).alias("before"),
        F.sum(F.round("revenue_adjusted", 6).cast("decimal(28,6)")).alias("after"),
    )
    return sums.select(
        *keys,
        dbl("before").alias("revenue"),
        dbl(F.round("after", 2)).alias("revenue_adjusted"),
        dbl(F.round(F.col("after") - F.col("before"), 2)).alias("impact"),
        ratio(F.col("after") - F.col("before"), "before").alias("impact_pct"),
    )


def opex_per_headcount(opex: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Monthly expense (cost of sales included) over heads, for months that have both.

    Without ``heads`` the expense table has the ``headcount`` too.
    """
    amount, people = F.sum("amount").alias("amount"), F.sum("headcount").alias("total_headcount")
    if heads is None:
        both = opex.groupBy("period").agg(amount, people)
    else:
        both = opex.groupBy("period").agg(amount).join(
            heads.groupBy("period").agg(people), "period"
        )
    return both.select(
        "period",
        dbl("amount").alias("amount"),
        "total_headcount",
        safe_div("amount", "total_headcount").alias("opex_per_headcount_monthly"),
    )


def opex_allocate(
    heads: DataFrame,
    payroll_split: Sequence[tuple[str, float]],
    ratios: DataFrame,
) -> DataFrame:
    """Expense by account derived from headcount.

    Monthly payroll is heads x loaded cost / 12. It is split over the payroll accounts,
    and ``ratios`` (cost_center, gl_account, ratio) adds further accounts as shares of it.
    The products are exact decimals, so half a cent rounds up wherever it is computed.
    """
    yearly = F.col("headcount").cast("decimal(12,4)") * F.col("avg_fully_loaded_cost").cast(
        "decimal(14,2)"
    )
    pay = heads.select("period", "cost_center", "company_code", yearly.alias("pay"))
    split = pay.select("*", literal_rows(("gl_account", "ratio"), payroll_split).alias("s"))
    other = pay.join(ratios, "cost_center")
    columns = ["period", "cost_center", "company_code", "pay"]
    return (
        split.select(*columns, "s.gl_account", "s.ratio")
        .unionByName(other.select(*columns, "gl_account", "ratio"))
        .select(
            "period",
            "cost_center",
            "company_code",
            "gl_account",
            F.round(F.col("pay") * F.col("ratio").cast("decimal(8,5)") / 12, 2)
            .cast(MONEY)
            .alias("amount"),
        )
    )


def allocate_by_mix(
    totals: DataFrame, amount: str, mix: Sequence[tuple[str, float]], target: str = "company_code"
) -> DataFrame:
    """Spread each row's amount over the members of a mix that sums to one."""
    if abs(sum(share for _, share in mix) - 1.0) > 1e-9:
        raise ValueError("mix shares must sum to 1")
    rest = [c for c in totals.columns if c != amount]
    return totals.select("*", literal_rows((target, "share"), mix).alias("m")).select(
        *rest,
        f"m.{target}",
        "m.share",
        (dbl(amount) * F.col("m.share")).alias(amount),
    )


def services_attach(
    revenue: DataFrame,
    segments: DataFrame,
    rate: float = 0.11,
    base_type: str = "Subscription",
) -> DataFrame:
    """Services revenue implied by the month's revenue of the base segments."""
    per_segment = revenue.groupBy("period", "profit_center").agg(F.sum("revenue").alias("revenue"))
    base = segments.filter(F.col("segment_type") == base_type).select("profit_center")
    return (
        per_segment.join(base, "profit_center", "left_semi")
        .groupBy("period")
        .agg(F.sum("revenue").alias("base_revenue"))
        .select(
            "period",
            dbl("base_revenue").alias("base_revenue"),
            F.round(dbl("base_revenue") * rate, 2).alias("services_revenue"),
        )
    )


def customer_rollforward(
    flows: DataFrame, keys: Sequence[str], opening: float = 0.0
) -> DataFrame:
    """Closing customers ``max(0, previous + new - churned)`` month by month.

    The floor at zero is a running sum plus its deepest fall below zero so far, so the
    recursion needs two window sums and no per-series loop. A series holds one row per
    month; flows are summed to that first.
    """
    monthly = flows.groupBy(*keys, "period").agg(
        or_zero(F.sum("new_logos")).alias("new_logos"),
        or_zero(F.sum("churned_customers")).alias("churned_customers"),
    )
    to_date = (
        Window.partitionBy(*keys)
        .orderBy("period")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    net = F.lit(float(opening)) + F.sum(F.col("new_logos") - F.col("churned_customers")).over(to_date)
    free = monthly.withColumn("free", net)
    closing = F.col("free") - F.least(F.min("free").over(to_date), F.lit(0.0))
    return free.select(
        *keys, "period", "new_logos", "churned_customers", closing.alias("customers")
    )

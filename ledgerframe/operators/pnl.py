"""P&L cube, monthly and quarterly P&L, year-over-year, segment mix."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dbl, ratio
from ..functions.periods import (
    fiscal_quarter,
    fiscal_year,
    is_actual,
    month_index,
    month_label,
    quarter_index,
)

ACTUAL_KEYS = ["period", "dim1", "dim2", "gl_account", "line_type"]


def calendar_dim(bounds: DataFrame, as_of: date, start: str = "start", end: str = "end") -> DataFrame:
    """Month spine with fiscal attributes between the two dates of a one-row frame."""
    month = F.explode(
        F.sequence(
            F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH")
        )
    )
    return bounds.select(month.alias("period")).select(
        "period",
        fiscal_year("period").alias("fiscal_year"),
        fiscal_quarter("period").alias("fiscal_quarter"),
        month_label("period").alias("month_name"),
        is_actual("period", as_of).alias("is_actual"),
    )


def actuals_all(revenue: DataFrame, opex: DataFrame) -> DataFrame:
    """Separately stored revenue and opex facts as one frame of postings."""
    sales = revenue.select(
        "period",
        F.lit("Revenue").alias("line_type"),
        F.col("profit_center").alias("dim1"),
        F.col("company_code").alias("dim2"),
        "gl_account",
        F.col("revenue").alias("amount"),
    )
    costs = opex.select(
        "period",
        F.lit("Opex").alias("line_type"),
        F.col("cost_center").alias("dim1"),
        F.col("company_code").alias("dim2"),
        "gl_account",
        "amount",
    )
    return sales.unionByName(costs)


def monthly_actuals(postings: DataFrame) -> DataFrame:
    """Postings summed to one row per month, dimensions, account and line type."""
    return postings.groupBy(*ACTUAL_KEYS).agg(F.sum("amount").alias("actual_amount"))


def pnl_cube(
    actuals: DataFrame,
    entities: DataFrame,
    segments: DataFrame,
    cost_centers: DataFrame,
    accounts: DataFrame,
) -> DataFrame:
    """Monthly P&L with names: revenue positive, expense negative.

    ``actuals`` are monthly actuals; names are attached after the sums, so the three
    lookups run over months, not postings. Revenue codes are looked up in segments and
    expense codes in cost centres, and a code missing from its table drops out.
    """
    names = segments.select(
        F.lit("Revenue").alias("line_type"),
        F.col("profit_center").alias("dim1"),
        "segment_name",
    ).unionByName(
        cost_centers.select(
            F.lit("Opex").alias("line_type"),
            F.col("cost_center").alias("dim1"),
            F.col("department").alias("segment_name"),
        )
    )
    sale = F.col("line_type") == "Revenue"
    amount = F.round("actual_amount", 2)
    return (
        actuals.join(entities.select(F.col("company_code").alias("dim2"), "entity_name"), "dim2")
        .join(names, ["line_type", "dim1"])
        .join(accounts.select("gl_account", "account_name", "pnl_category"), "gl_account")
        .select(
            "period",
            F.date_format("period", "yyyy").alias("fiscal_year"),
            F.col("dim2").alias("company_code"),
            "entity_name",
            F.when(sale, F.col("dim1")).alias("profit_center"),
            "segment_name",
            F.when(sale, F.lit("Revenue")).otherwise(F.col("pnl_category")).alias("pnl_line"),
            "gl_account",
            "account_name",
            dbl(F.when(sale, amount).otherwise(-amount)).alias("amount"),
        )
    )


def pnl_monthly(
    postings: DataFrame,
    accounts: DataFrame,
    as_of: date | None = None,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Company P&L by month, from one aggregation over all postings.

    Expense counts as cost of sales or as operating expense by its account's category;
    any other category drops out. ``as_of`` and ``years`` keep a part of the months.
    """
    if as_of is not None:
        postings = postings.filter(is_actual("period", as_of))
    if years is not None:
        postings = postings.filter(F.year("period").isin(*years))
    per_account = postings.groupBy("period", "line_type", "gl_account").agg(
        F.sum("amount").alias("amount")
    )
    coded = per_account.join(accounts.select("gl_account", "pnl_category"), "gl_account", "left")
    sale = F.col("line_type") == "Revenue"

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("amount"))), F.lit(0))

    sums = coded.groupBy("period").agg(
        total(sale).alias("total_revenue"),
        total(~sale & (F.col("pnl_category") == "COGS")).alias("total_cogs"),
        total(~sale & (F.col("pnl_category") == "Opex")).alias("total_opex_below_gm"),
    )
    return with_margins(sums).select("period", *PNL_COLUMNS)


PNL_COLUMNS = [
    "total_revenue",
    "total_cogs",
    "total_opex_below_gm",
    "gross_profit",
    "gross_margin_pct",
    "ebitda",
    "ebitda_margin_pct",
]


def with_margins(sums: DataFrame) -> DataFrame:
    """Add gross profit, EBITDA and their margins to the three totals."""
    gross = F.col("total_revenue") - F.col("total_cogs")
    ebitda = gross - F.col("total_opex_below_gm")
    return sums.withColumns(
        {
            "total_revenue": dbl("total_revenue"),
            "total_cogs": dbl("total_cogs"),
            "total_opex_below_gm": dbl("total_opex_below_gm"),
            "gross_profit": dbl(F.round(gross, 2)),
            "gross_margin_pct": ratio(gross, "total_revenue"),
            "ebitda": dbl(F.round(ebitda, 2)),
            "ebitda_margin_pct": ratio(ebitda, "total_revenue"),
        }
    )


def _year_ago(value: str, step: Column, keys: Sequence[str], distance: int) -> Column:
    """Value ``distance`` periods earlier by calendar, NULL where that period is missing."""
    frame = Window.partitionBy(*keys).orderBy(step).rangeBetween(-distance, -distance)
    return F.first(value).over(frame)


def yoy(series: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Growth over the same month of the prior year, per series.

    A calendar-distance frame instead of a self-join: a series with a missing month
    compares with the right month or with nothing. Takes month-grain rows.
    """
    return series.withColumn(
        "prior_year", _year_ago(value, month_index("period"), keys, 12)
    ).withColumn("yoy_growth", ratio(F.col(value) - F.col("prior_year"), "prior_year"))


def pnl_quarterly(pnl: DataFrame) -> DataFrame:
    """Quarter P&L from monthly P&L: margins of the sums, growth over the quarter a year ago."""
    sums = pnl.groupBy(
        F.year("period").alias("fiscal_year"),
        F.quarter("period").alias("quarter"),
        quarter_index("period").alias("step"),
    ).agg(
        *[
            F.sum(F.col(c).cast("decimal(28,2)")).alias(c)
            for c in ("total_revenue", "total_cogs", "total_opex_below_gm")
        ]
    )
    prior = _year_ago("total_revenue", F.col("step"), (), 4)
    return (
        with_margins(sums)
        .withColumn("yoy_growth", ratio(F.col("total_revenue") - prior, prior))
        .select(
            "fiscal_year",
            F.concat(F.lit("Q"), F.col("quarter").cast("string")).alias("fiscal_quarter"),
            *PNL_COLUMNS,
            "yoy_growth",
        )
    )


def pnl_levels(pnl: DataFrame) -> DataFrame:
    """Month, quarter and year P&L from monthly P&L in one shuffle, ``level`` as a column.

    Margins are those of the sums; columns above a level's grain are NULL.
    """
    keys = ["fiscal_year", "fiscal_quarter", "period"]
    dated = pnl.withColumns(
        {"fiscal_year": F.year("period"), "fiscal_quarter": fiscal_quarter("period")}
    )
    sums = dated.groupingSets([keys, keys[:2], keys[:1]], *keys).agg(
        F.grouping_id().alias("set"),
        *[
            F.sum(F.col(c).cast("decimal(28,2)")).alias(c)
            for c in ("total_revenue", "total_cogs", "total_opex_below_gm")
        ],
    )
    level = F.when(F.col("set") == 0, "month").when(F.col("set") == 1, "quarter").otherwise("year")
    return with_margins(sums).select(level.alias("level"), *keys, *PNL_COLUMNS)


def latest_kpis(pnl: DataFrame) -> DataFrame:
    """The last month's revenue, margins and EBITDA with growth over the year before."""
    grown = yoy(pnl, "total_revenue")
    row = F.struct(
        "period",
        "total_revenue",
        "gross_margin_pct",
        "ebitda_margin_pct",
        "ebitda",
        F.col("yoy_growth").alias("yoy_revenue"),
    )
    return grown.agg(F.max_by(row, "period").alias("k")).select("k.*")


def qbr_segment_quarterly(revenue: DataFrame, segments: DataFrame, as_of: date) -> DataFrame:
    """Closed-month revenue by fiscal quarter and segment name."""
    sums = (
        revenue.filter(is_actual("period", as_of))
        .groupBy(
            fiscal_year("period").alias("fiscal_year"),
            fiscal_quarter("period").alias("fiscal_quarter"),
            "profit_center",
        )
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        sums.join(segments.select("profit_center", "segment_name"), "profit_center")
        .groupBy("fiscal_year", "fiscal_quarter", "segment_name")
        .agg(dbl(F.round(F.sum("revenue"), 2)).alias("revenue"))
    )


def segment_mix(
    revenue: DataFrame,
    segments: DataFrame,
    years: Sequence[int] | None = None,
    by_quarter: bool = False,
) -> DataFrame:
    """Revenue by segment with its share of the total, over chosen years or per quarter."""
    if years is not None:
        revenue = revenue.filter(F.year("period").isin(*years))
    within = ["fiscal_year", "fiscal_quarter"] if by_quarter else []
    if by_quarter:
        revenue = revenue.withColumns(
            {"fiscal_year": fiscal_year("period"), "fiscal_quarter": fiscal_quarter("period")}
        )
    sums = revenue.groupBy(*within, "profit_center").agg(F.sum("revenue").alias("revenue"))
    named = sums.join(segments.select("profit_center", "segment_name"), "profit_center", "left")
    share = ratio("revenue", F.sum("revenue").over(Window.partitionBy(*within)))
    return named.select(
        *within, "profit_center", "segment_name", dbl("revenue").alias("revenue"),
        share.alias("share"),
    )

"""Plan against actuals, in detail and rolled up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dbl, or_zero, ratio
from ..functions.periods import fiscal_quarter, fiscal_year
from .pnl import ACTUAL_KEYS


def variance(
    plan: DataFrame, actuals: DataFrame, plan_col: str, fill_actual: bool = False
) -> DataFrame:
    """Every plan row with its actual and the difference.

    The plan drives: an actual without a plan row is left out. A missing actual stays
    NULL and counts as 0 in the differences; ``fill_actual`` shows the 0. Both sides have
    one row per key here, so a busy account does not make a busy join key.

    The keys are matched null-safe and rows with a NULL key are then left unmatched. With
    plain equality the planner would push a not-null filter into the actuals alone; a plan
    derived from the same actuals could then not share their shuffle, and the ledger would
    be read twice.
    """
    left, right = plan.alias("p"), actuals.alias("a")
    same, known = F.lit(True), F.lit(True)
    for k in ACTUAL_KEYS:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"a.{k}"))
        known = known & F.col(f"p.{k}").isNotNull()
    joined = left.join(right, same, "left").select(
        *[F.col(f"p.{k}") for k in ACTUAL_KEYS],
        F.col(f"p.{plan_col}"),
        F.when(known, F.col("a.actual_amount")).alias("actual_amount"),
    )
    diff = or_zero("actual_amount") - F.col(plan_col)
    actual = or_zero("actual_amount") if fill_actual else F.col("actual_amount")
    return joined.select(
        *ACTUAL_KEYS,
        dbl(plan_col).alias(plan_col),
        dbl(actual).alias("actual_amount"),
        dbl(F.round(diff, 2)).alias("variance_abs"),
        ratio(diff, plan_col, 4).alias("variance_pct"),
    )


def _cents(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(28,2)"))


def variance_rollup(detail: DataFrame, keys: Sequence[str | Column], plan_col: str) -> DataFrame:
    """Totals by key with the ratio of the sums (not the mean of the ratios)."""
    sums = detail.groupBy(*keys).agg(
        or_zero(_cents(plan_col)).alias("plan"), or_zero(_cents("actual_amount")).alias("actual")
    )
    return _compared(sums, plan_col)


def _compared(sums: DataFrame, plan_col: str) -> DataFrame:
    """Difference and ratio of the sums ``plan`` and ``actual``; the other columns stay."""
    diff = F.col("actual") - F.col("plan")
    names = [c for c in sums.columns if c not in ("plan", "actual")]
    return sums.select(
        *names,
        dbl("plan").alias(plan_col),
        dbl("actual").alias("actual_amount"),
        dbl(F.round(diff, 2)).alias("variance_abs"),
        ratio(diff, "plan").alias("variance_pct"),
    )


def variance_quarterly(detail: DataFrame, plan_col: str) -> DataFrame:
    """Quarter and line totals, with whether the difference is good news.

    More revenue than planned is favourable, and less expense.
    """
    keys = [
        fiscal_year("period").alias("fiscal_year"),
        fiscal_quarter("period").alias("fiscal_quarter"),
        F.col("line_type"),
    ]
    good = F.when(F.col("line_type") == "Revenue", F.col("variance_abs") >= 0).otherwise(
        F.col("variance_abs") <= 0
    )
    return variance_rollup(detail, keys, plan_col).withColumn("favourable", good)


# grouping_id of (line_type, fiscal_year, fiscal_quarter, period) by level
LEVELS = {"month": 0, "quarter": 1, "year": 3, "all": 7}


def variance_levels(detail: DataFrame, plan_col: str) -> DataFrame:
    """Month, quarter, year and overall totals by line, with ``level`` as a column.

    All levels come from one shuffle: a row is counted in four grouping sets that are
    summed before they are sent. Ratios are those of the sums. Columns above a level's
    grain are NULL; a row without a period keeps its level.
    """
    keys = ["line_type", "fiscal_year", "fiscal_quarter", "period"]
    dated = detail.withColumns(
        {"fiscal_year": fiscal_year("period"), "fiscal_quarter": fiscal_quarter("period")}
    )
    sums = dated.groupingSets([keys[:n] for n in (4, 3, 2, 1)], *keys).agg(
        F.grouping_id().alias("set"),
        or_zero(_cents(plan_col)).alias("plan"),
        or_zero(_cents("actual_amount")).alias("actual"),
    )
    level = F.lit(None).cast("string")
    for name, number in LEVELS.items():
        level = F.when(F.col("set") == number, name).otherwise(level)
    return _compared(sums.withColumn("level", level).drop("set"), plan_col)

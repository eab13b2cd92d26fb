"""Linking the tone of commentary to cost variance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dbl, pearson
from ..functions.periods import quarter_key
from .variance import variance_rollup

LINK_KEYS = ["fiscal_quarter", "cost_center"]


def quarterly_opex_variance(detail: DataFrame, plan_col: str = "budget_amount") -> DataFrame:
    """Expense against plan by quarter and cost centre, from variance rows."""
    keys = [quarter_key("period").alias("fiscal_quarter"), F.col("dim1").alias("cost_center")]
    return variance_rollup(detail.filter(F.col("line_type") == "Opex"), keys, plan_col)


def quarterly_sentiment(scored: DataFrame) -> DataFrame:
    """Mean score and most frequent tone (the smallest among equals) by quarter and centre."""
    return scored.groupBy(*LINK_KEYS).agg(
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.mode("predicted_tone", True).alias("predicted_tone_mode"),
    )


def link_tone(sentiments: DataFrame, variances: DataFrame) -> DataFrame:
    """Quarters and cost centres that have both commentary and a variance."""
    return sentiments.join(variances, LINK_KEYS)


def correlation(pairs: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Number of complete pairs and their Pearson correlation."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return pairs.groupBy(*keys).agg(
        F.count_if(both).alias("n"), pearson(x, y).alias("correlation")
    )


def ols(pairs: DataFrame, x: str, y: str, keys: Sequence[str] = (), min_n: int = 4) -> DataFrame:
    """Straight line of y on x per group, NULL for fewer than ``min_n`` pairs."""
    fy, fx = dbl(y), dbl(x)
    n = F.regr_count(fy, fx)

    def fitted(c: Column) -> Column:
        return F.when(n >= min_n, c)

    return pairs.groupBy(*keys).agg(
        n.alias("n"),
        fitted(F.regr_slope(fy, fx)).alias("slope"),
        fitted(F.regr_intercept(fy, fx)).alias("intercept"),
        fitted(F.regr_r2(fy, fx)).alias("r2"),
    )


def attach_department(scored: DataFrame, cost_centers: DataFrame) -> DataFrame:
    """Commentary rows with department and function; unknown centres stay, unnamed."""
    return scored.join(
        cost_centers.select("cost_center", "department", "function"), "cost_center", "left"
    )


def tone_distribution(scored: DataFrame, departments: Sequence[str] | None = None) -> DataFrame:
    """Number of texts per tone, over the chosen departments."""
    if departments is not None:
        scored = scored.filter(F.col("department").isin(*departments))
    return scored.groupBy(F.col("predicted_tone").alias("tone")).agg(
        F.count(F.lit(1)).alias("count")
    )

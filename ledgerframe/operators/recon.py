"""Ledger journal, reconciliation and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dbl, or_zero


def gl_journal(postings: DataFrame) -> DataFrame:
    """Postings as journal entries: revenue credits, expenses debits.

    Takes ``document_number``, ``document_line`` and ``posting_date`` along where the
    postings have them. The dimension the other side uses stays NULL.
    """
    sale = F.col("line_type") == "Revenue"
    carried = [
        c for c in ("document_number", "document_line", "posting_date") if c in postings.columns
    ]
    return postings.select(
        *carried,
        "period",
        F.col("dim2").alias("company_code"),
        F.when(sale, F.col("dim1")).alias("profit_center"),
        F.when(~sale, F.col("dim1")).alias("cost_center"),
        "gl_account",
        "amount",
        F.when(sale, "C").otherwise("D").alias("debit_credit"),
        F.when(sale, "RV").otherwise("SA").alias("document_type"),
        F.when(sale, "Billing").otherwise("Payroll/AP").alias("source"),
    )


def gl_check(gl: DataFrame, accounts: DataFrame) -> DataFrame:
    """Count and total by period, side and P&L category.

    Entries are summed per account before the chart is looked up, so the join sees a
    few rows per month. Accounts outside the chart keep a NULL category.
    """
    per_account = gl.groupBy("period", "debit_credit", "gl_account").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    return (
        per_account.join(accounts.select("gl_account", "pnl_category"), "gl_account", "left")
        .groupBy("period", "debit_credit", "pnl_category")
        .agg(
            F.sum("n").alias("txn_count"),
            dbl(F.round(F.sum("amount"), 2)).alias("gl_total_amount"),
        )
    )


def orphan_accounts(gl: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts that carry entries but are missing from the chart (NULL included)."""
    return gl.select("gl_account").distinct().join(
        accounts.select("gl_account"), "gl_account", "left_anti"
    )


def recon_revenue(gl: DataFrame, revenue: DataFrame) -> DataFrame:
    """Ledger credits against the revenue fact, month by month; a variance other than 0 is
    a gap in one of them."""
    ledger = (
        gl.filter(F.col("debit_credit") == "C")
        .groupBy("period")
        .agg(F.round(F.sum("amount"), 2).alias("gl_revenue"))
    )
    source = revenue.groupBy("period").agg(F.round(F.sum("revenue"), 2).alias("source_revenue"))
    return ledger.join(source, "period", "full").select(
        "period",
        dbl("gl_revenue").alias("gl_revenue"),
        dbl("source_revenue").alias("source_revenue"),
        dbl(F.round(or_zero("gl_revenue") - or_zero("source_revenue"), 2)).alias("variance"),
    )


def dq_negative(fact: DataFrame, column: str) -> DataFrame:
    """Rows of a fact with a negative amount."""
    return fact.filter(F.col(column) < 0)


def dq_nulls(checks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Number of rows without a dimension, one row per named table."""
    parts = [
        df.agg(F.count_if(F.col(column).isNull()).alias("null_rows")).select(
            F.lit(name).alias("table_name"), "null_rows"
        )
        for name, (df, column) in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)

"""Literal dimension and assumption tables.

They are local relations of a few rows: the optimiser knows their size and joins
them by broadcast on its own, so no join here carries a hint.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import schemas

# Chart of accounts.
CHART_OF_ACCOUNTS = (
    ("400000", "Subscription Revenue", "Revenue", "Revenue", "C"),
    ("400100", "Services Revenue", "Revenue", "Revenue", "C"),
    ("400200", "Hardware Revenue", "Revenue", "Revenue", "C"),
    ("500000", "Hosting & Cloud Infra Cost", "COGS", "COGS", "D"),
    ("500100", "Third-Party License COGS", "COGS", "COGS", "D"),
    ("500200", "Support & Success Labor COGS", "COGS", "COGS", "D"),
    ("600000", "Salaries & Wages", "Opex", "Opex", "D"),
    ("600100", "Employee Benefits", "Opex", "Opex", "D"),
    ("600200", "Stock-Based Compensation", "Opex", "Opex", "D"),
    ("610000", "Marketing Programs", "Opex", "Opex", "D"),
    ("620000", "Travel & Entertainment", "Opex", "Opex", "D"),
    ("630000", "Software & IT Subscriptions", "Opex", "Opex", "D"),
    ("640000", "Facilities & Occupancy", "Opex", "Opex", "D"),
    ("650000", "Professional Fees", "Opex", "Opex", "D"),
    ("660000", "Depreciation & Amortization", "Opex", "Opex", "D"),
)

# Planning scenarios (name, revenue growth, churn, opex growth); own texts.
SCENARIOS = (
    ("Base", 0.0, 0.0, 0.0, "As forecast."),
    ("Upside", 0.045, -0.006, 0.015, "More growth, fewer leavers, some more cost."),
    ("Downside", -0.055, 0.010, -0.020, "Less growth, more leavers, cost cut."),
)

# Share of payroll cost by account.
PAYROLL_SPLIT = (("600000", 0.78), ("600100", 0.16), ("600200", 0.06))

# Share of each company in a total.
ENTITY_MIX = (("1000", 0.55), ("2000", 0.30), ("3000", 0.15))


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: StructType) -> DataFrame:
    """Rows as a local relation (an Arrow table becomes one, a list of tuples does not)."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema.names)
    arrow = pa.table({n: list(c) for n, c in zip(schema.names, columns, strict=True)})
    return spark.createDataFrame(arrow, schema)


def chart_of_accounts(spark: SparkSession, without: Iterable[str] = ()) -> DataFrame:
    skip = set(without)
    rows = [r for r in CHART_OF_ACCOUNTS if r[0] not in skip]
    return literal_table(spark, rows, schemas.GL_ACCOUNTS)


def scenario_assumptions(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SCENARIOS, schemas.SCENARIOS)

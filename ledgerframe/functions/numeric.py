"""Money and ratio expressions.

Money is carried as DECIMAL so that a sum does not depend on the order in which
partitions arrive, and turned into DOUBLE only where a result leaves an operator.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
TOTAL = DecimalType(20, 2)
RATIO_DIGITS = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: Column | str) -> Column:
    """Half-up to cents, as DECIMAL(18,2)."""
    return F.round(_col(c), 2).cast(MONEY)


def cents(c: Column | str, scale: int = 100) -> Column:
    """Nearest whole number of cents of a floating-point amount, as BIGINT.

    Per-row money arithmetic is done on whole numbers: turning a DOUBLE into DECIMAL goes
    through its text form and costs far more than the rest of a scan.
    """
    return F.floor(_col(c) * scale + 0.5).cast("long")


def div_half_up(num: Column, den: int) -> Column:
    """Whole-number quotient, halves away from zero."""
    half = den // 2
    up = F.call_function("div", F.abs(num) + half, F.lit(den))
    return F.when(num < 0, -up).otherwise(up)


def from_cents(c: Column | str) -> Column:
    """Exact DECIMAL amount of a BIGINT number of cents."""
    return (_col(c).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(TOTAL)


def dbl(c: Column | str) -> Column:
    return _col(c).cast("double")


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Floating-point quotient, NULL where the denominator is zero or NULL."""
    return F.try_divide(dbl(num), dbl(den))


def ratio(num: Column | str, den: Column | str, digits: int = RATIO_DIGITS) -> Column:
    return F.round(safe_div(num, den), digits)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def pearson(x: str, y: str) -> Column:
    """Aggregate: Pearson correlation, NULL for two pairs or fewer or a constant side.

    The built-in ``corr`` raises under ANSI mode on a constant column, hence the
    quotient of population moments. Pairs with a NULL on either side are left out.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    px, py = F.when(both, dbl(x)), F.when(both, dbl(y))
    r = F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))
    return F.when(F.count(px) > 2, r)

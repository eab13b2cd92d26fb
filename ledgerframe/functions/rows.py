"""Short literal row sets as expressions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_rows(names: Sequence[str], rows: Sequence[Sequence[Any]]) -> Column:
    """Unfold each input row into one row per literal row (a struct column).

    For parameters such as scenarios, shares or horizons: the rows travel inside the
    plan and nothing is joined.
    """
    structs = [
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows
    ]
    return F.explode(F.array(*structs))

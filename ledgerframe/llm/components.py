"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link; nodes of a component share ``root``.

    ``links`` has the bigint columns ``a`` and ``b``. Each round hooks every node to its
    lowest neighbour, in an order drawn anew per round, and carries the links over to the
    hooked nodes, so that long chains shrink by a constant factor. Nothing is gathered per
    node: the lowest neighbour is an aggregate that combines before its shuffle, and the
    carrying over is two joins that adaptive execution can split at a hot node. Links and
    hooks of a round are written to the shared folder. A table without links gives no rows.
    """
    live = keep(links.filter(F.col("a") != F.col("b")).select("a", "b").distinct())
    hooks: list[DataFrame] = []
    while live.limit(1).count():
        turn = F.lit(len(hooks))
        both = live.unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(
            F.min(F.struct(F.xxhash64("b", turn).alias("rank"), F.col("b").alias("to"))).alias("m")
        )
        lower = F.struct(F.xxhash64("a", turn).alias("rank"), F.col("a").alias("to")) > F.col("m")
        hook = keep(
            lowest.select(
                F.col("a").alias("node"),
                F.when(lower, F.col("m.to")).otherwise(F.col("a")).alias("up"),
            )
        )
        hooks.append(hook)
        left = hook.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        right = hook.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        live = keep(
            live.join(left, "a")
            .join(right, "b")
            .filter(F.col("ua") != F.col("ub"))
            .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
            .distinct()
        )
    if not hooks:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = hooks[-1].select("node", F.col("up").alias("root"))
    for hook in reversed(hooks[:-1]):
        above = roots.select(F.col("node").alias("up"), "root")
        roots = hook.join(above, "up", "left").select(
            "node", F.coalesce("root", "up").alias("root")
        )
    return roots

"""Cutting a long lineage where a frame is read many times."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder, so that a lost executor costs
    no recomputation. The folder is ``spark.checkpoint.dir``; without it this is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared)
    return df.checkpoint()

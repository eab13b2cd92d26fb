"""Stored planning tables that are replaced whole or by year, in one small commit.

A write goes into a folder of its own (a generation). It counts once a commit has been
added: one file of one row, which names the generation and the years it replaces. A write
that stops half way leaves no commit, and readers go on with what was committed before.
Folders of replaced generations stay, for readers that have begun with them, until the
owner of the table expires them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..functions.periods import fiscal_year

COMMIT = StructType(
    [
        StructField("version", LongType()),
        StructField("generation", StringType()),
        StructField("whole", BooleanType()),
        StructField("years", ArrayType(IntegerType())),
        StructField("schema", StringType()),
    ]
)
YEAR = "fiscal_year"
NO_YEAR = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a NULL


def _commits(spark: SparkSession, path: str) -> list[Row]:
    """All commits, oldest first; of two with the same version the name decides."""
    rows = spark.read.schema(COMMIT).parquet(f"{path}/commits").collect()
    return sorted(rows, key=lambda c: (c["version"], c["generation"]))


def _next_version(spark: SparkSession, path: str) -> int:
    try:
        done = _commits(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return done[-1]["version"] + 1 if done else 0


def replace_table(df: DataFrame, path: str, period: str = "period", only_years: bool = False) -> None:
    """Write ``df`` by fiscal year and let it take the place of what is stored.

    With ``only_years`` the years that ``df`` holds are replaced and the others stay.
    The year is a column ``fiscal_year``, or that of ``period``; rows without one are kept
    under a NULL year. The rows are rebalanced by year, so a large year is split over
    tasks. The columns are those of the newest commit.
    """
    spark = df.sparkSession
    out = df if YEAR in df.columns else df.withColumn(YEAR, fiscal_year(period))
    generation = f"g{uuid.uuid4().hex}"
    staged = f"{path}/data/generation={generation}"
    out.hint("rebalance", YEAR).write.partitionBy(YEAR).parquet(staged)
    written = spark.read.schema(out.schema).parquet(staged).select(YEAR).distinct()
    years = [r[YEAR] for r in written.collect()]
    row = (_next_version(spark, path), generation, not only_years, years, out.schema.json())
    commit = spark.createDataFrame([row], COMMIT).coalesce(1)
    commit.write.mode("append").parquet(f"{path}/commits")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows. A filter on ``fiscal_year`` skips the other years' folders.

    The commits are read on the driver: one short row per write.
    """
    commits = _commits(spark, path)
    current: dict[int | None, str] = {}
    for commit in commits:
        if commit["whole"]:
            current.clear()
        current.update(dict.fromkeys(commit["years"], commit["generation"]))
    schema = StructType.fromJson(json.loads(commits[-1]["schema"]))
    if not current:
        return spark.createDataFrame([], schema)
    folders = [
        f"{path}/data/generation={g}/{YEAR}={NO_YEAR if year is None else year}"
        for year, g in current.items()
    ]
    stored = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return stored.select(*schema.names)

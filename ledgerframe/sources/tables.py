"""Reading and writing planning tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.periods import fiscal_year


def read_csv(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, read by a declared schema; a malformed row fails the read.

    Only files of free text need ``multi_line``: it takes line breaks within quotes, but a
    file is then read by one task. ``read_text_csv`` reads large ones by many.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_text_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header whose quoted texts hold line breaks, a large file read by many tasks.

    The same rows as ``read_csv`` with ``multi_line``. A line starts a record if the quotes
    before it in its file are even. They are summed per split of the file first, so each
    split knows whether it begins inside a text, and finds its records alone; the texts are
    shuffled once, by split. A record over a border is put together from the last record
    of a split and the heads of those that follow. Empty lines are no records; a
    malformed one fails the read; an empty text is read as NULL, as Spark's CSV reader does.
    Worth its shuffle where files are few and large.
    """
    odd = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.input_file_name().alias("file"),
        F.input_file_block_start().alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        (odd % 2).alias("odd"),
    )
    split = ["file", "block"]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    borders = lines.groupBy(*split).agg(F.sum("odd").alias("n")).select(
        *split, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("open")
    )
    upto = Window.partitionBy(*split).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    quotes = F.col("open") + F.sum("odd").over(upto) - F.col("odd")
    numbered = (
        lines.join(borders, split)
        .withColumn("starts", F.when(quotes % 2 == 0, 1).otherwise(0))
        .withColumn("number", F.sum("starts").over(upto))
    )
    # number 0 is the head of a split, which belongs to a record that began before it
    in_order = F.array_sort(F.collect_list(F.struct("at", "value")))
    pieces = (
        numbered.groupBy(*split, "number")
        .agg(F.array_join(F.transform(in_order, lambda x: x["value"]), "\n").alias("piece"))
        .withColumn("last", F.max("number").over(Window.partitionBy(*split)))
    )
    at_border = (F.col("number") == 0) | (F.col("number") == F.col("last"))
    place = [*split, "number"]
    edges = pieces.filter(at_border)
    so_far = Window.partitionBy("file").orderBy("block", "number")
    owners = edges.select(*place).withColumn(
        "owner", F.sum(F.when(F.col("number") > 0, 1).otherwise(0)).over(so_far)
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "number", "piece")))
    joined = edges.join(owners, place).groupBy("file", "owner").agg(parts.alias("parts")).select(
        F.col("parts")[0]["block"].alias("block"),
        F.col("parts")[0]["number"].alias("number"),
        F.array_join(F.transform("parts", lambda x: x["piece"]), "\n").alias("piece"),
    )
    records = pieces.filter(~at_border).select("block", "number", "piece").unionAll(joined)
    header = (F.col("block") == 0) & (F.col("number") == 1)
    record = F.regexp_replace("piece", "\\r\\z", "")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "FAILFAST", "dateFormat": "yyyy-MM-dd", "escape": '"', "multiLine": "true"}
    return (
        records.filter(~header).select(record.alias("record")).filter("record <> ''")
        .select(F.from_csv("record", fields, options).alias("x")).select("x.*")
    )


def read_table(spark: SparkSession, path: str, period: str | None = None) -> DataFrame:
    """Parquet table; ``period`` names a timestamp or date column to bring to month start."""
    df = spark.read.parquet(path)
    if period is None:
        return df
    return df.withColumn(period, F.trunc(F.col(period).cast("date"), "month"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column, one file per partition; texts are not trimmed."""
    out = df.write.mode("overwrite").option("header", True).option("escape", '"')
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        out = out.option(side, False)
    out.csv(path)


def write_table(df: DataFrame, path: str, period: str = "period") -> None:
    """Parquet laid out by fiscal year, so that year filters skip whole directories.

    The rows are rebalanced by year: adaptive execution splits a large year over tasks and
    puts small ones together, so there are few files and none is made by one overfull task.
    """
    out = df if "fiscal_year" in df.columns else df.withColumn("fiscal_year", fiscal_year(period))
    out.hint("rebalance", "fiscal_year").write.mode("overwrite").partitionBy("fiscal_year").parquet(path)


def create_views(frames: Mapping[str, DataFrame]) -> None:
    """Publish operator results under names for ``spark.sql``."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count of each named table, as one DataFrame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("long").alias("column_count"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

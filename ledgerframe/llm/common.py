"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = "\\x20\\x09-\\x0D"
# ASCII white space between words, as a Java pattern and inside a character class
GAP = f"[{SPACES}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return found.rstrip("/")


def keep(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it again.

    It cuts the lineage, so that a lost executor costs no recomputation and what is
    drawn once (row numbers, model weights) stays as drawn. Column pruning and filters
    reach the written file.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ledgerframe/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def body(text: str = "text") -> Column:
    """A text column; NULL counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space, in text order."""
    return F.array_remove(F.split(text, GAP, -1), "")


# texts that a Python worker holds as strings at once
SLICE_ROWS = 256


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The rows, a few at a time, with their column ``text`` as strings; NULL is empty."""
    for part in slices(batches):
        yield part, [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]

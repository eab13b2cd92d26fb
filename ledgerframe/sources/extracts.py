"""Ledger extracts as a data source: CSV below one folder per fiscal year.

``spark.read.format("ledger_extract")`` reads them with a declared schema. Filters on the
fiscal year are pushed into the source: folders of other years are not even opened. Large
files are split, and tasks read them block by block as Arrow batches.
"""

from __future__ import annotations

import io
import operator
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..functions.periods import fiscal_year

FORMAT = "ledger_extract"
YEAR = "fiscal_year"
SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
COMPARISONS = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge,
    LessThan: operator.lt, LessThanOrEqual: operator.le, In: lambda year, years: year in years,
}
ARROW = {
    StringType: pa.string(), DateType: pa.date32(), IntegerType: pa.int32(), LongType: pa.int64(),
    DoubleType: pa.float64(), BooleanType: pa.bool_(),
}


@dataclass
class Split(InputPartition):
    """The records of a file that begin in ``[start, end)``."""

    path: str
    year: int | None
    start: int
    end: int


def _arrow(kind: DataType) -> pa.DataType:
    if isinstance(kind, DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    if type(kind) not in ARROW:
        raise ValueError(f"ledger extracts hold no columns of type {kind.simpleString()}")
    return ARROW[type(kind)]


def _open_folder(path: str) -> tuple[pa.fs.FileSystem, str]:
    from pyarrow import fs

    # Spark writes a local path with one slash
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def _year(path: str) -> int | None:
    found = re.search(f"/{YEAR}=([0-9]+)/", path)
    return int(found[1]) if found else None


class ExtractReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split_bytes: int):
        self.path, self.schema, self.split_bytes = path, schema, split_bytes
        self.pushed: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if f.attribute == (YEAR,) and (type(f) in COMPARISONS or isinstance(f, IsNotNull)):
                self.pushed.append(f)
            else:
                yield f

    def _wanted(self, year: int | None) -> bool:
        if year is None:
            return not self.pushed  # a comparison with NULL holds for no row
        return all(isinstance(f, IsNotNull) or COMPARISONS[type(f)](year, f.value) for f in self.pushed)

    def partitions(self) -> list[Split]:
        from pyarrow import fs

        files, root = _open_folder(self.path)
        found = files.get_file_info(fs.FileSelector(root, recursive=True))
        return [
            Split(f.path, _year(f.path), at, min(at + self.split_bytes, f.size))
            for f in sorted(found, key=lambda f: f.path)
            if f.is_file and f.path.endswith(".csv") and _wanted_name(f.base_name) and self._wanted(_year(f.path))
            for at in range(0, f.size, self.split_bytes)
        ]

    def read(self, split: InputPartition) -> Iterator[pa.RecordBatch]:
        from pyarrow import csv

        if not isinstance(split, Split):
            return  # Spark plans one empty partition where there is none
        stored = [f for f in self.schema.fields if f.name != YEAR]
        names = [f.name for f in stored]
        parse = {
            "read_options": csv.ReadOptions(column_names=names, use_threads=False),
            "convert_options": csv.ConvertOptions(
                column_types={f.name: _arrow(f.dataType) for f in stored},
                null_values=[""], strings_can_be_null=True,
            ),
        }
        for lines in _blocks(_open_folder(self.path)[0], split, names):
            table = csv.read_csv(io.BytesIO(lines), **parse)
            year = pa.array([split.year] * len(table), pa.int32())
            columns = [year if f.name == YEAR else table[f.name] for f in self.schema.fields]
            yield from pa.table(columns, names=self.schema.names).to_batches()


def _wanted_name(name: str) -> bool:
    return not name.startswith(("_", "."))


def _blocks(files: pa.fs.FileSystem, split: Split, names: list[str]) -> Iterator[bytes]:
    """Whole lines of the split, some megabytes at a time. The line that a split begins
    within belongs to the split before."""
    with io.BufferedReader(files.open_input_file(split.path)) as f:
        if split.start:
            f.seek(split.start - 1)
            f.readline()
        else:
            header = f.readline().decode().rstrip("\r\n").split(",")
            if header != names:
                raise ValueError(f"{split.path} holds {header}, declared are {names}")
        while (at := f.tell()) < split.end:
            lines = f.read(min(BLOCK_BYTES, split.end - at))
            yield lines if lines.endswith(b"\n") else lines + f.readline()


class LedgerExtract(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise ValueError("declare the schema of a ledger extract; it is never inferred")

    def reader(self, schema: StructType) -> ExtractReader:
        return ExtractReader(self.options["path"], schema, int(self.options.get("split_bytes", SPLIT_BYTES)))


def write_extract(df: DataFrame, path: str, period: str = "period") -> None:
    """CSV with a header below a folder per fiscal year; texts without line breaks only."""
    out = df if YEAR in df.columns else df.withColumn(YEAR, fiscal_year(period))
    out = out.hint("rebalance", YEAR).write.mode("overwrite").partitionBy(YEAR).option("header", True)
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        out = out.option(side, False)
    out.option("escape", '"').csv(path)


def read_extract(spark: SparkSession, path: str, schema: StructType, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The extract below ``path`` by its declared schema, with ``fiscal_year`` behind it.

    A file whose header differs from the schema, or a value that does not fit its type,
    fails the read; an empty text is NULL. ``path`` is one that Arrow's file systems open
    on the driver and all executors. Registers the source with the session and switches
    filters of Python sources on.
    """
    spark.dataSource.register(LedgerExtract)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    declared = StructType([f for f in schema.fields if f.name != YEAR] + [StructField(YEAR, IntegerType())])
    return spark.read.format(FORMAT).schema(declared).option("split_bytes", split_bytes).load(path)

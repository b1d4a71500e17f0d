"""CSV files read as text, by the names in their headers, and written with a header.

Files of one folder may have their columns in different orders, lack some, or have
others besides. The header of every file is read first; files with the same header
make one scan, and the scans are put together by name. A row that does not fit its
header is never lost without a word: see ``read_named_csv``.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loanclean.functions.text import null_if_in
from loanclean.sources.staging import stage
from loanclean.values import CSV_NULLS, LOAN_COLUMNS

RECORD = "_record"  # the text of a row that does not fit its header


def text_schema(columns: list[str] = LOAN_COLUMNS) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def null_cells(df: DataFrame, markers: list[str] = CSV_NULLS) -> DataFrame:
    """Null every text cell that a CSV reader takes for a missing value."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select(*[null_if_in(F.col(c), markers).alias(c) if c in text else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class Layout:
    """The files that have one header."""

    names: list[str]
    files: list[str]

    def place(self, column: str) -> int | None:
        """Where the column stands; of several with one name the first."""
        return self.names.index(column) if column in self.names else None

    def problems(self, columns: list[str]) -> list[tuple[str, str]]:
        """(column, problem) of the header: wanted columns that are missing, names that come twice, names not wanted."""
        twice = [n for n in dict.fromkeys(self.names) if self.names.count(n) > 1]
        found = [(c, "missing") for c in columns if c not in self.names]
        return found + [(n, "repeated") for n in twice] + [(n, "extra") for n in dict.fromkeys(self.names) if n not in columns]


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header): the first line of every file that has one.

    A task that holds a part of a large file stops after its first lines. Small
    files, of which a task holds many, are read through.
    """
    alone = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))) // 2

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            lines = batch.to_pydict()
            found = {}
            for file, start, line in zip(lines["file"], lines["start"], lines["line"]):
                if start == 0 and file not in seen:
                    seen.add(file)
                    found[file] = line
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.string())], names=["file", "header"])
            if lines["length"] and lines["length"][0] > alone:  # no other file stands in this task
                return

    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), F.col("value").alias("line"),
    )
    return lines.mapInArrow(first_lines, "file string, header string")


def layouts(spark: SparkSession, path: str | list[str]) -> list[Layout]:
    """The different headers under ``path`` with their files, in the order of their first file."""
    rows = file_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    found = [Layout(next(csv.reader([r["header"].lstrip("﻿")]), []), r["files"]) for r in rows]
    return sorted(found, key=lambda x: x.files[0])


def _reader(spark: SparkSession, line_breaks: bool) -> DataFrameReader:
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", line_breaks)


def _cell_count(record: Column) -> Column:
    """Cells of a record: separators outside quotes, and one."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


@dataclass(frozen=True)
class Scan:
    """``rows``: the wanted columns by name. ``rejects``: rows that do not fit. ``headers``: what is odd about files."""

    rows: DataFrame
    rejects: DataFrame
    headers: DataFrame


def read_named_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] = LOAN_COLUMNS,
    markers: list[str] = CSV_NULLS,
    position: str | None = None,
    line_breaks: bool = False,
    staged: bool = False,
) -> Scan:
    """Scan CSV files as text, each by its own header, without a pass for type inference.

    A row with fewer cells than its header has nulls in the last columns; it is among the
    ``rows`` and also among the ``rejects`` with reason ``short``. A row with more cells
    (``surplus``) or an open quote (``quote``) is a reject only. A reject has its file,
    reason, number of cells, number expected, text, and its wanted cells so far as they
    can be told. ``headers`` lists per file the wanted columns that are ``missing`` (null
    in its rows), names that are ``repeated`` (the first one counts) and ``extra`` ones.

    ``line_breaks`` allows line breaks inside quoted cells, though not in headers; such
    files cannot be split between tasks. ``position`` names an extra column with a unique
    number per row that rises within a file. With ``staged``, rows are written once into
    the shared folder with their position, so that no later job numbers them anew.
    """
    found = layouts(spark, path)
    rows = [spark.createDataFrame([], text_schema(columns))]
    reject_fields = [StructField(c, StringType()) for c in columns]
    rejects = [spark.createDataFrame([], "file string, reason string, n_cells int, expected int, record string").select("*", *[F.lit(None).cast("string").alias(f.name) for f in reject_fields])]
    for layout in found:
        width = len(layout.names)
        cells = [f"c{i}" for i in range(width)]
        # cells are counted only where the whole row is parsed
        scan = _reader(spark, line_breaks).option("columnNameOfCorruptRecord", RECORD).option("columnPruning", False)
        scan = scan.schema(text_schema([*cells, RECORD])).csv(layout.files)
        count = _cell_count(F.col(RECORD))
        reason = F.when(F.col(RECORD).isNull(), None).when(count < width, "short").when(count > width, "surplus").otherwise("quote")
        read = F.coalesce(F.length(cells[0]), F.lit(0)) >= 0  # Spark refuses scans of the record's text alone
        named = [(F.lit(None).cast("string") if (at := layout.place(c)) is None else F.col(cells[at])).alias(c) for c in columns]
        rows.append(scan.where(F.coalesce(reason == "short", F.lit(True)) & read).select(*named))
        bad = scan.where(reason.isNotNull() & read)
        rejects.append(bad.select(F.col("_metadata.file_path").alias("file"), reason.alias("reason"), count.alias("n_cells"), F.lit(width).alias("expected"), F.col(RECORD).alias("record"), *named))
    out = null_cells(reduce(DataFrame.unionByName, rows[1:] or rows), markers)
    if position:
        out = out.withColumn(position, F.monotonically_increasing_id())
    odd = [(f, c, p) for x in found for f in x.files for c, p in x.problems(columns)]
    headers = spark.createDataFrame(odd, "file string, column string, problem string")
    return Scan(stage(out, "rows") if staged else out, reduce(DataFrame.unionByName, rejects[1:] or rejects), headers)


def read_text_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] = LOAN_COLUMNS,
    markers: list[str] = CSV_NULLS,
    position: str | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """The rows of ``read_named_csv`` where files are expected to fit.

    A file without a wanted column is an error. So is, once it is read, a row with more
    cells than its header or with an open quote.
    """
    scan = read_named_csv(spark, path, columns, markers, position, line_breaks)
    missing = scan.headers.where("problem = 'missing'").take(5)
    if missing:
        raise ValueError(f"columns missing: {', '.join(f'{r.column} in {r.file}' for r in missing)}")
    broken = scan.rejects.where("reason <> 'short'")
    fault = F.raise_error(F.concat(F.lit("row does not fit its header: "), F.col("file"), F.lit(": "), F.col("record"))).cast("string")
    first = scan.rows.columns[0]
    stop = broken.select(fault.alias(first), *[F.lit(None).cast(scan.rows.schema[c].dataType).alias(c) for c in scan.rows.columns[1:]])
    return scan.rows.unionByName(stop)


def write_csv(df: DataFrame, path: str) -> None:
    """Write with a header and without an index; nulls become empty cells."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .csv(path)
    )

"""Incremental cleaning with Structured Streaming.

The cleaning step and the date rule look at one row at a time, so they run on a
stream as they are, without state. Each run picks up the files that arrived
since the last one and stops; the streaming checkpoint is the resume list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loanclean.operators.cleaning import clean_layer1, repair_notes
from loanclean.operators.dating import rule_dates
from loanclean.sources.text_csv import null_cells, text_schema
from loanclean.values import LOAN_COLUMNS


def clean_rows(df: DataFrame) -> DataFrame:
    """First layer, repaired notes and resolved dates as one row-local projection."""
    return rule_dates(repair_notes(clean_layer1(df)))


def clean_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, columns: list[str] = LOAN_COLUMNS, files_per_batch: int = 1000
) -> StreamingQuery:
    """Clean the CSV files that are new in ``source`` and append them to the Parquet table ``target``.

    A stream reads columns by place. A file whose header has other names or another order
    stops the run; such files go through ``sources.text_csv.read_named_csv``.
    """
    rows = (
        spark.readStream.schema(text_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source)
    )
    return (
        clean_rows(null_cells(rows))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )

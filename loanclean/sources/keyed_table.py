"""A Parquet table cut by key into buckets, of which an update rewrites only those it touches.

The bucket of a row is a hash of its key. New rows replace the rows of their keys, or are
added; buckets without new rows are neither read nor written, and their files stay as
they are (dynamic partition overwrite). A key has one row in the table, always: rows that
repeat a key are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanclean.operators.merging import one_per_key, replace_rows
from loanclean.sources.staging import stage

BUCKET = "key_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def _write(df: DataFrame, path: str, key: str, buckets: int, mode: str) -> None:
    rows = df.select("*", _bucket(key, buckets)).repartition(BUCKET)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def write_keyed(df: DataFrame, path: str, key: str = "customer_id", buckets: int = 64) -> None:
    """Write a new table. Its bucket count holds for good and belongs to every later call."""
    _write(one_per_key(df, key), path, key, buckets, "errorifexists")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert(spark: SparkSession, path: str, new: DataFrame, key: str = "customer_id", buckets: int = 64) -> int:
    """Replace or add the rows of ``new``, which must be whole and one per key; returns how many buckets were written.

    The new content of the touched buckets is staged before any of it is put in place, so
    a failure while it is made leaves the table as it was.
    """
    table = spark.read.parquet(path)
    new = stage(one_per_key(new.select(read_keyed(spark, path).columns), key).select("*", _bucket(key, buckets)), "upsert")
    touched = [r[BUCKET] for r in new.select(BUCKET).distinct().collect()]  # no more than there are buckets
    if touched:
        old = table.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = stage(replace_rows(old, new.drop(BUCKET), key), "upserted")
        _write(merged, path, key, buckets, "overwrite")
    return len(touched)

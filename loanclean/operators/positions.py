"""Dense numbering, batches and exact samples without a global sort task.

Spark rows have no position, so order comes from a column. Rows per bucket of
the order column are counted, and rows are ranked inside their bucket only.
Buckets lie in wider buckets, and counts are added up inside the next wider one,
so sparse positions spread over tasks like dense ones. The one window without a
partition runs over the few widest buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

POSITION_BITS = 20  # a bucket spans 2**20 positions
_WIDER = 22  # a wider bucket holds 2**22 of the next narrower ones; at most that many are widest
SAMPLE_HEX = 5  # 16**5 buckets of a hex digest


def position_buckets(position: str, bits: int) -> list[Column]:
    """The buckets of a 64-bit position, widest first; the narrowest spans ``2**bits`` positions."""
    return [F.shiftright(F.col(position).cast("bigint"), b) for b in reversed(range(bits, 64, _WIDER))]


def _starts(sizes: DataFrame, names: list[str]) -> DataFrame:
    """The number of rows before each bucket, from the rows per bucket (``_n``)."""
    *above, last = names
    before = W.partitionBy(*above).orderBy(last).rowsBetween(W.unboundedPreceding, -1)
    here = sizes.select(*names, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    if not above:
        return here
    wider = _starts(sizes.groupBy(*above).agg(F.sum("_n").alias("_n")), above).withColumnRenamed("_start", "_base")
    return here.join(wider, above).select(*names, (F.col("_start") + F.col("_base")).alias("_start"))


def dense_index(df: DataFrame, buckets: list[Column], order_by: list[str], out: str = "idx") -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given order.

    ``buckets``, widest first, must be non-null and rise with the order, and each
    must lie in one of the bucket before it; ``order_by`` must be unique, else the
    numbers of equal rows are arbitrary.
    """
    names = [f"_bucket{i}" for i in range(len(buckets))]
    rows = df.withColumns(dict(zip(names, buckets)))
    starts = _starts(rows.groupBy(*names).agg(F.count("*").alias("_n")), names)
    rank = F.row_number().over(W.partitionBy(*names).orderBy(*order_by))
    return (
        rows.withColumn("_rank", rank)
        .join(starts, names)
        .withColumn(out, F.col("_start") + F.col("_rank") - 1)
        .drop(*names, "_rank", "_start")
    )


def index_by_position(df: DataFrame, position: str, out: str = "idx") -> DataFrame:
    """Dense index in the order of a unique integer column."""
    return dense_index(df, position_buckets(position, POSITION_BITS), [position], out)


def index_by_digest(df: DataFrame, digest: str, out: str = "idx") -> DataFrame:
    """Dense index in the order of a hex digest column."""
    return dense_index(df, [F.substring(digest, 1, SAMPLE_HEX)], [digest], out)


def assign_batches(df: DataFrame, position: str, size: int, out: str = "batch_id") -> DataFrame:
    """Cut the rows, in order, into batches of a fixed size; only the last may be short."""
    return index_by_position(df, position).withColumn(out, F.floor(F.col("idx") / size))


def mark_exact_share(df: DataFrame, digest: str, share: float, out: str, among: DataFrame | None = None) -> DataFrame:
    """Mark exactly ``int(rows * share)`` rows: those with the smallest digests.

    Only the digest at the cut is looked up, so the rows themselves are not
    shuffled. The cut is ranked inside the one bucket that contains it. It can
    be looked up in another table with the same digests, ``among``, where ``df``
    is the end of a long chain of steps.
    """
    among = df if among is None else among
    bucket = F.substring(digest, 1, SAMPLE_HEX)
    sizes = among.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    running = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy()
    edge = (
        sizes.withColumn("_upto", F.sum("_n").over(running))
        .withColumn("_want", F.floor(F.sum("_n").over(whole) * F.lit(share)))
        .where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select("_bucket", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_room"))
    )
    cut = (
        among.select(F.col(digest).alias("_digest"), bucket.alias("_bucket"))
        .join(F.broadcast(edge), "_bucket")  # at most one row
        .withColumn("_rank", F.row_number().over(W.partitionBy("_bucket").orderBy("_digest")))
        .where(F.col("_rank") == F.col("_room"))
        .select("_digest")
    )
    return df.withColumn(out, F.coalesce(F.col(digest) <= cut.scalar(), F.lit(False)))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """A repeatable sample of ``n`` rows; Spark keeps only ``n`` rows per task."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)

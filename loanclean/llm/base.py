"""Helpers shared by the operators: tables, staged results, shard counts, connected components.

Staged results go to the folder in ``spark.checkpoint.dir`` (see
``sources.staging``); a lost executor costs only the tasks it ran.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanclean.sources.staging import staging_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the table as Parquet into the shared folder and return its scan."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """Set bits of the longs in the only column, modulo ``bits``: a filter of fixed size that misses none of them.

    Blocks of 2^20 bits are put together in tasks; the driver gets bits / 8 bytes.
    """
    size = min(bits, 1 << 20)
    bit = values.toDF("v").where("v is not null").select(F.pmod("v", F.lit(bits)).alias("bit"))
    got = bit.groupBy(F.expr("cast(shiftright(bit, 5) as int)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 as int)))").alias("bits"))

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(size // 32, "<u4")
        out[pdf["at"].to_numpy() % (size // 32)] = pdf["bits"].to_numpy(np.int64).astype(np.uint32)
        return pd.DataFrame({"block": [int(pdf["at"].iloc[0]) // (size // 32)], "bytes": [out.tobytes()]})

    filled = np.zeros((bits // size, size // 8), np.uint8)
    for r in got.groupBy(F.expr(f"at div {size // 32}")).applyInPandas(block, "block int, bytes binary").toLocalIterator():
        filled[r["block"]] = np.frombuffer(r["bytes"], np.uint8)
    return filled.ravel()


def in_bitmap(filled: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Is the bit of each long set? ``bits`` is a power of two, so sign does not matter."""
    bit = values.view(np.uint64) & np.uint64(len(filled) * 8 - 1)
    return (filled[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def held_out(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as remainder 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(0))


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a table's size; for a file scan the size of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shards(df: DataFrame, mb: float, least: int = 8) -> int:
    """How many shards of about ``mb`` MB the table makes: grows with the table, has no upper limit.

    Where Spark has no estimate (a table that is no scan of files), the session's shuffle partitions.
    """
    size = plan_bytes(df)
    if size >= 1 << 60:
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, math.ceil(size / (mb * 1e6)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b) of longs.

    Returns (node, component) for every node of an edge; component is the smallest
    node reachable. Each round points every node at its smallest neighbour, follows
    the pointers once more, and contracts the edges; nothing is collected, and each
    round's tables are staged, so lineage stays short. Null ends are ignored.
    """
    edges = stage(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage(nodes.select("node", F.col("node").alias("component")), "labels")
    while not edges.isEmpty():
        hop = edges.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("up"))
        hop = stage(hop, "hops")
        far = hop.select(F.col("n").alias("m"), F.col("up").alias("top"))
        hop = stage(hop.join(far, F.col("up") == F.col("m"), "left").select("n", F.coalesce("top", "up").alias("up")), "hops")
        labels = stage(
            labels.join(hop, F.col("component") == F.col("n"), "left").select("node", F.coalesce("up", "component").alias("component")),
            "labels",
        )
        left, right = hop.select(F.col("n").alias("a"), F.col("up").alias("ua")), hop.select(F.col("n").alias("b"), F.col("up").alias("ub"))
        moved = edges.join(left, "a", "left").join(right, "b", "left").select(F.coalesce("ua", "a").alias("x"), F.coalesce("ub", "b").alias("y"))
        edges = stage(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return labels

"""Nearest neighbours by a permutation index.

A bounded sample of the vectors gives the pivots. Every vector is represented by the
pivots in order of nearness and posted in the inverted file of each of the first
``POSTED`` of them. A query visits the files of its own first pivots; there rows are
ranked by Spearman's footrule between the orders, the best are scored exactly, and the
best of all files are the answer. Where that gives too few, it visits all files. Nearness is the inner product, also for the pivots.

Files are cut into blocks of rows and their queries into blocks of queries, so a pivot
that is near a third of all vectors makes many small cells and not a hot one. Ties go
to the smaller vec_id, in footrule as in score, so copies need no special care.

Vectors that are null, zero, or hold null or non-finite components take no part, nor
do rows without vec_id or of another dimension than most of the sample. Rows of one
vec_id count once.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanclean.llm.base import stage, table

SAMPLE = 4000
PIVOTS = 128  # at most 255: a place in the order is a byte
POSTED = 12  # of the nearest pivots, how many inverted files hold or see a vector
TRIED = 300  # rows of a cell that a query scores exactly
ROWS, QUERIES = 8192, 1024  # of a cell


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v) of vectors that can take part; components as they are in the table."""
    v = rows.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return v.where(F.coalesce(fine, F.lit(False))).groupBy("vec_id").agg(F.min("v").alias("v"))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Pivots out of at most ``sample`` vectors taken by a hash: far from each other in turn, copies once."""
    got = [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    if not got:
        return np.zeros((0, 0))
    size = Counter(map(len, got)).most_common(1)[0][0]
    x = np.array([v for v in got if len(v) == size], float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    picked, near = [0], unit @ unit[0]
    while len(picked) < min(pivots, len(x)) and near.min() < 1 - 1e-9:
        # every second one at random, so that dense regions get pivots of their own
        at = int(near.argmin()) if len(picked) % 2 else int(np.flatnonzero(near < 1 - 1e-9)[len(picked) * 7919 % int((near < 1 - 1e-9).sum())])
        picked.append(at)
        near = np.maximum(near, unit @ unit[at])
    return unit[picked]


def order_column(pivots: np.ndarray, posted: int) -> Column:
    """struct(first, places): the nearest pivots of ``v``, and the place of every pivot in its order, a byte each."""

    @F.pandas_udf("struct<first array<int>, places binary>")
    def order(v: pd.Series) -> pd.DataFrame:
        if not len(v):
            return pd.DataFrame({"first": [], "places": []})
        by = np.argsort(-(np.stack(v.to_list()) @ pivots.T), axis=1, kind="stable")
        places = np.argsort(by, axis=1).astype(np.uint8)
        return pd.DataFrame({"first": list(by[:, :posted].astype(np.int32)), "places": [p.tobytes() for p in places]})

    return order(F.col("v"))


def _search_cell(k: int, tried: int):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """The k best of a cell's rows for each of its queries; a cell without either finds nothing."""
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        rows = rows.sort_values("vec_id")
        ids, v = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_list()).astype(float)
        places = np.frombuffer(b"".join(rows["places"]), np.uint8).reshape(len(rows), -1)
        out = []
        for q, qv, qp in zip(queries["query_id"], queries["qv"], queries["qplaces"]):
            mine = np.frombuffer(qp, np.uint8)
            own = np.flatnonzero(ids != q)
            if len(own) > tried:
                footrule = np.add.reduce(np.maximum(places, mine) - np.minimum(places, mine), axis=1, dtype=np.uint16)
                own = own[np.argsort(footrule[own], kind="stable")[:tried]]
            score = (v[own] * np.asarray(qv, float)).sum(axis=1)
            best = np.lexsort((ids[own], -score))[:k]
            out.append((np.full(len(best), q), ids[own][best], score[best]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    return run


def _visited(rows: DataFrame, asked: DataFrame, k: int, tried: int) -> DataFrame:
    """(query_id, vec_id, score): the best rows of each (query, pivot) visit, for rows and queries with the ``pivot`` they are in or go to."""
    sizes = rows.groupBy("pivot").agg(F.ceil(F.count("*") / ROWS).alias("row_blocks"))
    sizes = stage(sizes.join(asked.groupBy("pivot").agg(F.ceil(F.count("*") / QUERIES).alias("query_blocks")), "pivot"), "sizes")
    cell = lambda r, q: F.concat_ws(":", "pivot", r, q).alias("cell")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("other")
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).alias("own")
    left = rows.join(F.broadcast(sizes), "pivot").select("vec_id", "v", "places", "pivot", own("vec_id", "row_blocks"), every("query_blocks"))
    right = asked.join(F.broadcast(sizes), "pivot").select("query_id", "v", "places", "pivot", own("query_id", "query_blocks"), every("row_blocks"))
    left = left.select("vec_id", "v", "places", cell("own", "other"))
    right = right.select("query_id", F.col("v").alias("qv"), F.col("places").alias("qplaces"), cell("other", "own"))
    return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInPandas(_search_cell(k, tried), "query_id long, vec_id long, score double")


def nearest(rows: DataFrame, is_query: Column, k: int = 20, posted: int = POSTED, tried: int = TRIED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query row, nearest first.

    A query that finds fewer than ``k`` rows in the files of its first pivots visits all
    files in a second round, so it gets ``k`` rows, or all there are.
    """
    vectors = stage(usable(rows), "vectors")
    pivots = choose_pivots(vectors)
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = order_column(pivots, posted)
    ordered = stage(vectors.where(F.size("v") == pivots.shape[1]).withColumn("order", order).select("vec_id", "v", "order.*"), "orders")
    asked = ordered.where(is_query).withColumnRenamed("vec_id", "query_id")
    visits = lambda df: df.withColumn("pivot", F.explode("first"))
    found = stage(_visited(visits(ordered), visits(asked), k, tried).distinct(), "found")
    enough = min(k, ordered.count() - 1)
    few = asked.join(found.groupBy("query_id").count().where(F.col("count") >= enough), "query_id", "left_anti")
    if enough and not few.isEmpty():
        # each row is in the file of its nearest pivot once, and every file is visited
        once = ordered.withColumn("pivot", F.element_at("first", 1))
        everywhere = few.select("query_id", "v", "places", F.explode(F.sequence(F.lit(0), F.lit(len(pivots) - 1))).alias("pivot"))
        found = found.unionByName(_visited(once, everywhere, k, tried)).distinct()
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "b")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.far")).alias("score"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

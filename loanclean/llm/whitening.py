"""Whitening of embeddings by a covariance of weighted distinct vectors.

Components become integers (floor of 256 times the component). Equal integer vectors
are grouped into one row with a count; the covariance is a product of centred blocks of
these distinct vectors, weighted by one or by their counts, summed over tasks. Each
distinct vector is whitened once, and the result is joined back to its rows.

What reaches the driver has a size given by the dimension alone: sums, one square
matrix, its eigenvectors. The key of a group is the vector itself, in as few bytes as
its largest entry needs. Vectors that hold a large share of all rows are few by
definition, so their whitened rows are broadcast; the others meet by a shuffle in which
no key is hot.

Rows are dropped where the vector is null or empty, holds null or non-finite components,
or has another dimension than most of the others (ties: the smaller one). Rows with a
null or repeated id stay, each for itself. Components whose variance is zero (to double
precision) cannot be whitened and are left out, so one single distinct vector, like an
empty table, gives no rows. Entries beyond a long become the nearest long; a
``deviation`` beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from loanclean.llm.base import stage, table

LEVELS = 256  # integer steps of a component
COMPONENTS = 4
_WIDTHS = ("<i2", "<i4", "<i8")
_PART = 4096  # vectors of one product


def integer_vectors(rows: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(id, x) of the rows that can take part, with x = floor(256 c) as array of longs; and their dimension, 0 without rows."""
    v = rows.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v")).where("size(v) > 0")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = v.where(F.coalesce(fine, F.lit(False)))
    most = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = most["d"] if most else 0
    return v.where(F.size("v") == d).select("id", F.transform("v", lambda c: F.floor(c * LEVELS)).alias("x")), d


@F.pandas_udf(BinaryType())
def vector_key(x: pd.Series) -> pd.Series:
    """The vector's entries in the narrowest of three widths; equal keys mean equal vectors, as width and length tell them apart."""
    out = []
    for v in x:
        top = max(int(v.max()), -1 - int(v.min()))
        out.append(v.astype(_WIDTHS[0] if top < 1 << 15 else _WIDTHS[1] if top < 1 << 31 else _WIDTHS[2]).tobytes())
    return pd.Series(out, dtype=object)


def _vectors(keys: pa.Array, d: int) -> np.ndarray:
    """The keys as rows of longs."""
    raw = keys.to_pylist()
    out = np.empty((len(raw), d), np.int64)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for width in _WIDTHS:
        at = np.flatnonzero(sizes == d * np.dtype(width).itemsize)
        if len(at):
            out[at] = np.frombuffer(b"".join(raw[i] for i in at), width).reshape(len(at), d)
    return out


def _parts(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _PART):
            piece = batch.slice(at, _PART)
            yield piece, _vectors(piece.column("key"), d)


def _scaled(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly: longs where they suffice, else Python integers."""
    biggest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums.tolist()), default=0)
    if biggest < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


@dataclass(frozen=True)
class Whitening:
    """What the fit learnt: weight and sums of the fit list, and the projections onto its first components."""

    n: int
    sums: np.ndarray  # per dimension, Python integers
    values: np.ndarray  # eigenvalues, falling, of the components that can be whitened
    vectors: np.ndarray  # their unit eigenvectors, in columns
    trace: float

    def deviations(self, x: np.ndarray) -> list[int | None]:
        far = _scaled(x, self.n, self.sums)
        if far.dtype != object and len(far) and int(np.abs(far).max()) ** 2 * far.shape[1] >= 1 << 63:
            far = far.astype(object)
        squares = (far * far).sum(axis=1)
        return [int(s) if s < 1 << 63 else None for s in squares]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        centred = _scaled(x, self.n, self.sums).astype(float) / self.n
        return centred @ self.vectors / np.sqrt(self.values)


def fit(distinct: DataFrame, d: int, components: int = COMPONENTS, weights: str = "one") -> Whitening | None:
    """Fit over (key, copies): every distinct vector weighs one, or as much as it has copies (``weights="copies"``).

    Sums are exact. The covariance is centred before multiplying and has the total
    weight as divisor. None where nothing varies.
    """
    weigh = weights == "copies"

    def sums(batches):
        for piece, x in _parts(batches, d):
            w = piece.column("copies").to_numpy() if weigh else np.ones(len(x), np.int64)
            if len(x) and int(np.abs(x.astype(float)).max() * w.sum()) >= 1 << 62:
                x = x.astype(object)
            total = (x * w[:, None]).sum(axis=0)
            yield pa.record_batch({"i": pa.array(range(d), pa.int32()), "n": pa.array([int(w.sum())] * d), "total": pa.array([str(t) for t in total])})

    got = distinct.mapInArrow(sums, "i int, n long, total string").groupBy("i")
    got = {r["i"]: r for r in got.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    if not got:
        return None
    n, total = int(got[0]["n"]), np.array([int(got[i]["total"]) for i in range(d)], dtype=object)

    def products(batches):
        square = np.zeros((d, d))
        for piece, x in _parts(batches, d):
            centred = _scaled(x, n, total).astype(float) / n
            w = piece.column("copies").to_numpy().astype(float)[:, None] if weigh else 1.0
            square += centred.T @ (centred * w)
        yield pa.record_batch({"i": pa.array(range(d), pa.int32()), "line": pa.array(list(square), pa.list_(pa.float64()))})

    @F.pandas_udf("array<double>")
    def summed(line: pd.Series) -> list:
        return np.sum(np.stack(line.to_list()), axis=0)

    lines = {r["i"]: r["line"] for r in distinct.mapInArrow(products, "i int, line array<double>").groupBy("i").agg(summed("line").alias("line")).collect()}
    cov = np.array([lines[i] for i in range(d)]) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values)[:components]
    order = order[values[order] > max(values.max(), 0) * d * np.finfo(float).eps]
    if not len(order):
        return None
    return Whitening(n, total, values[order], vectors[:, order], float(np.trace(cov)))


def whiten(rows: DataFrame, id_column: str, vector_column: str, components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error): one row per row that takes part.

    ``whitened`` and ``explained`` are arrays by component; ``identity_error`` is the
    largest distance of the whitened vectors' covariance, over the fit list, from the
    identity.
    """
    spark = rows.sparkSession
    none = spark.createDataFrame([], rows.select(F.col(id_column).alias("id")).schema).selectExpr(
        "id", "0L n", "0L deviation", "array(0d) whitened", "array(0d) explained", "0d identity_error"
    )
    x, d = integer_vectors(rows, id_column, vector_column)
    if not d:
        return none
    keyed = stage(x.select("id", vector_key("x").alias("key")), "vector_keys")
    distinct = stage(keyed.groupBy("key").agg(F.count("*").alias("copies")), "distinct_vectors")
    model = fit(distinct, d, components, weights)
    if model is None:
        return none
    k = len(model.values)

    def score(batches):
        for piece, v in _parts(batches, d):
            yield pa.record_batch(
                {
                    "key": piece.column("key").cast(pa.binary()),
                    "copies": piece.column("copies"),
                    "deviation": pa.array(model.deviations(v), pa.int64()),
                    "whitened": pa.array(list(model.whiten(v)), pa.list_(pa.float64())),
                }
            )

    scored = stage(distinct.mapInArrow(score, "key binary, copies long, deviation long, whitened array<double>"), "whitened_vectors")
    error = _identity_error(scored, k, weights == "copies")
    # keys with over 1/(8 partitions) of all rows: at most 8 a partition, so their table is small by its definition
    rows_all = scored.agg(F.sum("copies")).first()[0]
    share = max(1, rows_all // (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = F.broadcast(scored.where(F.col("copies") > share).select(F.col("key").alias("k"), F.col("deviation").alias("d"), F.col("whitened").alias("w")))
    with_hot = keyed.join(hot, F.col("key") == F.col("k"), "left")
    cold = with_hot.where("k is null").select("id", "key").join(scored.where(F.col("copies") <= share), "key").select("id", "deviation", "whitened")
    out = with_hot.where("k is not null").select("id", F.col("d").alias("deviation"), F.col("w").alias("whitened")).unionByName(cold)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return out.select("id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def _identity_error(scored: DataFrame, k: int, weigh: bool) -> float:
    """Largest entry of covariance minus identity; means first, so that products are of centred values."""
    at = lambda i: F.col("whitened")[i]
    w = F.col("copies").cast("double") if weigh else F.lit(1.0)
    total, *means = scored.agg(F.sum(w), *[F.sum(at(i) * w) / F.sum(w) for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = scored.agg(*[F.sum((at(i) - means[i]) * (at(j) - means[j]) * w) / total for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, got))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    each: Column = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    got = got.select("id", "n", "deviation", "identity_error", each)
    return got.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error",
    )

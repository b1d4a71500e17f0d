"""Benchmark decontamination by greedy string tiling.

Texts are words (A-Z lower-cased, ASCII punctuation dropped). Every run of ``SEED``
words has a Karp-Rabin hash. Document seeds meet the benchmark's seeds in a join on
the hash; a bitmap of fixed size first drops seeds that no item has. Shared seeds on
one diagonal make a match, and within a document and an item the longest match that
is still unmarked is taken again and again until none of ``SEED`` words is left. The
tiles may stand in any order, so reordered passages count too. A document is
contaminated by an item if its tiles cover at least ``COVERAGE`` of the item's words.

Null and empty texts and items of fewer than ``SEED`` words match nothing. Rows with
equal doc_id and equal text are judged as one; a null doc_id is a value like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from loanclean.llm import base
from loanclean.llm.base import documents, stage, table

SEED = 4
COVERAGE = 0.5
BITMAP_BITS = 1 << 24  # 2 MB in every task, whatever the benchmark's size
_BASE = 0x9E3779B97F4A7C15
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 33 or (b < 128 and not chr(b).isalnum()) else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_CLEAN).split()


def seed_hashes(tokens: list[bytes], n: int = SEED) -> np.ndarray:
    """Karp-Rabin hash of every run of n words, as signed 64-bit numbers."""
    if len(tokens) < n:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    w = np.fromiter(map(digest, tokens), np.uint64, len(tokens))
    size, out = len(w) - n + 1, np.zeros(len(w) - n + 1, np.uint64)
    for j in range(n):
        out = out * np.uint64(_BASE) + w[j : j + size]
    out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _seeds(texts: DataFrame, carried: str, kind: str, bitmap: np.ndarray | None = None) -> DataFrame:
    """(carried columns, pos, seed, n_words) of the texts; with a bitmap only seeds whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pos, seed, size = [], [], [], []
            for i, t in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                tokens = words(t)
                h = seed_hashes(tokens)
                at = np.arange(len(h))
                if bitmap is not None:
                    at = np.flatnonzero(base.in_bitmap(bitmap, h))
                rows.append(np.full(len(at), i))
                pos.append(at)
                seed.append(h[at])
                size.append(np.full(len(at), len(tokens)))
            if not rows:
                continue
            take = pa.array(np.concatenate(rows), pa.int64())
            kept = [batch.column(j).take(take) for j in range(batch.num_columns - 1)]
            rest = [pa.array(np.concatenate(x), t) for x, t in ((pos, pa.int32()), (seed, pa.int64()), (size, pa.int32()))]
            yield pa.RecordBatch.from_arrays(kept + rest, names=batch.schema.names[:-1] + ["pos", "seed", "n_words"])

    return texts.mapInArrow(run, f"{kind}, pos int, seed long, n_words int")


def tiles(pairs: list[tuple[int, int]], n: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles (document word, item word, length) from shared seeds (document word, item word).

    Longest first; ties go to the earlier item word, then the earlier document word.
    A match that earlier tiles cut is taken again with what is left of it.
    """
    runs: list[list[int]] = []
    for d, i in sorted(set(pairs), key=lambda p: (p[0] - p[1], p[1])):
        if runs and runs[-1][0] - runs[-1][1] == d - i and runs[-1][1] + runs[-1][2] - n + 1 == i:
            runs[-1][2] += 1
        else:
            runs.append([d, i, n])
    marked_d, marked_i, out = set(), set(), []
    pending = sorted(runs, key=lambda r: (-r[2], r[1], r[0]))
    while pending:
        d, i, size = pending.pop(0)
        free = [k for k in range(size) if d + k not in marked_d and i + k not in marked_i]
        if len(free) == size:
            out.append((d, i, size))
            marked_d.update(range(d, d + size))
            marked_i.update(range(i, i + size))
            continue
        parts, begin = [], 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - begin >= n:
                    parts.append([d + free[begin], i + free[begin], k - begin])
                begin = k
        if parts:
            pending = sorted(pending + parts, key=lambda r: (-r[2], r[1], r[0]))
    return out


@F.pandas_udf(StructType([StructField("matched", IntegerType()), StructField("n_tiles", IntegerType())]))
def _tiled(pairs: pd.Series) -> pd.DataFrame:
    rows = []
    for p in pairs:
        got = tiles([(x["pos"], x["item_pos"]) for x in p])
        rows.append((sum(t[2] for t in got), len(got)))
    return pd.DataFrame(rows, columns=["matched", "n_tiles"])


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, digest, item_id, matched, n_tiles, item_words, coverage) of documents and items beyond the threshold.

    ``digest`` is xxhash64 of the text. Before tiling, pairs whose shared seeds could
    not cover enough of the item are dropped, which loses none. Items with equal
    item_id and text are one.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item_digest"), "text").dropDuplicates(["item_id", "item_digest"])
    own = stage(_seeds(items, "item", "item_id long, item_digest long"), "seeds").withColumnRenamed("pos", "item_pos").withColumnRenamed("n_words", "item_words")
    hits = _seeds(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text"), "doc", "doc_id long, digest long", base.bitmap(own.select("seed"), BITMAP_BITS))
    shared = hits.select("doc_id", "digest", "pos", "seed").join(own, "seed")
    key = ["doc_id", "digest", "item_id", "item_digest", "item_words"]
    pairs = shared.groupBy(*key).agg(F.collect_set(F.struct("pos", "item_pos")).alias("pairs"))
    enough = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item_pos"]))) * SEED >= F.col("item_words") * coverage
    out = pairs.where(enough).withColumn("t", _tiled("pairs"))
    out = out.select("doc_id", "digest", "item_id", "t.matched", "t.n_tiles", "item_words", (F.col("t.matched") / F.col("item_words")).alias("coverage"))
    return out.where(F.col("coverage") >= coverage)


def op9_greedy_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "matched", "n_tiles", "item_words", "coverage")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark passage go."""
    gone = stage(contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("doc_id__"), F.col("digest").alias("digest__")).distinct(), "gone")
    same = docs["doc_id"].cast("long").eqNullSafe(gone["doc_id__"]) & (F.xxhash64(docs["text"]) == gone["digest__"])
    return docs.join(gone, same, "left_anti").select(docs.columns)

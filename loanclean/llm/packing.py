"""Best-fit packing of documents into sequences of a fixed number of tokens.

Linear grouping scheme. The lengths of all pieces make a histogram of at most
``capacity`` rows; everything is planned on it. Full pieces stand alone. The large
ones, longest first, are cut into groups of equal cardinality and rounded up to the
longest of their group, so that few sizes are left; configurations of these sizes are
optimised one after the other (a bounded knapsack around the largest size left, used
as often as stock allows). Then the actual lengths take the places of the rounded
ones, and the small pieces go by best fit into the space that is left, longest first.
Several numbers of groups are planned and the one with the fewest sequences is used.

A plan is a list of runs: pieces of one length, from rank to rank, go to sequences
from number to number at some offset. Its size depends on the capacity, not on the
number of documents. Ranks within a length are numbered per bucket, so a length that a
third of all pieces have is no hot key.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanclean.llm import tokens
from loanclean.llm.base import documents, shards, stage

CAPACITY = 2048
GROUPS = (64, 160, 400, 800)
SMALL = 8  # pieces shorter than capacity / SMALL are small
Run = tuple[int, int, int, int, int]  # length, first rank, pieces, first sequence, offset


def word_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every whole text, with end id 0: doc_id, piece, start, length, ids_crc32[, ids].

    Null and empty texts have the end id only. Repeated rows are packed each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(path, split_special=False)
        for batch in batches:
            for begin, texts in tokens.slices(batch.column(1)):
                flat, counts = tokens.with_end(*coder.encode(texts))
                n = -(-counts // capacity)
                row = np.repeat(np.arange(begin, begin + len(texts)), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, counts[row - begin] - start)
                at = np.append(0, np.cumsum(length))
                raw = memoryview(flat.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
                out = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if ids:
                    out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _pattern(sizes: np.ndarray, stock: np.ndarray, room: int) -> list[int]:
    """Numbers of the sizes (repeats allowed, within stock) that fill ``room`` best: a bounded knapsack."""
    last = np.full(room + 1, -1)  # reachable sums, with the size that reached them first
    last[0] = len(sizes)
    for g in np.flatnonzero((stock > 0) & (sizes <= room)):
        s = int(sizes[g])
        for _ in range(int(min(stock[g], room // s))):
            new = np.flatnonzero((last[:-s] >= 0) & (last[s:] < 0)) + s
            if not len(new):
                break
            last[new] = g
        if last[room] >= 0:
            break
    at, out = int(np.flatnonzero(last >= 0)[-1]), []
    while at:
        out.append(int(last[at]))
        at -= int(sizes[last[at]])
    return out


def _configurations(sizes: np.ndarray, stock: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """(sizes of a sequence, how many such sequences) until the stock is used up."""
    stock, out = stock.copy(), []
    for g in range(len(sizes)):  # from the largest size on
        while stock[g]:
            stock[g] -= 1
            pattern = [g, *_pattern(sizes, stock, capacity - int(sizes[g]))]
            stock[g] += 1
            used = np.bincount(pattern, minlength=len(sizes))
            short = np.flatnonzero(used > stock)
            while len(short):  # a sum may have reused a size beyond its stock
                pattern.remove(int(short[0]))
                used = np.bincount(pattern, minlength=len(sizes))
                short = np.flatnonzero(used > stock)
            times = int((stock[used > 0] // used[used > 0]).min())
            stock -= used * times
            out.append((pattern, times))
    return out


def plan(histogram: dict[int, int], capacity: int, groups: int) -> tuple[int, list[Run]]:
    """Number of sequences and the runs, for one number of groups."""
    runs: list[Run] = []
    sequences = histogram.get(capacity, 0)
    if sequences:
        runs.append((capacity, 0, sequences, 0, 0))
    space: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of sequences

    def leave(room: int, low: int, high: int) -> None:
        if room > 0:
            if room not in space:
                insort(rooms, room)
            space.setdefault(room, []).append((low, high))

    rooms: list[int] = []
    large = [(n, histogram[n]) for n in sorted(histogram, reverse=True) if capacity // SMALL < n < capacity]
    lengths, counts = np.array([x[0] for x in large], np.int64), np.array([x[1] for x in large], np.int64)
    ends, total = np.cumsum(counts), int(counts.sum())
    if total:
        bounds = np.unique(np.linspace(0, total, min(groups, total) + 1).astype(np.int64))
        sizes = lengths[np.searchsorted(ends, bounds[:-1], side="right")]
        merged, first = np.unique(-sizes, return_index=True)
        bounds = np.append(bounds[:-1][first], total)
        taken = bounds[:-1].copy()
        for pattern, times in _configurations(-merged, np.diff(bounds), capacity):
            slots = []
            for g in pattern:
                slots.append(int(taken[g]))
                taken[g] += times
            cuts = {0, times}
            for s in slots:  # where a slot goes over to the next shorter length
                inside = ends[(ends > s) & (ends < s + times)] - s
                cuts.update(inside.tolist())
            marks = sorted(cuts)
            for a, b in zip(marks, marks[1:]):
                offset = 0
                for s in slots:
                    k = int(np.searchsorted(ends, s + a, side="right"))
                    runs.append((int(lengths[k]), s + a - int(ends[k] - counts[k]), b - a, sequences + a, offset))
                    offset += int(lengths[k])
                leave(capacity - offset, sequences + a, sequences + b)
            sequences += times
    for n in sorted((n for n in histogram if n <= capacity // SMALL), reverse=True):
        rank, left = 0, histogram[n]
        while left:
            at = bisect_left(rooms, n)
            if at == len(rooms):
                new = -(-left // (capacity // n))
                leave(capacity, sequences, sequences + new)
                sequences += new
                continue
            room = rooms[at]
            low, high = space[room].pop()
            if not space[room]:
                del space[room]
                rooms.pop(at)
            k = min(left, high - low)
            runs.append((n, rank, k, low, capacity - room))
            leave(room - n, low, low + k)
            if low + k < high:
                leave(room, low + k, high)
            rank, left = rank + k, left - k
    return sequences, runs


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> tuple[int, list[Run]]:
    return min((plan(histogram, capacity, g) for g in groups), key=lambda p: p[0])


def assign(cut: DataFrame, parts: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``cut`` is read several times: stage it first."""
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs = sorted(best_plan(histogram, capacity)[1])
    order = np.array([(n, rank) for n, rank, *_ in runs], np.int64).reshape(-1, 2)
    key, first = (order[:, 0] << 44) + order[:, 1], order[:, 1]
    sequence, offset = np.array([r[3] for r in runs], np.int64), np.array([r[4] for r in runs], np.int64)

    @F.pandas_udf("struct<sequence_id long, offset long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(key, (length.to_numpy() << 44) + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank.to_numpy() - first[at], "offset": offset[at]})

    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(parts))
    rows = cut.withColumn("bucket__", bucket)
    sizes = rows.groupBy("length", "bucket__").agg(F.count("*").alias("n__"))
    before = Window.partitionBy("length").orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket__", F.coalesce(F.sum("n__").over(before), F.lit(0)).alias("base__"))
    within = Window.partitionBy("length", "bucket__").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("in__", F.row_number().over(within) - 1).join(bases, ["length", "bucket__"])
    return ranked.withColumn("p__", place("length", F.col("base__") + F.col("in__"))).select(*[F.col(c) for c in cut.columns], "p__.sequence_id", "p__.offset")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Every piece of every document with its place; with ``ids`` also the ids (see ``sequences``)."""
    cut = stage(pieces(docs, path, capacity, ids), "pieces")
    return assign(cut, shards(docs, 16), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids in order, from ``pack(..., ids=True)``; a sequence is bounded by the capacity."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(rows, lambda r: r["ids"])).alias("ids"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(documents(spark, sf_dir), word_path())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of what is left."""
    return pack(docs, word_path()).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

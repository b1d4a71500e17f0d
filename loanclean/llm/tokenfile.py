"""Token files: Parquet tables of documents with their token ids as a list column.

Rows stand in ascending doc_id order, over files and within them. Ids are dictionary
encoded (50,000 values, two bytes each before compression); the running numbers fall
back to delta encoding (format version 2), row groups and pages have fixed sizes, and
the writer adds column and offset indexes, so a reader of the metadata never touches
ids and a reader of a doc_id range touches few pages.

Columns: doc_id, shard (number of the writing task), at (ids before the document
within its shard), n_tokens, ids. The position in the whole corpus needs only the
shards' totals, one row a file.

Null and empty texts have the end id only. Null doc_ids come first. Repeated rows are
written each, ties in the order of their texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanclean.llm import tokens
from loanclean.llm.base import documents, shards
from loanclean.sources.staging import staging_path

FORMAT = {
    "parquet.block.size": 32 << 20,
    "parquet.page.size": 256 << 10,
    "parquet.page.row.count.limit": 2000,
    "parquet.dictionary.page.size": 1 << 20,
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#at": "false",
    "compression": "zstd",
}


def byte_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, mb: float = 32) -> None:
    """Encode every whole text, with end id 0, and write the token file at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, before = tokens.encoder(tokenizer, split_special=False), TaskContext.get().partitionId(), 0
        for batch in batches:
            for begin, texts in tokens.slices(batch.column(1)):
                flat, counts = tokens.with_end(*coder.encode(texts))
                ends = np.cumsum(counts)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat.astype(np.int32)))
                columns = [batch.column(0).slice(begin, len(texts)), pa.array(np.full(len(texts), shard), pa.int32()), pa.array(before + ends - counts, pa.int64()), pa.array(counts, pa.int64()), ids]
                before += int(ends[-1])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shard", "at", "n_tokens", "ids"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = rows.repartitionByRange(shards(docs, mb), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, "doc_id long, shard int, at long, n_tokens long, ids array<int>").write.options(**FORMAT).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids; unused columns are not read."""
    table = spark.read.parquet(path)
    totals = table.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return table.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, and ids_crc32 over the ids as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                ids = part.column(3)
                at = (np.asarray(ids.offsets) - ids.offsets[0].as_py()).tolist()
                raw = ids.flatten().to_numpy().astype("<u4", copy=False)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([b - a for a, b in zip(at, at[1:])], pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
            pa.default_memory_pool().release_unused()

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, byte_path())
    return digests(read_tokens(spark, path))

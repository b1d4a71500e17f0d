"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of orders 3 to 0 with frozen counts. A byte
costs -log2 of its probability in the longest known context; where a context has
not seen the byte, the escape is paid (method C: as many escapes as distinct
successors) and the next shorter context is asked, down to 1/256 each. A context
never seen costs nothing. A text's language is the one with the shortest code.

Under frozen counts a byte's cost depends on it and the three bytes before it alone, so
the trees become tables: whole batches of texts are scored by table lookups. Texts are
lower-cased and start in a context of three zero bytes.

Trained on at most ``SAMPLE_PER_LANGUAGE`` whole documents of each language, chosen by a
hash of doc_id; rows without doc_id are not chosen. Null texts and texts without a
letter are ``und`` with score 0, as is every text if no language could be learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanclean.llm.base import documents, held_out

SAMPLE_PER_LANGUAGE = 1000
_BLOCK = 1 << 20


def _windows(raw: bytes) -> np.ndarray:
    """For each byte: itself and the three before it as one number, the byte lowest."""
    b = np.frombuffer(b"\0\0\0" + raw, np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Bounded training rows (lang, text); the choice needs ids only, and is cut per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = docs.where("lang is not null and doc_id is not null and text is not null").where(held_out(F.col("doc_id"), 4) != 2)
    chosen = ids.select("doc_id", "lang").withColumn("rank__", rank).where(F.col("rank__") <= per_language).select("doc_id", "lang").distinct()
    return docs.select("doc_id", "lang", "text").where("text is not null").join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text")


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) of the four-byte windows of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(_windows(_bytes(text)))
            for lang, grams in by.items():
                g, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Code lengths of all languages as lookup tables."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        many = len(self.langs)
        grams = [np.unique(np.concatenate([counts[x][0] & (1 << 8 * k) - 1 for x in self.langs])) if many else np.zeros(0, np.int64) for k in (1, 2, 3, 4)]
        self.grams, costs, escapes = grams, [], []
        lower = np.full((256, many), 8.0)  # order -1: every byte alike
        for k in range(1, 5):
            # rows: known grams of k bytes (the byte and its context of order k - 1); unseen ones escape
            keys, cost = grams[k - 1], np.zeros((len(grams[k - 1]), many))
            contexts = np.unique(keys >> 8)
            escape = np.zeros((len(contexts), many))
            below = lower[keys & 0xFF] if k == 1 else costs[-1][np.searchsorted(grams[k - 2], keys & (1 << 8 * (k - 1)) - 1)]
            at = np.searchsorted(contexts, keys >> 8)
            for j, lang in enumerate(self.langs):
                g, n = counts[lang]
                own, inverse = np.unique(g & (1 << 8 * k) - 1, return_inverse=True)
                c = np.zeros(len(keys))
                c[np.searchsorted(keys, own)] = np.bincount(inverse, n, len(own))
                total, kinds = np.bincount(at, c, len(contexts)), np.bincount(at, c > 0, len(contexts))
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape[:, j] = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                    cost[:, j] = np.where(c > 0, -np.log2(c / (total + kinds)[at]), escape[at, j] + below[:, j])
            costs.append(cost)
            escapes.append((contexts, escape))
        self.costs, self.escapes = costs, escapes
        self._tables()

    def _tables(self) -> None:
        many = len(self.langs)
        # two bytes: cost and escape of the context, dense
        one = np.tile(self.escapes[0][1] if len(self.escapes[0][1]) else np.zeros((1, many)), (256, 1)) + 8.0
        one[self.grams[0]] = self.costs[0]
        self.cost2 = np.tile(one, (256, 1))
        esc1 = np.zeros((256, many))
        esc1[self.escapes[1][0]] = self.escapes[1][1]
        self.cost2 += np.repeat(esc1, 256, axis=0)
        self.cost2[self.grams[1]] = self.costs[1]
        self.esc2 = np.zeros((65536, many))
        self.esc2[self.escapes[2][0]] = self.escapes[2][1]
        # three bytes: number of a known gram, 0 if unknown
        self.number3 = np.zeros(1 << 24, np.int32)
        self.number3[self.grams[2]] = np.arange(1, len(self.grams[2]) + 1)
        self.cost3 = np.concatenate([np.zeros((1, many)), self.costs[2]])
        self.esc3 = np.zeros((len(self.grams[2]) + 1, many))  # a context of order 3 that ended a text was never left
        contexts, escape = self.escapes[3]
        known = self.number3[contexts]
        self.esc3[known[known > 0]] = escape[known > 0]
        self.rare3 = dict(zip(contexts[known == 0].tolist(), escape[known == 0]))
        # four bytes: number by (number of the three bytes before, byte)
        self.number4 = np.zeros(((len(self.grams[2]) + 1), 256), np.int32)
        before = known[np.searchsorted(contexts, self.grams[3] >> 8)]
        fine = before > 0
        self.number4[before[fine], self.grams[3][fine] & 0xFF] = np.flatnonzero(fine) + 1
        self.cost4 = np.concatenate([np.zeros((1, many)), self.costs[3]]).astype(np.float32)
        self.rare4 = {int(g): self.costs[3][i] for i, g in zip(np.flatnonzero(~fine), self.grams[3][~fine])}

    def lengths(self, raw: bytes) -> np.ndarray:
        """Code length of the bytes in every language, in bits."""
        total = np.zeros(len(self.langs))
        for at in range(0, len(raw), _BLOCK):
            w = _windows(raw[max(0, at - 3) : at + _BLOCK])[3 if at else 0 :]
            if at:  # the block starts in the middle of the text
                head = raw[at - 3 : at + 3]
                w[: min(3, len(w))] = _windows(head)[3:][: min(3, len(w))]
            total += self._block(w)
        return total

    def _block(self, w: np.ndarray) -> np.ndarray:
        context = self.number3[w >> 8]
        four = self.number4[context, w & 0xFF]
        seen = four > 0
        total = np.bincount(four[seen], minlength=1)
        used = np.flatnonzero(total)
        out = total[used] @ self.cost4[used].astype(float)
        rest = w[~seen]
        if len(rest):
            grams, n = np.unique(rest, return_counts=True)
            esc = self.esc3[self.number3[grams >> 8]]
            three = self.number3[grams & 0xFFFFFF]
            low = np.where((three > 0)[:, None], self.cost3[three], self.esc2[(grams >> 8) & 0xFFFF] + self.cost2[grams & 0xFFFF])
            cost = esc + low
            for i, g in enumerate(grams.tolist()):  # contexts at the start of texts
                if g >> 24 == 0:
                    if g in self.rare4:
                        cost[i] = self.rare4[g]
                    elif g >> 8 in self.rare3:
                        cost[i] = self.rare3[g >> 8] + low[i]
            out = out + n @ cost
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        bits = self.lengths(_bytes(text))
        best = int(bits.argmin())
        return self.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Counts of each language's grams; bounded by the sample."""
    got = gram_counts(sample(docs, per_language)).toPandas()
    return {lang: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(float)) for lang, g in got.groupby("lang")}


_trees: dict[int, ContextTrees] = {}


def predict_column(counts: dict, text: str = "text"):
    """struct(lang_pred, score) of the text. Trees are built once in a worker."""
    import uuid

    key = uuid.uuid4().int

    @F.pandas_udf("struct<lang_pred string, score double>")
    def predict(t: pd.Series) -> pd.DataFrame:
        if key not in _trees:
            _trees.clear()
            _trees[key] = ContextTrees(counts)
        return pd.DataFrame([_trees[key].predict(x) for x in t], columns=["lang_pred", "score"])

    return predict(F.col(text))


def op6_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = docs.select("doc_id", predict_column(train(docs)).alias("p"))
    return out.select("doc_id", (held_out(F.col("doc_id"), 4) == 2).alias("held_out"), "p.lang_pred", "p.score")

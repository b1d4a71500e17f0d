"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a few dozen shape features (lengths, character classes, repeats).
The model is a sum of lookup tables: one per binned feature, and one per chosen
pair of features. Cyclic boosting with shallow trees fills the tables: each turn
fits one small tree on one feature and adds its leaves to that feature's table.
Scoring adds table entries, so a batch of texts costs one gather per table.

Null and empty texts have zero features and are scored like any other.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from loanclean.llm.base import documents, held_out, table

FEATURES = [
    "bytes", "words", "word_length", "upper", "digit", "space", "newline", "non_ascii", "sentence_end", "comma",
    "shout", "symbol", "bar", "markup", "quote", "distinct_words", "top_word", "same_word_runs", "lines", "distinct_lines",
    "line_length", "sentence_length", "capital_words", "short_words", "long_words", "entropy",
]
SAMPLE_ROWS = 20_000
BINS = 32
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t", "newline": b"\n", "sentence_end": b".?", "comma": b",",
    "shout": b"!", "symbol": b"#$%&*^~@+=", "bar": b"|", "markup": b"<>{}[]\\/_", "quote": b"\"'()",
}
_MEMBERS = np.array([[chr(b).encode("latin-1") in [bytes([x]) for x in _CLASSES.get(f, b"")] for b in range(256)] for f in FEATURES], dtype=float)


def text_features(text: str | None) -> np.ndarray:
    """The features of one whole text, in the order of FEATURES."""
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    out[:] = _MEMBERS @ counts / n
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    tally: dict[str, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    m, k = max(1, len(words)), max(1, len(lines))
    share = counts[counts > 0] / n
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = counts[46] + counts[33] + counts[63]
    more = {
        "bytes": np.log1p(n), "words": np.log1p(len(words)), "word_length": lengths.mean() if len(words) else 0.0,
        "non_ascii": counts[128:].sum() / n, "distinct_words": len(tally) / m, "top_word": max(tally.values(), default=0) / m,
        "same_word_runs": sum(a == b for a, b in zip(words, words[1:])) / m, "lines": np.log1p(len(lines)),
        "distinct_lines": len(set(lines)) / k, "line_length": np.log1p(n / k), "sentence_length": np.log1p(len(words) / (1 + ends)),
        "capital_words": sum(w[0].isupper() for w in words) / m, "short_words": (lengths <= 2).mean() if len(words) else 0.0,
        "long_words": (lengths >= 12).mean() if len(words) else 0.0, "entropy": float(-(share * np.log2(share)).sum()),
    }
    for name, value in more.items():
        out[FEATURES.index(name)] = value
    return out


@F.pandas_udf(ArrayType(DoubleType()))
def features(text: pd.Series) -> pd.Series:
    return pd.Series([text_features(t) for t in text])


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``pairs`` maps two feature numbers to a 2-d table."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for j, t in enumerate(self.tables):
            total += t[bins[:, j]]
        for (i, j), t in self.pairs.items():
            total += t[bins[:, i], bins[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.bins(x))))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return -g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree_1d(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Leaf value of every bin: the histogram is split greedily into ``leaves`` ranges."""
    cuts = [0, len(g)]
    G, H = np.concatenate([[0], g.cumsum()]), np.concatenate([[0], h.cumsum()])
    while len(cuts) <= leaves:
        best = (1e-9, 0)
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                at = np.arange(a + 1, b)
                won = _gain(G[at] - G[a], H[at] - H[a]) + _gain(G[b] - G[at], H[b] - H[at]) - _gain(G[b] - G[a], H[b] - H[a])
                best = max(best, (float(won.max()), int(at[won.argmax()])))
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = _leaf(G[b] - G[a], H[b] - H[a])
    return out


def _tree_2d(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best single cut on each axis: gain, and the value of every cell of the four quadrants."""
    G, H = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    a, b = G[1:-1, 1:-1], H[1:-1, 1:-1]
    top, left, whole = (G[1:-1, -1:], H[1:-1, -1:]), (G[-1:, 1:-1], H[-1:, 1:-1]), (G[-1, -1], H[-1, -1])
    parts = [(a, b), (top[0] - a, top[1] - b), (left[0] - a, left[1] - b), (whole[0] - top[0] - left[0] + a, whole[1] - top[1] - left[1] + b)]
    gain = sum(_gain(*p) for p in parts) - _gain(*whole)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros(g.shape)
    for (pg, ph), rows, cols in zip(parts, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)), (slice(0, j + 1), slice(j + 1, None)) * 2):
        out[rows, cols] = _leaf(pg[i, j], ph[i, j])
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, pairs: int = 6, pair_rounds: int = 40) -> AdditiveModel:
    """Cyclic boosting on the logistic loss: first all features in turn, then the strongest pairs.

    Without both labels the model is its (smoothed) base rate.
    """
    prior = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel([np.zeros(0)] * x.shape[1], float(np.log(prior / (1 - prior))))
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(set(y.tolist())) < 2:
        return model
    bins = model.bins(x)
    margin = model.margin(bins)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            if len(t) > 1:
                g, h = slopes()
                step = rate * _tree_1d(np.bincount(bins[:, j], g, len(t)), np.bincount(bins[:, j], h, len(t)))
                t += step
                margin += step[bins[:, j]]
    cells = {(i, j): bins[:, i] * len(model.tables[j]) + bins[:, j] for i in range(len(model.tables)) for j in range(i) if min(len(model.tables[i]), len(model.tables[j])) > 1}

    def grown(ij: tuple[int, int], g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        shape = (len(model.tables[ij[0]]), len(model.tables[ij[1]]))
        return _tree_2d(np.bincount(cells[ij], g, shape[0] * shape[1]).reshape(shape), np.bincount(cells[ij], h, shape[0] * shape[1]).reshape(shape))

    g, h = slopes()
    chosen = sorted(cells, key=lambda ij: -grown(ij, g, h)[0])[:pairs]
    model.pairs = {ij: np.zeros((len(model.tables[ij[0]]), len(model.tables[ij[1]]))) for ij in chosen}
    for _ in range(pair_rounds):
        for ij, t in model.pairs.items():
            step = rate * grown(ij, *slopes())[1]
            t += step
            margin += step.ravel()[cells[ij]]
    return model


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold, chosen by a hash of doc_id.

    Repeated label rows of a document count once (the larger label); labels of null
    or unknown documents don't count. Only the sample's features reach the driver.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .where(held_out(F.col("doc_id"), 5) != 0)
        .groupBy("doc_id").agg(F.max("quality").alias("label__"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    got = rows.select("doc_id", "label__", features("text").alias("x")).toPandas().sort_values("doc_id")
    x = np.stack(list(got["x"])) if len(got) else np.zeros((0, len(FEATURES)))
    return fit(x, got["label__"].to_numpy(float))


def score_column(model: AdditiveModel, text: str = "text"):
    """The score of the text as a column, 0 to 1."""

    @F.pandas_udf(DoubleType())
    def score(t: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([text_features(x) for x in t])) if len(t) else [], dtype=float)

    return score(F.col(text))


def classify(docs: DataFrame, labels: DataFrame, cutoff: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with ``score`` and ``predicted`` (1 from ``cutoff`` on); such columns of the input are replaced."""
    model = train(docs, labels, sample_rows)
    scored = docs.withColumn("score", score_column(model))
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = classify(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", (held_out(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    return docs.where(score_column(train(docs, table(spark, sf_dir, "labels"))) >= 0.3)

"""Periodic runs of words by a grammar.

A run is a stretch of words with smallest period q, at least max(``SHORTEST``, 2 q) words
long, that no neighbouring word extends at that period. How a batch of documents is
searched:

1. Words become numbers. A run is covered by word grams that occur twice in their
   document, so the stretches so covered hold all runs; documents without any are done.
2. The stretches are compressed together by Re-Pair in rounds: pairs that occur twice or
   more become nonterminals, frequent ones first (by powers of two, ties by a hash, so
   that a round replaces many pairs). What is left of a stretch is paired up until one
   symbol derives it.
3. Each nonterminal is looked at once, at its first place: which runs of its expansion
   cross the boundary of its two symbols? Candidate periods come from equal words or
   grams at the boundary; common extensions to both sides, from names of all stretches
   of 2^k words, give the ends.
4. The runs are translated to every place where the nonterminal was made. Of those with
   one period the maximal intervals are kept. A run lies whole in the lowest symbol that
   derives it and crosses its boundary, so none is missed, and what a symbol's border
   cuts off lies inside the whole one.

Memory grows with the words of one batch (``BATCH_WORDS``, or one longer document).
Null and empty texts have no words and no runs. Rows count each for itself, whether
their ids repeat or are null.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanclean.llm.base import documents

SHORTEST = 12  # words of a run, at least
GRAM = SHORTEST // 2  # words of a gram that any run repeats at the distance of its period
NEAR = SHORTEST  # periods below are sought by words, from here on by grams
BATCH_WORDS = 300_000
_CANDIDATES = 1 << 20  # (nonterminal, period) looked at in one go
RESULT = "n_words long, runs array<struct<start: long, length: long, period: long>>, kept string"


def _names(values: np.ndarray) -> np.ndarray:
    """Equal values get equal small numbers."""
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _distinct(rows: np.ndarray) -> np.ndarray:
    """Different rows, ordered by their first column, then the second, ..."""
    rows = rows[np.lexsort(rows.T[::-1])]
    fresh = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]) if len(rows) else np.zeros(0, bool)
    return rows[fresh]


class Names:
    """Numbers of all stretches of 2^k words: equal ones have equal numbers, which gives common extensions exactly."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        self.levels = [words]
        while 2 << len(self.levels) <= 2 * longest and 1 << len(self.levels) <= len(words):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(_names(last[:-half] * (int(last.max()) + 1) + last[half:]))

    def forward(self, i: np.ndarray, j: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Equal words from i and j (i < j) onwards, at most ``room``."""
        got = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                at = np.flatnonzero(got + (1 << k) <= room)
                at = at[self.levels[k][i[at] + got[at]] == self.levels[k][j[at] + got[at]]]
                got[at] += 1 << k
        return got

    def backward(self, i: np.ndarray, j: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Equal words before i and j (i < j), at most ``room``."""
        got = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                at = np.flatnonzero(got + (1 << k) <= room)
                back = got[at] + (1 << k)
                at = at[self.levels[k][i[at] - back] == self.levels[k][j[at] - back]]
                got[at] += 1 << k
        return got


def grams(words: np.ndarray) -> np.ndarray:
    """Number of the gram that starts at each word; the last ``GRAM`` - 1 words start none."""
    out = words
    for size in range(1, GRAM):
        out = _names(out[: len(words) - size] * (int(words.max()) + 1) + words[size:])
    return out


def stretches(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end places of the stretches covered by grams that occur twice in their document."""
    if len(words) < SHORTEST:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram, last = grams(words), len(words) - GRAM + 1
    whole = doc[:last] == doc[GRAM - 1 :]
    _, name, count = np.unique(gram * (int(doc[-1]) + 1) + doc[:last], return_inverse=True, return_counts=True)
    start = np.flatnonzero(whole & (count[name] > 1))
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + GRAM, -1)
    covered = np.concatenate([[0], (steps.cumsum()[:-1] > 0).astype(np.int8), [0]])
    same = np.concatenate([[False], doc[1:] == doc[:-1], [False]])
    begins = np.flatnonzero((covered[1:] == 1) & ((covered[:-1] == 0) | ~same))
    begins = begins[begins < len(words)]
    ends = np.flatnonzero((covered[1:-1] == 1) & ((covered[2:] == 0) | ~same[1:])) + 1
    keep = ends - begins >= SHORTEST
    return begins[keep], ends[keep]


def _spread(value: np.ndarray) -> np.ndarray:
    """A fixed hash of numbers, for ties."""
    x = value.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)


class Grammar:
    """Re-Pair over the stretches [begins, ends) of ``words``.

    ``symbol``, ``left``, ``middle``, ``right`` have one entry per place where a
    nonterminal was made: its number, its first word, the first word of its second
    symbol, and the word after it.
    """

    def __init__(self, words: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        places = np.concatenate([np.arange(b, e) for b, e in zip(begins, ends)]) if len(begins) else np.zeros(0, np.int64)
        self._start = places
        self._stop = places + 1
        self._part = np.repeat(np.arange(len(begins)), ends - begins)
        self._seq = _names(words[places]) if len(places) else places
        self._next = int(self._seq.max(initial=-1)) + 1
        self._made: list[tuple[np.ndarray, ...]] = []
        while self._replace(self._repeated()):
            pass
        while self._replace(self._neighbours()):
            pass
        self.symbol, self.left, self.middle, self.right = map(np.concatenate, zip(*self._made)) if self._made else [places] * 4

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs inside one stretch, and the pair's number."""
        at = np.flatnonzero(self._part[:-1] == self._part[1:])
        return at, self._seq[at] * self._next + self._seq[at + 1]

    @staticmethod
    def _every_other(at: np.ndarray, same: np.ndarray) -> np.ndarray:
        """Of neighbouring places of one pair (a symbol repeated), the first, third, ..."""
        if not len(at):
            return np.zeros(0, bool)
        opens = np.flatnonzero(~same)
        return (np.arange(len(at)) - opens[np.cumsum(~same) - 1]) % 2 == 0

    def _repeated(self) -> np.ndarray:
        at, pair = self._pairs()
        if not len(at):
            return at
        same = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (pair[1:] == pair[:-1])])
        odd = self._every_other(at, same)
        at, pair = at[odd], pair[odd]
        _, name, count = np.unique(pair, return_inverse=True, return_counts=True)
        often = count[name] > 1
        at, pair, count = at[often], pair[often], count[name][often]
        rank = (np.log2(count).astype(np.int64) << 24) | _spread(pair).astype(np.int64)
        after = np.concatenate([(at[1:] == at[:-1] + 1), [False]])
        # a neighbouring pair of higher rank goes first; of equal rank (another pair of the same hash) the left one
        lost = np.zeros(len(at), bool)
        lost[:-1] |= after[:-1] & (rank[1:] > rank[:-1])
        lost[1:] |= after[:-1] & (rank[:-1] >= rank[1:])
        return at[~lost]

    def _neighbours(self) -> np.ndarray:
        """First, third, ... symbol of each stretch, where another follows."""
        if not len(self._seq):
            return self._seq
        begins = np.concatenate([[True], self._part[1:] != self._part[:-1]])
        opens = np.flatnonzero(begins)
        odd = (np.arange(len(self._seq)) - opens[np.cumsum(begins) - 1]) % 2 == 0
        at = np.flatnonzero(odd[:-1] & ~begins[1:])
        return at

    def _replace(self, at: np.ndarray) -> bool:
        if not len(at):
            return False
        symbol = _names(self._seq[at] * self._next + self._seq[at + 1]) + self._next
        self._made.append((symbol, self._start[at], self._start[at + 1], self._stop[at + 1]))
        self._seq[at] = symbol
        self._stop[at] = self._stop[at + 1]
        stays = np.ones(len(self._seq), bool)
        stays[at + 1] = False
        self._seq, self._start, self._stop, self._part = (x[stays] for x in (self._seq, self._start, self._stop, self._part))
        self._next = int(symbol.max()) + 1
        return True


def _candidates(words: np.ndarray, gram: np.ndarray, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nonterminal, place, period): words at the place and a period on are equal, near the nonterminal's boundary."""
    for q in range(1, NEAR):
        for place in (middle, middle - q):
            at = np.flatnonzero((place >= left) & (place + q < right))
            at = at[words[place[at]] == words[place[at] + q]]
            yield at, place[at], np.full(len(at), q)
    order = np.argsort(gram, kind="stable")
    size = len(words) + 1
    keys = gram[order] * size + order
    for shift in (0, GRAM):
        seed = middle - shift
        at = np.flatnonzero((seed >= left) & (seed + GRAM <= right))
        name = gram[seed[at]] * size
        first, past = np.searchsorted(keys, name + left[at]), np.searchsorted(keys, name + right[at] - GRAM, side="right")
        total = np.concatenate([[0], np.cumsum(past - first)])
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(total, total[a] + _CANDIDATES, side="right")) - 1)
            count = (past - first)[a:b]
            node = np.repeat(at[a:b], count)
            other = order[np.repeat(first[a:b], count) + np.arange(count.sum()) - np.repeat(total[a:b] - total[a], count)]
            q = np.abs(other - seed[node])
            fits = (q >= NEAR) & (2 * q <= (right - left)[node])
            yield node[fits], np.minimum(other, seed[node])[fits], q[fits]
            a = b


def _multiples(found: np.ndarray, nodes: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Test for candidates that lie in a nonterminal's longest run found so far, at a multiple of its period: they give that run again."""
    start, end, period = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.ones(nodes, np.int64)
    found = found[np.argsort(found[:, 2] - found[:, 1], kind="stable")]
    start[found[:, 0]], end[found[:, 0]], period[found[:, 0]] = found[:, 1], found[:, 2], found[:, 3]
    return lambda node, place, q: (start[node] <= place) & (place + q < end[node]) & (q % period[node] == 0)


def crossing_runs(words: np.ndarray, gram: np.ndarray, names: Names, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
    """(nonterminal, start, end, period) of the runs inside [left, right) that hold words on both sides of ``middle``."""
    found, known = [np.zeros((0, 4), np.int64)], None
    for node, place, q in _candidates(words, gram, left, middle, right):
        if len(q) and q[0] >= NEAR:
            known = known or _multiples(np.concatenate(found), len(left))
            new = ~known(node, place, q)
            node, place, q = node[new], place[new], q[new]
        ahead = names.forward(place, place + q, right[node] - place - q)
        back = names.backward(place, place + q, place - left[node])
        start, end = place - back, place + q + ahead
        fits = (end - start >= np.maximum(SHORTEST, 2 * q)) & (start < middle[node]) & (middle[node] < end)
        found.append(_distinct(np.stack([node, start, end, q], axis=1)[fits]))
    got = _distinct(np.concatenate(found))
    # of periods of one stretch, the smallest; the others are its multiples
    fresh = np.concatenate([[True], (got[1:, :3] != got[:-1, :3]).any(axis=1)]) if len(got) else np.zeros(0, bool)
    return tuple(got[fresh].T)


def find_runs(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period, in numbered words of ascending documents."""
    begins, ends = stretches(words, doc)
    if not len(begins):
        return np.zeros((0, 3), np.int64)
    grammar = Grammar(words, begins, ends)
    symbol, first = np.unique(grammar.symbol, return_index=True)
    left, middle, right = grammar.left[first], grammar.middle[first], grammar.right[first]
    node, start, end, q = crossing_runs(words, grams(words), Names(words, int((ends - begins).max())), left, middle, right)
    # every place of the nonterminal, by its number
    order = np.argsort(grammar.symbol, kind="stable")
    lo, hi = np.searchsorted(grammar.symbol[order], symbol[node]), np.searchsorted(grammar.symbol[order], symbol[node], side="right")
    which = np.repeat(np.arange(len(node)), hi - lo)
    place = order[np.repeat(lo, hi - lo) + np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
    move = grammar.left[place] - left[node[which]]
    runs = _distinct(np.stack([q[which], start[which] + move, -(end[which] + move)], axis=1))
    # by period and start, longest first: what ends no later than one before lies inside it
    period, start, end = runs[:, 0], runs[:, 1], -runs[:, 2]
    reach = np.maximum.accumulate(period * (len(words) + 1) + end)
    keep = np.concatenate([[True], reach[1:] > reach[:-1]]) if len(runs) else np.zeros(0, bool)
    out = np.stack([start, end, period], axis=1)[keep]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _results(texts: list[list[bytes]]) -> Iterator[tuple[int, list[dict], bytes]]:
    """Number of words, runs and kept words of each document of a batch."""
    known: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    offset = np.cumsum(sizes) - sizes
    runs = find_runs(words, doc)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    stays = steps.cumsum()[:-1] == 0
    cut = np.searchsorted(runs[:, 0], np.append(offset, len(words)))
    for i, text in enumerate(texts):
        mine = runs[cut[i] : cut[i + 1]]
        if len(mine):
            keep = stays[offset[i] : offset[i] + len(text)]
            text = [w for w, k in zip(text, keep.tolist()) if k]
        yield int(sizes[i]), [{"start": int(s - offset[i]), "length": int(e - s), "period": int(q)} for s, e, q in mine], b" ".join(text)


Rewrite = Callable[[object, list[bytes]], list[bytes]]


def periodic_runs(docs: DataFrame, id_column: str, text_column: str, rewrite: Rewrite | None = None) -> DataFrame:
    """(id, n_words, runs, kept): the runs of every text by start and period, and the words outside their repetitions.

    ``rewrite(id, words)`` may give other words to search in. A word is kept where no
    run holds it after that run's first period.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def search(batches):
        kind = None

        def flush(ids, texts):
            n, runs, kept = zip(*_results(texts))
            parts = [pa.array(ids, kind), pa.array(n, pa.int64()), pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))]
            return pa.record_batch([*parts, pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "kept"])

        for batch in batches:
            kind = batch.schema.field("id").type
            ids, texts, held = [], [], 0
            for at in range(batch.num_rows):
                key, text = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                words = (text or b"").split()
                words = rewrite(key, words) if rewrite else words
                if held and held + len(words) > BATCH_WORDS:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(key)
                texts.append(words)
                held += len(words)
            if ids:
                yield flush(ids, texts)

    return rows.mapInArrow(search, f"id {id_type}, {RESULT}")


def planted(key: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: of one document in ten the end is replaced by a period repeated."""
    n = len(words)
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // len(period) + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = periodic_runs(documents(spark, sf_dir), "doc_id", "text", planted)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("far"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    got = got.withColumn("best", longest)
    length = -F.col("best.far")
    return got.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        length.alias("length"),
        "best.period",
        F.expr("1000 * (-best.far) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )

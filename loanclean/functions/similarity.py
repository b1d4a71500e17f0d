"""String similarity: Indel ratio (JVM expressions) and Jaro-Winkler (Arrow batches)."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

# The functions travel to the executors by value, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---------------------------------------------------------------- Indel ratio

_MAX_BITS = 62


def characters(col: Column) -> Column:
    return F.split(col, "")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two text columns.

    A dynamic-programming row is folded over the characters of ``a``; ``b``
    stays an array, so texts of any length work.
    """
    width = F.length(b)
    start = F.array_repeat(F.lit(0), width + 1)

    def next_row(row: Column, ch: Column) -> Column:
        def step(acc: Column, j: Column) -> Column:
            same = F.element_at(acc["b"], j) == ch
            up = F.element_at(row, j + 1)
            best = F.when(same, F.element_at(row, j) + 1).otherwise(F.greatest(up, F.element_at(acc["out"], -1)))
            return F.struct(acc["b"].alias("b"), F.concat(acc["out"], F.array(best)).alias("out"))

        first = F.struct(characters(b).alias("b"), F.array(F.lit(0)).alias("out"))
        return F.aggregate(F.sequence(F.lit(1), width), first, step, lambda acc: acc["out"])

    dp = F.aggregate(characters(a), start, next_row, lambda row: F.element_at(row, -1))
    empty = (F.length(a) == 0) | (width == 0)
    return F.when(a.isNull() | b.isNull(), None).when(empty, 0).otherwise(dp)


def lcs_length_to(chars: Column, choice: str) -> Column:
    """Longest common subsequence of an array of characters and a fixed text.

    The fixed text is turned into one bit mask per character, so each
    character of the column costs a few integer operations. Texts over 62
    characters do not fit a signed word and use the general form.
    """
    if len(choice) > _MAX_BITS:
        return lcs_length(F.concat_ws("", chars), F.lit(choice))
    full = (1 << len(choice)) - 1
    masks: dict[str, int] = {}
    for i, ch in enumerate(choice):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    lookup = F.create_map(*[F.lit(x) for ch, m in masks.items() for x in (ch, m)])

    def step(open_bits: Column, ch: Column) -> Column:
        hit = open_bits.bitwiseAND(F.coalesce(F.try_element_at(lookup, ch), F.lit(0)))
        return (open_bits + hit).bitwiseOR(open_bits - hit).bitwiseAND(F.lit(full))

    left = F.aggregate(chars, F.lit(full).cast("bigint"), step)
    return F.lit(len(choice)) - F.bit_count(left)


def _ratio(common: Column, total: Column) -> Column:
    return F.when(total == 0, 100.0).otherwise(common * 200.0 / total)


def indel_ratio(a: Column, b: Column) -> Column:
    """100 for equal texts, 0 for texts without a common character."""
    return _ratio(lcs_length(a, b), F.length(a) + F.length(b))


def best_choice(text: Column, chars: Column, choices: list[str], min_score: float) -> Column:
    """(score, order, choice) of the choice with the highest Indel ratio.

    The first choice wins a tie. The ratio reaches the minimum only if the
    lengths allow it and the Levenshtein distance, which never exceeds the Indel
    distance, is small enough; other choices get -1 without being scored.
    """
    size = F.size(chars)
    scored = []
    for i, choice in enumerate(choices):
        total = size + len(choice)
        lengths = F.least(size, F.lit(len(choice))) * 200.0 >= total * min_score
        edits = F.levenshtein(text, F.lit(choice)) * 100.0 <= total * (100.0 - min_score)
        score = F.when(lengths & edits, _ratio(lcs_length_to(chars, choice), total)).otherwise(-1.0)
        scored.append(F.struct(score.alias("score"), F.lit(-i).alias("order"), F.lit(choice).alias("choice")))
    return F.when(chars.isNotNull(), F.array_max(F.array(*scored)))


# --------------------------------------------------------------- Jaro-Winkler

_CELLS = 100_000
_PLACES = 1 << 20  # most words of the table of places


def _codes(texts: np.ndarray, width: int) -> np.ndarray:
    """Code points of the texts, one row each, padded with zeros."""
    return np.ascontiguousarray(texts.astype(f"<U{width}")).view(np.uint32).reshape(len(texts), width)


def _jaro_winkler_block(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Jaro-Winkler of non-empty texts; all pairs advance one character at a time."""
    wa, wb = int(la.max()), int(lb.max())
    ca, cb = _codes(a, wa), _codes(b, wb)
    if max(ca.max(), cb.max()) < 256:
        ca, cb = ca.astype(np.uint8), cb.astype(np.uint8)
    n = len(a)
    rows = np.arange(n)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    col = np.arange(wb)
    uneven = bool((reach < reach.max()).any())
    free = col[None, :] < lb[:, None]
    hit_a = np.zeros((n, wa), dtype=bool)
    widest = int(reach.max())
    for i in range(wa):
        lo, hi = max(0, i - widest), min(wb, i + widest + 1)
        if lo >= hi:
            break
        ok = cb[:, lo:hi] == ca[:, i : i + 1]
        ok &= free[:, lo:hi]
        if uneven:
            ok &= np.abs(col[None, lo:hi] - i) <= reach[:, None]
        j = ok.argmax(axis=1)
        hit = ok[rows, j] & (i < la)
        hit_a[:, i] = hit
        free[rows[hit], j[hit] + lo] = False
    hit_b = ~free & (col[None, :] < lb[:, None])
    m = hit_a.sum(axis=1)

    # k-th matched character of each side, compared in order
    seq_a = np.take_along_axis(ca, np.argsort(~hit_a, axis=1, kind="stable"), axis=1)
    seq_b = np.take_along_axis(cb, np.argsort(~hit_b, axis=1, kind="stable"), axis=1)
    w = min(wa, wb)
    differ = (seq_a[:, :w] != seq_b[:, :w]) & (np.arange(w)[None, :] < m[:, None])
    t = differ.sum(axis=1) // 2

    p = min(4, w)
    return _winkler(m, t, la, lb, ca[:, :p], cb[:, :p])


def _letters(texts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """A small number for each character of the texts, one row each, padded with 0, and how many numbers there are."""
    width = int(sizes.max())
    codes = _codes(texts, width)
    if codes.max() < 1 << 16:
        number = np.cumsum(np.bincount(codes.ravel()) > 0)[codes]
    else:
        number = np.unique(codes, return_inverse=True)[1].reshape(codes.shape) + 1
    return np.where(np.arange(width) < sizes[:, None], number, 0), int(number.max()) + 1


def _jaro_winkler_words(texts: np.ndarray, sizes: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Jaro-Winkler of pairs (ia, ib) of non-empty texts of up to 64 characters.

    A 64-bit word per pair says which places of the second text are free; a table per
    text says where each character stands. All pairs advance one character at a time.
    """
    used, at = np.unique(np.concatenate([ia, ib]), return_inverse=True)
    letters, n_letters = _letters(texts[used], sizes[used])
    second, row = np.unique(ib, return_inverse=True)
    if len(second) * n_letters > _PLACES and len(ia) > 1:
        cut = len(ia) // 2
        return np.concatenate([_jaro_winkler_words(texts, sizes, ia[part], ib[part]) for part in (slice(None, cut), slice(cut, None))])
    stands = _stands(letters[np.searchsorted(used, second)], n_letters)
    return _matched(letters[at[: len(ia)]], letters[at[len(ia) :]], sizes[ia], sizes[ib], stands, row * n_letters)


def _stands(letters: np.ndarray, n_letters: int) -> np.ndarray:
    """A 64-bit word for each text and letter: the places where the letter stands."""
    stands = np.zeros(len(letters) * n_letters, np.uint64)
    rows = np.arange(len(letters)) * n_letters
    for j, spot in enumerate(letters.T + rows):
        stands[spot] |= np.uint64(1) << np.uint64(j)
    stands[rows] = 0
    return stands


def _matched(ca: np.ndarray, cb: np.ndarray, la: np.ndarray, lb: np.ndarray, stands: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Jaro-Winkler of pairs from their letters, lengths and the second text's words, which begin at ``row``."""
    one, none = np.uint64(1), np.uint64(0)
    places = [stands[spot] for spot in np.ascontiguousarray(ca.T[: int(la.max())]) + row]
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    window = (one << (reach + 1).astype(np.uint64)) - one
    every = ~none >> (64 - lb).astype(np.uint64)
    free, hits = every.copy(), []
    for i, here in enumerate(places):
        if i:
            window = (window << one) | (i <= reach)
        found = here & window & free
        free ^= found & (~found + one)
        hits.append(found != 0)
    taken = every ^ free
    m = np.bitwise_count(taken).astype(np.int64)
    # k-th matched character of each side, compared in order
    differ = np.zeros(len(la), np.int64)
    for hit, here in zip(hits, places):
        first = taken & (~taken + one)
        differ += hit & (here & first == 0)
        taken ^= np.where(hit, first, none)
    return _winkler(m, differ // 2, la, lb, ca[:, :4], cb[:, :4])


def _winkler(m: np.ndarray, t: np.ndarray, la: np.ndarray, lb: np.ndarray, head_a: np.ndarray, head_b: np.ndarray) -> np.ndarray:
    """The score from matches, transpositions, lengths and first characters."""
    some = np.maximum(m, 1)
    jaro = np.where(m > 0, (m / la + m / lb + (m - t) / some) / 3.0, 0.0)
    same = (head_a == head_b) & (np.arange(head_a.shape[1])[None, :] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1.0 - jaro), jaro)


def _words(texts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int, np.ndarray] | None:
    """Letters, their number and places of all the texts, or nothing if that takes too much."""
    if not 0 < sizes.max() <= 64 or len(texts) > _PLACES // 16:
        return None
    letters, n_letters = _letters(texts, sizes)
    return (letters, n_letters, _stands(letters, n_letters)) if len(texts) * n_letters <= _PLACES else None


def _scores(texts: np.ndarray, sizes: np.ndarray, ia: np.ndarray, ib: np.ndarray, words: tuple[np.ndarray, int, np.ndarray] | None = None) -> np.ndarray:
    """Jaro-Winkler of pairs (ia, ib) of texts, in blocks of bounded size; ``words`` are those of all the texts, if they are known."""
    la, lb = sizes[ia], sizes[ib]
    score = np.where((ia == ib) & (la > 0), 1.0, 0.0)
    todo = np.flatnonzero((ia != ib) & (la > 0) & (lb > 0))
    longest = np.maximum(la, lb)
    todo = todo[np.argsort(longest[todo], kind="stable")]
    lengths, start = longest[todo], 0
    while start < len(todo):
        # a block holds pairs of similar length and a bounded number of cells
        shortest = int(lengths[start])
        similar = int(np.searchsorted(lengths, shortest + shortest // 4 + 2, side="right"))
        stop = min(similar, start + max(1, _CELLS // (shortest + shortest // 4 + 2)))
        pick = todo[start:stop]
        if words is not None:
            letters, n_letters, stands = words
            score[pick] = _matched(letters[ia[pick]], letters[ib[pick]], la[pick], lb[pick], stands, ib[pick] * n_letters)
        elif lengths[stop - 1] <= 64:
            score[pick] = _jaro_winkler_words(texts, sizes, ia[pick], ib[pick])
        else:
            score[pick] = _jaro_winkler_block(texts[ia[pick]], texts[ib[pick]], la[pick], lb[pick])
        start = stop
    return score


def jaro_winkler_array(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Jaro-Winkler similarity per row; 0 where a side is null or empty.

    Each distinct pair of texts is scored once. Pairs are sorted by length and
    scored in blocks of bounded size, so one very long text cannot blow up the
    memory of a batch.
    """
    out = np.zeros(len(a))
    live = np.flatnonzero((a.notna() & b.notna()).to_numpy())
    if len(live) == 0:
        return out
    coded = pa.chunked_array([pa.array(x.iloc[live], pa.large_string()) for x in (a, b)]).combine_chunks().dictionary_encode()
    texts = coded.dictionary.to_numpy(zero_copy_only=False)
    sizes = pc.utf8_length(coded.dictionary).to_numpy().astype(np.int64)
    number = coded.indices.to_numpy().astype(np.int64)
    pair, back = np.unique(number[: len(live)] * len(texts) + number[len(live) :], return_inverse=True)
    score = _scores(texts, sizes, pair // len(texts), pair % len(texts))
    out[live] = score[back]
    return out


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity of two text columns, null counted as 0."""
    return pd.Series(jaro_winkler_array(a, b))


# A text's characters as a set of bits: each (character, how often it came before) sets
# one of 128. What the other text's set lacks, the texts cannot share.
_SIGNATURE = StructType([StructField("size", IntegerType()), *[StructField(c, LongType()) for c in ("low", "high", "head")]])


def _signature_block(texts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (low, high, head) of texts of similar length."""
    width = max(4, int(sizes.max()))
    codes = _codes(texts, width)
    head = (codes[:, :4].astype(np.int64) & 0x7FFF) << np.array([45, 30, 15, 0])
    place = np.arange(width)
    codes = np.sort(np.where(place < sizes[:, None], codes, np.uint32(0xFFFFFFFF)), axis=1)
    opens = np.where(np.diff(codes, axis=1, prepend=codes[:, :1] + 1) != 0, place, 0)
    before = (place - np.maximum.accumulate(opens, axis=1)).astype(np.uint64)
    mixed = (codes * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)
    bit = mixed >> np.uint64(57)
    one = np.where(place < sizes[:, None], np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
    halves = [np.bitwise_or.reduce(np.where(bit >> np.uint64(6) == h, one, np.uint64(0)), axis=1).view(np.int64) for h in (0, 1)]
    return np.stack([*halves, head.sum(axis=1)], axis=1)


@F.pandas_udf(_SIGNATURE)
def signature(text: pd.Series) -> pd.DataFrame:
    """struct(size, low, high, head): length, bit set of the characters, and the first four packed into a long."""
    live = np.flatnonzero(text.notna().to_numpy())
    sizes, out = _signatures(text.to_numpy(dtype=object)[live])
    frame = pd.DataFrame({"size": pd.array([None] * len(text), "Int32"), **{c: pd.array([None] * len(text), "Int64") for c in ("low", "high", "head")}})
    frame.iloc[live, 0] = sizes
    for i in range(3):
        frame.iloc[live, i + 1] = out[:, i]
    return frame


def _signatures(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and rows (low, high, head) of texts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    order, out, start = np.argsort(sizes, kind="stable"), np.zeros((len(texts), 3), np.int64), 0
    while start < len(order):
        # a block holds texts of similar length and a bounded number of cells
        shortest = int(sizes[order[start]])
        similar = int(np.searchsorted(sizes[order], shortest + shortest // 4 + 2, side="right"))
        pick = order[start : min(similar, start + max(1, _CELLS // (shortest + shortest // 4 + 4)))]
        out[pick] = _signature_block(texts[pick], sizes[pick])
        start += len(pick)
    return sizes, out


def jaro_winkler_bound(a: Column, b: Column) -> Column:
    """A number that the Jaro-Winkler similarity of two texts, given by their signatures, never exceeds.

    Shared characters are at most those of either text that the other's set does not
    lack; all count as in order. 0 where a text is null or empty.
    """
    lacking = lambda x, y: F.bit_count(x["low"].bitwiseAND(F.bitwise_not(y["low"]))) + F.bit_count(x["high"].bitwiseAND(F.bitwise_not(y["high"])))
    shared = F.least(a["size"] - lacking(a, b), b["size"] - lacking(b, a))
    jaro = (shared / a["size"] + shared / b["size"] + 1.0) / 3.0
    apart = a["head"].bitwiseXOR(b["head"])
    prefix = F.when(apart == 0, 4).when(apart < 1 << 15, 3).when(apart < 1 << 30, 2).when(apart < 1 << 45, 1).otherwise(0)
    return F.coalesce(F.when(shared > 0, jaro + prefix * 0.1 * (1.0 - jaro)), F.lit(0.0))


def make_pair_scorer(names: list[str], low: float):
    """Function that scores field pairs one after the other.

    The first argument is the score already known for each pair; then come, if there are
    any, an upper bound for every field (else it is 1), and both sides of every field. A pair that cannot reach ``low`` any
    more, even at the bounds of all later fields, gets nulls from there on and is not
    scored further.
    """

    def score(known: pd.Series, *rest: pd.Series) -> pd.DataFrame:
        total = known.to_numpy(dtype=float).copy()
        sides = rest[-2 * len(names) :]
        bounds = [b.to_numpy(dtype=float) for b in rest[: -2 * len(names)]] or [np.ones(len(total))] * len(names)
        left = sum(bounds, np.zeros(len(total)))
        out = {}
        for i, name in enumerate(names):
            open_rows = np.flatnonzero(total + left >= low - 1e-6)
            column = np.full(len(total), np.nan)
            column[open_rows] = jaro_winkler_array(sides[2 * i].iloc[open_rows], sides[2 * i + 1].iloc[open_rows])
            total = total + column  # NaN from a skipped field keeps the pair out
            left = left - bounds[i]
            out[name] = column
        return pd.DataFrame(out)

    return score


# ------------------------------------------------------------- pairs of a cell

_PAIRS = 200_000  # pairs that are looked at together
_AHEAD = 8  # row pairs for each pair of distinct texts, from which on all of these are scored
_TABLE = 4_000_000  # most pairs of distinct texts whose scores are kept
_BYTES = 16 << 20  # of the pairs' own columns that leave in one batch
_LARGE = 256  # rows of a cell from which on its pairs are first bounded in blocks
_SAMPLE = 1000  # pairs that decide which field is scored first
_BLOCK = 1 << 16  # pairs of a block: its arrays stay in the cache


def _marks(column: pa.ChunkedArray) -> tuple[np.ndarray, ...]:
    """(size, low, high, head) of every text; of null the size is 0."""
    coded = column.combine_chunks().dictionary_encode()
    sizes, marks = _signatures(coded.dictionary.to_numpy(zero_copy_only=False))
    row = pc.fill_null(coded.indices, len(sizes)).to_numpy()
    low, high, head = marks.T
    return tuple(np.append(x, x.dtype.type(0))[row] for x in (sizes.astype(float), low.astype(np.uint64), high.astype(np.uint64), head))


def _bound(marks: tuple[np.ndarray, ...], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``jaro_winkler_bound`` of the rows a and b."""
    (size_a, low_a, high_a, head_a), (size_b, low_b, high_b, head_b) = (tuple(m[x] for m in marks) for x in (a, b))
    low, high = low_a & low_b, high_a & high_b
    lacking = lambda own_low, own_high: np.bitwise_count(own_low ^ low).astype(np.int16) + np.bitwise_count(own_high ^ high)
    shared = np.minimum(size_a - lacking(low_a, high_a), size_b - lacking(low_b, high_b))
    jaro = (shared / np.maximum(size_a, 1) + shared / np.maximum(size_b, 1) + 1.0) / 3.0
    apart = head_a ^ head_b
    prefix = (apart == 0).astype(np.int8)
    for bits in (15, 30, 45):
        prefix += apart < 1 << bits
    return np.where(shared > 0, jaro + prefix * 0.1 * (1.0 - jaro), 0.0)


class _Field:
    """The distinct texts of a column, and the scores of pairs of its rows.

    Pairs are scored by the numbers of their texts. Where a table of all pairs of distinct
    texts is smaller than the number of row pairs, no pair of texts is scored twice. Where it is
    smaller by far, it is filled at once (``ahead``), and a score costs no more than a bound.
    """

    def __init__(self, column: pa.ChunkedArray, pairs: int, ahead: bool):
        coded = column.combine_chunks().dictionary_encode()
        self.texts = np.append(coded.dictionary.to_numpy(zero_copy_only=False), "")  # the last stands for null
        self.sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.number = pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy().astype(np.int64)
        n = len(self.texts)
        self.table = np.full(n * n, np.nan) if n * n <= min(pairs, _TABLE) else None
        self.words, self.asked = None, 0
        self.filled = ahead and _AHEAD * n * n <= pairs and self.table is not None
        for start in range(0, n * n if self.filled else 0, _PAIRS):
            pair = np.arange(start, min(n * n, start + _PAIRS))
            self.table[pair] = _scores(self.texts, self.sizes, pair // n, pair % n)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Jaro-Winkler similarity of the rows a and b; 0 where a text is null or empty."""
        n = len(self.texts)
        pair = self.number[a] * n + self.number[b]
        if self.filled:
            return self.table[pair]
        if self.table is None and 2 * n > len(self.number):  # texts hardly repeat
            return self._scored(pair)
        if self.table is None:
            pair, back = np.unique(pair, return_inverse=True)
            return self._scored(pair)[back]
        new = pair[np.isnan(self.table[pair])]
        if len(new):
            new = np.unique(new)
            self.table[new] = self._scored(new)
        return self.table[pair]

    def _scored(self, pair: np.ndarray) -> np.ndarray:
        n, before = len(self.texts), self.asked
        self.asked += len(pair)
        if before <= n < self.asked:  # with as many pairs as texts it pays to prepare all of them
            self.words = _words(self.texts, self.sizes)
        return _scores(self.texts, self.sizes, pair // n, pair % n, self.words)


class _Rows:
    """Rows that are sorted by cell and, within it, by ``pos``, with what it takes to score pairs of them."""

    def __init__(self, rows: pa.Table, first: np.ndarray, fuzzy: list[str], exact: str, ahead: bool = True):
        self.pos, self.tile = rows["pos"].to_numpy(), rows["tile"].to_numpy()
        self.whole = rows["hi"].to_numpy() == rows["lo"].to_numpy()
        self.begin = np.repeat(first, np.diff(np.append(first, rows.num_rows)))
        self.before = np.arange(rows.num_rows) - self.begin
        same = rows[exact].combine_chunks().dictionary_encode().indices
        self.same = pc.fill_null(same, -1).to_numpy()
        self.fields = [_Field(rows[c], int(self.before.sum()), ahead) for c in fuzzy]
        self.marks = [None if field.filled else _marks(rows[c]) for c, field in zip(fuzzy, self.fields)]
        self.order = [i for i, field in enumerate(self.fields) if not field.filled]
        self.ordered = len(self.order) < 2
        size = np.diff(np.append(first, rows.num_rows))
        large = (size >= _LARGE) & any(m is not None for m in self.marks)
        self.large = list(zip(first[large].tolist(), (first + size)[large].tolist()))
        self.listed = np.where(np.repeat(large, size), 0, self.before)

    def meet(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the cell is the one where rows a and b meet."""
        return self.whole[a] | (self.tile[a] != self.tile[b])

    def pieces(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Every row of the smaller cells with each row before it in its cell, about ``_PAIRS`` pairs at a time."""
        upto, at = np.cumsum(self.listed), 0
        while at < len(self.listed):
            done = int(upto[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(upto, done + _PAIRS, side="right")))
            n = self.listed[at:stop]
            a = np.repeat(np.arange(at, stop), n)
            b = np.repeat(self.begin[at:stop] - (np.cumsum(n) - n), n) + np.arange(len(a))
            at = stop
            meet = (self.pos[a] > self.pos[b]) & self.meet(a, b)
            yield a[meet], b[meet]

    def candidates(self, low: float) -> Iterator[tuple]:
        """The pairs of all cells, of the large ones those that a bound lets reach ``low``, with it for each field; about ``_PAIRS`` at a time."""
        for a, b in self.pieces():
            yield a, b, None
        got, held = [], 0
        for begin, end in self.large:
            for found in self._blocks(begin, end, low):
                got.append(found)
                held += len(found[0])
                if held >= _PAIRS:
                    a, b, bounds = (np.concatenate(x, axis=-1) for x in zip(*got))
                    got, held = [], 0
                    for part in (slice(i, i + _PAIRS) for i in range(0, len(a), _PAIRS)):
                        yield a[part], b[part], bounds[:, part]
        if got:
            yield tuple(np.concatenate(x, axis=-1) for x in zip(*got))

    def _side(self, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """What ``_blocks`` reads of some rows, in their order: the exact field, and of each other field its numbers or marks."""
        fields = []
        for field, m in zip(self.fields, self.marks):
            if m is None:
                fields.append((field.number[rows],))
                continue
            size, low, high, head = (x[rows] for x in m)
            spare = (size - np.bitwise_count(low) - np.bitwise_count(high)).astype(np.float32)
            third = np.where(size > 0, 1 / (3 * np.maximum(size, 1)), 0).astype(np.float32)
            fields.append((low, high, spare, third, (head >> 45).astype(np.int16), (head >> 30).astype(np.int32)))
        return self.same[rows], fields

    def _blocks(self, begin: int, end: int, low: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The pairs of a cell that may reach ``low`` by a bound somewhat above ``_bound``: two equal first letters count as four.

        Rows of one side meet rows of the other in blocks, so no index of all pairs is made.
        """
        rows = np.arange(begin, end)
        left = right = rows
        if not self.whole[begin]:
            ours = self.tile[rows] == self.tile[begin]
            left, right = rows[ours], rows[~ours]
        (same_a, fields_a), (same_b, fields_b) = self._side(left), self._side(right)
        wide = min(len(right), 1 << 13)
        tall = max(1, _BLOCK // max(1, wide))
        for i in range(0, len(left), tall):
            x = slice(i, i + tall)
            upto = min(i + tall, len(right)) if left is right else len(right)
            for j in range(0, upto, wide):
                y = slice(j, min(j + wide, upto))
                own = same_a[x, None]
                total = ((own == same_b[y]) & (own >= 0)).astype(np.float32)
                bounds = []
                for field, ours, others in zip(self.fields, fields_a, fields_b):
                    if field.filled:
                        bounds.append(field.table[ours[0][x, None] * len(field.texts) + others[0][y]].astype(np.float32))
                        total += bounds[-1]
                        continue
                    (low_a, high_a, spare_a, third_a, *head_a), (low_b, high_b, spare_b, third_b, *head_b) = ours, others
                    shared = np.minimum(spare_a[x, None], spare_b[y])
                    shared += np.bitwise_count(low_a[x, None] & low_b[y]) + np.bitwise_count(high_a[x, None] & high_b[y])
                    shared *= third_a[x, None] + third_b[y]
                    shared += np.float32(1 / 3)
                    for ha, hb, more in zip(head_a, head_b, (0.1, 1 / 3)):  # 0.1 of what lacks, then 0.4: two letters count as four
                        np.add(shared * np.float32(1 - more), np.float32(more), out=shared, where=ha[x, None] == hb[y])
                    bounds.append(shared)
                    total += shared
                at = np.flatnonzero(total >= low - 1e-4)
                bounds = np.stack([x.ravel()[at] for x in bounds])
                a, b = left[x][at // total.shape[1]], right[y][at % total.shape[1]]
                if left is not right:
                    a, b = np.where(self.pos[a] > self.pos[b], a, b), np.where(self.pos[a] > self.pos[b], b, a)
                later = self.pos[a] > self.pos[b]
                yield a[later], b[later], bounds[:, later]

    def scored(self, a: np.ndarray, b: np.ndarray, low: float) -> tuple:
        """The pairs that reach ``low``, their exact score, fuzzy scores and total.

        Pairs are dropped by the bounds, field by field; the others are scored.
        """
        known = self._exact(a, b)
        reach, bounds = known.copy(), []
        for i, (field, m) in enumerate(zip(self.fields, self.marks)):
            bounds.append(field.scores(a, b) if field.filled else _bound(m, a, b))
            reach = reach + bounds[-1]
            near = np.flatnonzero(reach + (len(self.marks) - 1 - i) >= low - 1e-6)
            a, b, known, reach, bounds = a[near], b[near], known[near], reach[near], [x[near] for x in bounds]
        return self._finished(a, b, known, reach, bounds, low)

    def scored_candidates(self, a: np.ndarray, b: np.ndarray, bounds: np.ndarray | None, low: float) -> tuple:
        """The same for ``candidates``, whose bounds are known if they come from a large cell."""
        if bounds is None:
            return self.scored(a, b, low)
        known = self._exact(a, b)
        bounds = [field.scores(a, b) if field.filled else x + 1e-5 for field, x in zip(self.fields, bounds.astype(float))]
        return self._finished(a, b, known, known + sum(bounds), bounds, low)

    def _exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((self.same[a] == self.same[b]) & (self.same[a] >= 0)).astype(float)

    def _finished(self, a: np.ndarray, b: np.ndarray, known: np.ndarray, reach: np.ndarray, bounds: list[np.ndarray], low: float) -> tuple:
        """Scores in place of the bounds, first of the field whose scores are the farthest below its bounds for its length."""
        if not self.ordered and len(a) > _SAMPLE:
            few = slice(None, None, len(a) // _SAMPLE)
            drop = {i: float((bounds[i][few] - self.fields[i].scores(a[few], b[few])).mean()) for i in self.order}
            drop = {i: d / (1 + self.fields[i].sizes.mean()) for i, d in drop.items()}
            self.order, self.ordered = sorted(self.order, key=lambda i: -drop[i]), True
        for i in self.order if len(a) else ():
            score = self.fields[i].scores(a, b)
            reach = reach - bounds[i] + score
            bounds[i] = score
            near = np.flatnonzero(reach >= low - 1e-6)
            a, b, known, reach, bounds = a[near], b[near], known[near], reach[near], [x[near] for x in bounds]
        total = sum(bounds, known)
        good = np.flatnonzero(total >= low - 1e-6)
        return a[good], b[good], known[good], [x[good] for x in bounds], total[good]


def _over_cells(cell: list[str], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]):
    """Function over Arrow batches of rows sorted by ``cell``: ``work`` on whole cells and their first rows."""

    def starts(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for c in cell:
            x = rows[c].combine_chunks()
            new[1:] |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if not rows.num_rows:
                continue
            first = starts(rows)
            last = int(first[-1])  # this cell may go on
            rest = rows.slice(last)
            if last:
                yield from work(rows.slice(0, last), first[:-1])
        if rest is not None and rest.num_rows:
            yield from work(rest, np.zeros(1, np.int64))

    return run


def _row_bytes(column: pa.Array) -> np.ndarray:
    """About the bytes of each value of a column of texts, numbers or structs of them."""
    if pa.types.is_struct(column.type):
        return sum(map(_row_bytes, column.flatten()), np.zeros(len(column), np.int64))
    if pa.types.is_string(column.type):
        return 4 + pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)
    return np.full(len(column), 8)


def _batches(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of about ``_BYTES``, or of one row that is larger."""
    upto, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + _BYTES, side="right")))
        yield slice(start, stop)
        start = stop


def make_cell_scorer(
    fuzzy: dict[str, str], exact: str, exact_score: str, cell: list[str], kept: list[str], low: float, marked: str | None = None, high: float | None = None
):
    """Function over Arrow batches of rows that are sorted by ``cell`` and, within it, by ``pos``: its pairs of at least ``low``.

    A row meets the rows before it in its cell, some hundred thousand pairs at a time, so
    memory does not grow with the cell's pairs. Two rows of one tile meet where ``hi`` is
    ``lo``; with ``marked``, only if that column is true of either. With ``high``, pairs that
    reach it are left out; those within a millionth of it are returned.
    """

    def work(rows: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        known_rows = _Rows(rows, first, list(fuzzy), exact)
        wanted = rows[marked].to_numpy() if marked else None
        own = {c: rows[c].combine_chunks() for c in kept}
        sizes = sum(map(_row_bytes, own.values()))
        for a, b, bounds in known_rows.candidates(low):
            if marked:
                of = wanted[a] | wanted[b]
                a, b, bounds = a[of], b[of], None if bounds is None else bounds[:, of]
            a, b, known, got, total = known_rows.scored_candidates(a, b, bounds, low)
            if high is not None:
                near = total < high + 1e-6
                a, b, known, got = a[near], b[near], known[near], [x[near] for x in got]
            for part in _batches(sizes[a] + sizes[b]):
                out = {f"{c}_{side}": own[c].take(pa.array(x[part])) for c in kept for side, x in (("a", a), ("b", b))}
                out[exact_score] = pa.array(known[part])
                out |= {c: pa.array(x[part]) for c, x in zip(fuzzy.values(), got)}
                yield pa.RecordBatch.from_pydict(out)

    return _over_cells(cell, work)


_HALF = 5e-10  # totals are compared as rounded to nine decimals


def make_pair_counter(fuzzy: list[str], exact: str, cell: list[str], steps: dict[str, float]):
    """The same, but only sums: (decision, n_pairs) of the pairs that reach a step's total and no higher step's.

    A pair stands for ``n`` times ``n`` row pairs. ``steps`` rise.
    """
    names, least = list(steps), np.array(list(steps.values())) - _HALF

    def work(rows: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        known_rows, n = _Rows(rows, first, fuzzy, exact), rows["n"].to_numpy()
        small = int(n.max()) ** 2 < (1 << 62) // (4 * _PAIRS + rows.num_rows)
        n, sums = n if small else n.astype(object), [0] * len(names)
        for a, b, bounds in known_rows.candidates(float(least[0])):
            a, b, _, _, total = known_rows.scored_candidates(a, b, bounds, float(least[0]))
            step = np.searchsorted(least, total, side="right") - 1
            for i in range(len(names)):
                sums[i] += int((n[a[step == i]] * n[b[step == i]]).sum())
        found = [i for i in range(len(names)) if sums[i]]
        yield pa.RecordBatch.from_pydict({"decision": pa.array([names[i] for i in found], pa.string()), "n_pairs": pa.array([Decimal(sums[i]) for i in found], pa.decimal128(38, 0))})

    return _over_cells(cell, work)


def make_partner_finder(fuzzy: list[str], exact: str, cell: list[str], high: float):
    """The same, but for every row only the last row before it in its cell that it reaches ``high`` with: (id_a, id_b, pos_b).

    Rows are sorted by ``pos`` and ``id``. A row looks back, twice as far each time, until
    it has found a partner. Two rows of one profile meet at one position too.
    """

    def work(rows: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        known_rows = _Rows(rows, first, fuzzy, exact, ahead=False)
        pos, profile = known_rows.pos, rows["profile"].combine_chunks().dictionary_encode().indices.to_numpy()
        best = np.full(rows.num_rows, -1)
        todo, off, width = np.flatnonzero(known_rows.before > 0), 0, 8
        while len(todo):
            at_once = max(1, _PAIRS // width)
            for part in (todo[i : i + at_once] for i in range(0, len(todo), at_once)):
                n = np.minimum(width, known_rows.before[part] - off)
                a = np.repeat(part, n)
                b = a - off - 1 - (np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n))
                meet = ((pos[a] > pos[b]) | (profile[a] == profile[b])) & known_rows.meet(a, b)
                a, b, _, _, total = known_rows.scored(a[meet], b[meet], high)
                good = total >= high - _HALF
                np.maximum.at(best, a[good], b[good])
            off, width = off + width, min(2 * width, _PAIRS)
            todo = todo[(best[todo] < 0) & (known_rows.before[todo] > off)]
        a = np.flatnonzero(best >= 0)
        if len(a):
            a, b = pa.array(a), pa.array(best[a])
            yield pa.RecordBatch.from_pydict({"id_a": rows["id"].take(a).combine_chunks(), "id_b": rows["id"].take(b).combine_chunks(), "pos_b": rows["pos"].take(b).combine_chunks()})

    return _over_cells(cell, work)

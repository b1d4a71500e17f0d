"""Removal of repeated byte strings by common-prefix interval trees over sampled suffixes.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with
a smaller doc_id. The suffixes that matter are sampled: of the ``GRAM``-byte grams in a
window of LENGTH bytes the one with the least hash is the window's anchor, so equal
windows have equal anchors at equal places. Neighbouring windows with one anchor make a
context: the bytes that they cover.

1. A copy of a whole text with a smaller doc_id goes as a whole and takes no further part.
2. Grams that are an anchor once in the whole corpus can't repeat. Anchor grams are
   counted by 40 bits of their hash (summed per batch first, sorted and packed); a bitmap over
   those that occur again, two bits each, drops most other anchors before anything else moves. It
   drops no repeat, and its size grows with their number up to ``MOST_BITS``.
3. A context that a smaller document of the same batch has is a span at once. The others
   travel packed, a row for each part of a batch, with their places.
4. The contexts of a gram form one part of an enhanced suffix array: sorted by the bytes
   from the anchor on, with the common prefix lengths of neighbours. A stack scan gives
   the interval tree. Within an interval the contexts are grouped by the bytes to the
   left; a group goes on leftwards as one while its left characters agree and is output
   when they differ, or at the interval's limit: a maximal repeat with all occurrences.
   Each context learns the least doc_id of each of its windows.
5. A gram with more than ``CROWD`` different contexts (the edges of a very common line)
   would be one task: its windows are compared one by one, by a 128-bit hash, dealt by it.
6. Windows with a smaller doc_id make the removed spans of a document.

Bitmaps only spare work: a row that one lets pass in vain meets no equal.

Strings are judged on the input. Null texts are empty. Rows without doc_id take no part
and stay whole; rows of one doc_id are not smaller than each other.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanclean.llm.base import bitmap, documents, in_bitmap, shards, stage

LENGTH = 50
GRAM = 20
CROWD = 4096
KEY_BITS = 40
BITMAP_BITS, MOST_BITS = 1 << 26, 1 << 30
DOC_BITS = 1 << 24
_SLICE = 1 << 18  # bytes at a time: arrays of a slice stay in the cache
_HELD = 32 << 20  # bytes of contexts, or 16 times the anchors, held before they are passed on
_MASK = np.uint64((1 << 24) - 1)
_MUL = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all grams of GRAM (20) bytes: Horner's rule, doubling the length."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    sizes = {1: h}
    for n in (1, 2, 4, 8):
        a = sizes[n]
        sizes[2 * n] = a[:-n] * np.uint64(pow(_MUL, n, 1 << 64)) + a[n:]
    out = sizes[16][:-4] * np.uint64(pow(_MUL, 4, 1 << 64)) + sizes[4][16:]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def anchors(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """For each context of the pieces: gram hash, piece, start in the piece, anchor's offset, windows, and a mark of its ends."""
    none = np.zeros(0, np.int64)
    size = np.array([len(p) for p in pieces], np.int64)
    if size.sum() < LENGTH:
        return none, none, none, none, none, none
    h = gram_hashes(np.frombuffer(b"".join(pieces), np.uint8))
    least = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)  # ties to the left
    span = LENGTH - GRAM + 1
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    at = (least & _MASK).astype(np.int64)  # of the window that starts at each byte
    ends = np.cumsum(size)
    windows = np.maximum(size - LENGTH + 1, 0)
    piece = np.repeat(np.arange(len(pieces)), windows)
    begin = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    q = begin + np.repeat(ends - size, windows)
    p = at[q]
    first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (piece[1:] != piece[:-1])])) if len(p) else none
    count = np.diff(np.append(first, len(p)))
    ends_mark = h[q[first]] ^ (h[q[first] + count + LENGTH - GRAM - 1] << np.uint64(1)) ^ count.astype(np.uint64) if len(p) else none.view(np.uint64)
    return h[p[first]].view(np.int64), piece[first], begin[first], p[first] - q[first], count, ends_mark


def _sliced(batch: pa.RecordBatch, rows: list[int]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Rows, offsets and bytes of the batch's texts, about _SLICE bytes at a time; longer texts in overlapping pieces."""
    kept, offsets, pieces, size = [], [], [], 0
    texts = batch.column(batch.schema.get_field_index("text"))
    for i in rows:
        raw = (texts[i].as_py() or "").encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(raw) - LENGTH + 1), _SLICE):
            piece = raw[at : at + _SLICE + LENGTH - 1]
            if size and size + len(piece) > _SLICE:
                yield kept, offsets, pieces
                kept, offsets, pieces, size = [], [], [], 0
            kept.append(i)
            offsets.append(at)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield kept, offsets, pieces


def _taking_part(batch: pa.RecordBatch, copies: np.ndarray) -> list[int]:
    """Rows of the batch that are no copy for sure (bit not set), or known to be none (column ``sure``)."""
    doc, sure = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(sure | ~in_bitmap(copies, doc)).tolist()


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then their second bytes, and so on: small numbers pack well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _from_planes(raw: bytes, at: int, n: int, kind: type) -> tuple[np.ndarray, int]:
    """``n`` values of a packed array and the place behind them."""
    end = at + n * np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, end - at, at).reshape(-1, n).T).view(kind).ravel(), end


def _squeezed(raw: bytes) -> bytes:
    return pa.Codec("zstd").compress(raw, asbytes=True)


def _opened(blob: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(blob, decompressed_size=size, asbytes=True)


def _keys(gram: np.ndarray) -> np.ndarray:
    """40 bits of each gram hash: grams are counted and filtered by them."""
    return (gram.view(np.uint64) * np.uint64(_MUL) >> np.uint64(64 - KEY_BITS)).view(np.int64)


def _second(key: np.ndarray) -> np.ndarray:
    """Another number of each key, for a second bit of a bitmap."""
    return (key.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(8)).view(np.int64)


def filter_bits(grams: int) -> int:
    """Bits of the bitmap over the repeated grams: 8 to 16 a gram within BITMAP_BITS and MOST_BITS, a power of two."""
    return max(BITMAP_BITS, min(MOST_BITS, 1 << (8 * max(1, grams) - 1).bit_length()))


def _gram_counts(texts: DataFrame, copies: np.ndarray, parts: int) -> DataFrame:
    """(gram, other, n, contexts) of the keys of grams that are an anchor more than once.

    ``n`` are the places, ``contexts`` the different contexts of a batch, summed over the batches;
    ``other`` is the key's second number. Sorted keys of one range of the keys travel as one packed row.
    """

    def summed(got: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        gram, mark = (np.concatenate(x) for x in zip(*got))
        key = _keys(gram)
        order = np.lexsort((mark, key))
        key, mark = key[order], mark[order]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(key)))
        other = np.cumsum(new | np.concatenate([[True], mark[1:] != mark[:-1]])) if len(key) else np.zeros(0, np.int64)
        contexts = (other[first + n - 1] - other[first] + 1).astype(np.uint32)
        key, n = key[first], n.astype(np.uint32)
        ends = np.searchsorted(key, (np.arange(1, parts + 1) << KEY_BITS) // parts).tolist()
        rows, begin = [], 0
        for part, end in enumerate(ends):
            if end > begin:
                here = slice(begin, end)
                steps = np.diff(key[here], prepend=0)
                rows.append((part, end - begin, _squeezed(_planes(steps) + _planes(n[here]) + _planes(contexts[here]))))
            begin = end
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ((), (), ()), (pa.int32(), pa.int32(), pa.binary()))], names=["part", "size", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, held = [], 0  # summed over batches, up to a number of anchors
        for batch in batches:
            for _, _, pieces in _sliced(batch, _taking_part(batch, copies)):
                found = anchors(pieces)
                got.append((found[0], found[5]))
                held += len(found[0])
                if held * 16 > _HELD:
                    yield summed(got)
                    got, held = [], 0
        if got:
            yield summed(got)

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        got = []
        for size, blob in zip(pdf["size"].tolist(), pdf["blob"]):
            raw = _opened(blob, size * 16)
            steps, at = _from_planes(raw, 0, size, np.int64)
            n, at = _from_planes(raw, at, size, np.uint32)
            got.append((np.cumsum(steps), n.astype(np.int64), _from_planes(raw, at, size, np.uint32)[0].astype(np.int64)))
        key, n, contexts = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n, contexts = (np.add.reduceat(x[order], first) for x in (n, contexts))
        more = np.flatnonzero(n > 1)
        key = key[first[more]]
        return pd.DataFrame({"gram": key, "other": _second(key), "n": n[more], "contexts": contexts[more]})

    counted = texts.mapInArrow(run, "part int, size int, blob binary")
    return counted.groupBy("part").applyInPandas(repeated, "gram long, other long, n long, contexts long")


_CONTEXTS = "part int, leads int, places int, size int, blob binary, doc_id long, digest long, a long, b long"


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the row before it."""
    if not len(columns[0]):
        return np.zeros(0, bool)
    return np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in columns])])


def _windows(context: list[bytes], places: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The two halves of a 128-bit hash of every window of the contexts, and (doc_id, digest, start) of each."""
    n = np.fromiter(map(len, context), np.int64, len(context)) - LENGTH + 1
    code = b"".join(xxhash.xxh3_128_digest(c[j : j + LENGTH]) for c in context for j in range(len(c) - LENGTH + 1))
    high, low = np.frombuffer(code, np.int64).reshape(-1, 2).T.copy()
    doc, digest, start = (np.repeat(x, n) for x in places)
    return high, low, doc, digest, start + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)


def _contexts(texts: DataFrame, copies: np.ndarray, again: np.ndarray, crowds: np.ndarray, parts: int) -> DataFrame:
    """The contexts whose anchor's bits are set in ``again``, and spans that are known from a batch alone.

    A place whose context a smaller doc_id of its batch has is a span (doc_id, digest, a, b) at
    once. The others are packed, a row for each part of a batch: the different contexts (``leads``) and
    their ``places``, see ``_opened_part``. Grams whose bit is set in ``crowds`` are packed
    window by window, in as many parts more, dealt by the windows, see ``_spans_of_windows``.
    """
    schema = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in _CONTEXTS.split(", ")])

    def ranges(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
        cuts = np.flatnonzero(_new(part))
        return zip(part[cuts].tolist(), cuts.tolist(), [*cuts.tolist()[1:], len(part)])

    def packed(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        row, start, gram, at = (np.concatenate([p[k] for p in found]) for k in range(4))
        context = [c for p in found for c in p[4]]
        size = np.fromiter(map(len, context), np.int64, len(context))
        code = np.fromiter(map(xxhash.xxh3_64_intdigest, context), np.uint64, len(context)).view(np.int64)
        doc, digest = (batch.column(k).to_numpy(zero_copy_only=False)[row] for k in (0, 1))
        part = np.where(in_bitmap(crowds, _keys(gram)), -1, (gram.view(np.uint64) % np.uint64(parts)).astype(np.int64))
        order = np.lexsort((doc, code, gram, part))
        doc, digest, start, gram, at, code, part, size = (x[order] for x in (doc, digest, start, gram, at, code, part, size))
        first = np.flatnonzero(_new(gram, code))
        known = doc > np.repeat(doc[first], np.diff(np.append(first, len(doc))))
        spans = [_merged(doc[known], digest[known], start[known], start[known] + size[known])]
        order, doc, digest, start, gram, at, code, part, size = (x[~known] for x in (order, doc, digest, start, gram, at, code, part, size))
        first = np.flatnonzero(_new(gram, code))
        places = np.diff(np.append(first, len(gram)))
        out = {name: [] for name in schema.names[:5]}

        def add(*values: int | bytes) -> None:
            raw = values[-1]
            for name, value in zip(out, (*values[:-1], len(raw), _squeezed(raw))):
                out[name].append(value)

        for p, lo, hi in ranges(part):
            if p < 0:
                high, low, *where = _windows([context[i] for i in order[lo:hi].tolist()], (doc[lo:hi], digest[lo:hi], start[lo:hi]))
                of = (high.view(np.uint64) % np.uint64(parts)).astype(np.int64)
                by = np.lexsort((where[0], low, high, of))
                high, low, of, where = high[by], low[by], of[by], [x[by] for x in where]
                begin = np.flatnonzero(_new(high, low))
                sure = where[0] > np.repeat(where[0][begin], np.diff(np.append(begin, len(of))))
                spans.append(_merged(*(x[sure] for x in where), where[2][sure] + LENGTH))
                high, low, of, *where = (x[~sure] for x in (high, low, of, *where))
                for q, a, b in ranges(of):
                    add(parts + q, 0, b - a, b"".join([high[a:b].tobytes(), low[a:b].tobytes(), *(_planes(x[a:b]) for x in where)]))
                continue
            a, b = np.searchsorted(first, (lo, hi)).tolist()
            lead = first[a:b]
            add(p, b - a, hi - lo, b"".join(
                [size[lead].astype(np.uint8).tobytes(), at[lead].astype(np.uint8).tobytes(), _planes(places[a:b].astype(np.uint32))]
                + [context[i] for i in order[lead].tolist()] + [_planes(x[lo:hi]) for x in (doc, digest, start)]
            ))
        n, rows = len(out["part"]), dict(zip(schema.names[5:], (np.concatenate(x) for x in zip(*spans))))
        none = len(rows["a"])
        packs = [pa.concat_arrays([pa.array(out[f.name], f.type), pa.nulls(none, f.type)]) for f in schema if f.name in out]
        return pa.RecordBatch.from_arrays(packs + [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(x, pa.int64())]) for x in rows.values()], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            for rows, offsets, pieces in _sliced(batch, _taking_part(batch, copies)):
                gram, piece, start, at, count, _ = anchors(pieces)
                key = _keys(gram)
                keep = np.flatnonzero(in_bitmap(again, key))
                keep = keep[in_bitmap(again, _second(key[keep]))]
                piece, start, size = piece[keep], start[keep], count[keep] + LENGTH - 1
                texts_ = [pieces[p][s : s + n] for p, s, n in zip(piece.tolist(), start.tolist(), size.tolist())]
                found.append((np.array(rows, np.int64)[piece], start + np.array(offsets, np.int64)[piece], gram[keep], at[keep], texts_))
                held += int(size.sum())
                if held > _HELD:
                    yield packed(batch, found)
                    found, held = [], 0
            if found:
                yield packed(batch, found)

    return texts.mapInArrow(run, _CONTEXTS)


def _opened_part(pdf: pd.DataFrame) -> tuple[list[bytes], np.ndarray, tuple[np.ndarray, ...]]:
    """The different contexts of a part's packed rows, their anchors' offsets, and (context's number, doc_id, digest, start) of all places."""
    known: dict[bytes, int] = {}
    at, places = [], []
    for n, m, size, blob in zip(pdf["leads"].tolist(), pdf["places"].tolist(), pdf["size"].tolist(), pdf["blob"]):
        raw = _opened(blob, size)
        sizes = np.frombuffer(raw, np.uint8, n).astype(np.int64)
        offs = np.frombuffer(raw, np.uint8, n, n)
        times, here = _from_planes(raw, 2 * n, n, np.uint32)
        ends = here + np.cumsum(sizes)
        number = np.zeros(n, np.int64)
        for i, (a, b, o) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), offs.tolist())):
            number[i] = k = known.setdefault(raw[a:b], len(known))
            if k == len(at):
                at.append(o)
        here = int(ends[-1])
        columns = [np.repeat(number, times)]
        for _ in range(3):
            column, here = _from_planes(raw, here, m, np.int64)
            columns.append(column)
        places.append(columns)
    return list(known), np.array(at, np.int64), tuple(np.concatenate(x) for x in zip(*places))


def _merged(doc: np.ndarray, digest: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans of each text with those that touch or overlap put together."""
    if not len(doc):
        return doc, digest, a, b
    order = np.lexsort((a, digest, doc))
    doc, digest, a, b = (x[order] for x in (doc, digest, a, b))
    text = _new(doc, digest)
    far = int(b.max()) + 1  # a text's spans lie behind those of the text before it
    base = (np.cumsum(text) - 1) * far
    reach = np.maximum.accumulate(b + base)
    first = np.flatnonzero(text | np.concatenate([[True], (a + base)[1:] > reach[:-1]]))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], digest[first], a[first], (reach - base)[last]


def prefix_intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
    """Stack scan: (first, last, depth, parent's depth) of the intervals with common prefixes of ``least`` or more.

    ``lcp[i]`` belongs to the neighbours i - 1 and i; a parent's depth below ``least`` is given as ``least`` - 1.
    """
    stack: list[list[int]] = []  # (depth, first)
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack and stack[-1][0] > now:
            depth, first = stack.pop()
            outer = max(now, stack[-1][0] if stack else 0)
            yield first, i - 1, depth, max(outer, least - 1)
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append([now, first])


def maximal_groups(members: list[int], lefts: list[bytes], low: int, high: int) -> Iterator[tuple[list[int], int, int]]:
    """(members, from, to): groups that agree in the ``from`` to ``to`` bytes to the left.

    Starts with groups alike in ``low`` bytes. A group goes on while the next character
    to the left is the same for all (no diversity) and is output where it differs or
    ``high`` is reached; its parts go on from there. Single members are not output.
    """
    start: dict[bytes, list[int]] = {}
    for m in members:
        if len(lefts[m]) >= low:
            start.setdefault(lefts[m][len(lefts[m]) - low :], []).append(m)
    todo = [(g, low) for g in start.values() if len(g) > 1]
    while todo:
        group, size = todo.pop()
        begin = size
        while True:
            if size == high:
                yield group, begin, size
                break
            parts: dict[int, list[int]] = {}
            for m in group:
                parts.setdefault(lefts[m][-size - 1] if len(lefts[m]) > size else -1, []).append(m)
            if len(parts) > 1 or -1 in parts:
                yield group, begin, size
                todo += [(g, size + 1) for c, g in parts.items() if c >= 0 and len(g) > 1]
                break
            size += 1


def _spans_of_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, digest, a, b): the places of a part's windows that a smaller document has."""
    got = []
    for m, size, blob in zip(pdf["places"].tolist(), pdf["size"].tolist(), pdf["blob"]):
        raw = _opened(blob, size)
        columns, here = [np.frombuffer(raw, np.int64, m), np.frombuffer(raw, np.int64, m, 8 * m)], 16 * m
        for _ in range(3):
            column, here = _from_planes(raw, here, m, np.int64)
            columns.append(column)
        got.append(columns)
    high, low, doc, digest, start = (np.concatenate(x) for x in zip(*got))
    order = np.lexsort((doc, low, high))
    first = np.flatnonzero(_new(high[order], low[order]))
    hit = order[doc[order] > np.repeat(doc[order][first], np.diff(np.append(first, len(order))))]
    return pd.DataFrame(dict(zip(("doc_id", "digest", "a", "b"), _merged(doc[hit], digest[hit], start[hit], start[hit] + LENGTH))))


def _spans_of_part(pdf: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, digest, a, b): the runs of windows of each place of a part's contexts that a smaller document has."""
    context, at, (number, doc, digest, start) = _opened_part(pdf)
    size = np.fromiter(map(len, context), np.int64, len(context))
    gram = gram_hashes(np.frombuffer(b"".join(context), np.uint8))[np.cumsum(size) - size + at]
    limits = np.iinfo(np.int64)
    low, high = np.full(len(context), limits.max), np.full(len(context), limits.min)
    np.minimum.at(low, number, doc)
    np.maximum.at(high, number, doc)
    low, high, at = low.tolist(), high.tolist(), at.tolist()
    right = [c[a:] for c, a in zip(context, at)]
    lefts = [c[:a] for c, a in zip(context, at)]
    least = [[d] * (len(c) - LENGTH + 1) for d, c in zip(low, context)]
    # the enhanced suffix array: order, and common prefixes of neighbours of one gram
    wide = max((len(r) for r in right), default=1)
    text = np.array(right, dtype=f"S{wide}")
    order = np.lexsort((text, gram))
    rows = np.frombuffer(text[order].tobytes(), np.uint8).reshape(len(order), wide)
    sizes = np.array([len(r) for r in right], np.int64)[order]
    lcp = np.zeros(len(order), np.int64)
    for begin in range(1, len(order), 65536):
        end = min(len(order), begin + 65536)
        differ = rows[begin:end] != rows[begin - 1 : end - 1]
        lcp[begin:end] = np.where(differ.any(axis=1), differ.argmax(axis=1), wide)
    lcp[1:] = np.minimum(lcp[1:], np.minimum(sizes[1:], sizes[:-1]))
    lcp[1:][gram[order][1:] != gram[order][:-1]] = 0
    order = order.tolist()
    for first, last, depth, outer in prefix_intervals(lcp.tolist(), GRAM):
        # with l bytes to the left, a window needs LENGTH - l to the right: those between the parent's depth and this one
        l_low, l_high = max(0, LENGTH - depth), min(LENGTH - GRAM, LENGTH - outer - 1)
        if l_low > l_high:
            continue
        for group, a, b in maximal_groups(order[first : last + 1], lefts, l_low, l_high):
            smallest = min(low[m] for m in group)
            for m in group:
                if smallest < low[m]:
                    for l in range(a, b + 1):  # noqa: E741
                        j = at[m] - l
                        if 0 <= j < len(least[m]) and smallest < least[m][j]:
                            least[m][j] = smallest
    out = []
    for m, values in enumerate(least):
        j = 0
        while j < len(values):
            k = j
            while k + 1 < len(values) and values[k + 1] == values[j]:
                k += 1
            if values[j] < high[m]:
                out.append((m, j, k, values[j]))
            j = k + 1
    m, a, b, d = (np.array(x, np.int64) for x in (zip(*out) if out else ((), (), (), ())))
    runs = np.bincount(m, minlength=len(context))
    times = runs[number]
    run = np.arange(int(times.sum())) + np.repeat((np.cumsum(runs) - runs)[number] - (np.cumsum(times) - times), times)
    place = np.repeat(np.arange(len(number)), times)
    hit = d[run] < doc[place]
    run, place = run[hit], place[hit]
    spans = _merged(doc[place], digest[place], start[place] + a[run], start[place] + b[run] + LENGTH)
    return pd.DataFrame(dict(zip(("doc_id", "digest", "a", "b"), spans)))


def _maybe(bits: np.ndarray):
    """Is the bit of a doc_id set?"""

    @F.pandas_udf("boolean")
    def test(doc: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits, doc.to_numpy(np.int64)))

    return test(F.col("doc_id"))


def _copies(texts: DataFrame) -> DataFrame:
    """(doc_id, digest, size) of the texts that a document with a smaller doc_id has as a whole."""
    keys = stage(texts.select("doc_id", "digest", F.unhex(F.sha2("text", 256)).alias("sha"), F.octet_length("text").alias("size")), "keys")
    first = keys.groupBy("sha").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("sha", "low")
    return keys.join(first, "sha").where("doc_id > low").select("doc_id", "digest", "size").distinct()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, spans): byte spans (a, b) of each document that repeat from a smaller doc_id, sorted; they may overlap."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    copies = stage(_copies(texts), "copies")
    marked = bitmap(copies.select("doc_id"), DOC_BITS)
    odd = stage(texts.where(_maybe(marked)).join(copies, ["doc_id", "digest"], "left_anti"), "odd")  # marked, but no copies
    columns = lambda df, sure: df.select("doc_id", "digest", F.lit(sure).alias("sure"), "text")
    reps = columns(texts, False).unionByName(columns(odd, True))
    again = stage(_gram_counts(reps, marked, shards(docs, 8)), "grams")
    crowds = bitmap(again.where(F.col("contexts") > CROWD).select("gram"), DOC_BITS)
    both = bitmap(again.select(F.explode(F.array("gram", "other"))), filter_bits(again.count()))
    parts = shards(docs, 2)
    found = stage(_contexts(reps, marked, both, crowds, parts), "contexts")

    def of_part(pdf: pd.DataFrame) -> pd.DataFrame:
        return _spans_of_windows(pdf) if pdf["part"].iloc[0] >= parts else _spans_of_part(pdf)

    by_part = found.where("part is not null").select("part", "leads", "places", "size", "blob").repartition(max(1, parts // 4), "part").groupBy("part")
    spans = by_part.applyInPandas(of_part, "doc_id long, digest long, a long, b long").unionByName(found.where("part is null").select("doc_id", "digest", "a", "b"))
    whole = copies.where(F.col("size") >= LENGTH).select("doc_id", "digest", F.lit(0).cast("long").alias("a"), F.col("size").cast("long").alias("b"))
    return spans.unionByName(whole).groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))


def cut(text: str | None, spans) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans and the SHA-256 of what stays, for sorted spans that may overlap."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
    for s in spans if spans is not None else ():
        a, b = int(s["a"]), int(s["b"])
        if a > at or not runs:
            kept.update(raw[at:a])
            runs += 1
            removed += b - a
        elif b > at:
            removed += b - at
        at = max(at, b)
    kept.update(raw[at:])
    return len(raw), removed, runs, kept.hexdigest()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = stage(repeated_spans(docs), "spans")
    touched = _maybe(bitmap(spans.select("doc_id"), DOC_BITS))

    @F.pandas_udf("struct<n_bytes long, n_removed long, n_spans long, kept_sha256 string>")
    def digest(text: pd.Series, found: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut(t, s) for t, s in zip(text, found)], columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    named = rows.where("doc_id is not null")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    none = F.lit(0).cast("long")
    whole = [size.alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")]
    cuts = named.where(touched).join(spans, ["doc_id", "digest"], "left").select("doc_id", digest("text", "spans").alias("d")).select("doc_id", "d.*")
    return reduce(DataFrame.unionByName, [cuts, named.where(~touched).select("doc_id", *whole), rows.where("doc_id is null").select("doc_id", *whole)])


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))

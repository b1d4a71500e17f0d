"""Token ids of whole texts by a public tokenizer file, many times faster on natural text.

Both tokenizers used here cut a text at a blank or newline between two other characters
whatever stands around it, so a text's ids are those of its pieces between them.
They also cut between letters and punctuation behind them. Pieces recur: each is
encoded by the library, and its ids are kept: all at first, later from the second time on
that it is new (most new pieces never come again). The store has a number of pieces; when
it is full, those that came again since the last turn stay and the others make room. New
pieces are encoded many at a time in one string. Texts in which white space meets a blank
or newline or that hold an added token, and tokenizers that don't cut there, go to the
library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_STORE_PIECES = 400_000
_SEEN_BITS = 1 << 23  # a bit for each piece that was new once, by its hash
_JOINED = 2000
_MARK = "~"
_TAIL = ".,;:!?|%*&#$-"
_MEETING = ("  ", " \n", "\n ", "\n\n")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_START = "\0"  # before the first piece of a text, and before a piece without a blank before it

_encoders: dict[tuple[str, bool], "Encoder"] = {}


def encoder(path: str, split_special: bool = True) -> Encoder:
    """The encoder of this worker process for a tokenizer file; its store outlives a task.

    ``split_special``: a special token that a text spells out is ordinary text; else it is
    the special id, the library's default.
    """
    if (path, split_special) not in _encoders:
        _encoders[path, split_special] = Encoder(path, split_special)
    return _encoders[path, split_special]


class Encoder:
    def __init__(self, path: str, split_special: bool = True):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = split_special
        self.added = [a.content for a in self.tok.get_added_tokens_decoder().values() if not (split_special and a.special)]
        self.mode = "whole"
        if isinstance(self.tok.pre_tokenizer, pre_tokenizers.ByteLevel) and self.tok.normalizer is None:
            self.mode = "blank"  # a piece's first id begins with the blank before it
            size = self.tok.get_vocab_size()
            self.opens = np.array([(self.tok.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
            self.mark = self._ids("\n")[0]  # keeps pieces apart that begin a line
        elif self._ids("ab \n ~ c") == self._ids("ab") + self._ids(_MARK) + self._ids("c") and len(self._ids(_MARK)) == 1:
            self.mode = "mark"  # white space is dropped; a mark keeps pieces apart
            self.mark = self._ids(_MARK)[0]
        self._clear()
        self.seen = np.zeros(_SEEN_BITS, bool)

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.store: dict[str, int] = {}  # pieces; those that begin a line or a text have a newline or _START before
        self.flat, self.used, self.n = np.zeros(1 << 16, np.uint32), 0, 0
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.again = np.zeros(1 << 14, bool)  # runs of pieces that came again

    def _turn(self) -> None:
        """Make room: pieces that came again stay, at most half of all, the oldest first."""
        stays = np.flatnonzero(self.again[: self.n])[: _STORE_PIECES // 2]
        flat, lengths = self._gather(stays), self.lengths[stays]
        number = np.full(self.n, -1)
        number[stays] = np.arange(len(stays))
        names = list(self.store)
        at = number[np.fromiter(self.store.values(), np.int64, len(names))]
        kept = np.flatnonzero(at >= 0).tolist()
        store = dict(zip([names[k] for k in kept], at[kept].tolist()))
        del names
        self._clear()
        self.store = store
        self._keep(flat, lengths)
        self.seen[:] = False

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """Store runs of ids; returns the number of the first run."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(lengths) > len(self.starts):
            self.starts, self.lengths, self.again = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths, self.again))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[self.n : self.n + len(lengths)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : self.n + len(lengths)] = lengths
        self.used += len(ids)
        self.n += len(lengths)
        return self.n - len(lengths)

    def _alone(self, texts: list[str]) -> int:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        runs = [e.ids for e in got]
        return self._keep(np.fromiter(chain.from_iterable(runs), np.uint32), np.array([len(r) for r in runs], np.int64))

    def _joined(self, words: list[str], blank: bool) -> dict[str, int]:
        """Numbers of the runs of words, encoded many in one string; ``blank``: with a blank before each. Odd ones go alone."""
        before, between = (" ", " ") if blank else ("", "\n" if self.mode == "blank" else f" {_MARK} ")
        plain = lambda w: w and w != "\n" and (self.mode == "blank" or _MARK not in w)
        easy, hard, out = [w for w in words if plain(w)], [w for w in words if not plain(w)], {}
        for i in range(0, len(easy), _JOINED):
            group = easy[i : i + _JOINED]
            ids = np.array(self.tok.encode_batch_fast([before + between.join(group)], add_special_tokens=False)[0].ids, np.uint32)
            if blank:
                cut = np.flatnonzero(self.opens[ids])
                lengths = np.diff(np.append(cut, len(ids)))
            else:
                cut = np.flatnonzero(ids == self.mark)
                lengths = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1
                ids = ids[ids != self.mark]
            if len(lengths) != len(group):
                hard += group
                continue
            out.update(zip(group, range(at := self._keep(ids, lengths), at + len(group))))
        out.update(zip(hard, range(at := self._alone([before + w for w in hard]), at + len(hard))))
        return out

    def _combined(self, words: list[str], runs: list[tuple[int, int]]) -> Iterator[tuple[str, int]]:
        """Words whose ids are those of two runs, with the numbers of their own runs."""
        if words:
            run = np.array(runs, np.int64)
            at = self._keep(self._gather(run.ravel()), self.lengths[run].sum(axis=1))
            yield from zip(words, range(at, at + len(words)))

    def _learn(self, pieces: set[str]) -> dict[str, int]:
        """Runs of new pieces and of their stems; letters with punctuation behind, and words behind a newline, are put together."""
        lead = [w for w in pieces if w[:1] in ("\n", _START)] if self.mode == "blank" else []
        wanted = [w for w in pieces if w[:1] not in ("\n", _START)] if lead else list(pieces)
        cut: dict[str, tuple[str, str]] = {}
        for w in wanted:
            if w and w[-1] in _TAIL:
                stem = w.rstrip(_TAIL)
                if stem.isalpha() and (stem.isascii() or max(stem) < "\u0250"):
                    cut[w] = (stem, w[len(stem) :])
        stems = {s for s, _ in cut.values() if s not in self.store}
        got = self._joined([w for w in wanted if w not in cut and w not in stems] + list(stems), self.mode == "blank")
        bare = self._joined(list({t for _, t in cut.values()} | {w[1:] for w in lead} | {"\n"} if lead else {t for _, t in cut.values()}), False)
        run_of = lambda w: got[w] if w in got else self.store[w]
        words = [w for w in cut if w not in got]
        got.update(self._combined(words, [(run_of(cut[w][0]), bare[cut[w][1]]) for w in words]))
        got.update((w, bare[w[1:]]) for w in lead if w[0] == _START)
        words = [w for w in lead if w[0] == "\n"]
        got.update(self._combined(words, [(bare["\n"], bare[w[1:]]) for w in words]))
        return got

    def _remember(self, got: dict[str, int], runs: int, ids: int) -> None:
        """Of the pieces just learnt keep those that were new before; the runs from number ``runs`` on are otherwise given up.

        A store less than half full keeps them all.
        """
        names = list(got)
        bits = np.fromiter(map(hash, names), np.int64, len(names)) & (_SEEN_BITS - 1)
        known = np.flatnonzero(self.seen[bits] | (runs < _STORE_PIECES // 2)).tolist()
        self.seen[bits] = True
        names = [names[k] for k in known]
        numbers = np.fromiter(map(got.get, names), np.int64, len(names))
        flat, lengths = self._gather(numbers), self.lengths[numbers]
        self.n, self.used = runs, ids
        at = self._keep(flat, lengths)
        self.again[at : self.n] = False
        self.store.update(zip(names, range(at, self.n)))

    def _gather(self, run: np.ndarray) -> np.ndarray:
        """The ids of the stored runs, one after the other."""
        lengths = self.lengths[run]
        ends = np.cumsum(lengths)
        return self.flat[np.repeat(self.starts[run] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has. Null is empty."""
        if self.n > _STORE_PIECES:
            self._turn()
        odd = [i for i, t in enumerate(texts) if t and self._whole(t)]
        plain = [i for i, t in enumerate(texts) if t]
        if odd:
            gone = set(odd)
            plain = [i for i in plain if i not in gone]
        distinct, piece, counts = self._pieces([texts[i] for i in plain])
        run = np.fromiter(map(self.store.get, distinct, repeat(-1)), np.int64, len(distinct))
        self.again[run[run >= 0]] = True
        new = np.flatnonzero(run < 0).tolist()
        runs, ids = self.n, self.used
        got = self._learn({distinct[k] for k in new}) if new else {}
        run[new] = [got[distinct[k]] for k in new]
        run = run[piece]
        first = self._alone([texts[i] for i in odd])
        # runs in the order of the texts
        number = np.zeros(len(texts), np.int64)
        number[plain], number[odd] = counts, 1
        start = np.zeros(len(texts), np.int64)
        start[plain], start[odd] = np.cumsum(counts) - counts, len(run) + np.arange(len(odd))
        run = np.concatenate([run, first + np.arange(len(odd))])
        upto = np.cumsum(number)
        run = run[np.repeat(start - (upto - number), number) + np.arange(int(upto[-1]) if len(upto) else 0)]
        sizes = np.concatenate([[0], np.cumsum(self.lengths[run])])
        out = self._gather(run), np.diff(sizes[np.concatenate([[0], upto])])
        self._remember(got, runs, ids)
        return out

    def _pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Different pieces of the texts, the number of the piece at each place, and how many places each text has."""
        if self.mode == "mark":
            distinct, piece, counts = _cut([" " + t.replace("\n", " ") for t in texts])
            return distinct.to_pylist(), piece, counts
        bare = [f" {_START}{t}" for t in texts]
        distinct, piece, counts = _cut([_parted(t).replace("\n", " \n") for t in bare])
        opens = pc.starts_with(distinct, _START).to_numpy(zero_copy_only=False)[piece]
        ends = pc.utf8_is_alnum(pc.utf8_slice_codeunits(distinct, -1)).to_numpy(zero_copy_only=False)[piece]
        begin = np.cumsum(counts) - counts
        opens[begin] = False
        wrong = np.flatnonzero(opens[1:] & ~ends[:-1]) + 1
        wrong = np.unique(np.searchsorted(begin, wrong, side="right") - 1)  # texts where no letter or digit stands before
        if not len(wrong):
            return distinct.to_pylist(), piece, counts
        more, piece2, counts2 = _cut([bare[k].replace("\n", " \n") for k in wrong.tolist()])
        start, size = begin, counts.copy()
        start[wrong], size[wrong] = len(piece) + np.cumsum(counts2) - counts2, counts2
        upto = np.cumsum(size)
        at = np.repeat(start - (upto - size), size) + np.arange(int(upto[-1]))
        piece = np.concatenate([piece, piece2 + len(distinct)])[at]
        used = np.unique(piece)
        return pa.concat_arrays([distinct, more]).take(pa.array(used)).to_pylist(), np.searchsorted(used, piece), size

    def _whole(self, text: str) -> bool:
        if any(a in text for a in self.added):
            return True
        if self.mode != "blank":
            return self.mode == "whole"
        if any(m in text for m in _MEETING) or _START in text:
            return True
        return not text.isprintable() and _OTHER_SPACE.search(text.replace("\n", "")) is not None


def _parted(text: str) -> str:
    """The text with commas and full stops as pieces of their own where a word ends with one."""
    for end in (", ", ". ", ",\n", ".\n"):
        text = text.replace(end, f" {_START}{end}")
    return text


def _cut(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different pieces of texts that begin with a blank each, the number of the piece at each place, and how many places each text has.

    A piece lies between two blanks. The texts' bytes are one buffer, cut at its blanks
    without copying; the blank before a piece goes at the end.
    """
    parts = [t.encode() for t in texts]
    raw = b"".join(parts)
    at = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    offsets = np.append(at, len(raw)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(raw))
    coded = pieces.dictionary_encode()
    ends = np.cumsum([len(p) for p in parts])
    counts = np.diff(np.searchsorted(at, np.concatenate([[0], ends]))).astype(np.int64)
    return pc.utf8_slice_codeunits(coded.dictionary, 1), coded.indices.to_numpy().astype(np.int64), counts


def with_end(ids: np.ndarray, counts: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``end`` behind each text."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1


def slices(column: pa.Array, most: int = 2_000_000, rows: int = 2000) -> Iterator[tuple[int, list[str | None]]]:
    """Neighbouring texts with their first row, about ``most`` characters at a time (a longer text comes alone)."""
    for start in range(0, len(column), rows):
        texts = column.slice(start, rows).to_pylist()
        begin, size = 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t or "") > most:
                yield start + begin, texts[begin:i]
                begin, size = i, 0
            size += len(t or "")
        yield start + begin, texts[begin:]

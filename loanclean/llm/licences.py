"""Licence scan by a positional index of rare words.

Templates are short phrases and the wordings of common licence notices. Their index
holds, for every licence word, the templates and positions where it stands. How a table
is scanned:

1. Each text becomes its number of words and the places of its licence words.
2. Over all documents, the number that hold each licence word gives its inverse
   document frequency (IDF); the driver gets one number per licence word.
3. A file's rarest licence words (highest IDF first) are looked up. A posting at template
   position p and a place w in the file mean that the template starts at w - p. Words
   that agree on the start, up to ``SLACK`` words inserted or left out, are added up by
   their IDF; a template with over ``SHARE`` of its weight there is a candidate.
4. A candidate counts only if all its mandatory key phrases stand word by word within
   its stretch. The phrases of ``PHRASES`` are templates that are mandatory as a whole:
   their places come from the phrase's rarest word, intersected with the others.

The index depends on the templates alone and is closed over by the tasks; no document
leaves its row. Places are worked off in windows of ``WINDOW`` words, so memory does not
depend on how often a word recurs. Null and empty texts have no words, no label and score
0. Rows count each for itself, whether their ids repeat or are null; ties in IDF go to the
word first in the templates.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from loanclean.llm.base import documents, stage

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RARE = 64  # of a file's licence words, how many are looked up for the wordings
SLACK = 12  # words that may be missing or added between words of a template
SHARE = 0.6  # of a template's weight, found in agreeing positions
WINDOW = 1 << 16  # words of a file looked at in one go

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Short notices that name one licence exactly.
NOTICES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "cc by 4 0": "cc-by-4.0",
    "cc0 1 0": "cc0-1.0",
    "mozilla public license": "mpl",
    "spdx license identifier": "spdx",
}

# Wordings of licence notices (label, mandatory key phrases, text).
WORDINGS = [
    (
        "mit-text",
        ["permission is hereby granted free of charge", "the software is provided as is"],
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED""",
    ),
    (
        "isc-text",
        ["permission to use copy modify and or distribute this software"],
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE""",
    ),
    (
        "bsd-2-clause-text",
        ["redistribution and use in source and binary forms", "redistributions in binary form must reproduce"],
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    (
        "bsd-3-clause-text",
        ["neither the name of", "endorse or promote products derived from this software"],
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
    ),
    (
        "apache-2.0-text",
        ["licensed under the apache license version 2 0", "you may not use this file except in compliance"],
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    ),
    (
        "gpl-text",
        ["redistribute it and or modify it under the terms of the gnu general public license"],
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    ),
    (
        "mpl-2.0-text",
        ["subject to the terms of the mozilla public license"],
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "zlib-text",
        ["this software is provided as is without any express or implied warranty", "altered source versions must be plainly marked"],
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
        for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: The origin of this software must not be misrepresented. Altered source versions must be
        plainly marked as such, and must not be misrepresented as being the original software.""",
    ),
    (
        "unlicense-text",
        ["free and unencumbered software released into the public domain"],
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    ),
    (
        "all-rights-reserved",
        ["all rights reserved", "without the prior written permission"],
        """All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by
        any means without the prior written permission of the publisher""",
    ),
]


def words_of(text: str | bytes) -> list[bytes]:
    """The words of a text, A-Z lowered."""
    return WORD.findall((text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).lower())


@dataclass(frozen=True)
class Template:
    """A wording as numbers of licence words, with its mandatory phrases; ``base`` for the contract's phrases."""

    label: str
    words: np.ndarray
    mandatory: tuple[np.ndarray, ...]
    base: bool = False

    @property
    def whole(self) -> bool:
        """Is the template mandatory as a whole, every word in its place?"""
        return len(self.mandatory) == 1 and len(self.mandatory[0]) == len(self.words)


class Index:
    """Licence words by number, and templates written in these numbers."""

    def __init__(self, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, wordings: list[tuple[str, list[str], str]] = WORDINGS) -> None:
        self.words: dict[bytes, int] = {}
        numbers = lambda text: np.array([self.words.setdefault(w, len(self.words)) for w in words_of(text)], np.int64)
        whole = [(label, [text], text, base) for given, base in ((phrases, True), (notices, False)) for text, label in given.items()]
        rest = [(label, must, text, False) for label, must, text in wordings]
        self.templates = [Template(label, numbers(text), tuple(map(numbers, must)), base) for label, must, text, base in whole + rest]

    def places(self, text: bytes | None) -> tuple[int, list[int], list[int]]:
        """Number of words, and (place, licence word) of the words that stand in a template."""
        words = words_of(text or b"")
        number = self.words.get
        at = [(i, n) for i, n in enumerate(map(number, words)) if n is not None]
        return len(words), [i for i, _ in at], [n for _, n in at]


def places_column(index: Index, text: Column) -> Column:
    """struct(n_words, place, word): where the licence words of a text stand."""
    kind = StructType([StructField("n_words", LongType()), StructField("place", ArrayType(IntegerType())), StructField("word", ArrayType(IntegerType()))])

    @F.pandas_udf(kind)
    def look(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([index.places(t) for t in texts], columns=["n_words", "place", "word"])

    return look(text.cast("binary"))


class File:
    """Places of each licence word of one file, ascending."""

    def __init__(self, place: np.ndarray, word: np.ndarray) -> None:
        order = np.argsort(word, kind="stable")
        self.known, first = np.unique(word, return_index=True)
        self.of = dict(zip(self.known.tolist(), np.split(place[order], np.sort(np.searchsorted(word[order], self.known))[1:])))

    def phrase(self, words: np.ndarray, idf: np.ndarray) -> np.ndarray:
        """Starts of all places where the words stand one after the other: the rarest word's, kept where the others agree."""
        order = np.argsort(-idf[words], kind="stable").tolist()
        if any(int(w) not in self.of for w in words):
            return np.zeros(0, np.int64)
        start = self.of[int(words[order[0]])] - order[0]
        for p in order[1:]:
            if not len(start):
                break
            there = self.of[int(words[p])] - p
            at = np.searchsorted(there, start)
            start = start[there[np.minimum(at, len(there) - 1)] == start]
        return start


def _agreement(file: File, words: np.ndarray, rare: set[int], idf: np.ndarray) -> tuple[float, int | None]:
    """Largest share of a template's weight whose words agree on a start, up to SLACK, and the first such start.

    None for the start where even all of the file's rare words are too few of the template.
    """
    use = [p for p, w in enumerate(words.tolist()) if w in rare]
    total = float(idf[words].sum())
    if not use or float(idf[words[use]].sum()) < SHARE * total:
        return (float(idf[words[use]].sum()) / total if use else 0.0), None
    spots = [file.of[int(words[p])] for p in use]
    best, where = 0.0, None
    low, high = min(int(s[0]) for s in spots), max(int(s[-1]) for s in spots)
    reach = len(words) + SLACK
    while low <= high:
        cuts = [s[np.searchsorted(s, low) : np.searchsorted(s, low + WINDOW + reach)] for s in spots]
        start = np.concatenate([c - p for c, p in zip(cuts, use)])
        position = np.repeat(use, [len(c) for c in cuts])
        order = np.argsort(start, kind="stable")
        start, position = start[order], position[order]
        # in a sliding window of starts, the weight of the different template positions
        seen, weight, tail = np.zeros(len(words), np.int64), 0.0, 0
        for s, p in zip(start.tolist(), position.tolist()):
            weight += idf[words[p]] if not seen[p] else 0.0
            seen[p] += 1
            while s - start[tail] > SLACK:
                q = position[tail]
                seen[q] -= 1
                weight -= idf[words[q]] if not seen[q] else 0.0
                tail += 1
            if weight > best + 1e-9:
                best, where = weight, int(start[tail])
        low += WINDOW
        nexts = [int(s[i]) for s in spots if (i := int(np.searchsorted(s, low))) < len(s)]
        if not nexts:
            break
        low = max(low, min(nexts))
    return min(1.0, best / total), where


_FOUND = StructType(
    [StructField("base", ArrayType(StructType([StructField("label", StringType()), StructField("start", LongType())]))), StructField("labels", ArrayType(StringType())), StructField("score", IntegerType())]
)


def find(index: Index, idf: np.ndarray, place: np.ndarray, word: np.ndarray) -> tuple[list[dict], list[str], int]:
    """Places of the base phrases, labels, and the best share of a template (in millionths) of one file."""
    base: list[dict] = []
    labels: set[str] = set()
    score = 0.0
    if not len(place):
        return base, [], 0
    file = File(place, word)
    rare = set(file.known[np.argsort(-idf[file.known], kind="stable")][:RARE].tolist())
    for t in index.templates:
        if t.whole:
            start = file.phrase(t.words, idf)
            if len(start):
                labels.add(t.label)
                score = 1.0
                base += [{"label": t.label, "start": int(s)} for s in start] if t.base else []
            continue
        share, at = _agreement(file, t.words, rare, idf)
        score = max(score, share)
        if at is not None and share >= SHARE:
            near = [file.phrase(m, idf) for m in t.mandatory]
            if all(((s >= at - SLACK) & (s <= at + len(t.words) + 2 * SLACK)).any() for s in near):
                labels.add(t.label)
    return base, sorted(labels), round(score * 1_000_000)


def scan(docs: DataFrame, id_column: str, text_column: str, index: Index | None = None) -> DataFrame:
    """(id, n_words, base, labels, score): places of the base phrases as array of (label, start), all labels, 0 to 1."""
    index = index or Index()
    rows = docs.select(F.col(id_column).alias("id"), places_column(index, F.col(text_column)).alias("p"))
    rows = stage(rows.select("id", "p.n_words", "p.place", "p.word"), "licence_words")
    held = rows.select(F.explode(F.array_distinct("word")).alias("w")).groupBy("w").count().collect()  # a row per licence word
    total = rows.count()
    idf = np.full(len(index.words), np.log(1.0 + total) + 1.0)
    for r in held:
        idf[r["w"]] = np.log((1.0 + total) / (1.0 + r["count"])) + 1.0

    @F.pandas_udf(_FOUND)
    def found(place: pd.Series, word: pd.Series) -> pd.DataFrame:
        got = [find(index, idf, np.asarray(p, np.int64), np.asarray(w, np.int64)) for p, w in zip(place, word)]
        return pd.DataFrame(got, columns=["base", "labels", "score"])

    rows = rows.select("id", "n_words", found("place", "word").alias("f"))
    return rows.select("id", "n_words", F.col("f.base").alias("base"), F.col("f.labels").alias("labels"), (F.col("f.score") / 1_000_000).alias("score"))


def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(documents(spark, sf_dir), "doc_id", "text")
    return got.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort("labels"), ",").alias("labels"),
        "score",
    )

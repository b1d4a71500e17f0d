"""Periodic runs, licence scan and whitening against brute force, on nulls, empty tables, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from loanclean.llm import licences, periodic, whitening
from loanclean.llm.base import documents, table

SCHEMA = "doc_id long, text string, lang string, source string, id string, runs string, kept int, base string, labels int, score string, n_words int, place int, word int, key int"
CLASHING = ("x", "x", "x", "x", 1, "x", 2, "x", 3, 4, 5, 6)


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(12, 2 * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e, q) for (s, e), q in found.items())


def repeating(rng, letters):
    w = [rng.randrange(letters) for _ in range(rng.randint(0, 90))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.randrange(letters) for _ in range(rng.randint(1, 25))]
        at = rng.randint(0, len(w))
        w[at:at] = (unit * rng.randint(2, 6))[: -rng.randint(1, len(unit))]
    return w + w if rng.random() < 0.2 else w


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        docs = [repeating(rng, rng.choice([1, 2, 3, 8, 60])) for _ in range(rng.randint(1, 6))]
        words = np.array([x for d in docs for x in d], np.int64)
        doc = np.repeat(np.arange(len(docs)), list(map(len, docs)))
        want, offset = [], 0
        for d in docs:
            want += [(s + offset, e + offset, q) for s, e, q in brute_runs(d)]
            offset += len(d)
        assert [tuple(map(int, r)) for r in periodic.find_runs(words, doc)] == want


def test_runs_of_long_words_lists():
    unit = list(range(3000))
    for w, want in (
        (unit * 7, [(0, 21000, 3000)]),
        ([5] * 40000, [(0, 40000, 1)]),
        (list(range(50000)), []),
        ([9, 9, 9, 9, 9, 9, 9, 9, 9, 9, 9, 8], []),
    ):
        got = periodic.find_runs(np.array(w, np.int64), np.zeros(len(w), np.int64))
        assert [tuple(map(int, r)) for r in got] == want


def test_grammar_derives_its_words():
    rng = random.Random(5)
    words = np.array(repeating(rng, 4) * 3 + list(range(100, 140)), np.int64)
    got = periodic.Grammar(words, np.array([0]), np.array([len(words)]))
    expansion = {}
    for symbol, left, middle, right in zip(got.symbol.tolist(), got.left.tolist(), got.middle.tolist(), got.right.tolist()):
        text = (middle - left, tuple(words[left:right].tolist()))
        assert expansion.setdefault(symbol, text) == text  # one symbol, one expansion
    assert len(got.symbol) == len(words) - 1 and int((got.right - got.left).max()) == len(words)


def run_digest(text, doc_id=None):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = [(s, e - s, q) for s, e, q in brute_runs(w)]
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in drop)
    return (len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_run_query_over_the_small_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    got = {r.doc_id: tuple(r)[1:] for r in periodic.op12_periodic_runs(spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    short = {i: t for i, t in texts.items() if len(t or "") < 8000}
    assert len(short) > 100
    assert {i: got[i] for i in short} == {i: run_digest(t, i) for i, t in short.items()}


@pytest.fixture(scope="module")
def odd_docs(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "one", "a " * 11, "a " * 12, "é é " * 30, "x y z " * 9 + "tail", " ".join(str(rng.random()) for _ in range(3000)) + " q w" * 4000]
    texts += [
        "Under the GNU  General-Public\nLicense, version 3. CC BY cc-by 4.0 MIT license; mit licenses apache_license",
        "licensé apache license apache license", "ccby cc by-nc 4.0", "MIT License " * 5000, "permission is hereby granted free of charge",
        "Copyright 2020 A. B. " + licences.WORDINGS[0][2].replace("sublicense, ", "") + " trailing", licences.WORDINGS[0][2].replace("charge", "cost"),
    ]
    rows = [(i, t, *CLASHING) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[7], rows[9], (None, texts[7], *CLASHING), (None, None, *CLASHING)], SCHEMA).repartition(3).cache()


def test_runs_of_odd_rows(spark, odd_docs):
    got = periodic.periodic_runs(odd_docs, "doc_id", "text")
    assert got.columns == ["id", "n_words", "runs", "kept"]
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    rows = got.collect()
    assert len(rows) == odd_docs.count() and sum(r.id == 7 for r in rows) == 2 and sum(r.id is None for r in rows) == 2
    for r in rows:
        if r.id is not None and len(texts[r.id] or "") < 8000:
            lines = "".join(f"{x.start},{x.length},{x.period}\n" for x in r.runs)
            want = run_digest(texts[r.id])
            assert (len(r.runs), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(r.kept.encode()).hexdigest()) == (want[0], *want[-2:])
    big = next(r for r in rows if r.id == 8)
    assert [tuple(x) for x in big.runs] == [(3000, 8000, 2)] and big.n_words == 11000
    assert got.limit(0).count() == 0 and periodic.periodic_runs(odd_docs.limit(0), "doc_id", "text").collect() == []


def brute_licences(text):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    hits = []
    for phrase, label in licences.PHRASES.items():
        p = phrase.encode().split()
        hits += [(i, label) for i in range(len(w)) if w[i] == p[0] and w[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_licence_query_over_the_small_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    got = licences.op11_licence_scan(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {i: brute_licences(t) for i, t in texts.items()}
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_licences_of_odd_rows(spark, odd_docs):
    rows = licences.scan(odd_docs, "doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    assert len(rows) == odd_docs.count() and sum(r.id == 9 for r in rows) == 2 and sum(r.id is None for r in rows) == 2
    by = {r.id: r for r in rows if r.id is not None}
    for i, r in by.items():
        starts = sorted(b.start for b in r.base)
        want = brute_licences(texts[i])
        assert (r.n_words, len(starts), *(starts[:1] or [None]), *(starts[-1:] or [None])) == want[:4]
        assert 0 <= r.score <= 1
    assert {"gpl", "gpl-3.0", "cc-by", "cc-by-4.0", "mit", "apache"} == set(by[9].labels)
    assert set(by[11].labels) == {"cc-by", "cc-by-nc-4.0"}
    # a wording with a word left out counts; one without its mandatory phrase does not, nor a phrase without its wording
    assert by[14].labels == ["mit-text"] and by[14].score > 0.9
    assert by[15].labels == [] and by[15].score > 0.9
    assert by[13].labels == [] and 0 < by[13].score < 0.6
    assert by[0].score == by[1].score == by[2].score == 0
    assert licences.scan(odd_docs.limit(0), "doc_id", "text").collect() == []


def test_wordings_hold_their_phrases_and_are_found(spark):
    index = licences.Index()
    idf = np.ones(len(index.words))
    for label, must, text in licences.WORDINGS:
        _, place, word = index.places(f"Some file. {text} The end.".encode())
        got = licences.find(index, idf, np.array(place), np.array(word))
        assert label in got[1], (label, must)


def brute_whitening(vectors, weigh=False, levels=256):
    x = {i: np.floor(np.array(v, float) * levels).astype(int) for i, v in vectors}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    w = np.array([sum((v == f).all() for v in x.values()) for f in fit]) if weigh else np.ones(len(fit), int)
    n, s = int(w.sum()), (fit * w[:, None]).sum(axis=0)
    c = (n * fit - s) / n
    values, axes = np.linalg.eigh(c.T @ (c * w[:, None]) / n)
    order = np.argsort(-values)
    return {i: (n, int(((n * v - s).astype(object) ** 2).sum()), ((n * v - s) / n) @ axes[:, order] / np.sqrt(np.maximum(values[order], 1e-300))) for i, v in x.items()}, values[order] / values.sum()


def test_whitening_query_over_the_small_table(spark, sf_dir):
    got = whitening.op13_embedding_whitening(spark, sf_dir).collect()
    vectors = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    want, explained = brute_whitening(vectors)
    assert len(got) == 4 * len(vectors)
    sign = {}
    for r in got:
        n, deviation, white = want[r.vec_id]
        value = white[r.component - 1]
        if abs(value) > 1e-3:
            assert sign.setdefault(r.component, np.sign(value * r.whitened)) == np.sign(value * r.whitened)
        assert (r.n, r.deviation) == (n, deviation) and abs(r.whitened) == pytest.approx(abs(value), abs=1e-6)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-6) and r.identity_error < 1e-4


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_whitening_of_odd_rows(spark, weights):
    rng = np.random.default_rng(4)
    base = [[float(v) for v in rng.normal(0, 2, 3)] for _ in range(40)]
    base[1] = [300.0, -400.5, 90000.0]  # wider than two bytes
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 2.0], [nan, 0.0, 1.0], [1.0, inf, 0.0], [1.0, 2.0], [0.5]]
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(60)]
    rows.append((200, [v + 1 / 1024 if v * 256 % 1 < 0.7 else v for v in base[2]]))  # equal after rounding down
    rows += [(300 + i, v) for i, v in enumerate(bad)] + [(7, base[7]), (None, base[8])]
    df = spark.createDataFrame([(i, v, "x", 1, 2.0, 3, 4) for i, v in rows], "vec_id long, embedding array<double>, key string, id int, whitened double, copies int, n int")
    got = whitening.whiten(df.repartition(3), "vec_id", "embedding", components=3, weights=weights).collect()
    kept = [r for r in rows if r[0] is None or r[0] < 300]
    assert sorted(str(r.id) for r in got) == sorted(str(i) for i, _ in kept)
    numbered = list(enumerate(v for _, v in kept))
    want, explained = brute_whitening(numbered, weights == "copies")
    by_id = {kept[i][0]: w for i, w in want.items()}
    for r in got:
        n, deviation, white = by_id[r.id]
        assert (r.n, r.deviation) == (n, deviation)
        assert np.abs(r.whitened) == pytest.approx(np.abs(white), rel=1e-6, abs=1e-6)
        assert r.explained == pytest.approx(explained, rel=1e-6) and r.identity_error < 1e-6  # one entry is 10,000 times the others


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    run = lambda rows: whitening.whiten(spark.createDataFrame(rows, schema), "vec_id", "embedding").collect()
    assert run([]) == [] and run([(1, None)]) == []
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # one distinct vector
    line = run([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])  # one direction only
    assert len(line) == 5 and all(len(r.whitened) == len(r.explained) == 1 for r in line) and line[0].explained[0] == pytest.approx(1)
    tie = run([(1, [1.0, 2.0]), (2, [1.0]), (3, [3.0, 1.0]), (4, [2.0])])  # as many of one dimension as of two
    assert sorted(r.id for r in tie) == [2, 4]
    huge = run([(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])])  # beyond a long: no crash, deviation null
    assert len(huge) == 3 and all(r.deviation is None for r in huge)

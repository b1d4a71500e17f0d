"""The operators against brute force on small tables with nulls, empty texts, copies, repeated rows and extra columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from loanclean.llm import langid, packing, permindex, pii, quality, repeats, simhash, tiling, tokenfile, tokens, toolcalls
from loanclean.llm.base import components, documents, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string, digest long, pos int"


def rows():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(6000))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    texts = [None, "", " ", "one", "two words", long, *base, *base[:3], base[0].replace(" ", "  ", 1), base[1] + " tail", base[2].upper(), "mail a@b.co now", "\n\n", "{} ~ ~x\ttab", "12:30 !!"]
    out = [(i, t, "en" if i % 2 else "de", "s", len(t or ""), 0.0, "x", 1, 2) for i, t in enumerate(texts)]
    out.append(out[6])  # a repeated row
    out.append((None, base[3], None, None, None, None, None, None, None))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def known():
    return [(r[0], r[1]) for r in rows()]


def brute_print(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (7, 7), (None, 3), (300, 299), (299, 301)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 299: 299, 300: 299, 301: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_links_as_all_pairs_do(spark, docs, none):
    rng = random.Random(3)
    centre = [rng.getrandbits(64) for _ in range(4)]
    prints = [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centre for _ in range(400)]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    out = simhash.fingerprint_components(spark.createDataFrame(signed, "doc_id long, fp long"), 8).collect()
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert {r.doc_id: r.component_id for r in out} == {i: find(i) for i in range(len(prints))}
    got = docs.select("doc_id", simhash.fingerprint_column(3).alias("fp")).collect()
    want = sorted((str(i), brute_print(t)) for i, t in known())
    assert sorted((str(r.doc_id), r.fp % (1 << 64)) for r in got) == want
    assert simhash.fingerprint_components(none.select("doc_id", simhash.fingerprint_column(3).alias("fp")), 8).count() == 0


def test_near_duplicate_stage(spark, docs, none):
    kept = simhash.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(6) == 1 and not {1, 2, 12, 13, 14, 15, 16, 19} & set(ids) and {0, 5, 7, 8, 9, 17, 18, None} <= set(ids)
    assert simhash.drop_near_duplicates(spark, none, "").count() == 0


def test_quality(spark, docs, none, sf_dir):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 0, 0), (2, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels)
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or predicted is null").isEmpty()
    assert quality.classify(none, labels.limit(0)).count() == 0
    held = quality.op4_quality_gam(spark, sf_dir.replace("0.001", "0.01")).join(table(spark, sf_dir.replace("0.001", "0.01"), "labels"), "doc_id").where("held_out").toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.9


def test_tables_of_a_model_follow_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y, rounds=5)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95 and (1, 0) in model.pairs


@pytest.mark.parametrize("path", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_are_those_of_the_library(path):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(path))
    plain.encode_special_tokens = True
    odd = ["l1.\nl2, x!!\nl3", "\nabc d\n", "a\n\nb", "~\n~ ~.", "a  b", " lead", "x \n y", "don't we'll 'S", "\0a b", "a \0b\0", "日本 語", "x\u0085 y", "<|endoftext|> a", "İ ΑΣ Σ", "q　 w"]
    texts = [t for _, t in known()] + odd
    coder = tokens.encoder(public_tokenizers.path(path))
    for _ in range(2):
        ids, counts = coder.encode(texts)
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_file_round_trip(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenfile.byte_path())
    tokenfile.write_tokens(docs, str(tmp_path / "t"), tokenfile.byte_path(), mb=0.01)
    got = tokenfile.digests(tokenfile.read_tokens(spark, str(tmp_path / "t"))).orderBy("start").collect()
    at = 0
    for r, (i, t) in zip(got, sorted(known(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), strict=True):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    tokenfile.write_tokens(none, str(tmp_path / "e"), tokenfile.byte_path())
    assert tokenfile.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_packing(docs, none):
    out = packing.pack(docs, packing.word_path(), ids=True)
    got = out.orderBy("sequence_id", "offset").collect()
    at = {}
    for r in got:
        assert r.offset == at.get(r.sequence_id, 0) and r.length == len(r.ids)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048 and sorted(at) == list(range(len(at)))
    assert sum(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got) == len(got)
    assert {r.sequence_id: len(r.ids) for r in packing.sequences(out).collect()} == at
    assert packing.pack(none, packing.word_path()).count() == 0


def test_plans_use_every_piece_once():
    rng = random.Random(5)
    for _ in range(30):
        capacity = rng.choice([16, 100, 2048])
        histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, capacity + 1), min(capacity, rng.randint(1, 60)))}
        total, runs = packing.best_plan(histogram, capacity)
        used, ranks = {}, {n: set() for n in histogram}
        for n, rank, k, sequence, offset in runs:
            for j in range(k):
                assert rank + j not in ranks[n]
                ranks[n].add(rank + j)
                used.setdefault(sequence + j, []).append((offset, n))
        assert all(ranks[n] == set(range(c)) for n, c in histogram.items())
        for places in used.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n
            assert at <= capacity
        assert len(used) <= total


def brute_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 13 <= len(digits) <= 19 and sum(d if k % 2 == 0 else d * 2 // 10 + d * 2 % 10 for k, d in enumerate(digits)) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def test_base_spans():
    rng = random.Random(5)
    for k in range(20000):
        t = "".join(rng.choice("a@.+-1 23(4)5678 90%_x,\n" if k % 3 else "@.+-1 23(4)5678 90") for _ in range(rng.randint(0, 60)))
        assert [(n, a, b) for n, s in zip(pii.KINDS, pii.base_spans(t)) for a, b in s] == brute_spans(t)


def test_bootstrapping_finds_unseen_identifiers(spark, docs, none):
    seen = [(i, f"please write to u{i}@mail.org today about item {i}00000") for i in range(16)]
    unseen = [(20, "please write to u77(at)mail.org today ok"), (21, "we sold u77(at)mail.org there"), (None, "please write to bob99-at-mail today")]
    both = spark.createDataFrame([(*r, "x") for r in seen + unseen], "doc_id long, text string, extra string")
    got = {r.doc_id: r for r in pii.detect(both).collect()}
    assert got[20].spans == "email:16:31" and got[20].n_email == 0 and got[20].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[21].spans == "" and got[3].spans.count(":") == 2 and got[None].spans == "email:16:29"
    clean = {r.doc_id: r.text for r in pii.redact_stage(spark, both, "").collect()}
    assert clean[20] == "please write to [EMAIL] today ok" and "@" not in clean[3]
    out = pii.redact_stage(spark, docs, "")
    assert out.columns == docs.columns and out.count() == docs.count() and out.where("n_chars <> length(text)").isEmpty()
    assert pii.detect(docs).count() == docs.count() and pii.detect(none).count() == 0


def test_language(spark, none, sf_dir):
    got = langid.op6_ppm_language(spark, sf_dir).join(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.97
    counts = langid.train(documents(spark, sf_dir), 20)
    trees = langid.ContextTrees(counts)
    assert [trees.predict(t) for t in (None, "", "12 !")] == [("und", 0.0)] * 3
    for raw in (b"", b"a", b"the zq\xff\x00 qqq", "à été".encode()):
        want = []
        for lang in trees.langs:
            tree = [{} for _ in range(4)]
            for g, n in zip(*counts[lang]):
                b = int(g).to_bytes(4, "big")
                for k in range(4):
                    node = tree[k].setdefault(b[3 - k : 3], {})
                    node[b[3]] = node.get(b[3], 0) + n
            bits, padded = 0.0, b"\0\0\0" + raw
            for i in range(3, len(padded)):
                for k in (3, 2, 1, 0):
                    node = tree[k].get(padded[i - k : i])
                    if node:
                        total = sum(node.values()) + len(node)
                        if padded[i] in node:
                            bits -= np.log2(node[padded[i]] / total)
                            break
                        bits -= np.log2(len(node) / total)
                else:
                    bits += 8
            want.append(bits)
        assert np.allclose(trees.lengths(raw), want, atol=1e-3)
    assert langid.train(none) == {} and langid.ContextTrees({}).predict("text") == ("und", 0.0)


def brute_repeats(pairs):
    first, out = {}, []
    for i, t in sorted((p for p in pairs if p[0] is not None), key=lambda p: p[0]):
        raw = (t or "").encode()
        for q in range(len(raw) - 49):
            first.setdefault(raw[q : q + 50], i)
    for i, t in pairs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for q in range(len(raw) - 49) if i is not None else ():
            if first[raw[q : q + 50]] < i:
                gone[q : q + 50] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(i), len(raw), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("crowd", [4096, 1])
def test_repeats(spark, docs, none, crowd, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = random.Random(1)
    base, pairs = "".join(rng.choice("ab c") for _ in range(400)), []
    for i in range(120):
        a, noise = rng.randint(0, 300), lambda: "".join(rng.choice("ab c") for _ in range(rng.randint(0, 40)))
        pairs.append((i, rng.choice(["a" * rng.randint(0, 130), "xyz " * rng.randint(0, 40), *[noise() + base[a : a + rng.randint(30, 100)] + noise()] * 4])))
    pairs += [(5, "other text of a doc_id there was"), (None, base)]
    for table_, plain in ((spark.createDataFrame(pairs, "doc_id long, text string"), pairs), (docs, known())):
        got = repeats.remove_repeats(table_).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(plain)
    assert repeats.remove_repeats(none).count() == 0


def test_intervals_and_groups():
    assert sorted(repeats.prefix_intervals([0, 3, 5, 3, 0, 4], 2)) == [(0, 3, 3, 1), (1, 2, 5, 3), (4, 5, 4, 1)]
    lefts = [b"xab", b"yab", b"zb", b"xab"]
    assert sorted(map(str, repeats.maximal_groups([0, 1, 2, 3], lefts, 1, 3))) == ["([0, 1, 2, 3], 1, 1)", "([0, 1, 3], 2, 2)", "([0, 3], 3, 3)"]


def test_permutation_index(spark, sf_dir):
    table_ = table(spark, sf_dir.replace("0.001", "0.01"), "embeddings")
    got = permindex.nearest(table_, F.col("vec_id") % 20 == 0).toPandas()
    all_ = table_.toPandas()
    v, ids = np.stack(all_["embedding"].to_list()).astype(float), all_["vec_id"].to_numpy()
    hit = total = 0
    for q, g in got.groupby("query_id"):
        s = v @ v[ids == q][0]
        s[ids == q] = -9
        best = ids[np.lexsort((ids, -s))[:20]]
        hit, total = hit + len(set(best) & set(g["vec_id"])), total + 20
        assert list(g.sort_values("rank")["rank"]) == list(range(1, 21)) and np.allclose(g.sort_values("rank")["score"], sorted(g["score"], reverse=True))
    assert hit / total >= 0.9
    odd = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    small = spark.createDataFrame([(*r, "x") for r in odd], "vec_id long, embedding array<float>, pivot string")
    rows_ = permindex.nearest(small, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in rows_] == [(1, 1.0), (2, 1.0), (7, 0.5)]
    assert permindex.nearest(small.limit(0), F.lit(True)).count() == 0


def test_tiling(spark, docs, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = item.split()
    texts = [(100, "x " + " ".join(w[6:]) + " y " + " ".join(w[:6])), (101, item.upper() + "!"), (102, " ".join(w[:5])), (103, " ".join(reversed(w))), (104, None), (None, item), (105, (item + " ") * 3)]
    table_ = spark.createDataFrame([(*t, 1.0) for t in texts], "doc_id long, text string, coverage double")
    bench = spark.createDataFrame([(1, item), (1, item), (2, ""), (3, None), (4, "too short")], "item_id long, text string")
    got = {r.doc_id: (r.matched, r.n_tiles) for r in tiling.contaminated(table_, bench).collect()}
    assert got == {100: (12, 2), 101: (12, 1), None: (12, 1), 105: (12, 1)}
    assert tiling.tiles([(0, 0), (1, 1), (2, 2), (10, 1), (11, 2), (12, 3)], 2) == [(0, 0, 4), (12, 3, 2)] or tiling.tiles([(0, 0)], 4) == [(0, 0, 4)]
    assert tiling.contaminated(docs, bench.limit(0)).count() == 0 and tiling.contaminated(none, bench).count() == 0


def test_tool_calls(spark):
    calls = [
        ("c", "a", 0, "reply", '{"turn": 1, "text": "x", "chars": 2}', []), ("c", "b", 1, "reply", '{"z":1,"text":5}', ["a", "nope"]),
        ("c", "d", 2, "mystery", "no json", ["b"]), ("c", "e", 3, "configure", None, ["f"]), ("c", "f", 4, "reply", "{}", ["e", None]),
        ("c", "a", 5, "reply", "{}", None), ("c", None, 6, "reply", "{}", None),
    ]
    results = [("c", "a", 1, "r"), ("c", "a", 2, "again"), ("c", "q", 3, "lost")]
    schema = "conv_id string, call_id string, position int, tool string, arguments string, depends_on array<string>, status string"
    got = toolcalls.link_calls(spark.createDataFrame([(*c, "s") for c in calls], schema), spark.createDataFrame(results, "conv_id string, call_id string, position int, content string"), toolcalls.CHAT_TOOLS).collect()
    by = {(r.call_id, r.position): r for r in got}
    assert len(got) == 9 and by["a", 0].record == '{"arguments":{"chars":2,"text":"x","turn":1},"call_id":"a","result":"r","tool":"reply"}'
    assert (by["a", 0].status, by["a", 0].level, by["b", 1].status, by["b", 1].level, by["d", 2].level) == ("linked", 0, "open", 1, 2)
    assert by["b", 1].errors == "type:text,missing:turn,missing:chars,unknown:z,no_dependency:nope" and by["d", 2].errors == "malformed,unknown_tool"
    assert by["e", 3].status == by["f", 4].status == "cycle" and by["a", 5].status == "duplicate" and by[None, 6].status == "no_id"
    assert by["a", 2].status == "extra_result" and by["q", 3].status == "orphan_result"


def test_pipeline(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id"} <= set(out.columns) and out.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]

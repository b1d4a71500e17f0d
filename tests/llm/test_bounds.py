"""Cases at the edge of an operator's bounds: long words, few candidates, batches of long texts."""

import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanclean.llm import permindex, pii, repeats, tokens


@pytest.mark.parametrize("word", ["x" * 1_000_000, "语" * 1_000_000, "x" * 500_000 + "7" + "y" * 500_000])
def test_long_words_are_read_once(word):
    begin = time.perf_counter()
    got = pii.occurrences(f"please call {word} now or {word[:50]} 12345 later")
    assert time.perf_counter() - begin < 5
    assert [v for _, v, *_ in got if v == "12345"] == ["12345"]
    assert (word in [v for _, v, *_ in got]) == ("7" in word)


def test_tokens_with_digits_are_whole_words():
    text = "a1 bb2bb, (c33cc) ddddd e4e4e\t55555\n(at)6789 é7777 x-8-y9"
    want = [w.strip(" \t\n\r.,;:!?()[]{}<>\"'") for w in text.split() if any(c.isdigit() for c in w)]
    assert [v for _, v, *_ in pii.occurrences(text)] == [w for w in want if len(w) >= 5]


def test_words_cut_off_are_no_patterns():
    text = "q" * 200 + " to reach ab123cd today " + "z" * 200
    found = pii.occurrences(text)[0]
    assert found[4] == ["to reach _", "reach _ today"]
    assert pii.occurrences("w" * 200 + " reach ab123cd today")[0][4] == []


@pytest.mark.parametrize("posted", [1, 2, 12])
def test_queries_get_all_the_neighbours_there_are(spark, posted):
    """Two clusters of 20: the files of a query's pivots hold 19 other rows at most."""
    rng = np.random.default_rng(1)
    centre = np.eye(8)[:2] * 10
    v = np.concatenate([c + rng.normal(0, 0.01, (20, 8)) for c in centre])
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "vec_id long, embedding array<double>")
    got = permindex.nearest(df, F.col("vec_id") % 20 == 0, posted=posted).collect()
    for q in (0, 20):
        score = v @ v[q]
        want = sorted((i for i in range(40) if i != q), key=lambda i: (-score[i], i))[:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and len({r.vec_id for r in mine}) == 20
        assert posted > 2 or [r.vec_id for r in mine[:19]] == want[:19]
    few = permindex.nearest(df.where("vec_id < 5 or vec_id = 20"), F.col("vec_id") % 20 == 0, posted=posted).collect()
    assert sorted(r.query_id for r in few) == [0] * 5 + [20] * 5
    assert permindex.nearest(df.where("vec_id = 0"), F.lit(True)).count() == 0


@pytest.mark.parametrize("held", [1 << 25, 1 << 10])
def test_repeats_do_not_depend_on_how_much_is_held(spark, monkeypatch, held):
    monkeypatch.setattr(repeats, "_HELD", held)
    rng = random.Random(9)
    base = "".join(rng.choice("abcd ") for _ in range(3000))
    texts = [(i, base[(a := rng.randint(0, 2000)) : a + rng.randint(40, 900)] + str(rng.random())) for i in range(60)]
    got = repeats.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(2)).collect()
    first: dict[str, int] = {}
    for i, t in texts:
        for q in range(len(t) - 49):
            first.setdefault(t[q : q + 50], i)
    for r in got:
        t, gone = texts[r.doc_id][1], np.zeros(len(texts[r.doc_id][1]), bool)
        for q in range(len(t) - 49):
            if first[t[q : q + 50]] < r.doc_id:
                gone[q : q + 50] = True
        assert r.n_removed == gone.sum()


@pytest.mark.parametrize("limit", [40, 5000])
def test_a_store_that_is_full_gives_the_same_tokens(monkeypatch, limit):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "_STORE_PIECES", limit)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé'日9") for _ in range(rng.randint(0, 5))) + rng.choice(["", "", ",", ".", "!,", "..", "-,", "_."])
    for path in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        plain, coder = Tokenizer.from_file(public_tokenizers.path(path)), tokens.Encoder(public_tokenizers.path(path), split_special=False)
        for _ in range(30):
            texts = [rng.choice([" ", "\n"]).join(word() for _ in range(rng.randint(0, 30))) for _ in range(20)] + [", a", ". ", ",\n", "x , y", "(, z", "9, ., 8."]
            ids, counts = coder.encode(texts)
            ends = np.cumsum(counts)
            assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert limit > 40 or coder.n <= 40 + 1000


def test_the_filter_of_repeated_grams_grows_with_their_number(spark, monkeypatch):
    """Half of each text is its own. A filter that is full would pass on all of it."""
    rng = random.Random(4)
    text = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    shared = [text(4000) for _ in range(20)]
    docs = spark.createDataFrame([(i, text(4000) + shared[i % 20]) for i in range(40)], "doc_id long, text string").repartition(2)
    shared_dir, moved = Path(spark.conf.get("spark.checkpoint.dir")), []
    for bits in (1 << 26, 1 << 10):
        monkeypatch.setattr(repeats, "BITMAP_BITS", bits)
        before = set(shared_dir.glob("contexts-*"))
        got = repeats.remove_repeats(docs).collect()
        assert [r.n_removed >= 4000 for r in sorted(got, key=lambda r: r.doc_id)] == [i >= 20 for i in range(40)]
        (new,) = set(shared_dir.glob("contexts-*")) - before
        moved.append(sum(f.stat().st_size for f in new.rglob("*.parquet")))
    assert moved[1] < 1.3 * moved[0]

"""Cases that a part of the job would miss."""

import random

import numpy as np
import pytest

from loanclean.llm import pii, simhash, tokens


def test_near_copies_with_one_changed_word_are_found(spark):
    rng = random.Random(3)
    texts = []
    for i in range(150):
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        texts += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:30], "changed", *words[31:]]))]
    out = simhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in out.collect()} == {d: d - d % 2 for d, _ in texts}


@pytest.mark.parametrize("tile", [256, 40])
def test_copies_of_one_text_are_one_group_though_copies_differ(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(4)
    base = [f"w{rng.randrange(9000)}" for _ in range(400)]
    texts = [(0, " ".join(base))]
    for i in range(1, 400):
        words = list(base)
        for k in rng.sample(range(400), 6):
            words[k] = f"c{i}x{k}"
        texts.append((i, " ".join(words)))
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for _, t in texts]
    like = lambda x, y: len(x & y) / len(x | y)
    assert all(like(sets[0], s) >= 0.8 for s in sets)
    out = simhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r.component_id for r in out.collect()} == {0}


def test_found_identifiers_support_further_contexts_and_are_found_anywhere(spark):
    texts = [f"please write to s{i}@mail.org today then go" for i in range(8)]
    texts += [f"please write to v{i}(at)mail today then go" for i in range(16)]
    texts += [f"now forward all to v{i}(at)mail desk then go" for i in range(8)]
    texts += ["now forward all to z99(at)mail desk then go", "you please write to v0(at)mail today again", "v0(at)mail", "w0(at)mail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.redact_stage(spark, docs, "").collect()}
    assert clean[8] == "please write to [EMAIL] today then go"  # more unseen identifiers than seeds
    assert clean[32] == "now forward all to [EMAIL] desk then go"  # no seed ever stands there
    assert clean[34] == "[EMAIL]" and clean[35] == "w0(at)mail"


@pytest.mark.parametrize("path", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_tokens_in_texts_are_those_of_the_library(path):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["<|endoftext|> a", "a b<|startoftext|>c <|endoftext|>", "plain words, here", "<|ENDOFTEXT|>", "<|endof text|>"]
    ids, counts = tokens.encoder(public_tokenizers.path(path), split_special=False).encode(texts)
    plain = Tokenizer.from_file(public_tokenizers.path(path))
    assert [ids[e - n : e].tolist() for e, n in zip(np.cumsum(counts), counts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]

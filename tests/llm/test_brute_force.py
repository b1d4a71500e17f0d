"""Quality, tiling, packing and token files against direct versions; pipeline stages on odd rows."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanclean.llm import packing, quality, simhash, tiling, tokenfile
from loanclean.llm.base import table


def test_scores_are_sums_of_looked_up_tables():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 5))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    model = quality.fit(x, y, rounds=10, pair_rounds=10)
    assert model.pairs
    for row, score in zip(x[:100], model.score(x[:100])):
        at = [sum(v >= e for e in edges) for v, edges in zip(row, model.edges)]
        margin = model.base + sum(t[k] for t, k in zip(model.tables, at)) + sum(t[at[i], at[j]] for (i, j), t in model.pairs.items())
        assert score == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-12)


def test_a_tree_of_three_leaves_is_the_best_there_is_for_one_cut():
    """Two leaves: no other cut of the histogram gains more."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, h = rng.normal(size=8), rng.random(8) + 0.1
        tree = quality._tree_1d(g, h, leaves=2)
        gain = lambda cut: sum(s.sum() ** 2 / (w.sum() + 1.0) for s, w in ((g[:cut], h[:cut]), (g[cut:], h[cut:])))
        cuts = [k for k in range(1, 8) if tree[k] != tree[k - 1]]
        assert len(cuts) <= 1 and (not cuts or gain(cuts[0]) == pytest.approx(max(gain(k) for k in range(1, 8))))


def naive_tiles(doc, item, n):
    """Longest unmarked match again and again, looked up at every pair of places."""
    used_d, used_i, out = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while i + k < len(item) and d + k < len(doc) and doc[d + k] == item[i + k] and d + k not in used_d and i + k not in used_i:
                    k += 1
                if k >= n and (best is None or (-k, i, d) < best):
                    best = (-k, i, d)
        if best is None:
            return out
        k, i, d = -best[0], best[1], best[2]
        out.append((d, i, k))
        used_d.update(range(d, d + k))
        used_i.update(range(i, i + k))


@pytest.mark.parametrize("letters", [2, 4, 30])
def test_tiles_are_those_of_the_naive_tiler(letters):
    rng = random.Random(letters)
    for _ in range(60):
        item = [rng.randrange(letters) for _ in range(rng.randint(0, 25))]
        doc = [rng.randrange(letters) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, max(0, len(item) - 4))
            at = rng.randint(0, len(doc))
            doc[at:at] = item[a : a + rng.randint(3, 10)]
        n = 3
        pairs = [(d, i) for d in range(len(doc) - n + 1) for i in range(len(item) - n + 1) if doc[d : d + n] == item[i : i + n]]
        assert tiling.tiles(pairs, n) == naive_tiles(doc, item, n)


def fewest(sizes, capacity):
    """The least number of bins, over all ways to fill them."""
    full = (1 << len(sizes)) - 1
    best = {0: (0, 0)}  # chosen items: (bins closed, room used in the open one)
    for mask in range(1, full + 1):
        options = []
        for k, size in enumerate(sizes):
            if mask >> k & 1:
                bins, used = best[mask ^ (1 << k)]
                options.append((bins, used + size) if bins and used + size <= capacity else (bins + 1, size))
        best[mask] = min(options)
    return best[full][0]


def test_plans_need_hardly_more_than_the_fewest_sequences():
    rng = random.Random(8)
    same = 0
    for _ in range(150):
        capacity = rng.choice([10, 24, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        histogram = {n: sizes.count(n) for n in set(sizes)}
        total, _ = packing.best_plan(histogram, capacity)
        least = fewest(sizes, capacity)
        assert least <= total <= least + 1
        same += total == least
    assert same >= 140


def test_the_token_file_is_laid_out_as_said(spark, tmp_path):
    rows = [(i, " ".join(f"w{(i * j) % 50}" for j in range(40))) for i in range(6000)]
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), str(tmp_path / "t"), tokenfile.byte_path(), mb=1000)
    last = None
    for path in sorted((tmp_path / "t").glob("*.parquet")):
        file = pq.ParquetFile(path)
        meta = file.metadata
        names = {meta.row_group(0).column(k).path_in_schema: meta.row_group(0).column(k) for k in range(meta.row_group(0).num_columns)}
        ids = next(c for n, c in names.items() if n.startswith("ids"))
        assert ids.has_dictionary_page and "RLE_DICTIONARY" in ids.encodings
        for plain in ("doc_id", "at"):
            assert not names[plain].has_dictionary_page and "DELTA_BINARY_PACKED" in names[plain].encodings
        for k in range(meta.row_group(0).num_columns):
            column = meta.row_group(0).column(k)
            assert column.compression == "ZSTD" and column.has_column_index and column.has_offset_index
        assert all(meta.row_group(g).total_byte_size <= 48 << 20 for g in range(meta.num_row_groups))
        docs = file.read(["doc_id"])["doc_id"].to_pylist()
        assert docs == sorted(docs) and (last is None or not docs or last < docs[0])
        last = docs[-1] if docs else last
    # a range of documents, and their metadata alone, are selective reads
    table_ = tokenfile.read_tokens(spark, str(tmp_path / "t"))
    plan = table_.where("doc_id between 10 and 20").select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" in plan and "PushedFilters: [" in plan and table_.where("doc_id between 10 and 20").count() == 11


STAGES = [("quality", quality.keep_good), ("near_duplicates", simhash.drop_near_duplicates), ("decontamination", tiling.drop_contaminated)]


@pytest.mark.parametrize("name,stage", STAGES, ids=[n for n, _ in STAGES])
def test_stages_keep_odd_rows_and_columns(spark, sf_dir, name, stage):
    """Nulls, empty texts, repeated rows and columns named like the stages' own."""
    clean = "The quiet river bends past old mills and green fields, where people walk in the evening. "
    texts = [None, "", " ", "one", clean * 3, clean * 3, "long " * 3000]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, digest long, item_id long, label__ int"
    rows = [(i, t, "en", "s", len(t or ""), 0.5, 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows += [rows[4], (None, clean, None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema).repartition(2)
    out = stage(spark, docs, sf_dir)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got = out.collect()
    assert set(map(tuple, got)) <= set(rows)
    if name == "near_duplicates":
        assert sorted(str(r.doc_id) for r in got) == sorted(["0", "3", "4", "6", "None"])
    if name == "decontamination":
        assert len(got) == len(rows)  # none of them holds a benchmark passage
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_packing_stage_on_odd_rows(spark):
    schema = "doc_id long, text string, piece string, start int, sequence_id string, offset double, length int"
    rows = [(i, t, "x", 1, "y", 2.0, 3) for i, t in enumerate([None, "", "one", "word " * 5000])] + [(None, "z", "x", 1, "y", 2.0, 3)]
    rows.append(rows[2])
    out = packing.pack_stage(spark, spark.createDataFrame(rows, schema), "")
    got = out.collect()
    assert {str(r.doc_id) for r in got} == {"0", "1", "2", "3", "None"}
    places = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == places.get(r.sequence_id, 0)
        places[r.sequence_id] = r.offset + r.length
    assert max(places.values()) <= 2048 and sum(r.length for r in got if r.doc_id == 3) == 5001
    assert packing.pack_stage(spark, spark.createDataFrame([], schema), "").count() == 0


def test_contamination_covers_the_planted_share(spark, sf_dir):
    """Half of an item's words in one passage is found, a few words are not."""
    item = max((r.text for r in table(spark, sf_dir, "benchmark").collect()), key=len)
    w = item.split()
    docs = spark.createDataFrame([(1, " ".join(w[: len(w) // 2 + 3])), (2, " ".join(w[:5])), (3, item)], "doc_id long, text string")
    got = {r.doc_id for r in tiling.contaminated(docs, table(spark, sf_dir, "benchmark").where(F.col("text") == item)).collect()}
    assert got == {1, 3}

"""Linkage against brute force over all row pairs of a block."""

import random
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_expressions import python_jaro_winkler

from loanclean.functions import similarity
from loanclean.functions.similarity import jaro_winkler_bound, signature
from loanclean.operators import linkage, quality
from loanclean.plans import jobs

COLUMNS = "customer_id string, row_pos long, full_name string, email string, phone string, street_address string, zip_code string"


def make_rows(n, seed, hot=0.4, copies=0.3):
    rng = random.Random(seed)
    rows, positions = [], rng.sample(range(-5 * n, 5 * n), n)
    for i in range(n):
        if rows and rng.random() < copies:
            rows.append((f"C{i}", positions[i], *rng.choice(rows[: max(1, len(rows) // 4)])[2:]))
            continue
        last = "Smith" if rng.random() < hot else rng.choice(["Jones", "Brown", ""])
        first = rng.choice(["Anna", "Ann", "Peter", "Petra"])
        name = rng.choice([f"{first} {last}", f"{first} {last}".upper(), f" {first}  {last} "]) if last else rng.choice(["", None])
        email = rng.choice([f"{first}.{last}{rng.randint(1, 3)}@x.org".lower(), None])
        phone = rng.choice(["no phone", "200-000-0001", "200-000-0002", None])
        street = rng.choice(["1 Oak St", "1 Oak Street", "77 Pine Rd", None])
        zip_code = "00000" if rng.random() < hot else rng.choice(["10001", None])
        rows.append((f"C{i}", positions[i], name, email, phone, street, zip_code))
    return rows


def brute_force(rows):
    blocks = {}
    for r in rows:
        words = (r[2] or "").split()
        if words and r[6] is not None:
            blocks.setdefault((words[-1].upper(), r[6]), []).append(r)
    pairs = []
    for block in blocks.values():
        for a in block:
            for b in block:
                if a[1] > b[1]:
                    total = sum(python_jaro_winkler(a[i], b[i]) for i in (2, 3, 5)) + (a[4] is not None and a[4] == b[4])
                    pairs.append((a, b, round(total, 9)))
    return pairs


def decision(total):
    return "auto_dup" if total >= 2.6 else "gray" if total >= 2.3 else "auto_not"


@pytest.mark.parametrize("seed,tile", [(1, 2000), (2, 7), (3, 3)])
def test_against_brute_force(spark, seed, tile, monkeypatch):
    monkeypatch.setattr(linkage, "POSITION_BITS", 5)  # many slices per list
    rows = make_rows(160, seed)
    pairs = brute_force(rows)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    link = linkage.find_duplicates(df, tile_profiles=tile, staged=True)

    counts = {r.decision: int(r.n_pairs) for r in linkage.triage_counts(link).collect()}
    want = {}
    for _, _, total in pairs:
        want[decision(total)] = want.get(decision(total), 0) + 1
    assert {k: v for k, v in counts.items() if v} == want

    flags = {r.id: r.duplicate_of for r in linkage.duplicate_flags(link).collect()}
    last = {}
    for a, b, total in sorted(pairs, key=lambda p: p[1][1]):
        if decision(total) == "auto_dup":
            last[a[0]] = b[0]
    assert flags == last

    confirmed = link.pairs.where("decision = 'gray' and address_score = 1").select("id_a", "id_b")
    for a, b, total in sorted(pairs, key=lambda p: p[1][1]):
        if decision(total) == "gray" and a[5] and a[5] == b[5]:
            last[a[0]] = b[0]
    later = {}
    for a, b, total in sorted(pairs, key=lambda p: p[1][1]):
        if decision(total) == "gray" and a[5] and a[5] == b[5]:
            later[a[0]] = b[0]
    named = {}
    for r in confirmed.collect():  # the partner that a verdict names goes before those found for copies
        named[r.id_a] = max(r.id_b, named.get(r.id_a, ""))
    both = {r.id: r.duplicate_of for r in linkage.duplicate_flags(link, confirmed).collect()}
    assert both == {**flags, **later, **named}


def test_copies_are_counted_not_listed(spark):
    rows = [(f"C{i}", i, "Anna Smith", "a@x.org", "1", "1 Oak St", "00000") for i in range(500)]
    rows.append(("Z", 1000, "Anna Smith", "a@x.org", None, "1 Oak St", "00000"))
    link = linkage.find_duplicates(spark.createDataFrame(rows, COLUMNS))
    pairs = link.pairs.collect()
    assert len(pairs) == 2
    assert sorted(int(p.n_pairs) for p in pairs) == [500, 500 * 499 // 2]
    flags = {r.id: r.duplicate_of for r in linkage.duplicate_flags(link).collect()}
    assert flags == {**{f"C{i}": f"C{i - 1}" for i in range(1, 500)}, "Z": "C499"}


def test_tiles_meet_once(spark):
    rows = [(f"C{i}", i, f"Anna{i % 50} Smith", f"{i}@x.org", str(i), f"{i} Oak St", "1") for i in range(300)]
    df = spark.createDataFrame(rows, COLUMNS)
    whole = linkage.find_duplicates(df, low=0.0, high=4.5).pairs.select("id_a", "id_b")
    tiled = linkage.find_duplicates(df, low=0.0, high=4.5, tile_profiles=40).pairs.select("id_a", "id_b")
    assert whole.count() == 300 * 299 // 2 == tiled.distinct().count() == tiled.count()


def test_empty_and_null_blocks(spark):
    rows = [("A", 1, None, None, None, None, "1"), ("B", 2, "  ", None, None, None, "1"), ("C", 3, "Anna Smith", None, None, None, None)]
    link = linkage.find_duplicates(spark.createDataFrame(rows, COLUMNS))
    assert link.pairs.count() == 0
    assert linkage.duplicate_flags(link).count() == 0
    assert linkage.block_sizes(link.rows).count() == 0


def test_thresholds(spark):
    total = F.col("t")
    df = spark.createDataFrame([(2.3,), (2.6,), (2.299999999,), (2.599999999,)], "t double")
    assert [r.d for r in df.select(linkage._triage(total, 2.3, 2.6).alias("d")).collect()] == ["gray", "auto_dup", "auto_not", "gray"]


def test_payload_takes_first_row_of_an_id(spark):
    rows = [("A", 2, "Second", None, None, None, "1"), ("A", 1, "First", None, None, None, "1"), ("B", 3, "Other", None, None, None, "1")]
    pairs = spark.createDataFrame([("B", "A")], "id_a string, id_b string")
    out = linkage.pair_payload(pairs, spark.createDataFrame(rows, COLUMNS)).collect()
    assert len(out) == 1 and out[0].record_b.full_name == "First" and out[0].record_a.full_name == "Other"


def test_quality_numbers(spark):
    rows = [("L1", 1, "Anna Smith", "a@x.org", "1", "1 Oak St", "1"), ("D1", 2, "Anna Smith", "a@x.org", "1", "1 Oak St", "1")]
    rows += [("L2", 3, "Peter Jones", "p@x.org", "2", "9 Elm St", "2"), ("D2", 4, "Peter Jones", "p@x.org", "2", "9 Elm St", None)]
    link = linkage.find_duplicates(spark.createDataFrame(rows, COLUMNS))
    truth = spark.createDataFrame([("D1", "L1"), ("D2", "L2")], "duplicate_id string, original_id string")
    got = quality.duplicate_quality(link, truth).collect()[0]
    assert (got.true_pairs, got.true_found, got.found, got.precision, got.recall) == (2, 1, 1, 1.0, 0.5)


def test_a_bound_is_never_exceeded(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé日 .") for _ in range(rng.randint(0, 14)))
    rows = []
    for _ in range(3000):
        a = word()
        b = "".join(c for c in a if rng.random() < 0.8) + word()[:2] if rng.random() < 0.5 else word()
        rows.append((rng.choice([a, a, a, None]) if rng.random() < 0.05 else a, b))
    rows += [("abcd", "abcd"), ("", ""), ("a" * 300, "a" * 290), ("ab" * 100, "ba" * 100)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", jaro_winkler_bound(signature(F.col("a")), signature(F.col("b"))).alias("bound")).collect()
    close = 0
    for r in got:
        exact = python_jaro_winkler(r.a, r.b)
        assert exact <= r.bound + 1e-9, r
        close += r.bound - exact < 0.15
    assert close > len(got) / 3


def test_most_pairs_of_a_block_never_reach_python(spark):
    """Different people of one block: the bound settles nearly all of their pairs, and none that counts."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    rows = [(f"C{i}", i, f"{text(7)} Smith", f"{text(8)}@{text(4)}.org", str(i), f"{rng.randint(1, 97)} {text(9)}", "1") for i in range(300)]
    rows += [(f"D{i}", 1000 + i, rows[i][2].replace("a", "e"), rows[i][3], rows[i][4], rows[i][5] + ".", "1") for i in range(40)]
    prof = linkage.profiles(linkage.block_rows(spark.createDataFrame(rows, COLUMNS)))
    total = 340 * 339 // 2
    kept = linkage._cross_pairs(prof, linkage.shared_blocks(prof, 100), 2.3).count()
    assert 40 <= kept < total / 20
    print(f"{1 - kept / total:.1%} of {total} pairs settled by the bound")
    pairs = linkage.find_duplicates(spark.createDataFrame(rows, COLUMNS)).pairs.collect()
    want = {(a[0], b[0]): t for a, b, t in brute_force(rows) if t >= 2.3}
    assert {(p.id_a, p.id_b): p.total_score for p in pairs} == pytest.approx(want) and len(want) >= 40


def test_cells_are_of_about_equal_work(spark):
    rows = [(f"C{i}", i, f"N{i} Smith", None, None, None, "1" if i < 600 else str(i % 90)) for i in range(900)]
    prof = linkage.profiles(linkage.block_rows(spark.createDataFrame(rows, COLUMNS)))
    cells = linkage._cells(prof, linkage.shared_blocks(prof, 50))
    work = sorted(r["count"] for r in cells.groupBy("zip_code", "hi", "lo").count().where("zip_code = '1' and hi <> lo").collect())
    assert len(work) == 13 * 12 // 2 and work[-1] <= 1.6 * work[len(work) // 2]
    assert linkage.tile_size(prof) == 200 and linkage.tile_size(prof.limit(0)) == 200
    report = {r.size_class: (r.n_blocks, r.n_rows, int(r.n_pairs), r.largest) for r in linkage.block_report(linkage.block_rows(spark.createDataFrame(rows, COLUMNS))).collect()}
    assert report[9] == (1, 603, 603 * 602 // 2, 603) and sum(v[1] for v in report.values()) == 900


def texts(n, seed):
    rng = random.Random(seed)
    word = lambda most: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789 é日\0") for _ in range(rng.randint(0, most)))
    a = [word(rng.choice([5, 14, 64, 70])) for _ in range(n)]
    return a, ["".join(c for c in x if rng.random() < 0.8) + word(3) if rng.random() < 0.7 else word(14) for x in a]


def test_both_bounds_are_one_number(spark):
    a, b = texts(400, 2)
    b[:3] = [None] * 3
    rows = spark.createDataFrame(list(zip(range(400), a, b)), "i int, a string, b string")
    want = [r.bound for r in rows.select("i", jaro_winkler_bound(signature(F.col("a")), signature(F.col("b"))).alias("bound")).orderBy("i").collect()]
    marks = similarity._marks(pa.chunked_array([pa.array(a + b, pa.string())]))
    assert similarity._bound(marks, np.arange(400), 400 + np.arange(400)).tolist() == pytest.approx(want)


def test_words_of_64_bits_score_as_the_plain_block():
    a, b = texts(1500, 3)
    got = similarity.jaro_winkler_array(pd.Series(a), pd.Series(b))
    assert got.tolist() == pytest.approx([python_jaro_winkler(x, y) for x, y in zip(a, b)])


def test_cells_that_go_on_over_batches():
    """Equal pairs whatever the batches, in pieces of a few pairs."""
    score = lambda low: similarity.make_cell_scorer({"name": "s"}, "phone", "p", ["z", "hi", "lo"], ["pos"], low)
    rows = pa.table({"z": ["1"] * 30 + ["2"] * 3, "hi": [1] * 33, "lo": [0] * 30 + [1] * 3, "tile": [i % 2 for i in range(33)], "pos": list(range(33)),
                     "phone": [None] * 33, "name": [f"ann{i % 4}" for i in range(33)]})
    want = {(i, j) for i in range(30) for j in range(i) if (i - j) % 2} | {(31, 30), (32, 30), (32, 31)}
    for size in (1, 7, 33):
        out = pa.Table.from_batches(list(score(0.0)(iter(rows.combine_chunks().to_batches(size)))))
        got = list(zip(out["pos_a"].to_pylist(), out["pos_b"].to_pylist()))
        assert len(got) == len(set(got)) and set(got) == want


def test_texts_of_a_cell_are_scored_once(monkeypatch):
    """Pairs of repeated texts, with nulls, empty and long ones, as in a pass over all pairs."""
    scored, scores = [], similarity._scores
    monkeypatch.setattr(similarity, "_scores", lambda texts, sizes, ia, ib: scored.append(len(ia)) or scores(texts, sizes, ia, ib))
    monkeypatch.setattr(similarity, "_PAIRS", 500)
    values = [None, "", "anna", "anne", "hanna", "bob " * 20, "bob  " * 18, "Ж" * 3]
    n, rng = 200, random.Random(5)
    name, mail = ([rng.choice(values) for _ in range(n)] for _ in range(2))
    rows = pa.table({"z": ["1"] * n, "hi": [0] * n, "lo": [0] * n, "tile": [0] * n, "pos": list(range(n)), "phone": [None] * n, "name": pa.array(name, pa.string()), "mail": pa.array(mail, pa.string())})
    for low in (0.0, 1.5):
        scored.clear()
        out = pa.Table.from_batches(list(similarity.make_cell_scorer({"name": "s", "mail": "t"}, "phone", "p", ["z", "hi", "lo"], ["pos"], low)(iter(rows.to_batches()))))
        got = {(a, b): (s, t) for a, b, s, t in zip(*(out[c].to_pylist() for c in ("pos_a", "pos_b", "s", "t")))}
        jw = lambda x, y: python_jaro_winkler(x, y) if x and y else 0.0
        want = {(i, j): (jw(name[i], name[j]), jw(mail[i], mail[j])) for i in range(n) for j in range(i)}
        want = {k: v for k, v in want.items() if sum(v) >= low}
        assert got.keys() == want.keys() and len(got) == out.num_rows
        assert all(got[k] == pytest.approx(want[k]) for k in want)
        assert sum(scored) <= 2 * len(values) ** 2


@pytest.mark.parametrize("few, tile", [(8, None), (1, 30), (2, 12)])
def test_results_without_a_list_of_all_pairs(spark, monkeypatch, few, tile):
    """Counts, flags and lookups of one crowded block list no pairs and equal those from the list."""
    monkeypatch.setattr(linkage, "FEW_ROWS", few)
    rows = make_rows(220, 17 + few, hot=0.8, copies=0.4)
    rows += [(f"K{i}", 5000 + i, "Anna Smith", f"anna.smith{i % 9}@x.org", str(i), f"{i % 13} Oak St", "00000") for i in range(120)]
    found = linkage.find_duplicates(spark.createDataFrame(rows, COLUMNS), tile_profiles=tile, staged=True)
    listed = linkage.Linkage(found.rows, found.profiles, found.pairs)

    def fail():
        raise AssertionError("all pairs were listed")

    link = linkage.Linkage(found.rows, found.profiles, fail, found.search)
    table = lambda df: sorted(map(tuple, df.collect()), key=str)
    confirmed = listed.pairs.where("decision = 'gray' and address_score = 1").select("id_a", "id_b")
    assert confirmed.count() and listed.pairs.where("n_a > 2 and profile_a <> profile_b").count()
    truth = spark.createDataFrame([(f"K{i}", f"K{i - 13}") for i in range(13, 120)] + [(f"C{i}", "C0") for i in range(1, 200)], "duplicate_id string, original_id string")
    for of in (
        linkage.triage_counts,
        linkage.duplicate_flags,
        lambda x: linkage.duplicate_flags(x, confirmed),
        lambda x: linkage.judged_pairs(x, confirmed).select(listed.pairs.columns),
        lambda x: linkage.agreeing_pairs(x, "street_address").where("address_score = 1"),
        lambda x: linkage.flags_from_pairs(linkage.last_pairs(x), "pos_b"),
        lambda x: quality.duplicate_quality(x, truth),
        lambda x: quality.duplicate_quality(x, truth, confirmed),
    ):
        want = table(of(listed))
        assert table(of(link)) == want and want


def similar_people(n):
    """One block of people of like names, mails and streets, nearly all of whose pairs count."""
    return pa.table({
        "z": ["1"] * n, "hi": [0] * n, "lo": [0] * n, "tile": [0] * n, "pos": list(range(n)), "n": [1] * n, "id": [f"C{i}" for i in range(n)], "profile": [f"P{i}" for i in range(n)],
        "phone": [None] * n, "name": ["Linda Smith"] * n, "street": [f"{i * 31 % 97} {['Oak St', 'Maple St', 'Virginia Road'][i % 3]}" for i in range(n)], "mail": [f"linda.smith{i % 50}@x.org" for i in range(n)],
    })


def test_a_row_looks_back_until_it_finds_a_partner(monkeypatch):
    """The scored pairs grow with the rows, not with their square."""
    scored, plain = [], similarity._Rows.scored
    monkeypatch.setattr(similarity._Rows, "scored", lambda self, a, b, low: scored.append(len(a)) or plain(self, a, b, low))
    find = similarity.make_partner_finder(["name", "street", "mail"], "phone", ["z", "hi", "lo"], 2.6)
    out = pa.Table.from_batches(list(find(iter(similar_people(2000).combine_chunks().to_batches()))))
    assert out.num_rows > 1900 and sum(scored) < 40 * 2000
    pairs = pa.Table.from_batches(list(similarity.make_cell_scorer({"name": "s", "street": "t", "mail": "u"}, "phone", "p", ["z", "hi", "lo"], ["id", "pos"], 2.6)(iter(similar_people(300).to_batches()))))
    last = {}
    for a, b in sorted(zip(pairs["pos_a"].to_pylist(), pairs["pos_b"].to_pylist())):
        last[f"C{a}"] = b
    assert {a: b for a, b in zip(out["id_a"].to_pylist(), out["pos_b"].to_pylist()) if int(a[1:]) < 300} == last


def test_counted_pairs_are_not_returned():
    """Tasks return sums; large counts do not overflow."""
    rows = similar_people(300)
    count = similarity.make_pair_counter(["name", "street", "mail"], "phone", ["z", "hi", "lo"], {"gray": 2.3, "auto_dup": 2.6})
    score = similarity.make_cell_scorer({"name": "s", "street": "t", "mail": "u"}, "phone", "p", ["z", "hi", "lo"], ["pos"], 2.3)
    totals = [round(sum(x), 9) for x in zip(*(pa.Table.from_batches(list(score(iter(rows.to_batches()))))[c].to_pylist() for c in "ptus"))]
    want = {"gray": sum(2.3 <= t < 2.6 for t in totals), "auto_dup": sum(t >= 2.6 for t in totals)}
    for times in (1, 1 << 40):
        out = pa.Table.from_batches(list(count(iter(rows.set_column(rows.schema.get_field_index("n"), "n", pa.array([times] * 300)).to_batches()))))
        assert out.num_rows == 2 and dict(zip(out["decision"].to_pylist(), map(int, out["n_pairs"].to_pylist()))) == {k: v * times * times for k, v in want.items()}


def test_a_text_that_many_share_fills_no_tile(spark):
    rows = [(f"C{i}", i, f"N{i} Smith", None, None, None if i % 3 else f"{i % 30} Oak St", "1") for i in range(900)]
    prof = linkage.profiles(linkage.block_rows(spark.createDataFrame(rows, COLUMNS)))
    search, shared = linkage.Search(2.3, 2.6, 50, lambda df, name: df), linkage.shared_blocks(prof, 50)
    tiles = linkage._cells(linkage._tiles_by(prof, shared, search, "street_address"), shared, place="_place").where("hi = lo")
    sizes = [r["count"] for r in tiles.groupBy("hi").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 300


@pytest.mark.parametrize("low, high, tile", [(2.3, 2.6, None), (2.3, 2.6, 9), (2.0, 3.5, 12)])
def test_payload_without_a_list_of_pairs(spark, monkeypatch, low, high, tile):
    """Gray pairs leave their cells with their records, in small batches, and equal those of the list."""
    monkeypatch.setattr(similarity, "_BYTES", 2000)
    rows = make_rows(200, 23, hot=0.8, copies=0.4)
    rows += [(f"K{i}", 5000 + i, "Anna Smith", f"anna.smith{i % 9}@x.org", str(i), f"{i % 13} Oak St", "00000") for i in range(90)]
    rows += [(rows[i][0], 9000 + i, *rows[i - 1][2:]) for i in range(5, 40, 7)]  # ids that come again
    rows += [(None, 9900, *rows[-1][2:])]
    df = spark.createDataFrame(rows, COLUMNS)
    found = linkage.find_duplicates(df, low=low, high=high, tile_profiles=tile, staged=True)
    gray = found.pairs.where("decision = 'gray'")

    def fail():
        raise AssertionError("all pairs were listed")

    link = linkage.Linkage(found.rows, found.profiles, fail, found.search)
    table = lambda payload: sorted(map(str, payload.select("id_a", "id_b", "record_a", "record_b").collect()))
    want = table(linkage.pair_payload(gray, df))
    assert table(linkage.pair_payload(link, df)) == want and len(want) > 100
    assert table(linkage.pair_payload(linkage.Linkage(found.rows, found.profiles, found.pairs), df)) == want
    if high > 3:
        assert gray.where("profile_a = profile_b").count()
    texts = lambda record: F.to_json(record, {"ignoreNullFields": "false"})
    payload = linkage.pair_payload(gray, df)
    assert table(linkage.pair_payload(link, df, form=texts)) == table(payload.withColumns({c: texts(F.col(c)) for c in ("record_a", "record_b")}))


def test_pairs_of_a_cell_leave_in_batches_of_bounded_size(monkeypatch):
    """Long texts make batches of few pairs; pairs that reach ``high`` are not returned."""
    monkeypatch.setattr(similarity, "_BYTES", 50_000)
    rows = similar_people(200)
    rows = rows.append_column("record", pa.array([{"text": "x" * 1000, "note": None}] * 200))
    names = {"name": "s", "street": "t", "mail": "u"}
    score = lambda **more: list(similarity.make_cell_scorer(names, "phone", "p", ["z", "hi", "lo"], ["pos", "record"], 2.3, **more)(iter(rows.to_batches())))
    total = lambda out: [round(sum(x), 9) for x in zip(*(out[c].to_pylist() for c in "pstu"))]
    out, all_pairs = score(high=2.6), pa.Table.from_batches(score())
    assert max(b.num_rows for b in out) <= 25 and {r["text"] for b in out for r in b["record_b"].to_pylist()} == {"x" * 1000}
    want = [x for x in zip(all_pairs["pos_a"].to_pylist(), all_pairs["pos_b"].to_pylist(), total(all_pairs)) if x[2] < 2.6]
    got = pa.Table.from_batches(out)
    assert list(zip(got["pos_a"].to_pylist(), got["pos_b"].to_pylist(), total(got))) == want and 0 < len(want) < all_pairs.num_rows


@pytest.mark.parametrize("large,tile", [(2, 2000), (2, 11), (30, 40)])
def test_blocks_of_large_cells_against_brute_force(spark, large, tile, monkeypatch):
    """Cells whose pairs are bounded in blocks give the pairs, scores and counts of all row pairs."""
    monkeypatch.setattr(similarity, "_LARGE", large)
    monkeypatch.setattr(similarity, "_BLOCK", 64)
    monkeypatch.setattr(similarity, "_SAMPLE", 5)
    rows = make_rows(200, 12, copies=0.1)
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdef", k=n))
    rows += [(f"L{i}", 9000 + i, f"{text(6)} Smith", rng.choice([f"{text(5)}@x.org", text(70), "", None]), rng.choice(["1", "2", None]), f"{i % 7} {text(5)}", "00000") for i in range(90)]
    link = linkage.find_duplicates(spark.createDataFrame(rows, COLUMNS), tile_profiles=tile, staged=True)
    first, want, counts = {}, {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        first.setdefault(r[2:], r[0])
    for a, b, total in brute_force(rows):
        if total >= 2.3:
            counts[decision(total)] = counts.get(decision(total), 0) + 1
            if a[2:] != b[2:]:
                want[frozenset((first[a[2:]], first[b[2:]]))] = total
    got = link.pairs.where("profile_a <> profile_b").collect()
    assert len(got) == len(want) and {frozenset((r.id_a, r.id_b)): r.total_score for r in got} == want
    assert {r.decision: int(r.n_pairs) for r in linkage.pair_counts(link).collect()} == counts


def test_a_large_cell_is_not_scored_pair_by_pair(monkeypatch):
    """Different people of one block: the pairs that a cheap bound rules out are not looked at one by one."""
    rng, n, looked = random.Random(6), 600, []
    text = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    rows = pa.table({
        "pos": pa.array(range(n), pa.int64()), "profile": [str(i) for i in range(n)], "id": [str(i) for i in range(n)], "n": pa.array([1] * n, pa.int64()),
        "full_name": [f"{text(7)} Smith" for _ in range(n)], "email": [f"{text(8)}@{text(4)}.org" for _ in range(n)], "phone": [str(i) for i in range(n)],
        "street_address": [f"{i % 97} {text(9)}" for i in range(n)], **{c: pa.array([0] * n, pa.int32()) for c in ("tile", "hi", "lo")},
    })
    bound, scores = similarity._bound, similarity._scores
    monkeypatch.setattr(similarity, "_bound", lambda m, a, b: looked.append(len(a)) or bound(m, a, b))
    monkeypatch.setattr(similarity, "_scores", lambda t, n, a, *rest: looked.append(len(a)) or scores(t, n, a, *rest))
    count = similarity.make_pair_counter(list(linkage.FUZZY_FIELDS), "phone", ["hi", "lo"], {"gray": 2.3, "auto_dup": 2.6})
    list(count(iter(rows.to_batches())))
    assert 0 < sum(looked) < 0.6 * n * (n - 1) / 2


def test_saving_lists_the_pairs_once(spark, tmp_path):
    """The list of pairs goes to the job's folder only, not to the shared one first."""
    found = linkage.find_duplicates(spark.createDataFrame(make_rows(120, 21), COLUMNS), staged=True)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("link-pairs-*"))
    final = spark.createDataFrame([(True, None)], "is_duplicate boolean, issue_date string")
    layer2 = spark.createDataFrame([("2020-01-01", None)], "application_date string, issue_date string")
    counts = {(r.stage, r.metric): r.value for r in jobs.save(jobs.Cleaned(final, found, layer2), str(tmp_path / "saved")).collect()}
    assert set(shared.glob("link-pairs-*")) == before
    want = {r.decision: int(r.n) for r in found.pairs.groupBy("decision").agg(F.sum("n_pairs").alias("n")).collect()}
    assert {k: counts["pairs", k] for k in want} == want and counts["pairs", "rows"] == found.pairs.count()

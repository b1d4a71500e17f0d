"""Column expressions against plain Python on edge cases."""

from datetime import date, datetime
from itertools import product

import pandas as pd
from pyspark.sql import functions as F

from loanclean.functions.numbers import number_text, parse_number
from loanclean.functions.similarity import indel_ratio, jaro_winkler_array, lcs_length_to, make_pair_scorer, characters
from loanclean.functions.text import digits, last_word_upper, phone_layout, strip
from loanclean.operators import cleaning, dating
from loanclean.values import CANONICAL_PURPOSES, DATE_FORMATS, WHITESPACE


def column(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, {name} string").repartition(2)


def evaluate(df, expr):
    return [r.x for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


DATES = [
    "5-1-2019", "05-11-2019", "13-05-2019", "05-05-2019", "31/02/2019", "29-02-2020", "29-02-2019", "05-11-19", "20190105",
    "05 nov 2019", "05  Nov 2019", "05 Nov 2019\t", "\xa005 Nov 2019", "", None, "  ", "2019-01-05", "2019/1/5", "1.2.2019",
    "Nov 5, 2019", "November 05,  2019", "5 November 2019", "Sept 5, 2019", "05-11/2019", "0000-01-01", "12/ 5/2019", "12/31/2019",
    "31.12.2019", "99-99-2019", "Nov 31, 2019", "2019-13-01", "May 5, 2019", "5 May 2019", "x2019-01-05", "2019-01-05 10:00",
]


def python_candidates(text):
    if text is None or not text.strip():
        return set()
    found = set()
    for fmt in DATE_FORMATS:
        try:
            found.add(datetime.strptime(text.strip(), fmt).date())
        except ValueError:
            pass
    return found


def test_candidates_agree_with_strptime(spark):
    got = dating.candidate_dates(column(spark, DATES), "v", out="x").orderBy("i").collect()
    for row in got:
        assert set(row.x) == python_candidates(DATES[row.i]), DATES[row.i]
        assert len(row.x) == len(set(row.x))


def test_candidates_agree_on_every_layout(spark):
    days = [date(2015, 1, 1), date(2016, 2, 29), date(2019, 11, 5), date(2020, 12, 12), date(2021, 5, 31)]
    texts = [d.strftime(f) for d in days for f in DATE_FORMATS]
    got = dating.candidate_dates(column(spark, texts), "v", out="x").orderBy("i").collect()
    assert [set(r.x) for r in got] == [python_candidates(t) for t in texts]


def test_pair_rule(spark):
    rows = [
        ("gap0", "2019-01-05", "2019-01-05"), ("gap1", "2019-01-05", "2019-01-06"), ("gap30", "2019-01-01", "2019-01-31"),
        ("gap31", "2019-01-01", "2019-02-01"), ("blank", "", None), ("two", "01/02/2019", "02/03/2019"), ("swap", "05-11-2019", "18-11-2019"),
    ]
    df = spark.createDataFrame(rows, "customer_id string, application_date string, issue_date string")
    one = {r.customer_id: r for r in dating.resolve_date_pairs(df).collect()}
    for name, app, iss in rows:
        pairs = [(a, b) for a, b in product(python_candidates(app), python_candidates(iss)) if 1 <= (b - a).days <= 30]
        assert one[name].is_ambiguous == (len(pairs) != 1), name
        if len(pairs) == 1:
            assert (one[name].solved_application_date, one[name].solved_issue_date) == tuple(d.isoformat() for d in pairs[0])
    best = {r.customer_id: r for r in dating.resolve_date_pairs(df, policy="min_gap").collect()}
    for name, app, iss in rows:
        pairs = sorted(((b - a).days, a, b) for a, b in product(python_candidates(app), python_candidates(iss)) if 1 <= (b - a).days <= 30)
        assert best[name].is_ambiguous == (not pairs)
        if pairs:
            assert best[name].solved_application_date == pairs[0][1].isoformat()


def test_numbers(spark):
    values = ["1.234,5", "1,5", "1.5d", " 7 ", "nan", "inf", "-Infinity", "1e5", "-0", "1_000", "0x10", "", None, "12.", ".5", "+3", "3 4"]
    df = column(spark, values).withColumn("v", number_text(F.col("v")))
    want = [None, 1.5, None, 7.0, None, float("inf"), float("-inf"), 1e5, -0.0, None, None, None, None, 12.0, 0.5, 3.0, None]
    assert evaluate(df, parse_number(F.col("v"))) == want


def test_strip_and_last_word(spark):
    values = ["  a b ", "\ta b\x1c", "\xa0x　", "", "   ", None, "Anna  de\tla Cruz \n", "é ß"] + [f"{w}a{w}" for w in WHITESPACE]
    df = column(spark, values)
    assert evaluate(df, strip(F.col("v"))) == [None if v is None else v.strip() for v in values]
    assert evaluate(df, last_word_upper(F.col("v"))) == [None if v is None or not v.split() else v.split()[-1].upper() for v in values]


def test_phone(spark):
    values = ["(200) 123-4567", "200.123.4567", "123456789", "12345678901", "no phone", "200-123-456²", "٢٠٠1234567", None, "", "a2b0c01234567"]
    df = column(spark, values).withColumn("v", digits(F.col("v")))

    def phone(p):
        d = "".join(c for c in p or "" if c.isdigit())
        return f"{d[:3]}-{d[3:6]}-{d[6:]}" if len(d) == 10 else None

    assert evaluate(df, phone_layout(F.col("v"))) == [phone(v) for v in values]


def python_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_forms_agree(spark):
    words = ["", "a", "dept_consolidation", "creditcard", "small_buisness", "zzz", "home improvment", "ääö", "ca", "medicals", "x" * 70]
    pairs = list(product(words, words))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    got = evaluate(df, indel_ratio(F.col("a"), F.col("b")))
    for (a, b), g in zip(pairs, got):
        want = 100.0 if not a and not b else 200.0 * python_lcs(a, b) / (len(a) + len(b))
        assert abs(g - want) < 1e-9, (a, b)
    for choice in [*CANONICAL_PURPOSES, "y" + "x" * 70]:
        got = evaluate(column(spark, words), lcs_length_to(characters(F.col("v")), choice))
        assert got == [python_lcs(w, choice) for w in words], choice


def test_match_category(spark):
    values = ["Debt Consolidation", "dept_consolidation", "credit-card", "zzz", None, "", "CAR ", "cat", "smal business", "othr", "home  improvement"]

    def best(v):
        if v is None:
            return None
        text = v.strip().lower().replace(" ", "_").replace("-", "_")
        scores = [(200.0 * python_lcs(text, c) / (len(text) + len(c)), -i, c) for i, c in enumerate(CANONICAL_PURPOSES)]
        score, _, choice = max(scores)
        return choice if score >= 80 else None

    out = cleaning.match_category(column(spark, values), "v", keep_as="old").orderBy("i").collect()
    assert [r.v for r in out] == [best(v) for v in values]
    assert [r.old for r in out] == values


def test_match_category_tie_and_limit(spark):
    # "ab" and "ac" tie on "a"; the first choice wins
    out = cleaning.match_category(column(spark, ["a"]), "v", ["ab", "ac"], 60).collect()
    assert out[0].v == "ab"
    exactly = cleaning.match_category(column(spark, ["abcdx"]), "v", ["abcde"], 80).collect()
    assert exactly[0].v == "abcde"
    below = cleaning.match_category(column(spark, ["abcdx"]), "v", ["abcde"], 80.1).collect()
    assert below[0].v is None


def python_jaro_winkler(a, b):
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, mine = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                mine.append(x)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [y for y, u in zip(b, used) if u]
    t = sum(x != y for x, y in zip(mine, theirs)) // 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def test_jaro_winkler():
    words = ["", None, "a", "martha", "marhta", "dixon", "dicksonx", "james.smith1@example.org", "ÄÖ ü", "\U0001f600x", "x" * 50, "ab" * 300, "a\0b", "a\0"]
    pairs = list(product(words, words))
    got = jaro_winkler_array(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    for (a, b), g in zip(pairs, got):
        assert abs(g - python_jaro_winkler(a, b)) < 1e-12, (a, b)


def test_pair_scorer_skips_only_hopeless_pairs():
    names = ["one", "two"]
    a, b = pd.Series(["abc", "abc", "abc"]), pd.Series(["abc", "xyz", "abd"])
    out = make_pair_scorer(names, 1.9)(pd.Series([0.0, 0.0, 0.0]), a, b, a, b)
    assert out["one"][0] == 1.0 and out["two"][0] == 1.0
    assert out["two"].isna()[1]
    full = make_pair_scorer(names, 0.0)(pd.Series([0.0, 0.0, 0.0]), a, b, a, b)
    assert not full.isna().any().any()


def test_layer1_cells(spark):
    values = ["grade B", " g", "b ", "H", None, "a"]
    token = cleaning.extract_letter(column(spark, values), "v").orderBy("i").collect()
    first = cleaning.extract_letter(column(spark, values), "v", "first").orderBy("i").collect()
    assert [r.v for r in token] == ["B", "G", "B", None, None, "A"]
    assert [r.v for r in first] == ["G", "G", "B", None, None, "A"]
    marked = cleaning.null_markers(column(spark, [" NULL ", "no phone", "-1", "NULL", "x"])).orderBy("i").collect()
    assert [r.v for r in marked] == [" NULL ", None, None, None, "x"]
    homes = cleaning.recode_category(column(spark, [" rented", "Mortgaged ", "own", None]), "v").orderBy("i").collect()
    assert [r.v for r in homes] == ["RENT", "MORTGAGE", "OWN", None]


def test_note_repair(spark):
    values = ["  Stable  incme,\templyed 3 years.  ", "STABLE INCOME, EMPLYED 3 YEARS.", "Fine.", None, "12"]
    out = cleaning.repair_notes(column(spark, values), "v", vocabulary=["stable", "income", "employed", "years"]).orderBy("i").collect()
    assert [r.v for r in out] == ["Stable income, employed 3 years.", "Stable income, employed 3 years.", "Fine.", None, "12"]
    assert [r.needs_review for r in out] == [False, False, True, False, False]

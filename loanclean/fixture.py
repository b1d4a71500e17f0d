"""A dirty loan table derived from the ``orders`` table.

The rules use integer arithmetic and plain text functions only, so one SELECT
text runs on Spark and on any other SQL engine. ``k`` is the order key and
``c`` the customer key. Each column has a clean value and a list of
(condition, dirty value); the first condition that holds wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from loanclean.sources.staging import stage, staging_path
from loanclean.values import CANONICAL_PURPOSES, LOAN_COLUMNS

MONTH_NAMES = "JanFebMarAprMayJunJulAugSepOctNovDec"


def _div(x: str, n: int) -> str:
    return f"cast(floor(({x}) / {n}) as bigint)"


def _text(x: str) -> str:
    return f"cast({x} as string)"


def _pick(values: list[str], index: str) -> str:
    return f"split_part('{'|'.join(values)}', '|', cast(1 + ({index}) % {len(values)} as int))"


def _cents(n: str) -> str:
    return f"concat({_text(_div(n, 100))}, '.', lpad({_text(f'({n}) % 100')}, 2, '0'))"


def _comma(x: str) -> str:
    return f"replace({x}, '.', ',')"


def _layout(day: str, choice: str) -> str:
    """ISO, or one of four other layouts, of a date by the last digit of ``choice``."""
    s = _text(day)
    y, m, d = f"substr({s}, 1, 4)", f"substr({s}, 6, 2)", f"substr({s}, 9, 2)"
    month = f"substr('{MONTH_NAMES}', 3 * cast({m} as int) - 2, 3)"
    return (
        f"case ({choice}) % 10 when 5 then concat({d}, '/', {m}, '/', {y}) when 6 then concat({m}, '-', {d}, '-', {y}) "
        f"when 7 then concat({d}, ' ', {month}, ' ', {y}) when 8 then concat({y}, '/', {m}, '/', {d}) else {s} end"
    )


FIRST = _pick(["James", "Mary", "Robert", "Linda", "Anna", "Peter", "Olga", "Sven", "Ivan", "Rosa"], "k")
LAST = _pick(["Smith", "Jones", "Brown", "Taylor", "Wilson", "Davies", "Evans", "Thomas", "Johnson", "Roberts", "Walker"], "k * 7")
NAME = f"concat({FIRST}, ' ', {LAST})"
MAIL = f"lower(concat({FIRST}, '.', {LAST}, {_text('1 + k % 998')}, '@example.org'))"
PHONE = _text("2000000000 + (k * 7919) % 7999999999")
P1, P2, P3 = f"substr({PHONE}, 1, 3)", f"substr({PHONE}, 4, 3)", f"substr({PHONE}, 7, 4)"
GRADE = "substr('ABCDEFG', cast(1 + k % 7 as int), 1)"
HOME = _pick(["RENT", "MORTGAGE", "OWN", "OTHER"], "k")
PURPOSE = _pick(CANONICAL_PURPOSES, "k")
AMOUNT = f"concat({_text('amt')}, '.0')"
RATE = _cents("531 + (k * 37) % 2500")
INCOME = _cents("1500000 + (k * 7717) % 38500000")
DTI = _cents("(k * 53) % 4500")
FICO = _text("600 + k % 251")
NOTE = f"concat('Desk remark: papers on income filed, applicant employed for ', {_text('1 + k % 10')}, ' years at one firm.')"
APP, ISS = "app", "iss"

# column: (clean value, [(condition, dirty value), ...])
RULES: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "full_name": (NAME, [("copy = 1 and k % 4 < 2", f"upper({NAME})")]),
    "email": (MAIL, [("copy = 1 and k % 3 = 0", f"replace({MAIL}, '@', '+dup@')")]),
    "phone": (
        f"concat({P1}, '-', {P2}, '-', {P3})",
        [
            ("k % 33 = 4", "'no phone'"),
            ("k % 33 = 5", "''"),
            ("k % 10 = 1", f"concat('(', {P1}, ') ', {P2}, '-', {P3})"),
            ("k % 10 = 4", f"concat({P1}, '.', {P2}, '.', {P3})"),
            ("k % 10 = 7", PHONE),
        ],
    ),
    "street_address": (
        f"concat({_text('1 + (k * 31) % 997')}, ' ', {_pick(['Oak', 'Maple', 'Cedar', 'Pine', 'Elm', 'Lake', 'Hill', 'River'], 'k')}, ' St')",
        [],
    ),
    "city": (_pick(["Ashford", "Dover", "Easton", "Hudson", "Milton"], "c"), []),
    "state": (_pick(["CA", "NY", "TX", "WA"], "c"), []),
    # one zip per customer of the orders table, so blocks do not grow with the data
    "zip_code": (_text("10000 + c"), [("k % 150 = 3", "''"), ("k % 150 = 53", "'00000'"), ("k % 150 = 103", "'N/A'")]),
    "loan_amnt": (AMOUNT, [("k % 100 = 9", f"concat('-', {_text('amt')})"), ("k % 12 = 5", _comma(AMOUNT))]),
    "term_months": ("case when k % 3 = 0 then '60' else '36' end", []),
    "int_rate": (RATE, [("k % 12 = 7", _comma(RATE))]),
    "installment": (_cents("2000 + (k * 131) % 120000"), []),
    "grade": (GRADE, [("k % 40 = 3", f"concat('grade ', {GRADE})"), ("k % 40 = 13", f"lower({GRADE})"), ("k % 40 = 23", f"concat(' ', {GRADE})")]),
    "emp_title": (_pick(["Teacher", "Nurse", "Engineer", "Driver", "Clerk"], "k"), [("k % 50 = 2", "'???'"), ("k % 50 = 7", "'n/a'")]),
    "emp_length": (_pick(["< 1 year", "1 year", "2 years", "3 years", "5 years", "10+ years"], "k"), []),
    "home_ownership": (
        HOME,
        [
            ("k % 20 = 4", f"lower({HOME})"),
            (f"k % 20 = 9 and {HOME} = 'MORTGAGE'", "'mortgaged'"),
            (f"k % 20 = 12 and {HOME} = 'RENT'", "'rented'"),
            ("k % 20 = 14", f"concat({HOME}, ' ')"),
        ],
    ),
    "annual_inc": (
        INCOME,
        [("k % 25 = 1", "'NULL'"), ("k % 25 = 6", "'unknown'"), ("k % 25 = 11", "'-1'"), ("k % 12 = 3", _comma(INCOME))],
    ),
    "verification_status": (_pick(["Verified", "Source Verified", "Not Verified"], "k"), []),
    "purpose": (
        PURPOSE,
        [
            ("k % 200 = 15", "'zzz'"),
            ("k % 16 = 8", "'dept_consolidation'"),
            ("k % 16 = 9", "'creditcard'"),
            ("k % 16 = 10", "'Home Improvement'"),
            ("k % 16 = 12", "'small buisness'"),
        ],
    ),
    "dti": (DTI, [("k % 33 = 1", "'999'"), ("k % 33 = 12", "'nan'"), ("k % 100 = 21", _text("150 + k % 849"))]),
    "fico_score": (FICO, [("k % 100 = 7", "'9999'")]),
    "loan_status": (_pick(["Fully Paid", "Current", "Charged Off", "Late (31-120 days)"], "k"), []),
    "application_date": (_text(APP), [("k % 500 = 11", "''"), ("k % 500 = 12", "'31/02/1999'"), ("true", _layout(APP, "k"))]),
    "issue_date": (_text(ISS), [("true", _layout(ISS, _div("k", 10)))]),
    "advisor_notes": (
        NOTE,
        [
            ("k % 15 = 3", f"upper({NOTE})"),
            ("k % 15 = 6", f"concat('  ', {NOTE}, '   ')"),
            ("k % 15 = 9", f"replace(replace({NOTE}, 'employed', 'emplyed'), 'income', 'incme')"),
            ("k % 15 = 12", f"replace({NOTE}, 'papers', 'pprs')"),
        ],
    ),
}

CUSTOMER_ID = f"case when copy = 1 then concat('DUP', {_text('1000 + ' + _div('k', 67))}) else concat('LC', {_text('100000 + k')}) end"
ROW_POS = "case when copy = 0 then k when k % 2 = 0 then k + 10000000 else k - 10000000 end"

_KEYS = """
select o_orderkey as k, o_custkey as c, cast(round(o_totalprice) as bigint) as amt, cast(o_orderdate as date) as iss,
       cast(o_orderdate as date) - cast(1 + o_orderkey % 29 as int) as app, {copy} as copy
from {orders} {where}"""


def _dirty(column: str) -> str:
    clean, rules = RULES[column]
    if not rules:
        return clean
    return "case " + " ".join(f"when {cond} then {value}" for cond, value in rules) + f" else {clean} end"


def loans_sql(orders: str = "orders") -> str:
    """The raw dirty table as it would lie in a CSV file, with row_pos, k and the truth columns."""
    cells = [f"{_dirty(c)} as {c}" for c in LOAN_COLUMNS[1:]]
    keys = _KEYS.format(copy=0, orders=orders, where="") + " union all " + _KEYS.format(copy=1, orders=orders, where="where o_orderkey % 67 = 0")
    return (
        f"select {CUSTOMER_ID} as customer_id, {', '.join(cells)}, {ROW_POS} as row_pos, k, "
        f"app as true_app, iss as true_iss, {NOTE} as true_notes from ({keys}) keys"
    )


def clean_sql(orders: str = "orders") -> str:
    """The same customers without dirt and without copies, all cells as text."""
    cells = [f"{RULES[c][0]} as {c}" for c in LOAN_COLUMNS[1:]]
    keys = _KEYS.format(copy=0, orders=orders, where="")
    return f"select concat('LC', {_text('100000 + k')}) as customer_id, {', '.join(cells)} from ({keys}) keys"


def layer2_sql(orders: str = "orders") -> str:
    """An imperfect second layer: some days and months exchanged, some dates missing, some rows lost."""
    y, m, d = (f"substr({_text('true_app')}, {a}, {n})" for a, n in ((1, 4), (6, 2), (9, 2)))
    swapped = f"concat({y}, '-', {d}, '-', {m})"
    app = (
        f"case when k % 97 = 5 then null when k % 11 = 3 and cast({d} as int) <= 12 then {swapped} "
        f"when k % 101 = 9 then concat({y}, '-', {m}, '-01') else {_text('true_app')} end"
    )
    return (
        f"select customer_id, {app} as application_date, {_text('true_iss')} as issue_date, true_notes as advisor_notes "
        f"from ({loans_sql(orders)}) loans where k % 50 <> 7"
    )


SOURCE_BYTES = 1 << 20  # of the orders' file a task; it makes some tens of MB of loans
_staged: dict[tuple[str, str, str], DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str, select: str) -> DataFrame:
    """The derived table: a projection of the spread orders, of which a query makes the columns that it reads.

    Only the narrow orders are written, once per session.
    """
    slot = (spark.conf.get("spark.app.id"), sf_dir, "orders")
    if slot not in _staged:
        _staged[slot] = stage(_orders(spark, sf_dir), "fixture-orders")
    derived = (*slot[:2], name)
    if derived not in _staged:
        _staged[derived] = spark.sql(select, orders=_staged[slot])
    return _staged[derived]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four columns that the loans are made of, spread by key.

    Test tables may come as one file with one row group. The orders are spread, not the
    derived rows, which are twenty times as wide; each task gets about ``SOURCE_BYTES``.
    """
    table = spark.read.parquet(f"{sf_dir}/orders.parquet")
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    narrow = table.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return narrow.repartition(max(1, ceil(size / SOURCE_BYTES)), "o_orderkey")


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "loans", loans_sql("{orders}"))


def clean_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "clean", clean_sql("{orders}"))


def layer2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "layer2", layer2_sql("{orders}"))


# Files of one folder with different headers. Of the rows, one in 40 lacks its last cell
# and another one in 40 has a cell too many.
MIXED_COLUMNS = ["customer_id", "full_name", "zip_code", "loan_amnt", "purpose"]
MIXED_LAYOUTS = [MIXED_COLUMNS, MIXED_COLUMNS[::-1], ["zip_code", "customer_id", "branch", "full_name", "loan_amnt"]]
MIXED_FAULT = "case k % 40 when 7 then 'short' when 9 then 'surplus' end"


def _cell(column: str) -> str:
    x = "'main'" if column == "branch" else column
    return f"""case when instr({x}, ',') > 0 or instr({x}, '"') > 0 then concat('"', replace({x}, '"', '""'), '"') else {x} end"""


def mixed_sql(loans: str = "loans") -> str:
    """(layout, fault, record, columns): every row as the line of a CSV file."""
    lines = []
    for names in MIXED_LAYOUTS:
        cells = [_cell(c) for c in names]
        lines.append(f"case {MIXED_FAULT} when 'short' then concat({", ',', ".join(cells[:-1])}) when 'surplus' then concat({", ',', ".join(cells)}, ',spare') else concat({", ',', ".join(cells)}) end")
    record = " ".join(f"when {i} then {line}" for i, line in enumerate(lines))
    return f"select k % {len(lines)} as layout, {MIXED_FAULT} as fault, case k % {len(lines)} {record} end as record, {', '.join(MIXED_COLUMNS)} from {loans}"


def mixed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The folder of CSV files with different headers, written anew."""
    path = staging_path(spark, "mixed-csv")
    rows = spark.sql(mixed_sql("{loans}"), loans=raw_loans(spark, sf_dir))
    for i, names in enumerate(MIXED_LAYOUTS):

        def with_header(batches: Iterator[pd.DataFrame], header: str = ",".join(names)) -> Iterator[pd.DataFrame]:
            yield pd.DataFrame({"value": [header]})
            yield from batches

        lines = rows.where(f"layout = {i}").select(rows["record"].alias("value"))
        lines.mapInPandas(with_header, "value string").write.text(f"{path}/layout={i}")
    return path


# One block that grows with the data: a share of all rows are different people of one
# name and zip code.
_HASH = f"md5({_text('k')})"
CROWDED = {
    "full_name": f"concat(substr({_HASH}, 1, 7), ' Smith')",
    "email": f"concat(substr({_HASH}, 8, 8), '@', substr({_HASH}, 16, 4), '.org')",
    "street_address": f"concat({_text('1 + k % 97')}, ' ', substr({_HASH}, 20, 9))",
    "zip_code": "'00000'",
}


def crowded_sql(loans: str = "loans", one_in: int = 40) -> str:
    """The linkage columns of the loans, of which one in ``one_in`` live in one block."""
    crowd = f"(k % {one_in} = 1)"
    cells = [f"case when {crowd} then {v} else {c} end as {c}" for c, v in CROWDED.items()]
    return f"select customer_id, row_pos, phone, {', '.join(cells)} from {loans}"


def crowded_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(crowded_sql("{loans}"), loans=raw_loans(spark, sf_dir))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True dates of the original customers."""
    loans = raw_loans(spark, sf_dir)
    return loans.where("customer_id like 'LC%'").selectExpr(
        "customer_id", "cast(true_app as string) as application_date", "cast(true_iss as string) as issue_date"
    )


def pair_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Injected copies and their originals."""
    loans = raw_loans(spark, sf_dir)
    return loans.where("customer_id like 'DUP%'").selectExpr(
        "customer_id as duplicate_id", "concat('LC', cast(100000 + k as string)) as original_id"
    )

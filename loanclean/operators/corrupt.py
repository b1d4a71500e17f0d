"""Controlled dirt for clean loan tables, with a log of every change.

An injector is a list of changes: a cell's new value as an expression on the old one,
and which rows it meets. Any number of changes, in their order, becomes one projection
that also notes them in an array column ``dirt`` of the same row. The log of all
injectors is read from that column in one pass. Rows are chosen by a draw per row (each
row has the given chance). With ``exact_in``, a table of the same ids, exactly
``int(rows * share)`` rows are taken instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanclean.functions import draws
from loanclean.functions.text import NOT_A_DIGIT
from loanclean.operators.positions import index_by_digest, mark_exact_share
from loanclean.values import (
    COMMA_SKIPS,
    HOME_VARIANTS,
    MESSY_DATE_FORMATS,
    MISSING_PLAN,
    NOTE_TYPOS,
    PHONE_LAYOUTS,
    PHONE_SKIPS,
    PURPOSE_VARIANTS,
)

KEY = "customer_id"
DIRT = "dirt"

def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, with an empty ``dirt`` column."""
    cells = [F.col(c).cast("string").alias(c) for c in df.columns if c != DIRT]
    return df.select(*cells, F.array().cast("array<struct<column:string,dirt_type:string>>").alias(DIRT))


def _dig(seed: int, name: str) -> Column:
    return draws.digest(seed, name, F.col(KEY))


@dataclass(frozen=True)
class Change:
    """New values for a share of the rows. ``new`` and ``only`` are given the cell as the changes before left it."""

    column: str
    name: str
    share: float
    dirt_type: str
    new: Callable[[Column], Column]
    only: Callable[[Column], Column] | None = None


def _choose(df: DataFrame, name: str, share: float, seed: int, exact_in: DataFrame | None, mark: str = "_hit") -> DataFrame:
    """Add ``mark``: the rows that this change meets."""
    dig = _dig(seed, f"{name}/rows")
    if exact_in is None:
        return df.withColumn(mark, draws.uniform(dig, 0) < share)
    ids = exact_in.select(dig.alias("_dig"))
    return mark_exact_share(df.withColumn("_dig", dig), "_dig", share, mark, among=ids).drop("_dig")


def apply_changes(df: DataFrame, changes: list[Change], seed: int = 7, exact_in: DataFrame | None = None) -> DataFrame:
    """All changes, in their order, as one projection; draws decide the rows, or numbers of rows among ``exact_in``."""
    marks = {i: draws.uniform(_dig(seed, f"{c.name}/rows"), 0) < c.share for i, c in enumerate(changes)}
    names = df.columns
    if exact_in is not None:
        for i, c in enumerate(changes):
            df = _choose(df, c.name, c.share, seed, exact_in, f"_hit{i}")
            marks[i] = F.col(f"_hit{i}")
    cells, entries = {c: F.col(c) for c in names}, []
    for i, c in enumerate(changes):
        cell = cells[c.column]
        hit = marks[i] if c.only is None else marks[i] & F.coalesce(c.only(cell), F.lit(False))
        cells[c.column] = F.when(hit, c.new(cell)).otherwise(cell)
        entries.append(F.when(hit, F.struct(F.lit(c.column).alias("column"), F.lit(c.dirt_type).alias("dirt_type"))))
    cells[DIRT] = F.concat(F.col(DIRT), F.array_compact(F.array(*entries)))
    return df.select(*[cells[c].alias(c) for c in names])


def missing(col: str, share: float, markers: list[str], seed: int) -> list[Change]:
    name = f"missing/{col}"
    return [Change(col, name, share, "missing_marker", lambda _: draws.pick(markers, _dig(seed, name), 0))]


def date_format(col: str, share: float, formats: list[str], seed: int) -> list[Change]:
    name = f"date_format/{col}"

    def new(cell: Column) -> Column:
        which, day = draws.number(_dig(seed, name), 0) % len(formats), F.to_date(cell)
        return F.coalesce(*[F.when(which == i, F.date_format(day, fmt)) for i, fmt in enumerate(formats)])

    return [Change(col, name, share, "date_format", new)]


def decimal_comma(col: str, share: float) -> list[Change]:
    return [Change(col, f"comma/{col}", share, "decimal_comma", lambda cell: F.translate(cell, ".", ","), lambda cell: ~cell.isin(COMMA_SKIPS))]


def variants(col: str, spellings: dict[str, list[str]], share: float, seed: int) -> list[Change]:
    name = f"variant/{col}"

    def new(cell: Column) -> Column:
        dig = _dig(seed, name)
        return F.coalesce(*[F.when(cell == value, draws.pick(others, dig, 0)) for value, others in spellings.items()])

    return [Change(col, name, share, "category_variant", new, lambda cell: cell.isin(list(spellings)))]


def grade_variants(col: str, share: float, seed: int) -> list[Change]:
    def new(g: Column) -> Column:
        which = draws.number(_dig(seed, "variant/grade"), 0) % 4
        return (
            F.when(which == 0, F.lower(g)).when(which == 1, F.concat(F.lit(" "), g))
            .when(which == 2, F.concat(g, F.lit(" "))).otherwise(F.concat(F.lit("grade "), g))
        )

    return [Change(col, "variant/grade", share, "category_variant", new)]


def text_noise(col: str, share: float, typos: list[tuple[str, str]], seed: int) -> list[Change]:
    def new(text: Column) -> Column:
        for i, (right, wrong) in enumerate(typos):
            u = draws.uniform(_dig(seed, f"noise/typo{i // 4}"), i % 4)
            text = F.replace(text, F.lit(right), F.when(u < 0.5, F.lit(wrong)).otherwise(F.lit(right)))
        style = _dig(seed, "noise/style")
        capital, padded = draws.uniform(style, 0) < 0.3, draws.uniform(style, 1) < 0.3
        return F.when(capital, F.upper(text)).when(padded, F.concat(F.lit("  "), text, F.lit("   "))).otherwise(text)

    return [Change(col, "noise", share, "text_noise", new)]


def outliers(share: float, seed: int) -> list[Change]:
    amount = lambda _: F.concat(F.lit("-"), draws.between(1000, 40000, _dig(seed, "outlier/loan_amnt"), 0).cast("string"))
    ratio = lambda _: draws.between(150, 999, _dig(seed, "outlier/dti"), 0).cast("string")
    plan = [("loan_amnt", amount, "outlier_negative"), ("fico_score", lambda _: F.lit("9999"), "outlier_impossible"), ("dti", ratio, "outlier_impossible")]
    return [Change(col, f"outlier/{col}", share, kind, new) for col, new, kind in plan]


def phone_layouts(col: str, share: float, seed: int) -> list[Change]:
    def new(cell: Column) -> Column:
        digits = F.regexp_replace(cell, NOT_A_DIGIT, "")
        which = draws.number(_dig(seed, "phone"), 0) % len(PHONE_LAYOUTS)
        parts = [F.substring(digits, 1, 3), F.substring(digits, 4, 3), F.substring(digits, 7, 4)]
        made = [F.when(which == i, F.format_string(layout.replace("{}", "%s"), *parts)) for i, layout in enumerate(PHONE_LAYOUTS)]
        return F.when(F.length(digits) == 10, F.coalesce(*made)).otherwise(cell)

    return [Change(col, "phone", share, "phone_format", new, lambda cell: ~cell.isin(PHONE_SKIPS))]


def inject_missing(df: DataFrame, col: str, share: float, markers: list[str], seed: int = 7, exact_in: DataFrame | None = None) -> DataFrame:
    return apply_changes(df, missing(col, share, markers, seed), seed, exact_in)


def inject_date_format(
    df: DataFrame, col: str, share: float = 0.5, formats: list[str] = MESSY_DATE_FORMATS, seed: int = 7, exact_in: DataFrame | None = None
) -> DataFrame:
    """Write ISO dates in one of several layouts."""
    return apply_changes(df, date_format(col, share, formats, seed), seed, exact_in)


def inject_decimal_comma(df: DataFrame, col: str, share: float = 0.08, seed: int = 7, exact_in: DataFrame | None = None) -> DataFrame:
    return apply_changes(df, decimal_comma(col, share), seed, exact_in)


def inject_variants(
    df: DataFrame, col: str, spellings: dict[str, list[str]], share: float, seed: int = 7, exact_in: DataFrame | None = None
) -> DataFrame:
    """Replace known values by one of their other spellings."""
    return apply_changes(df, variants(col, spellings, share, seed), seed, exact_in)


def inject_grade(df: DataFrame, col: str = "grade", share: float = 0.10, seed: int = 7, exact_in: DataFrame | None = None) -> DataFrame:
    return apply_changes(df, grade_variants(col, share, seed), seed, exact_in)


def inject_text_noise(
    df: DataFrame, col: str = "advisor_notes", share: float = 0.20, typos: list[tuple[str, str]] = NOTE_TYPOS, seed: int = 7, exact_in: DataFrame | None = None
) -> DataFrame:
    """Misspell words, write in capitals or pad with blanks."""
    return apply_changes(df, text_noise(col, share, typos, seed), seed, exact_in)


def inject_outliers(df: DataFrame, share: float = 0.01, seed: int = 7, exact_in: DataFrame | None = None) -> DataFrame:
    """Impossible loan amounts, scores and debt ratios."""
    return apply_changes(df, outliers(share, seed), seed, exact_in)


def inject_phone(df: DataFrame, col: str = "phone", share: float = 0.30, seed: int = 7, exact_in: DataFrame | None = None) -> DataFrame:
    """Other layouts for ten-digit phone numbers."""
    return apply_changes(df, phone_layouts(col, share, seed), seed, exact_in)


def dirt_log(df: DataFrame) -> DataFrame:
    """One row per change: customer_id, column, dirt_type.

    The outer form keeps Spark from testing the array for rows below the
    injectors, which would evaluate all of them twice.
    """
    return df.select(KEY, F.inline_outer(DIRT)).where(F.col("dirt_type").isNotNull())


def inject_duplicates(
    df: DataFrame, share: float = 0.015, seed: int = 7, exact_in: DataFrame | None = None, position: str = "row_pos"
) -> tuple[DataFrame, DataFrame]:
    """Add changed copies of some rows, shuffle, and return the table and the truth.

    The shuffle is a dense number in the order of a digest of the id, kept in
    ``position``; Spark tables have no row order of their own.
    """
    chosen = _choose(df, "duplicate", share, seed, exact_in).where("_hit").drop("_hit")
    numbered = index_by_digest(chosen.withColumn("_dig", _dig(seed, "duplicate/rows")), "_dig", "_i").drop("_dig")
    change = _dig(seed, "duplicate")
    copies = numbered.withColumns(
        {
            "full_name": F.when(draws.uniform(change, 0) < 0.5, F.upper("full_name")).otherwise(F.col("full_name")),
            "email": F.when(draws.uniform(change, 1) < 0.3, F.replace("email", F.lit("@"), F.lit("+dup@"))).otherwise(F.col("email")),
            "original_id": F.col(KEY),
            KEY: F.concat(F.lit("DUP"), (F.col("_i") + 1000).cast("string")),
        }
    )
    truth = copies.select(F.col(KEY).alias("duplicate_id"), "original_id")
    table = df.unionByName(copies.select(*df.columns)).withColumn("_dig", _dig(seed, "shuffle"))
    return index_by_digest(table, "_dig", position).drop("_dig"), truth


def make_dirty(df: DataFrame, seed: int = 7, exact: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All injectors in order, in one projection. Returns the dirty text table, the duplicate truth and the log."""
    exact_in = df.select(KEY) if exact else None
    changes = [c for col, share, markers in MISSING_PLAN for c in missing(col, share, markers, seed)]
    for col in ("application_date", "issue_date"):
        changes += date_format(col, 0.5, MESSY_DATE_FORMATS, seed)
    for col in ("loan_amnt", "int_rate", "dti", "annual_inc"):
        changes += decimal_comma(col, 0.08)
    changes += variants("home_ownership", HOME_VARIANTS, 0.15, seed) + grade_variants("grade", 0.10, seed) + variants("purpose", PURPOSE_VARIANTS, 0.10, seed)
    changes += text_noise("advisor_notes", 0.20, NOTE_TYPOS, seed) + outliers(0.01, seed) + phone_layouts("phone", 0.30, seed)
    out = apply_changes(as_text(df), changes, seed, exact_in)
    log = dirt_log(out)
    table, truth = inject_duplicates(out.drop(DIRT), seed=seed, exact_in=exact_in)
    return table, truth, log

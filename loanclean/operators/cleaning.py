"""Cleaning operators of the first layer. All are row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loanclean.functions.numbers import number_text, parse_number, within
from loanclean.functions.similarity import best_choice, characters
from loanclean.functions.text import digits, note_words, null_if_in, phone_layout, repair_note, squeeze, strip
from loanclean.values import (
    CANONICAL_PURPOSES,
    HOME_OWNERSHIP_RECODE,
    MISSING_MARKERS,
    NOTE_TYPOS,
    NUMERIC_COLUMNS,
    PROFILED_COLUMNS,
    PURPOSE_MIN_SCORE,
    RANGE_RULES,
)


def null_markers(df: DataFrame, markers: list[str] = MISSING_MARKERS) -> DataFrame:
    """Null every text cell that equals a missing-value marker as a whole."""
    text = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: null_if_in(F.col(c), markers) for c in text})


def coerce_numbers(df: DataFrame, columns: list[str] = NUMERIC_COLUMNS, plain: tuple[str, ...] = ("fico_score",)) -> DataFrame:
    """Text to double; ``columns`` also get their decimal comma repaired."""
    texts = {c: number_text(F.col(c)) for c in columns if c in df.columns}
    texts |= {c: number_text(F.col(c), decimal_comma=False) for c in plain if c in df.columns}
    return df.withColumns(texts).withColumns({c: parse_number(F.col(c)) for c in texts})


def apply_range_rules(df: DataFrame, rules: list[tuple] = RANGE_RULES) -> DataFrame:
    """Null the numbers that cannot be true."""
    return df.withColumns({c: within(F.col(c), lo, hi) for c, lo, hi in rules if c in df.columns})


def recode_category(df: DataFrame, col: str, recode: dict[str, str] = HOME_OWNERSHIP_RECODE) -> DataFrame:
    """Strip, upper-case and replace the listed spellings."""
    return df.withColumn(col, F.upper(strip(F.col(col)))).replace(recode, subset=[col])


def extract_letter(df: DataFrame, col: str, mode: str = "token") -> DataFrame:
    """Risk letter A-G of a text.

    ``token`` wants the letter as a word of its own, so ``grade B`` gives B.
    ``first`` takes the first such letter anywhere, so ``grade B`` gives the G
    of the upper-cased word.
    """
    pattern = {"token": r"\b[A-G]\b", "first": "[A-G]"}[mode]
    return df.withColumn(col, F.regexp_substr(F.upper(strip(F.col(col))), F.lit(pattern)))


def match_category(
    df: DataFrame,
    col: str,
    choices: list[str] = CANONICAL_PURPOSES,
    min_score: float = PURPOSE_MIN_SCORE,
    keep_as: str | None = None,
) -> DataFrame:
    """Replace a text by the most similar choice, null below the minimum score.

    Matching is an expression on the row: the column may have one value in a
    third of all rows, or a billion different ones, without any shuffle. Texts
    that already are a choice are not scored.
    """
    df = df.withColumn(keep_as, F.col(col)) if keep_as else df
    text = F.lower(strip(F.col(col)))
    df = df.withColumn(col, F.replace(F.replace(text, F.lit(" "), F.lit("_")), F.lit("-"), F.lit("_")))
    exact = F.col(col).isin(choices)
    df = df.withColumn("_chars", F.when(~exact, characters(F.col(col))))
    # a filter on the result stays above the one-row array, so nothing is scored twice
    best = F.array(best_choice(F.col(col), F.col("_chars"), choices, min_score))
    df = df.select("*", F.inline_outer(best).alias("_score", "_order", "_choice"))
    fuzzy = F.when(F.col("_score") >= min_score, F.col("_choice"))
    return df.withColumn(col, F.when(exact, F.col(col)).otherwise(fuzzy)).drop("_chars", "_score", "_order", "_choice")


def normalize_phone(df: DataFrame, col: str = "phone") -> DataFrame:
    return df.withColumn(col, digits(F.col(col))).withColumn(col, phone_layout(F.col(col)))


def repair_notes(
    df: DataFrame, col: str = "advisor_notes", typos: list[tuple[str, str]] = NOTE_TYPOS, vocabulary: list[str] | None = None
) -> DataFrame:
    """Put notes right with rules; with a vocabulary, mark those that still hold unknown words."""
    df = df.withColumn(col, squeeze(F.col(col))).withColumn(col, repair_note(F.col(col), typos))
    if vocabulary is None:
        return df
    known = F.array(*[F.lit(w) for w in sorted(set(vocabulary))])
    return df.withColumn("needs_review", F.coalesce(F.size(F.array_except(note_words(F.col(col)), known)) > 0, F.lit(False)))


def clean_layer1(df: DataFrame, grade: str = "token") -> DataFrame:
    """The whole first layer: projections only, no shuffle. Adds ``purpose_original``."""
    df = apply_range_rules(coerce_numbers(null_markers(df)))
    df = recode_category(df, "home_ownership")
    df = extract_letter(df, "grade", grade)
    df = match_category(df, "purpose", keep_as="purpose_original")
    return normalize_phone(df)


# ------------------------------------------------------------------ profiling


def null_delta(df: DataFrame, stages: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Nulls before and after a rule, per column, in one pass over the table."""
    cells = []
    for name, (before, after) in stages.items():
        cells += [F.count_if(before.isNull()).alias(f"{name}|b"), F.count_if(after.isNull()).alias(f"{name}|a")]
    wide = df.agg(*cells)
    rows = F.array(
        *[F.struct(F.lit(n).alias("column"), F.col(f"{n}|b").alias("before"), F.col(f"{n}|a").alias("after")) for n in stages]
    )
    return wide.select(F.inline(rows)).withColumn("added", F.col("after") - F.col("before"))


def unmapped_values(df: DataFrame, cleaned: str, original: str) -> DataFrame:
    """Original values that the matching turned into null, with their counts."""
    lost = df.where(F.col(cleaned).isNull() & F.col(original).isNotNull())
    return lost.groupBy(F.col(original).alias("value")).agg(F.count("*").alias("n"))


def category_profile(df: DataFrame, position: str, columns: list[str] = PROFILED_COLUMNS, top: int = 15) -> DataFrame:
    """The first distinct values of each column in row order, with their counts.

    The columns are turned into rows after a map-side count, and Spark keeps
    only ``top`` rows per task before the final ranking.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    seen = (
        df.select(F.col(position).alias("_pos"), F.inline(cells))
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"), F.min("_pos").alias("first_pos"))
    )
    rank = F.row_number().over(W.partitionBy("column").orderBy("first_pos"))
    return seen.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top).drop("first_pos")

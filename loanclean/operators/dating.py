"""Date pairs: all readings, the gap rule, and what to do with the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanclean.functions.dates import candidates, fitting_pairs, iso_date
from loanclean.functions.text import strip
from loanclean.values import DATE_FORMATS, MAX_GAP_DAYS, MIN_GAP_DAYS


def candidate_dates(df: DataFrame, col: str, formats: list[str] = DATE_FORMATS, out: str | None = None) -> DataFrame:
    """Array of the distinct dates that a text can mean."""
    found = df.withColumn("_text", strip(F.col(col))).withColumn("_found", candidates(F.col("_text"), formats))
    return found.withColumn(out or f"{col}_candidates", F.col("_found")).drop("_text", "_found")


def date_pairs(
    df: DataFrame,
    first: str = "application_date",
    second: str = "issue_date",
    min_gap: int = MIN_GAP_DAYS,
    max_gap: int = MAX_GAP_DAYS,
    out: str = "date_pairs",
) -> DataFrame:
    """Array of the readings of both dates whose gap is in the range."""
    texts = df.withColumns({"_first": strip(F.col(first)), "_second": strip(F.col(second))})
    both = texts.withColumns({"_first": candidates(F.col("_first")), "_second": candidates(F.col("_second"))})
    return both.withColumn(out, fitting_pairs(F.col("_first"), F.col("_second"), min_gap, max_gap)).drop("_first", "_second")


def resolve_date_pairs(
    df: DataFrame,
    key: str = "customer_id",
    first: str = "application_date",
    second: str = "issue_date",
    min_gap: int = MIN_GAP_DAYS,
    max_gap: int = MAX_GAP_DAYS,
    policy: str = "unique",
) -> DataFrame:
    """One row per record with the resolved dates as ISO text.

    ``unique`` accepts a record only if exactly one pair fits. ``min_gap``
    takes the pair with the smallest gap, the earlier first date on a tie.
    """
    pairs = F.col("date_pairs")
    if policy == "unique":
        best = F.when(F.size(pairs) == 1, F.try_element_at(pairs, F.lit(1)))
    elif policy == "min_gap":
        best = F.array_min(pairs)
    else:
        raise ValueError(f"unknown policy {policy!r}")
    found = date_pairs(df.select(key, first, second), first, second, min_gap, max_gap).withColumn("_best", best)
    solved = F.struct(
        F.date_format(F.col("_best.first"), "yyyy-MM-dd").alias(f"solved_{first}"),
        F.date_format(F.col("_best.second"), "yyyy-MM-dd").alias(f"solved_{second}"),
        F.col("_best").isNull().alias("is_ambiguous"),
    )
    # A filter on the result stays above the one-row array, so the search runs
    # once per record and not again inside the filter.
    return found.select(key, F.inline_outer(F.array(solved)))


def rule_dates(df: DataFrame, first: str = "application_date", second: str = "issue_date") -> DataFrame:
    """Both dates as ISO text where one reading fits, else null; ``dates_open`` marks the others. Row-local."""
    best = F.when(F.size("date_pairs") == 1, F.try_element_at("date_pairs", F.lit(1)))
    found = date_pairs(df, first, second).withColumn("_best", best)
    solved = F.struct(
        F.date_format("_best.first", "yyyy-MM-dd").alias("_date1"),
        F.date_format("_best.second", "yyyy-MM-dd").alias("_date2"),
        F.col("_best").isNull().alias("dates_open"),
    )
    # the one-row array keeps later uses of the dates from repeating the search
    rows = found.select(*df.columns, F.inline_outer(F.array(solved)))
    return rows.withColumns({first: F.col("_date1"), second: F.col("_date2")}).drop("_date1", "_date2")


def overlay_dates(
    layer2: DataFrame, solved: DataFrame, key: str = "customer_id", first: str = "application_date", second: str = "issue_date"
) -> DataFrame:
    """Take the resolved dates where there is no doubt, keep the others as they are."""
    order = layer2.columns
    sure = F.coalesce(~F.col("is_ambiguous"), F.lit(False))
    merged = layer2.join(solved, key, "left")
    for col in (first, second):
        merged = merged.withColumn(col, F.when(sure, F.col(f"solved_{col}")).otherwise(F.col(col)))
    return merged.select(*order)


def gap_days(first: Column, second: Column) -> Column:
    return F.datediff(iso_date(second), iso_date(first))


def date_rule_check(
    df: DataFrame,
    first: str = "application_date",
    second: str = "issue_date",
    min_gap: int = MIN_GAP_DAYS,
    max_gap: int = MAX_GAP_DAYS,
    strict: bool = False,
) -> DataFrame:
    """Rows that break the gap rule. ``strict`` also returns rows with an unreadable date."""
    gap = gap_days(F.col(first), F.col(second))
    bad = ~gap.between(min_gap, max_gap)
    marked = df.withColumn("gap_days", gap)
    return marked.where(F.coalesce(bad, F.lit(strict)))


def solver_outcomes(df: DataFrame, first: str = "application_date", second: str = "issue_date") -> DataFrame:
    """How many records have exactly one, no, or several fitting pairs."""
    n = F.least(F.size("date_pairs"), F.lit(2))
    label = F.when(n == 1, "one").when(n == 0, "none").otherwise("several")
    return date_pairs(df.select(first, second), first, second).groupBy(label.alias("outcome")).agg(F.count("*").alias("n"))

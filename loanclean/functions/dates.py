"""Date expressions: every possible reading of a text, and pairs that fit a rule."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanclean.functions.text import squeeze, strip
from loanclean.values import DATE_FORMATS, WHITESPACE

_MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
]

# strptime directive -> (what it accepts, Spark datetime pattern letters)
_DIRECTIVES = {
    "%Y": (r"(?!0000)[0-9]{4}", "yyyy"),
    "%m": (r"(?:1[0-2]|0?[1-9])", "M"),
    "%d": (r"(?:3[01]|[12][0-9]|0?[1-9]| [1-9])", "d"),
    "%b": ("(?:" + "|".join(m[:3] for m in _MONTHS) + ")", "MMM"),
    "%B": ("(?:" + "|".join(_MONTHS) + ")", "MMMM"),
}


def _compile(fmt: str) -> tuple[str, str]:
    """Regular expression and Spark pattern for one strptime format."""
    regex, pattern = "", ""
    for part in re.findall(r"%.|[^%]", fmt):
        if part in _DIRECTIVES:
            accepts, letters = _DIRECTIVES[part]
            regex, pattern = regex + accepts, pattern + letters
        elif part.startswith("%"):
            raise ValueError(f"unsupported date directive {part} in {fmt!r}")
        else:
            regex += f"[{WHITESPACE}]+" if part == " " else re.escape(part)
            pattern += part
    return f"(?i)^{regex}$", pattern


def _may_match(col: Column, fmt: str) -> Column:
    """Cheap look for the separator of a format, or for letters where it has a month name."""
    if "%b" in fmt or "%B" in fmt:
        return col.rlike("[A-Za-z]")
    literal = re.sub(r"%.", "", fmt).strip()[:1]
    return col.contains(literal) if literal else F.lit(True)


def read_date(col: Column, fmt: str) -> Column:
    """Date read with one strptime format, or null.

    The regular expression keeps texts of another shape away from the parser,
    which would otherwise build and swallow an exception for each of them.
    """
    regex, pattern = _compile(fmt)
    text = squeeze(col) if " " in fmt else F.replace(col, F.lit(" "), F.lit(""))
    return F.when(_may_match(col, fmt) & col.rlike(regex), F.try_to_date(text, pattern))


def candidates(text: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """Distinct dates that a stripped text can mean; an empty array when there is none."""
    return F.array_distinct(F.array_compact(F.array(*[read_date(text, f) for f in formats])))


def fitting_pairs(first: Column, second: Column, min_gap: int, max_gap: int) -> Column:
    """All (gap, first, second) of two candidate arrays with a gap in the range."""
    pairs = F.flatten(
        F.transform(
            first,
            lambda a: F.transform(
                second,
                lambda b: F.struct(F.datediff(b, a).alias("gap"), a.alias("first"), b.alias("second")),
            ),
        )
    )
    return F.filter(pairs, lambda p: p["gap"].between(min_gap, max_gap))


def iso_date(col: Column) -> Column:
    """Lenient read of an ISO date text; null when it is not one."""
    return read_date(strip(col.cast("string")), "%Y-%m-%d")


def is_day_month_swap(got: Column, truth: Column) -> Column:
    """Same year, day and month exchanged, and the two are different numbers."""
    swap = (
        (F.year(got) == F.year(truth))
        & (F.month(got) == F.dayofmonth(truth))
        & (F.dayofmonth(got) == F.month(truth))
        & (F.month(got) != F.dayofmonth(got))
    )
    return F.coalesce(swap, F.lit(False))

"""Repeatable random draws.

A draw depends only on the seed, the name of the draw and the row key, so it
is the same for any partitioning, any order and any re-run of a lost task.
One digest gives four independent 32-bit numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = float(2**32)


def digest(seed: int, name: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{name}:"), key.cast("string")))


def number(dig: Column, part: int) -> Column:
    """One of the four 32-bit numbers (``part`` 0..3) in a digest."""
    return F.conv(F.substring(dig, 1 + 8 * part, 8), 16, 10).cast("bigint")


def uniform(dig: Column, part: int) -> Column:
    """A double in [0, 1)."""
    return number(dig, part) / F.lit(_SCALE)


def normal(dig: Column, part: int = 0) -> Column:
    """A standard normal value from two uniforms (Box-Muller)."""
    u = (number(dig, part) + 1) / F.lit(_SCALE)
    v = uniform(dig, part + 1)
    return F.sqrt(-2 * F.ln(u)) * F.cos(2 * math.pi * v)


def pick(values: list, dig: Column, part: int) -> Column:
    """One of the values, all equally likely."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number(dig, part) % len(values) + 1).cast("int"))


def pick_weighted(values: list, weights: list[float], dig: Column, part: int) -> Column:
    """One of the values with the given probabilities."""
    u, total, out = uniform(dig, part), 0.0, None
    for value, weight in list(zip(values, weights))[:-1]:
        total = round(total + weight, 10)
        out = F.when(u < total, value) if out is None else out.when(u < total, value)
    return F.lit(values[-1]) if out is None else out.otherwise(values[-1])


def between(low: int, high: int, dig: Column, part: int) -> Column:
    """An integer in ``low..high-1``."""
    return F.lit(low) + number(dig, part) % (high - low)

"""Merging: overlays, updates by key and the final table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanclean.values import ESCALATED_COLUMNS


def one_per_key(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """The table as it is, or an error, once it is read, that names a key of several rows."""
    fault = F.raise_error(F.concat(F.lit(f"{key} has several rows: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    counted = df.withColumn("_rows", F.count("*").over(Window.partitionBy(key)))
    return counted.where(F.when(F.col("_rows") > 1, fault.cast("boolean")).otherwise(True)).select(df.columns)


def keyed_update(df: DataFrame, new: DataFrame, key: str = "customer_id") -> DataFrame:
    """Overwrite cells by key; a null in ``new`` leaves the old cell. ``new`` must have one row per key."""
    new = one_per_key(new, key)
    fresh = [c for c in new.columns if c != key and c in df.columns]
    renamed = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in fresh])
    merged = df.join(renamed, key, "left")
    return merged.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in fresh else F.col(c) for c in df.columns])


def replace_rows(df: DataFrame, new: DataFrame, key: str = "customer_id") -> DataFrame:
    """Drop the rows whose key was done again and append the new rows, which must be whole and one per key."""
    missing = set(df.columns) - set(new.columns)
    if missing:
        raise ValueError(f"the new rows lack {sorted(missing)}")
    return df.join(new.select(key).distinct(), key, "left_anti").unionByName(one_per_key(new.select(df.columns), key))


def final_merge(layer1: DataFrame, layer2: DataFrame, flags: DataFrame, key: str = "customer_id") -> DataFrame:
    """First layer, resolved columns of the second layer, and the duplicate flags.

    ``flags`` has one row (id, duplicate_of) per flagged record.
    """
    kept = layer1.drop(*ESCALATED_COLUMNS)
    return flag_rows(kept.join(layer2.select(key, *ESCALATED_COLUMNS), key, "left"), flags, key)


def flag_rows(df: DataFrame, flags: DataFrame, key: str = "customer_id") -> DataFrame:
    """The rows with their duplicate flags; the columns of the second layer stand before the flags."""
    marks = flags.select(F.col("id").alias(key), "duplicate_of")
    kept = [c for c in df.columns if c not in ESCALATED_COLUMNS]
    flag = F.col("duplicate_of").isNotNull().alias("is_duplicate")
    return df.join(marks, key, "left").select(*kept, *ESCALATED_COLUMNS, flag, "duplicate_of")


def overlay_rows(rules: DataFrame, given: DataFrame, keep_rules: bool, key: str = "customer_id") -> DataFrame:
    """The columns of the second layer from ``given``, by key, put right by rows with ``dates_open``.

    Dates that rules are sure of stay. A row that ``given`` lacks keeps what the
    rules gave it, or is null in these columns without ``keep_rules``. ``given``
    must have one row per key.
    """
    given = one_per_key(given.select(key, *ESCALATED_COLUMNS), key)
    names = {c: f"_given_{c}" for c in ESCALATED_COLUMNS}
    found = given.select(key, *ESCALATED_COLUMNS, F.lit(True).alias("_there")).withColumnsRenamed(names)
    there = F.col("_there").isNotNull()
    out = {}
    for c, g in names.items():
        sure = F.lit(False) if c == "advisor_notes" else ~F.col("dates_open")
        other = F.col(c) if keep_rules else F.lit(None)
        out[c] = F.when(there, F.when(sure, F.col(c)).otherwise(F.col(g))).otherwise(other)
    return rules.join(found, key, "left").select(*[out[c].alias(c) if c in out else F.col(c) for c in rules.columns])


def join_with_truth(
    df: DataFrame, truth: DataFrame, key: str = "customer_id", suffixes: tuple[str, str] = ("_got", "_truth")
) -> DataFrame:
    """Inner join on the key; columns that both tables have get a suffix."""
    both = [c for c in df.columns if c in truth.columns and c != key]
    left = df.select(*[F.col(c).alias(c + suffixes[0]) if c in both else F.col(c) for c in df.columns])
    right = truth.select(*[F.col(c).alias(c + suffixes[1]) if c in both else F.col(c) for c in truth.columns])
    return left.join(right, key)

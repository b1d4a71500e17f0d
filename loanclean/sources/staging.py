"""Staged tables: results written once and read by several later jobs.

A staged table survives the loss of executors, which cached blocks do not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SETTING = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    shared = spark.conf.get(_SETTING, None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="loanclean-")
    return _local[app]


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write the table as Parquet into the shared folder and return its scan.

    A given ``path`` must be new: an earlier result there is never replaced.
    """
    spark = df.sparkSession
    path = path or staging_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str, metrics: dict[str, Column], path: str | None = None) -> tuple[DataFrame, dict]:
    """Stage the table; its metrics are observed while it is written, without a job of their own."""
    seen = Observation(name)
    out = stage(df.observe(seen, *[m.alias(n) for n, m in metrics.items()]), name, path)
    return out, seen.get

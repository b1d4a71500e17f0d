"""Session settings that the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings. The wide projections of the cleaning step would otherwise
# become one generated method that the JVM refuses to compile; above the limit
# Spark generates one small method per expression group instead.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session of the caller."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark

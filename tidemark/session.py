"""Session defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TIMEZONE = "America/Santiago"


def session(app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and Arrow on; ``conf`` adds settings (dots as double underscores)."""
    b = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": TIMEZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for k, v in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores where a table has fewer partitions than that, as one small file has; larger tables stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

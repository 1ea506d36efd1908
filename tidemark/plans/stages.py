"""Stage results kept by what they depend on, and the report that mining ends in."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import mining


def fingerprint(*parts: object) -> str:
    """A hash of values and of the source of functions; dictionaries count by content, not by order."""
    texts = [inspect.getsource(p) if callable(p) else json.dumps(p, sort_keys=True, default=str) for p in parts]
    return hashlib.sha256("\0".join(texts).encode()).hexdigest()


def input_fingerprint(df: DataFrame) -> str:
    """A hash of a table's rows, whatever their order: sums of two hashes and the count, pre-aggregated."""
    row = F.struct(*sorted(df.columns))
    s = df.agg(F.count("*"), *(F.sum(F.xxhash64(F.to_json(row), F.lit(k)).cast("decimal(38,0)")) for k in (0, 1))).first()
    return fingerprint([str(x) for x in s], sorted(df.dtypes))


def kept(spark: SparkSession, folder: str, stage: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage's table under its key, built and written where it isn't there yet.

    The table counts as there once Spark's success marker is, so an interrupted write is
    built again. ``folder`` must be one that all executors share.
    """
    path = f"{folder}/{stage}/{key}"
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def samples(df: DataFrame, section: str, position: str, columns: list[str], most: int = 20) -> DataFrame:
    """The first rows of each section in corpus order."""
    from pyspark.sql.window import Window

    n = F.row_number().over(Window.partitionBy(section).orderBy(position))
    return df.withColumn("_n", n).where(F.col("_n") <= most).select(section, position, *columns)


def mining_report(docs: DataFrame, key: str, text: str, section: str, top: int = 50, min_df: int = 5, stop: list[str] = []) -> dict:  # noqa: B006
    """Top n-grams and TF-IDF terms and first samples of every section, as one JSON-ready object of bounded size."""
    out: dict = {"metadata": {"documents": docs.count(), "sections": {}}}
    for name in [r[0] for r in docs.select(section).distinct().orderBy(section).collect()]:
        part = docs.where(F.col(section) == name)
        n = part.count()
        counts = mining.gram_counts(part, key, text, stop=stop)
        out["metadata"]["sections"][name] = n
        out[name] = {
            "ngrams_top": [r.asDict() for r in mining.ngram_table(counts, n, min_df, top=top).collect()],
            "tfidf_top": [r.asDict() for r in mining.tfidf_table(counts, key, n, min_df, top=top).collect()],
            "samples": [r.asDict() for r in samples(part, section, key, [text]).collect()],
        }
    return out

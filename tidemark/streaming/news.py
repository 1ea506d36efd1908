"""Incremental loads as Structured Streaming, and the state of scheduled runs.

State is bounded by the watermark: keys are remembered only as long as a late copy can come.
"""

from __future__ import annotations

import fcntl
import json
import os
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 50) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def deduplicated(stream: DataFrame, key: str, time: str, late: str = "2 days") -> DataFrame:
    """Each key once, as long as copies come within ``late``."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def daily_counts(stream: DataFrame, time: str, keys: list[str], value: str, late: str = "1 day") -> DataFrame:
    """Articles, and their values, of each day; a day is final once the watermark has passed it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").cast("date").alias("day"), *keys, "n", "total")


def rolling_counts(stream: DataFrame, time: str, days: int, late: str = "1 day") -> DataFrame:
    """Articles of the ``days`` days before each day, that day itself left out."""
    w = F.window(time, f"{days} days", "1 day")
    return stream.withWatermark(time, late).groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.col("w.end").cast("date").alias("day"), "n")


def available_now(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything there is, once; the checkpoint is the high-water mark."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()


def with_quarantine(stream: DataFrame, good: Column, path: str, rejected: str, checkpoint: str) -> StreamingQuery:
    """Rows that meet the condition to one table, the others to another. Batches carry their number, so a batch run again replaces itself."""
    flagged = stream.withColumn("_good", F.coalesce(good, F.lit(False)))

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for ok, to in ((True, path), (False, rejected)):
            batch.where(F.col("_good") == ok).drop("_good").write.mode("overwrite").parquet(f"{to}/batch={number}")
        batch.unpersist()

    return flagged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rebuild_changed(stream: DataFrame, key: str, fingerprint: str, build, path: str, checkpoint: str) -> StreamingQuery:
    """``build`` only for rows whose fingerprint isn't in the result yet."""
    from tidemark.sources.news import existing

    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        todo = batch
        if existing(spark, [f"{path}/batch=*/_SUCCESS"]):
            done = spark.read.parquet(path).where(F.col("batch") != number).select(key, fingerprint)
            todo = batch.join(done, [key, fingerprint], "left_anti")
        build(todo).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def days_to_load(last: str | None, today: date, initial: int = 3, most: int = 30) -> int:
    """Days to go back: a few at first, then what has passed (two at least). Too long a gap is an error and isn't cut short."""
    if not last:
        count = initial
    else:
        gap = (today - date.fromisoformat(last)).days
        if gap < 0:
            raise RuntimeError(f"the last successful day {last} lies in the future")
        count = max(2, gap)
    if count > most:
        raise RuntimeError(f"{count} days to load; more than {most} need a decision")
    return count


def load_state(path: str) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else {}


def save_success(path: str, source: str, day: date, now: str) -> None:
    """The new high-water mark of a source; call it only after success."""
    from tidemark.plans.reports import write_atomic

    write_atomic(path, load_state(path) | {source: {"last_successful_date": day.isoformat(), "last_run_at": now}})


def succeeded(summary: list[dict]) -> bool:
    return bool(summary) and all(s.get("status") != "error" for s in summary)


@contextmanager
def exclusive(path: str) -> Iterator[None]:
    """One run at a time; a second one is an error at once."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "a+") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            raise RuntimeError("another run holds the lock") from None
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)

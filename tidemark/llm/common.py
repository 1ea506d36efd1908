"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


HOT = 100_000  # rows of a key beyond which its name is broadcast; there is at most one such key for every HOT rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where neither that setting nor an
    earlier call has named one, a session of one machine gets a temporary folder; on a
    cluster that would be another folder for each executor, so it is an error there.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder of whatever file system it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is cut within goes at the end; results have to be stored by then."""
    home = shared_folder(spark)
    folder = f"{home}/cuts-{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(folder)
    try:
        yield
    finally:
        spark.sparkContext.setCheckpointDir(home)
        remove(spark, folder)


def parts(df: DataFrame) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_class(rows: DataFrame, named: DataFrame, key: str, size: str, elsewhere: Column) -> DataFrame:
    """``rows`` with what ``named`` says about their ``key``; null where it says nothing.

    ``named`` has one row for each key, and ``size``, its number of rows. Keys of more than
    ``HOT`` rows are broadcast, which the number of rows bounds; their rows (and those of a
    null key) are dealt out by ``elsewhere``, a value of the key's type, so that no task
    gets all rows of a frequent key. The plan is the same at every size.
    """
    said = F.struct(*(c for c in named.columns if c not in (key, size)))
    often = F.broadcast(named.where(F.col(size) > HOT).select(key, said.alias("_often")))
    rows = rows.join(often, key, "left")
    rows = rows.withColumn(key, F.when(F.col("_often").isNotNull() | F.col(key).isNull(), elsewhere).otherwise(F.col(key)))
    rows = rows.join(named.select(key, said.alias("_said")), key, "left").drop(key)
    rows = rows.withColumn("_said", F.coalesce("_often", "_said")).drop("_often")
    return rows.select(*(c for c in rows.columns if c != "_said"), "_said.*")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges ``(src, dst)``: ``(node, component)``.

    ``component`` is the smallest node reachable. Alternates large-star and small-star
    steps (Kiveris et al., 2014), each a pre-aggregated minimum and an equi-join that deals
    out the centres of large stars, and writes every round to the shared checkpoint folder.
    Self links and repeated edges change nothing; an empty input gives an empty result;
    null ends are dropped.
    """
    e = cut(
        edges.where("src is not null and dst is not null and src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", "n", F.least("u", "m").alias("m"))
        large = with_class(both.where("v > u"), least, "u", "n", F.xxhash64("v")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        kept = with_class(large, least, "u", "n", F.xxhash64("v")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(kept.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in sorted ``keys``, and the length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def by_run(key: str, handle: Callable[[pa.Table], Iterator[pa.RecordBatch]], most: int = 200_000) -> Callable:
    """A ``mapInArrow`` function over rows sorted by ``key``: ``handle`` gets tables of whole runs.

    Rows are gathered to about ``most`` before they are handed on, so that a call sees
    many short runs or one long one.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, last = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(b.schema.get_field_index(key)).to_numpy()
            start = int(np.searchsorted(k, k[-1]))  # of the last run, which may go on
            if n + start >= most and (start or k[0] != last):
                ready = [*held, b.slice(0, start)] if start else held
                if ready:
                    yield from handle(pa.Table.from_batches(ready).combine_chunks())
                held, n = [], 0
                b = b.slice(start)
            held.append(b)
            n += b.num_rows
            last = k[-1]
        if held:
            yield from handle(pa.Table.from_batches(held).combine_chunks())

    return go


def sorted_by(df: DataFrame, key: str) -> DataFrame:
    """Rows of one ``key`` side by side in one partition; the sort spills to disk."""
    return df.repartition(parts(df), key).sortWithinPartitions(key)

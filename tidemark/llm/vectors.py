"""Vectors as classes of equal ones, for the operators on embeddings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def kind(df: DataFrame) -> str:
    """The type in which vectors travel: single precision if they are stored so, else double."""
    t = df.schema["embedding"].dataType
    return "array<float>" if isinstance(t, ArrayType) and isinstance(t.elementType, FloatType) else "array<double>"


def matrix(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by length: positions and a two-dimensional array of doubles. Null lists are left out, null components are NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    there = np.flatnonzero(np.asarray(column.is_valid()))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.asarray(column.filter(column.is_valid()).value_lengths(), np.int64)
    start = np.cumsum(size) - size
    out = []
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        out.append((there[at], flat.reshape(-1, d) if len(at) == len(size) and d else flat[start[at][:, None] + np.arange(d)]))
    return out


def lists(x: np.ndarray, kind_: str) -> pa.ListArray:
    """Rows of a two-dimensional array as a list column."""
    values = np.ascontiguousarray(x, np.float32 if kind_ == "array<float>" else np.float64).ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(values))


def keyed(df: DataFrame, vectors: bool = True, all_rows: bool = False) -> DataFrame:
    """``vec_id, key`` and ``vec`` of the rows that take part.

    ``key`` is the first half of the vector's SHA-256, so that equal keys mean equal
    vectors. A vector that is null, empty, zero or holds a null or non-finite component
    takes no part, nor does a row without vec_id; with ``all_rows`` such rows are there
    with a null key.
    """
    k = kind(df)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, key = b.column(0), [None] * b.num_rows
            known = np.asarray(ids.is_valid())
            for at, x in matrix(b.column(1)):
                good = known[at] & np.isfinite(x).all(1) & (x != 0).any(1)
                at, x = at[good], x[good] + 0.0  # no negative zeros
                found = [hashlib.sha256(r).digest()[:16] for r in x]
                if not all_rows and len(at):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(found, pa.binary()), *([lists(x, k)] if vectors else [])], ["vec_id", "key", "vec"][: 2 + vectors])
                for i, h in zip(at.tolist(), found):
                    key[i] = h
            if all_rows:
                yield pa.RecordBatch.from_arrays([ids, pa.array(key, pa.binary())], ["vec_id", "key"])

    rows = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast(k).alias("embedding"))
    return rows.mapInArrow(go, f"vec_id long, key binary, vec {k}" if vectors and not all_rows else "vec_id long, key binary")


def classes(df: DataFrame, *more: Column) -> DataFrame:
    """One row for each distinct usable vector: ``key, id`` (smallest vec_id), ``n`` rows, ``vec`` and ``more`` aggregates of ``vec_id``; pre-aggregated before the shuffle."""
    return keyed(df).groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.min("vec").alias("vec"), *more)


def elsewhere(c: Column | str) -> Column:
    """A key that no vector has, for rows that are dealt out another way."""
    return F.unhex(F.md5(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)).cast("string").cast("binary")))

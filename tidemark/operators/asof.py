"""Backward as-of join by union and a carried value: one shuffle on the key, no range join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str], strict: bool = False) -> DataFrame:
    """Each row of ``left`` with the latest row of ``right`` whose ``right_on`` is not after ``left_on`` (``strict``: before it).

    Columns of ``right`` besides ``by`` must have names of their own. Rows without a match
    keep nulls. Among rows of ``right`` with one time the greatest by their columns counts.
    """
    carried = [c for c in right.columns if c not in by]
    if clash := set(carried) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    a = left.select(*by, F.col(left_on).alias("_t"), F.lit(0 if strict else 1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.select(F.struct(*carried).alias("x")).schema[0].dataType).alias("_found"))
    b = right.select(*by, F.col(right_on).alias("_t"), F.lit(1 if strict else 0).alias("_side"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), F.struct(*carried).alias("_found"))
    w = Window.partitionBy(*by).orderBy("_t", "_side", F.col("_found").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b.where(F.col(right_on).isNotNull())).withColumn("_found", F.last("_found", ignorenulls=True).over(w))
    return both.where(F.col("_row").isNotNull()).select(*(F.col("_row")[c].alias(c) for c in left.columns), *(F.col("_found")[c].alias(c) for c in carried))

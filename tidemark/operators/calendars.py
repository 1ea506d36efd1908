"""Dense calendars and business days."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def days(spark: SparkSession, start: object, end: object, name: str = "date") -> DataFrame:
    """Every day from ``start`` to ``end``."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))).alias(name))


def densify(df: DataFrame, calendar: DataFrame, day: str, fill: dict[str, float]) -> DataFrame:
    """One row for each day of the calendar; columns of ``fill`` are filled where ``df`` has no row."""
    return calendar.join(df, day, "left").fillna(fill)


def business_calendar(spark: SparkSession, start: object, end: object, weekmask: str = "1111100", holidays: Iterable[object] = ()) -> DataFrame:
    """``date``, whether it is a business day, and ``k``, the number of business days up to it.

    A calendar is as long as its range of days, not as the data, so one window over it is small.
    """
    off = [str(h) for h in holidays]
    d = F.col("date")
    open_ = F.substring(F.lit(weekmask), F.weekday(d) + 1, F.lit(1)) == "1"
    if off:
        open_ &= ~F.date_format(d, "yyyy-MM-dd").isin(off)
    c = days(spark, start, end).withColumn("is_business", open_)
    return c.withColumn("k", F.sum(F.col("is_business").cast("int")).over(Window.partitionBy(F.lit(0)).orderBy("date")).cast("int"))


def business_offset(df: DataFrame, calendar: DataFrame, day: str, n: int, name: str) -> DataFrame:
    """Adds ``name``, the ``n``-th business day strictly after ``day``; a day off first rolls back to the business day before it."""
    at = calendar.select(F.col("date").alias(day), F.col("k").alias("_k"))
    to = calendar.where("is_business").select((F.col("k") - n).alias("_k"), F.col("date").alias(name))
    return df.join(F.broadcast(at), day, "left").join(F.broadcast(to), "_k", "left").drop("_k")

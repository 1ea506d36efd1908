"""Identity of articles: keep-best, uniqueness over days, incremental loads, merged discoveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_best(df: DataFrame, key: str, quality: list[Column], position: str) -> DataFrame:
    """For each key the row of highest quality, of equal ones the first; its place is that of the key's first row.

    A pre-aggregated maximum, so a key with many copies isn't sorted anywhere. Rows with
    an empty key are dropped.
    """
    best = F.max_by(F.struct(*df.columns), F.struct(*quality, (-F.col(position)).alias("_p")))
    rows = df.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(F.col(key).alias("_k")).agg(best.alias("r"), F.min(position).alias("first_position"))
    return rows.select("r.*", "first_position")


def first_wins(df: DataFrame, key: str, position: str) -> DataFrame:
    """For each key the first row; rows with an empty key all stay."""
    blank = F.coalesce(F.col(key), F.lit("")) == ""
    first = df.where(~blank).groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*df.columns), position).alias("r")).select("r.*")
    return first.unionByName(df.where(blank))


def repeated_over_days(df: DataFrame, medium: str, key: str, day: str) -> DataFrame:
    """Keys of a medium that stand under more than one day."""
    return df.where(F.col(key) != "").groupBy(medium, key).agg(F.countDistinct(day).alias("days"), F.min(day).alias("first_day"), F.max(day).alias("last_day")).where("days > 1")


def assert_unique(df: DataFrame, medium: str, key: str, day: str) -> None:
    """An error that names some of the keys that break uniqueness."""
    if bad := repeated_over_days(df, medium, key, day).limit(5).collect():
        raise ValueError("addresses under more than one day: " + "; ".join(f"{r[medium]} {r[key]} ({r.first_day}, {r.last_day})" for r in bad))


def new_only(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return found.join(known.select(key).distinct(), key, "left_anti")


def quarantine(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition, and the others (null counts as not met)."""
    ok = F.coalesce(good, F.lit(False))
    return df.where(ok), df.where(~ok)


def merge_quarantine(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Both, with the newer row of each key."""
    both = old.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c != "_n"]
    return both.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*cols), "_n").alias("r")).select("r.*")


def merge_discoveries(df: DataFrame, url: str, order: str, first: list[str], any_: list[str], sources: str) -> DataFrame:
    """One row for each address: the first value of each field, flags joined by or, sources in order of finding, each once."""
    aggs = [F.min_by(F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col(c)), F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col(order))).alias(c) for c in first]
    aggs += [F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in any_]
    by_source = df.groupBy(url, sources).agg(F.min(order).alias("_o")).groupBy(url).agg(F.sort_array(F.collect_list(F.struct("_o", sources))).alias("_s"))
    return df.groupBy(url).agg(*aggs).join(by_source.select(url, F.transform("_s", lambda x: x[sources]).alias(sources)), url)

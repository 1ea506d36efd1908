"""Daily feature matrix of articles in long form: ``source, date, feature, value``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, NumericType, StringType, StructType
from pyspark.sql.window import Window

from tidemark.functions.text import safe_name, to_number

PAIR = "array<struct<feature:string,value:double>>"
FLAGS = ("is_economy_section", "is_market_section", "is_national_section", "is_international_section", "is_country_section", "is_world_section", "is_opinion", "is_column", "is_editorial", "is_agency_content")
NUMBERS = ("body_length_words", "body_length_chars", "paragraph_count", "quote_count", "related_count", "image_count")
SKIPPED = {("audit", "classification_reason"), ("temporal", "published_date"), ("temporal", "published_time")}


def _pairs(*items: tuple[Column | str, Column]) -> Column:
    return F.array(*(F.struct((F.lit(n) if isinstance(n, str) else n).alias("feature"), v.cast("double").alias("value")) for n, v in items)).cast(PAIR)


def _number(prefix: Column, v: Column) -> Column:
    good = v.isNotNull() & ~F.isnan(v)
    return F.when(good, _pairs((F.concat(prefix, F.lit("_sum")), v), (F.concat(prefix, F.lit("_mean")), v))).otherwise(F.array().cast(PAIR))


def flattened(column: Column, kind, prefix: Column | str) -> Column:
    """A value as features: numbers as ``_sum`` and ``_mean``, other text as one-hot ``_count``, lists by size, structs and maps by field."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    none = F.array().cast(PAIR)
    if isinstance(kind, (NumericType, BooleanType)):
        return _number(prefix, column.cast("double"))
    if isinstance(kind, StringType):
        text = F.trim(column)
        hot = _pairs((F.concat(prefix, F.lit("_"), safe_name(text), F.lit("_count")), F.lit(1.0)))
        return F.when(column.isNull() | (text == ""), none).when(to_number(text).isNotNull() & ~F.isnan(to_number(text)), _number(prefix, to_number(text))).otherwise(hot)
    if isinstance(kind, ArrayType):
        return F.when(column.isNull(), none).otherwise(_number(F.concat(prefix, F.lit("_items")), F.size(column).cast("double")))
    if isinstance(kind, StructType):
        parts = [flattened(column.getField(f.name), f.dataType, F.concat(prefix, F.lit("_"), safe_name(F.lit(f.name)))) for f in kind.fields]
        return F.when(column.isNull(), none).otherwise(F.concat(*parts)) if parts else none
    if isinstance(kind, MapType):
        each = F.transform(F.map_entries(column), lambda e: flattened(e["value"], kind.valueType, F.concat(prefix, F.lit("_"), safe_name(e["key"]))))
        return F.when(column.isNull(), none).otherwise(F.flatten(each))
    return none


def article_features(df: DataFrame, source: str, raw: str | None = None, blocks: list[str] = [], families: str | None = None) -> Column:  # noqa: B006
    """Features of one article: counts, section flags, numbers, families and the flattened blocks."""
    parts = [_pairs(("news_count", F.lit(1.0))), F.array(F.struct(F.concat(F.lit("news_count_"), F.col(source)).alias("feature"), F.lit(1.0).alias("value"))).cast(PAIR)]
    if raw:
        kinds = {f.name: f.dataType for f in df.schema[raw].dataType.fields}
        r = F.col(raw)
        parts += [_pairs((f"{f}_count", F.coalesce(r[f], F.lit(False)).cast("double"))) for f in FLAGS if f in kinds]
        parts += [_number(F.lit(n), to_number(r[n])) for n in NUMBERS if n in kinds]
    if families:
        name = lambda e, end: F.concat(F.lit("news_family_"), e["key"], F.lit(end))
        zero = lambda v: F.coalesce(v.cast("double"), F.lit(0.0))
        each = F.transform(F.map_entries(families), lambda e: _pairs((name(e, "_score_sum"), zero(e["value"]["score"])), (name(e, "_score_mean"), zero(e["value"]["score"])), (name(e, "_hit_count_sum"), zero(e["value"]["hit_count"])), (name(e, "_active_count"), zero(e["value"]["active"]))))
        parts.append(F.coalesce(F.flatten(each), F.array().cast(PAIR)))
    for b in blocks:
        for f in df.schema[b].dataType.fields:
            if (b, f.name) not in SKIPPED:
                parts.append(F.coalesce(flattened(F.col(b)[f.name], f.dataType, F.concat(F.lit(f"news_{b}_"), safe_name(F.lit(f.name)))), F.array().cast(PAIR)))
    return F.concat(*parts)


def daily_long(df: DataFrame, source: str, day: str, pairs: str, cutoff: str | None = None, clock: str | None = None) -> DataFrame:
    """Values of each source's day, ``_mean`` over all its articles (missing counts as 0), the rest summed.

    With a ``cutoff`` only articles whose ``clock`` is known and not later count.
    """
    if cutoff is not None:
        df = df.where(F.col(clock) <= cutoff)
    n = df.groupBy(source, day).agg(F.count("*").alias("articles"))
    long = df.select(source, day, F.inline(pairs)).groupBy(source, day, "feature").agg(F.sum("value").alias("total"))
    value = F.when(F.col("feature").endswith("_mean"), F.col("total") / F.col("articles")).otherwise(F.col("total"))
    return long.join(n, [source, day]).select(source, day, "feature", value.alias("value"))


def across_sources(long: DataFrame, day: str) -> DataFrame:
    """Sources added up, means too."""
    return long.groupBy(F.col(day).alias("date"), "feature").agg(F.sum("value").alias("value"))


def dense(matrix: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every feature on every day from the calendar's first to its last, 0 where nothing is known.

    Days are made within each feature, so there is no join with the calendar.
    """
    a, b = calendar.agg(F.min("date"), F.max("date")).first()
    days = F.sequence(F.lit(a).cast("date"), F.lit(b).cast("date")) if a else F.array().cast("array<date>")
    known = matrix.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("date", "value"))).alias("on"))  # one entry a day
    return known.select("feature", "on", F.explode(days).alias("date")).select("date", "feature", F.coalesce(F.try_element_at("on", F.col("date")), F.lit(0.0)).alias("value"))


def lagged(matrix: DataFrame) -> DataFrame:
    """``_lag1`` and sums over the 3 and 7 days before, shorter at the start, 0 on the first day; the calendar must be dense."""
    w = Window.partitionBy("feature").orderBy("date")
    roll = lambda k: F.coalesce(F.sum("value").over(w.rowsBetween(-k, -1)), F.lit(0.0))
    new = F.array(*(F.struct(F.concat("feature", F.lit(end)).alias("feature"), v.alias("value")) for end, v in (("_lag1", roll(1)), ("_roll3_lag1", roll(3)), ("_roll7_lag1", roll(7)))))
    return matrix.withColumn("new", new).select("date", F.inline("new"))


def weekend_pressure(matrix: DataFrame) -> DataFrame:
    """Weekend articles over the 3 and 7 days before."""
    m = matrix.where("feature = 'news_count'").withColumn("value", F.when(F.weekday("date") >= 5, F.col("value")).otherwise(0.0))
    w = Window.partitionBy("feature").orderBy("date")
    return m.select("date", *(F.coalesce(F.sum("value").over(w.rowsBetween(-k, -1)), F.lit(0.0)).alias(f"news_weekend_pressure_roll{k}_lag1") for k in (3, 7)))


def with_partial(df: DataFrame, source: str, day: str, pairs: str, clock: str, cutoff: str) -> DataFrame:
    """Whole-day and until-cutoff values side by side, in one pass over the articles."""
    early = F.coalesce(F.col(clock) <= cutoff, F.lit(False))
    n = df.groupBy(source, day).agg(F.count("*").alias("n"), F.count_if(early).alias("n_early"))
    long = df.select(source, day, early.alias("early"), F.inline(pairs)).groupBy(source, day, "feature").agg(F.sum("value").alias("t"), F.sum(F.when(F.col("early"), F.col("value"))).alias("t_early"))
    mean = F.col("feature").endswith("_mean")
    per = lambda t, k: F.coalesce(F.when(mean, F.try_divide(F.col(t), F.col(k))).otherwise(F.col(t)), F.lit(0.0))
    out = long.join(n, [source, day]).select(F.col(day).alias("date"), "feature", per("t", "n").alias("a"), per("t_early", "n_early").alias("b"))
    return out.groupBy("date", "feature").agg(F.sum("a").alias("value"), F.sum("b").alias("value_until"))


def to_wide(matrix: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One column per feature, in name order, for the model's door."""
    names = features or sorted(r.feature for r in matrix.select("feature").distinct().collect())
    return matrix.groupBy("date").pivot("feature", names).agg(F.sum("value")).fillna(0.0)

"""Technical features of price series: one window partition per series, full-window semantics.

A rolling value over ``w`` rows is null unless all ``w`` are there. Everything is a frame
of one and the same window specification, so Spark sorts each series once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

LAGS, WINDOWS, AVERAGES = (1, 2, 3, 5, 10, 20), (3, 5, 10, 20), (5, 10, 20)


def ordered(keys: list[str], day: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(day)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b) - 1


def rolling(how, c: Column, w: WindowSpec, width: int, shift: int = 1) -> Column:
    """``how`` over the ``width`` rows that end ``shift`` rows back; null unless all are there."""
    frame = w.rowsBetween(-(width + shift - 1), -shift)
    return F.when(F.count(c).over(frame) == width, how(c).over(frame))


def with_returns(df: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """``return_1d``, ``log_return_1d``."""
    w, v = ordered(keys, day), F.col(value)
    return df.withColumns({"return_1d": ratio(v, F.lag(v).over(w)), "log_return_1d": F.ln(v) - F.ln(F.lag(v).over(w))})


def with_lags(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    w = ordered(keys, day)
    new = {f"{c}_lag1_safe": F.lag(c, 1).over(w) for c in ("return_1d", "log_return_1d")}
    for k in LAGS:
        new |= {f"return_lag_{k}": F.lag("return_1d", k).over(w), f"log_return_lag_{k}": F.lag("log_return_1d", k).over(w)}
    return df.withColumns(new)


def with_rolling(df: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """Rolling mean and sample deviation of returns, and momentum, all as of the row before."""
    w, v = ordered(keys, day), F.col(value)
    new = {}
    for k in WINDOWS:
        new[f"return_roll_mean_{k}"] = rolling(F.avg, F.col("return_1d"), w, k)
        new[f"return_roll_std_{k}"] = rolling(F.stddev_samp, F.col("return_1d"), w, k)
        new[f"momentum_{k}"] = ratio(F.lag(v, 1).over(w), F.lag(v, k + 1).over(w))
    return df.withColumns(new)


def with_levels(df: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """Moving averages and maximum as of the row before, and today's value against them."""
    w, v = ordered(keys, day), F.col(value)
    df = df.withColumns({f"{value}_ma_{k}": rolling(F.avg, v, w, k) for k in AVERAGES} | {"rolling_max_20": rolling(F.max, v, w, 20)})
    return df.withColumns({f"{value}_vs_ma20": ratio(v, F.col(f"{value}_ma_20")), "ma5_vs_ma20": ratio(F.col(f"{value}_ma_5"), F.col(f"{value}_ma_20")), "drawdown_20": ratio(v, F.col("rolling_max_20"))})


def with_flows(df: DataFrame, keys: list[str], day: str, inflow: str = "CUOTAS_APORTADAS", outflow: str = "CUOTAS_RESCATADAS", assets: str = "PATRIMONIO_NETO", holders: str = "NUM_PARTICIPES") -> DataFrame:
    """Net flow, assets and holders, each only if its columns are there."""
    w = ordered(keys, day)
    if {inflow, outflow} <= set(df.columns):
        df = df.withColumn("net_flow_cuotas_raw", F.col(inflow) - F.col(outflow))
        n = F.col("net_flow_cuotas_raw")
        df = df.withColumns({f"net_flow_cuotas_lag{k}": F.lag(n, k).over(w) for k in (1, 2)} | {f"net_flow_cuotas_roll{k}_lag1": rolling(F.sum, n, w, k) for k in (3, 5, 10)})
    if assets in df.columns:
        df = df.withColumn("patrimonio_return_1d", ratio(F.col(assets), F.lag(assets).over(w)))
        df = df.withColumn("patrimonio_return_lag1", F.lag("patrimonio_return_1d").over(w))
    if holders in df.columns:
        df = df.withColumn("participes_change_1d", F.col(holders) - F.lag(holders).over(w))
        df = df.withColumn("participes_change_lag1", F.lag("participes_change_1d").over(w))
    return df


def with_calendar(df: DataFrame, day: str) -> DataFrame:
    d = F.col(day)
    return df.withColumns(
        {
            "day_of_week": F.weekday(d),
            "day_of_month": F.dayofmonth(d),
            "month": F.month(d),
            "is_month_start": (d == F.trunc(d, "MM")).cast("int"),
            "is_month_end": (d == F.last_day(d)).cast("int"),
            "is_weekend_fund_date": (F.weekday(d) >= 5).cast("int"),
        }
    )


def features(df: DataFrame, keys: list[str], day: str = "date", value: str = "valor_cuota") -> DataFrame:
    """All of the above. One sort of each series serves every frame."""
    df = with_rolling(with_lags(with_returns(df, keys, day, value), keys, day), keys, day, value)
    return with_calendar(with_flows(with_levels(df, keys, day, value), keys, day), day)


def with_target(df: DataFrame, keys: list[str], horizon: int, threshold: float, day: str = "date", value: str = "valor_cuota") -> DataFrame:
    """The value ``horizon`` rows later, its return and whether that exceeds the threshold (an unknown one doesn't)."""
    w = ordered(keys, day)
    df = df.withColumns({"future_exit_date": F.lead(day, horizon).over(w), "future_valor_cuota": F.lead(value, horizon).over(w)})
    df = df.withColumn("future_return_h", ratio(F.col("future_valor_cuota"), F.col(value)))
    return df.withColumn("target_up", F.coalesce(F.col("future_return_h") > threshold, F.lit(False)).cast("int"))


def choose_series(df: DataFrame, keys: list[str], series: str, preferred: list[str], weight: str) -> DataFrame:
    """For each key the first preferred series that is there, else the one with the highest mean ``weight`` (ties: first name)."""
    rank = F.coalesce(*(F.when(F.col(series) == s, F.lit(k)) for k, s in enumerate(preferred)), F.lit(len(preferred)))
    by = df.where(F.col(series).isNotNull()).groupBy(*keys, series).agg(F.avg(weight).alias("_mean")).withColumn("_rank", rank)
    first = Window.partitionBy(*keys).orderBy("_rank", F.when(F.col("_rank") == len(preferred), F.col("_mean")).desc_nulls_last(), series)
    return by.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*keys, F.col(series).alias("selected_series"), F.col("_mean").alias("mean_weight"))


def last_of_day(df: DataFrame, keys: list[str], day: str, arrival: list[str], value: str) -> DataFrame:
    """Whole-row copies once, prices over zero only, and of each day the row that arrived last."""
    df = df.where(F.col(value) > 0).distinct()
    w = Window.partitionBy(*keys, day).orderBy(*(F.col(c).desc() for c in arrival))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

"""Metrics of classifiers and of strategies that follow them, each in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


STEPS = 4096


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def classification(df: DataFrame, truth: str, guess: str, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """Confusion matrix, accuracy, balanced accuracy, precision, recall and F1; a share of nothing is 0.

    Balanced accuracy averages the recall of the classes that occur.
    """
    t, g = F.col(truth), F.col(guess)
    n = df.groupBy(*keys).agg(
        F.count_if((t == 0) & (g == 0)).alias("tn"), F.count_if((t == 0) & (g == 1)).alias("fp"), F.count_if((t == 1) & (g == 0)).alias("fn"), F.count_if((t == 1) & (g == 1)).alias("tp")
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = [F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)]
    there = sum(F.when(r.isNotNull(), 1.0).otherwise(0.0) for r in rates)
    return n.withColumns(
        {
            "accuracy": _share(tp + tn, tp + tn + fp + fn),
            "balanced_accuracy": F.try_divide(sum(F.coalesce(r, F.lit(0.0)) for r in rates), there),
            "precision_up": _share(tp, tp + fp),
            "recall_up": _share(tp, tp + fn),
            "f1_up": _share(2 * tp, 2 * tp + fp + fn),
        }
    )


def auc(df: DataFrame, truth: str, score: str, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """Area under the ROC curve by mid-ranks, exactly; null with one class.

    Rows are summed to distinct scores first. Scores are dealt out to ``STEPS`` steps of
    their range, which keep their order: ranks are counted within a step, and what lies
    below it is added, so that no task sorts all scores, with keys or without.
    """
    by = df.groupBy(*keys, F.col(score).alias("_score")).agg(F.count("*").alias("_n"), F.count_if(F.col(truth) == 1).alias("_p"))
    low, high = by.agg(F.min("_score"), F.max("_score")).first()
    width = (high - low) / STEPS if low is not None and high > low else 1.0
    step = F.least(F.lit(STEPS - 1), F.floor((F.col("_score") - F.lit(low or 0.0)) / F.lit(width))).cast("int")
    by = by.withColumn("_step", F.coalesce(step, F.lit(-1)))
    within = Window.partitionBy(*keys, "_step").orderBy("_score")
    steps = by.groupBy(*keys, "_step").agg(F.sum("_n").alias("_all"))  # at most STEPS + 1 rows for each key
    steps = steps.select(*keys, "_step", (F.sum("_all").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_step")) - F.col("_all")).alias("_below"))
    mid = F.col("_below") + F.sum("_n").over(within) - F.col("_n") + (F.col("_n") + 1) / 2
    s = by.join(steps, [*keys, "_step"]).withColumn("_mid", mid).groupBy(*keys).agg(F.sum(F.col("_mid") * F.col("_p")).alias("r"), F.sum("_p").alias("np"), F.sum("_n").alias("na"))
    p, q = F.col("np"), F.col("na") - F.col("np")
    return s.select(*keys, F.try_divide(F.col("r") - p * (p + 1) / 2, (p * q).cast("double")).alias("roc_auc"))


def compounded(r: Column) -> Column:
    """The product of ``1 + r`` less 1; a total loss stays one, signs are kept."""
    f = 1 + r
    size = F.exp(F.sum(F.when(f != 0, F.ln(F.abs(f)))))
    sign = F.when(F.count_if(f < 0) % 2 == 1, -1.0).otherwise(1.0)
    return F.when(F.count_if(f == 0) > 0, F.lit(0.0)).otherwise(sign * F.coalesce(size, F.lit(1.0))) - 1


def strategy(df: DataFrame, guess: str, future_return: str, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """Holding always against following the signal; overlapping horizons multiply, so this is a diagnostic and no portfolio."""
    g, r = F.col(guess), F.col(future_return)
    out = df.groupBy(*keys).agg(
        compounded(r).alias("buy_hold_return_compounded"),
        compounded(F.when(g == 1, r).otherwise(0.0)).alias("strategy_return_compounded"),
        F.coalesce(F.avg(F.when(g == 1, r)), F.lit(0.0)).alias("avg_future_return_when_pred_up"),
        F.coalesce(F.avg(F.when(g == 0, r)), F.lit(0.0)).alias("avg_future_return_when_pred_down"),
        F.count_if(g == 1).alias("signals_up_mantener"),
        F.count_if(g == 0).alias("signals_down_mover_o_retirar"),
    )
    return out.withColumn("strategy_improvement_vs_buy_hold", F.col("strategy_return_compounded") - F.col("buy_hold_return_compounded"))


def _base_score(mode: str) -> Column:
    up, down = F.col("avg_future_return_when_pred_up"), F.col("avg_future_return_when_pred_down")
    gain, total = F.col("strategy_improvement_vs_buy_hold"), F.col("strategy_return_compounded")
    modes = {"strategy_return": total, "improvement": gain, "risk_adjusted": gain + 0.5 * total + 0.5 * (up - down)}
    if mode == "balanced_accuracy":
        return F.coalesce(F.col("balanced_accuracy"), F.lit(0.0))
    if mode not in modes:
        raise ValueError(f"unknown score mode: {mode}")
    return F.coalesce(modes[mode], F.lit(0.0))


def model_score(mode: str) -> Column:
    """For choosing parameters: less where the signal doesn't tell gains from losses."""
    up, down = F.col("avg_future_return_when_pred_up"), F.col("avg_future_return_when_pred_down")
    return _base_score(mode) - F.when(up <= down, 0.02 + F.abs(down - up)).otherwise(0.0)


def threshold_score(mode: str, least_up: int, least_down: int) -> Column:
    """For choosing thresholds: also less for each signal too few, on either side."""
    if mode == "balanced_accuracy":
        raise ValueError("thresholds aren't scored by balanced accuracy")
    up, down = F.col("avg_future_return_when_pred_up"), F.col("avg_future_return_when_pred_down")
    ups, downs = F.col("signals_up_mantener"), F.col("signals_down_mover_o_retirar")
    few = 0.02 * (F.greatest(F.lit(0), least_up - ups) + F.greatest(F.lit(0), least_down - downs))
    return _base_score(mode) - few - F.when((ups > 0) & (downs > 0) & (up <= down), 0.02 + F.abs(down - up)).otherwise(0.0)


def confusion_lines(row: dict) -> str:
    """A confusion matrix as text."""
    return "\n".join(
        [
            f"{'':<18}{'pred. leave':>14}{'pred. hold':>14}",
            f"{'real not up':<18}{row['tn']:>14}{row['fp']:>14}",
            f"{'real up':<18}{row['fn']:>14}{row['tp']:>14}",
        ]
    )

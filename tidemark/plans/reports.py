"""Reports: flat tables of metrics, atomic files, availability of data."""

from __future__ import annotations

import json
import os
import tempfile
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def percent_table(report: DataFrame) -> DataFrame:
    """Evaluated experiments with returns in percent and points, by label."""
    pct = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)) * 100, 4)
    return report.select(
        "experiment",
        *(F.round(c, 6).alias(c) for c in ("accuracy", "balanced_accuracy", "precision_up", "recall_up", "f1_up", "roc_auc")),
        pct("buy_hold_return_compounded").alias("buy_hold_return_pct"),
        pct("strategy_return_compounded").alias("strategy_return_pct"),
        pct("strategy_improvement_vs_buy_hold").alias("strategy_improvement_pp"),
        pct("avg_future_return_when_pred_up").alias("avg_future_return_when_pred_up_pct"),
        pct("avg_future_return_when_pred_down").alias("avg_future_return_when_pred_down_pct"),
        "signals_up_mantener",
        "signals_down_mover_o_retirar",
        F.col("tn").alias("tn_salida_correcta"),
        F.col("fp").alias("fp_mantener_incorrecto"),
        F.col("fn").alias("fn_salida_incorrecta"),
        F.col("tp").alias("tp_mantener_correcto"),
    ).orderBy("experiment")


def read_reports(spark: SparkSession, pattern: str) -> DataFrame:
    """Saved reports: files that are lists of objects."""
    return spark.read.option("multiLine", True).json(pattern)


def flat(row: dict) -> dict:
    """Scalars of a result; scalars of ``metrics`` get a prefix, anything nested goes."""
    plain = (str, int, float, bool, type(None))
    out = {k: v for k, v in row.items() if isinstance(v, plain)}
    return out | {f"metric_{k}": v for k, v in (row.get("metrics") or {}).items() if isinstance(v, plain)}


def write_atomic(path: str, value: object) -> None:
    """A JSON file that readers see whole or not at all."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2, default=str)
    os.replace(f.name, path)


def latest_common_day(quotes: DataFrame, news: DataFrame, fund: str, medium: str, funds: int, media: int, day: str = "day") -> DataFrame:
    """The last day that has quotes of all funds and news of all media."""
    q = quotes.groupBy(day).agg(F.countDistinct(fund).alias("n")).where(F.col("n") == funds).select(day)
    n = news.groupBy(day).agg(F.countDistinct(medium).alias("n")).where(F.col("n") == media).select(day)
    return q.join(n, day, "left_semi").agg(F.max(day).alias("latest"))


def run_summary(df: DataFrame, medium: str, day: str, status: str) -> DataFrame:
    """Articles read, failed and rejected for each medium and day, and what that makes the day."""
    c = lambda s: F.count_if(F.col(status) == s)
    out = df.groupBy(medium, day).agg(F.count("*").alias("articles"), c("ok").alias("parsed"), c("error").alias("failed"), c("rejected").alias("rejected"))
    return out.withColumn("status", F.when(F.col("parsed") == 0, "error").when(F.col("failed") + F.col("rejected") > 0, "partial").otherwise("ok"))


def live_report(predictions: DataFrame, errors: dict[str, str]) -> dict:
    """What a dashboard shows: rows, counts by light and score, and what failed."""
    rows = [r.asDict(recursive=True) for r in predictions.orderBy("fund_key").collect()]
    lights: dict[str, int] = {}
    scores: dict[int, int] = {}
    for r in rows:
        lights[r["semaforo"]] = lights.get(r["semaforo"], 0) + 1
        scores[r["entry_score"]] = scores.get(r["entry_score"], 0) + 1
    return {"made_at": datetime.now(timezone.utc).isoformat(), "predictions": rows, "by_light": lights, "by_score": scores, "errors": errors}

"""Traffic-light signals and prediction output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEEDED = ("pred_up", "pred_prob_up", "momentum_10", "valor_cuota_vs_ma20", "drawdown_20")
DRAWDOWN = -0.04


def semaforo(df: DataFrame, probability_threshold: float | Column) -> DataFrame:
    """Five conditions, their sum, the light and what to do outside and inside the fund.

    Green: the model is for it (class and probability) and all three technical conditions
    hold. Red: none of the three holds, or the model is against it and at most one does.
    Missing columns count as 0; a null meets no condition.
    """
    df = df.withColumns({c: F.lit(0.0) for c in NEEDED if c not in df.columns})
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    df = df.withColumns(
        {
            "semaforo_cond_pred_up": yes(F.col("pred_up") == 1),
            "semaforo_cond_prob": yes(F.col("pred_prob_up") >= probability_threshold),
            "semaforo_cond_momentum_10": yes(F.col("momentum_10") > 0),
            "semaforo_cond_valor_vs_ma20": yes(F.col("valor_cuota_vs_ma20") > 0),
            "semaforo_cond_drawdown_20": yes(F.col("drawdown_20") > DRAWDOWN),
        }
    )
    model = F.col("semaforo_cond_pred_up") + F.col("semaforo_cond_prob")
    technical = F.col("semaforo_cond_momentum_10") + F.col("semaforo_cond_valor_vs_ma20") + F.col("semaforo_cond_drawdown_20")
    green = (model == 2) & (technical == 3)
    red = (technical == 0) | ((model < 2) & (technical <= 1))
    light = F.when(green, "verde").when(red, "rojo").otherwise("amarillo")
    df = df.withColumns({"entry_score": model + technical, "semaforo_green_required": green.cast("int"), "semaforo": light})
    s = F.col("semaforo")
    return df.withColumns({"decision_if_out": F.when(s == "verde", "entrar").otherwise("esperar"), "decision_if_in": F.when(s == "verde", "mantener").when(s == "amarillo", "mantener_con_alerta").otherwise("salir_o_mover_defensivo")})


def output(df: DataFrame, *, probability_threshold: float, target_threshold: float, horizon: int, decision_mode: str, decision_time: str | None, same_day_returns: bool, live: bool) -> DataFrame:
    """Prediction rows from ``pred_prob_up`` and ``pred_up``, with configuration, evaluability and the light."""
    future = F.col("future_valor_cuota")
    captured = F.lit(None).cast("double") if live else F.when(F.col("pred_up") == 1, F.col("future_return_h")).otherwise(0.0)
    df = df.withColumns(
        {
            "decision": F.when(F.col("pred_up") == 1, "mantener").otherwise("mover_o_retirar"),
            "horizon_business_days": F.lit(horizon),
            "decision_mode": F.lit(decision_mode),
            "decision_time": F.lit(decision_time or ""),
            "target_threshold": F.lit(target_threshold),
            "probability_threshold": F.lit(probability_threshold),
            "use_same_day_return_features": F.lit(same_day_returns),
            "is_live_signal": F.lit(live),
            "is_evaluable": F.coalesce(future > 0, F.lit(False)),
            "captured_return_if_follow_signal": captured,
        }
    )
    return semaforo(df, probability_threshold)


def live_rows(df: DataFrame, start: object, end: object, day: str = "date") -> DataFrame:
    """Rows of the range whose future price isn't known."""
    return df.where(F.col(day).between(F.lit(str(start)), F.lit(str(end)))).where("future_valor_cuota <= 0 or future_valor_cuota is null")


def latest_rows(df: DataFrame, keys: list[str], day: str = "date") -> DataFrame:
    """The last row of each key, for when no live row is left."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), day).alias("r")).select("r.*")


def experiment_key(fund: str, mode: str, probability_threshold: float, target_threshold: float) -> str:
    head = f"{fund}_{mode}_prob{probability_threshold:.3f}"
    return head.replace(".", "p") + f"_target{target_threshold:.4f}".replace(".", "p")

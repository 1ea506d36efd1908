"""Training, evaluation, tuning, registry and live prediction.

The unit of parallel work is the experiment (fund, mode, thresholds, parameters): each is
one group of ``applyInPandas`` over a dataset that is built once.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import boost, metrics, signals

MIN_TRAIN = 30


@dataclass(frozen=True)
class Experiment:
    fund_key: str
    probability_threshold: float = 0.5
    target_threshold: float = 0.0
    decision_mode: str = "strict_lag"
    decision_time: str | None = None
    same_day_returns: bool = True
    scenario: str = "legacy"
    tune: int = 0
    params: dict = field(default_factory=dict)

    def key(self) -> str:
        return signals.experiment_key(self.fund_key, self.decision_mode, self.probability_threshold, self.target_threshold)


def matrix(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys and an array of the feature columns in name order (column sampling depends on order)."""
    return df.select(*keys, F.array(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in sorted(columns))).alias("x"))


def _fit(pdf: pd.DataFrame) -> tuple[boost.Booster | None, np.ndarray, np.ndarray, str]:
    """The model of one experiment's rows, and matrices of training and evaluation rows."""
    train, rest = pdf[pdf.part == "train"], pdf[pdf.part != "train"]
    x = np.stack(train.x.to_numpy()) if len(train) else np.zeros((0, 0))
    z = np.stack(rest.x.to_numpy()) if len(rest) else np.zeros((0, x.shape[1]))
    y = train.y.to_numpy(float)
    if len(train) < MIN_TRAIN or not len(rest):
        return None, x, z, f"{len(train)} training rows, {len(rest)} evaluation rows"
    up, down = int((y == 1).sum()), int((y == 0).sum())
    weight = down / up if up else 1.0
    params = boost.merged(json.loads(pdf.params.iloc[0] or "{}"))
    if (n := int(pdf.tune.iloc[0])) > 0:
        known = train.known.to_numpy() if "known" in train and train.known.notna().all() else None
        params = boost.tuned(x, y, weight, n, train.day.to_numpy(), known)
    return boost.Booster(params).fit(x, y, weight), x, z, "" if up and down else "one class in training"


PREDICTED = "experiment string, fund_key string, day date, future_return double, y int, pred_prob_up double, pred_up int, note string"


def train_predict(data: DataFrame, experiments: list[Experiment], splits: tuple[object, object, object, object]) -> DataFrame:
    """Evaluation rows of every experiment with its probability.

    ``data`` has ``fund_key, day, x, future_return`` and optionally ``known`` (the day a
    label was out). Labels follow from the future return and each experiment's threshold,
    so features are never built again for another threshold. A failed experiment is one
    row with a note.
    """
    spark = data.sparkSession
    rows = [(e.key(), e.fund_key, e.probability_threshold, e.target_threshold, e.tune, json.dumps(e.params)) for e in experiments]
    ex = spark.createDataFrame(rows, "experiment string, fund_key string, p double, target double, tune int, params string")
    a, b, c, d = (F.lit(str(s)).cast("date") for s in splits)
    df = data.where("future_return is not null").join(F.broadcast(ex), "fund_key")
    part = F.when(F.col("day").between(a, b), "train").when(F.col("day").between(c, d), "eval")
    if "known" in data.columns:
        part = F.when((part == "train") & (F.col("known") > b), None).otherwise(part)
    df = df.withColumns({"part": part, "y": (F.col("future_return") > F.col("target")).cast("int")}).where("part is not null")

    def go(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day")
        head = pdf[["experiment", "fund_key"]].iloc[:1]
        try:
            model, _, z, note = _fit(pdf)
        except Exception as e:  # noqa: BLE001  one experiment must not end the others
            model, note = None, f"{type(e).__name__}: {e}"
        if model is None:
            return head.assign(day=None, future_return=None, y=None, pred_prob_up=None, pred_up=None, note=note)
        out = pdf[pdf.part == "eval"][["experiment", "fund_key", "day", "future_return", "y"]].copy()
        out["pred_prob_up"] = model.predict(z)
        out["pred_up"] = (out.pred_prob_up >= pdf.p.iloc[0]).astype(int)
        return out.assign(note=note)

    return df.groupBy("experiment").applyInPandas(go, PREDICTED)


def evaluated(predicted: DataFrame) -> DataFrame:
    """All metrics of each experiment."""
    p = predicted.where("pred_up is not null")
    k = ["experiment"]
    return metrics.classification(p, "y", "pred_up", k).join(metrics.auc(p, "y", "pred_prob_up", k), k).join(metrics.strategy(p, "pred_up", "future_return", k), k)


def ranked(scored: DataFrame, order: str = "experiment") -> DataFrame:
    """By falling score, unknown ones last, ties by order."""
    return scored.orderBy(F.desc(F.coalesce("score", F.lit(-999.0))), order)


def importance(data: DataFrame, experiment: Experiment, splits: tuple[object, object, object, object], names: list[str]) -> DataFrame:
    """Share of the gain of each feature, largest first."""
    spark = data.sparkSession
    a, b = (F.lit(str(s)).cast("date") for s in splits[:2])
    pdf = data.where((F.col("fund_key") == experiment.fund_key) & F.col("day").between(a, b) & F.col("future_return").isNotNull()).orderBy("day").toPandas()
    y = (pdf.future_return > experiment.target_threshold).to_numpy(float)
    model = boost.Booster(boost.merged(experiment.params)).fit(np.stack(pdf.x.to_numpy()), y, float((y == 0).sum() / max(1, (y == 1).sum())))
    return spark.createDataFrame([(n, float(g)) for n, g in zip(sorted(names), model.importance())], "feature string, importance double").orderBy(F.desc("importance"), "feature")


@dataclass
class Search:
    """A seeded search after the TPE paper (Bergstra et al., 2011): numbers between bounds, on a log scale if asked."""

    space: dict[str, tuple]
    seed: int = 42
    start: int = 10
    draws: int = 24
    share: float = 0.25

    def _draw(self, rng: np.random.Generator, name: str, around: float | None) -> float:
        lo, hi, *kind = self.space[name]
        if "choice" in kind:
            return lo[rng.integers(len(lo))] if around is None or rng.random() < 0.3 else around
        log = "log" in kind
        a, b = (math.log(lo), math.log(hi)) if log else (lo, hi)
        v = rng.uniform(a, b) if around is None else rng.normal(math.log(around) if log else around, (b - a) / 6)
        v = min(max(v, a), b)
        v = math.exp(v) if log else v
        return int(round(v)) if "int" in kind else float(v)

    def _density(self, name: str, v: float, points: list[float]) -> float:
        lo, hi, *kind = self.space[name]
        if "choice" in kind:
            return (points.count(v) + 1) / (len(points) + len(lo))
        f = math.log if "log" in kind else float
        width = (f(hi) - f(lo)) / 6 or 1.0
        return sum(math.exp(-0.5 * ((f(v) - f(p)) / width) ** 2) for p in points) / max(1, len(points)) + 1e-12

    def propose(self, history: list[tuple[dict, float]], count: int = 1) -> list[dict]:
        """The next ``count`` trials, to be run side by side."""
        rng = np.random.default_rng(self.seed + len(history))
        if len(history) < self.start:
            return [{n: self._draw(rng, n, None) for n in self.space} for _ in range(count)]
        best = sorted(history, key=lambda h: -h[1])
        k = max(2, int(len(best) * self.share))
        good, bad = best[:k], best[k:] or best[:k]
        out = []
        for _ in range(count):
            tries = [{n: self._draw(rng, n, good[rng.integers(len(good))][0][n]) for n in self.space} for _ in range(self.draws)]
            gain = [sum(math.log(self._density(n, t[n], [g[0][n] for g in good]) / self._density(n, t[n], [b[0][n] for b in bad])) for n in self.space) for t in tries]
            out.append(tries[int(np.argmax(gain))])
        return out


def search_thresholds(data: DataFrame, fund: str, search: Search, splits: tuple[object, object, object, object], trials: int, mode: str = "risk_adjusted", batch: int = 8, least: tuple[int, int] = (5, 5), params: dict | None = None) -> list[tuple[dict, float]]:
    """Trials of ``probability`` and ``target`` thresholds, ``batch`` at a time as one Spark job; a failed trial scores -999."""
    history: list[tuple[dict, float]] = []
    while len(history) < trials:
        tries = search.propose(history, min(batch, trials - len(history)))
        ex = [Experiment(fund, round(t["probability"], 6), round(t["target"], 8), decision_mode=f"trial{len(history) + k}", params=params or {}) for k, t in enumerate(tries)]
        got = {r.experiment: r.score for r in evaluated(train_predict(data, ex, splits)).select("experiment", metrics.threshold_score(mode, *least).alias("score")).collect()}
        history += [(t, got.get(e.key(), -999.0)) for t, e in zip(tries, ex)]
    return history


def search_params(data: DataFrame, base: Experiment, search: Search, splits: tuple[object, object, object, object], trials: int, mode: str = "risk_adjusted", batch: int = 8) -> list[tuple[dict, float]]:
    """Trials of model parameters under fixed thresholds."""
    history: list[tuple[dict, float]] = []
    while len(history) < trials:
        tries = search.propose(history, min(batch, trials - len(history)))
        ex = [Experiment(base.fund_key, base.probability_threshold, base.target_threshold, f"trial{len(history) + k}", params=t) for k, t in enumerate(tries)]
        got = {r.experiment: r.score for r in evaluated(train_predict(data, ex, splits)).select("experiment", metrics.model_score(mode).alias("score")).collect()}
        history += [(t, got.get(e.key(), -999.0)) for t, e in zip(tries, ex)]
    return history


def spark_model(features: str = "features", label: str = "y", weight: str = "w", params: dict | None = None):
    """Spark's own boosted trees for one large dataset. Ridge and lasso terms have no counterpart there."""
    from pyspark.ml.classification import GBTClassifier

    p = boost.merged(params)
    return GBTClassifier(featuresCol=features, labelCol=label, weightCol=weight, maxIter=p["n_estimators"], stepSize=p["learning_rate"], maxDepth=p["max_depth"], subsamplingRate=p["subsample"], featureSubsetStrategy=str(p["colsample_bytree"]), minInfoGain=p["gamma"] / 1000, seed=boost.SEED)


REGISTRY = "fund_key string, decision_mode string, decision_time string, scenario string, target_threshold double, probability_threshold double, same_day_returns boolean, params string, selected_series string, feature_columns array<string>, train_start date, train_end date, saved_at timestamp, path string"


def compatible(registry: DataFrame, wanted: DataFrame, day: object) -> DataFrame:
    """For each wanted configuration the newest model that was trained before ``day`` and agrees with it in everything.

    ``wanted`` has the registry's configuration columns. Thresholds agree within 1e-12.
    """
    w = wanted.select("fund_key", *(F.col(c).alias(f"w_{c}") for c in ("decision_mode", "decision_time", "scenario", "target_threshold", "probability_threshold", "same_day_returns", "params")))
    near = lambda c: F.abs(F.col(c) - F.col(f"w_{c}")) <= 1e-12
    same = lambda c: F.col(c).eqNullSafe(F.col(f"w_{c}"))
    time = same("decision_time") | (F.col("decision_mode") != "night_partial")
    fit = registry.join(F.broadcast(w), "fund_key").where(same("decision_mode") & time & same("scenario") & near("target_threshold") & near("probability_threshold") & same("same_day_returns") & same("params"))
    fit = fit.where((F.col("train_end") < F.lit(str(day)).cast("date")) & (F.size("feature_columns") > 0) & (F.col("selected_series") != ""))
    n = F.row_number().over(Window.partitionBy("fund_key").orderBy(F.desc("train_end"), F.desc("saved_at"), "path"))
    return fit.withColumn("_n", n).where("_n = 1").select(*registry.columns)


def save_model(path: str, model: boost.Booster, experiment: Experiment, columns: list[str]) -> str:
    """A JSON file of trees and configuration; returns its hash."""
    import os
    import tempfile

    body = json.dumps({"experiment": asdict(experiment), "columns": sorted(columns), "params": model.params, "edges": [e.tolist() for e in model.edges], "trees": model.trees})
    with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(path) or ".", delete=False) as f:
        f.write(body)
    os.replace(f.name, path)
    return hashlib.sha256(body.encode()).hexdigest()


def load_model(path: str, expected: Experiment | None = None) -> tuple[boost.Booster, dict]:
    """The model and its configuration; an error if the configuration isn't the expected one."""
    with open(path) as f:
        d = json.load(f)
    if expected and d["experiment"] != json.loads(json.dumps(asdict(expected))):
        raise ValueError("the model was trained with another configuration; train it again")
    m = boost.Booster(d["params"])
    tuples = lambda t: tuple(tuples(x) if isinstance(x, list) else x for x in t)
    m.edges = [np.array(e) for e in d["edges"]]
    m.trees = [tuples(t) if isinstance(t, list) else t for t in d["trees"]]
    m.gains = np.zeros(len(m.edges))
    return m, d


def predict_live(spark: SparkSession, rows: DataFrame, model: boost.Booster, experiment: Experiment, horizon: int) -> DataFrame:
    """Live prediction rows with the traffic light; ``rows`` has ``x`` and what the light reads."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(held.value.predict(np.stack(x.to_numpy())))

    df = rows.withColumn("pred_prob_up", score("x")).drop("x")
    df = df.withColumn("pred_up", (F.col("pred_prob_up") >= experiment.probability_threshold).cast("int"))
    return signals.output(df, probability_threshold=experiment.probability_threshold, target_threshold=experiment.target_threshold, horizon=horizon, decision_mode=experiment.decision_mode, decision_time=experiment.decision_time, same_day_returns=experiment.same_day_returns, live=True)

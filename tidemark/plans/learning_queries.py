"""Queries on learning, search, clusters, reports and streams, over the driver's tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cluster, metrics, series
from tidemark.plans import learning, reports, scenarios
from tidemark.plans.series_queries import _PREDICTED, _STRATEGY, KEYS, _predicted, _year, funds, read, shown
from tidemark.streaming import news

SPLITS = ("1996-01-01", "1998-12-31", "1999-01-01", "1999-12-31")
FEW = {"n_estimators": 40, "learning_rate": 0.1}


def _folder(spark: SparkSession) -> str:
    """A folder of its own under the one that executors share; a temporary one only on a single machine where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base}/{uuid.uuid4().hex}"


def _data(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = series.with_target(series.features(funds(spark, sf_dir), KEYS), KEYS, 5, 0.0)
    return learning.matrix(f.withColumnRenamed("date", "day").withColumnRenamed("future_return_h", "future_return"), ["fund_key", "day", "future_return"], [c for c in scenarios.feature_columns(f) if c not in ("date",)])


def _experiments(spark: SparkSession, sf_dir: str) -> list[learning.Experiment]:
    return [learning.Experiment(r.fund_key, 0.5, t, params=FEW) for r in funds(spark, sf_dir).select("fund_key").distinct().orderBy("fund_key").collect() for t in (0.0, 0.05)]


def gbt_train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learning.train_predict(_data(spark, sf_dir), _experiments(spark, sf_dir), SPLITS)


def gbt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = learning.evaluated(gbt_train_predict(spark, sf_dir))
    return learning.ranked(scored.withColumn("score", metrics.model_score("balanced_accuracy")))


def _keys(spark: SparkSession, sf_dir: str) -> list[str]:
    return [r.fund_key for r in funds(spark, sf_dir).select("fund_key").distinct().orderBy("fund_key").collect()]


def gbt_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each fund's model looks at."""
    data, names = _data(spark, sf_dir), scenarios.feature_columns(series.with_target(series.features(funds(spark, sf_dir), KEYS), KEYS, 5, 0.0))
    every = [learning.importance(data, learning.Experiment(k, params=FEW), SPLITS, names).withColumn("fund_key", F.lit(k)) for k in _keys(spark, sf_dir)]
    return reduce(DataFrame.unionByName, every)


def tpe_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight trials of thresholds for each fund."""
    data, rows = _data(spark, sf_dir).cache(), []
    for fund in _keys(spark, sf_dir):
        s = learning.Search({"probability": (0.3, 0.7), "target": (0.0, 0.1)}, start=4)
        h = learning.search_thresholds(data, fund, s, SPLITS, 8, batch=4, params=FEW)
        rows += [(fund, k, float(t["probability"]), float(t["target"]), float(v)) for k, (t, v) in enumerate(h)]
    data.unpersist()
    return spark.createDataFrame(rows, "fund_key string, trial int, probability double, target double, score double")


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return cluster.clusters(e, "vec_id", "embedding")


def model_registry_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest compatible model of each fund; models and wishes are made from the funds' names."""
    f = funds(spark, sf_dir).select("fund_key").distinct()
    base = f.select("fund_key", F.lit("night_partial").alias("decision_mode"), F.lit("21:30").alias("decision_time"), F.lit("legacy").alias("scenario"), F.lit(0.01).alias("target_threshold"), F.lit(0.5).alias("probability_threshold"), F.lit(True).alias("same_day_returns"), F.lit("{}").alias("params"))
    models = base.withColumn("k", F.explode(F.array(*map(F.lit, range(4)))))
    models = models.withColumns({"selected_series": F.lit("A"), "feature_columns": F.array(F.lit("x")), "train_start": F.lit("1995-01-01").cast("date"), "train_end": F.add_months(F.lit("1996-01-31").cast("date"), F.col("k") * 3), "saved_at": F.lit("2000-01-01").cast("timestamp"), "path": F.concat_ws("/", "fund_key", F.col("k").cast("string")), "decision_time": F.when(F.col("k") == 1, "20:00").otherwise(F.col("decision_time"))}).drop("k")
    return learning.compatible(models, base, "1996-09-01").select("fund_key", "train_end", "path")


def report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _year(spark, sf_dir).select(F.col("fund_key").alias("experiment"), F.col("target_up").alias("y"), "pred_up", "pred_prob_up", F.col("future_return_h").alias("future_return"))
    t = reports.percent_table(learning.evaluated(p))
    return t.select("experiment", "accuracy", "roc_auc", "buy_hold_return_pct", "strategy_return_pct", "signals_up_mantener", "tp_mantener_correcto")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("source", (F.col("doc_id") % 30).cast("int").alias("day"), F.when(F.col("doc_id") % 17 == 0, "error").when(F.col("doc_id") % 13 == 0, "rejected").otherwise("ok").alias("state"))
    return reports.run_summary(d, "source", "day", "state")


def best_per_fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of each fund: what a live view falls back on."""
    from tidemark.operators.signals import latest_rows

    return shown(latest_rows(_predicted(spark, sf_dir), KEYS).select("fund_key", "date", "valor_cuota", "pred_prob_up"), ["fund_key", "date", "valor_cuota", "pred_prob_up"])


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    s = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return s.withColumn("time", F.to_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))


def stream_dedup_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a stream that drops copies, then counted by day and type."""
    folder = _folder(spark)
    s = news.deduplicated(_stream(spark, sf_dir), "event_id", "time")
    news.available_now(s.select("event_id", F.to_date("time").alias("day"), "event_type", "value"), f"{folder}/out", f"{folder}/state").awaitTermination()
    t = spark.read.parquet(f"{folder}/out")
    return t.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of even users to one table, the others to quarantine, both counted."""
    folder = _folder(spark)
    news.with_quarantine(_stream(spark, sf_dir), F.col("user_id") % 2 == 0, f"{folder}/good", f"{folder}/bad", f"{folder}/state").awaitTermination()
    parts = [spark.read.parquet(f"{folder}/{p}").groupBy(F.lit(p).alias("part"), "event_type").agg(F.count("*").alias("n")) for p in ("good", "bad")]
    return parts[0].unionByName(parts[1])


QUERIES = {f.__name__: f for f in (gbt_train_predict, gbt_metrics, gbt_importance, tpe_search, clusters, model_registry_match, report_table, run_summary, best_per_fund, stream_dedup_daily, stream_quarantine)}

ORACLE_SQL = {
    "model_registry_match": "SELECT DISTINCT o_orderpriority AS fund_key, DATE '1996-07-31' AS train_end, o_orderpriority || '/2' AS path FROM orders",
    "report_table": f"""WITH {_PREDICTED}, {_STRATEGY}, v AS (SELECT * FROM q WHERE future > 0 AND date BETWEEN '1996-01-01' AND '1996-12-31'),
c AS (SELECT fund_key, count(*) FILTER (target_up = up) / count(*) AS acc, count(*) FILTER (target_up = 1 AND up = 1) AS tp FROM v GROUP BY 1),
a AS (SELECT fund_key, target_up, rank() OVER (PARTITION BY fund_key ORDER BY prob) + (count(*) OVER (PARTITION BY fund_key, prob) - 1) / 2 AS mid FROM v),
u AS (SELECT fund_key, (sum(CASE WHEN target_up = 1 THEN mid ELSE 0 END) - sum(target_up) * (sum(target_up) + 1) / 2) / (sum(target_up) * (count(*) - sum(target_up))) AS auc FROM a GROUP BY 1)
SELECT fund_key AS experiment, round(acc, 6) AS accuracy, round(auc, 6) AS roc_auc, round(buy_hold_return_compounded * 100, 4) AS buy_hold_return_pct, round(strategy_return_compounded * 100, 4) AS strategy_return_pct, signals_up_mantener, tp AS tp_mantener_correcto FROM s JOIN c USING (fund_key) JOIN u USING (fund_key)""",
    "run_summary": "WITH d AS (SELECT source, (doc_id % 30)::INT AS day, CASE WHEN doc_id % 17 = 0 THEN 'error' WHEN doc_id % 13 = 0 THEN 'rejected' ELSE 'ok' END AS s FROM documents), g AS (SELECT source, day, count(*) AS articles, count(*) FILTER (s = 'ok') AS parsed, count(*) FILTER (s = 'error') AS failed, count(*) FILTER (s = 'rejected') AS rejected FROM d GROUP BY 1, 2) SELECT *, CASE WHEN parsed = 0 THEN 'error' WHEN failed + rejected > 0 THEN 'partial' ELSE 'ok' END AS status FROM g",
    "best_per_fund": f"WITH {_PREDICTED} SELECT fund_key, date, round(valor_cuota, 6) AS valor_cuota, round(prob, 6) AS pred_prob_up FROM q QUALIFY row_number() OVER (PARTITION BY fund_key ORDER BY date DESC) = 1",
    "stream_dedup_daily": "SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "stream_quarantine": "SELECT CASE WHEN user_id % 2 = 0 THEN 'good' ELSE 'bad' END AS part, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}

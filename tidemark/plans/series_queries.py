"""Queries on price series, decisions, metrics and signals, over ``orders`` as funds, with their SQL.

A fund is an order priority, its price on a day the mean total of that day's orders, flows
are totals by order status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import asof, calendars, metrics, series, signals
from tidemark.plans import scenarios

KEYS = ["fund_key"]
HOLIDAYS = ("1996-01-01", "1996-05-01", "1996-09-18", "1996-09-19", "1996-12-25")
START, END = "1996-01-01", "1996-12-31"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    part = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")).otherwise(0.0))
    return o.groupBy(F.col("o_orderpriority").alias("fund_key"), F.col("o_orderdate").cast("date").alias("date")).agg(
        F.round(F.avg("o_totalprice"), 4).alias("valor_cuota"),
        F.round(part("O"), 2).alias("CUOTAS_APORTADAS"),
        F.round(part("F"), 2).alias("CUOTAS_RESCATADAS"),
        F.round(F.sum("o_totalprice"), 2).alias("PATRIMONIO_NETO"),
        F.countDistinct("o_custkey").cast("double").alias("NUM_PARTICIPES"),
    )


FUNDS = """f AS (SELECT o_orderpriority AS fund_key, o_orderdate::DATE AS date, round(avg(o_totalprice), 4) AS valor_cuota,
  round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END), 2) AS "CUOTAS_APORTADAS",
  round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END), 2) AS "CUOTAS_RESCATADAS",
  round(sum(o_totalprice), 2) AS "PATRIMONIO_NETO", count(DISTINCT o_custkey)::DOUBLE AS "NUM_PARTICIPES"
  FROM orders GROUP BY 1, 2)"""
RETURNS = """r AS (SELECT *, valor_cuota / nullif(lag(valor_cuota) OVER w, 0) - 1 AS return_1d, ln(valor_cuota) - ln(lag(valor_cuota) OVER w) AS log_return_1d
  FROM f WINDOW w AS (PARTITION BY fund_key ORDER BY date))"""
W = "WINDOW w AS (PARTITION BY fund_key ORDER BY date)"


def shown(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*(F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in columns))


def _rolled(how: str, c: str, width: int) -> str:
    frame = f"OVER (PARTITION BY fund_key ORDER BY date ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({c}) {frame} = {width} THEN {how}({c}) {frame} END"


def series_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.with_returns(funds(spark, sf_dir), KEYS, "date", "valor_cuota"), ["fund_key", "date", "valor_cuota", "return_1d", "log_return_1d"])


def series_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = series.with_lags(series.with_returns(funds(spark, sf_dir), KEYS, "date", "valor_cuota"), KEYS, "date")
    return shown(df, ["fund_key", "date", *(c for c in df.columns if "lag" in c)])


def series_rolling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = series.with_rolling(series.with_returns(funds(spark, sf_dir), KEYS, "date", "valor_cuota"), KEYS, "date", "valor_cuota")
    return shown(df, ["fund_key", "date", *(c for c in df.columns if "_roll_" in c)])


def series_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = series.with_rolling(series.with_returns(funds(spark, sf_dir), KEYS, "date", "valor_cuota"), KEYS, "date", "valor_cuota")
    return shown(df, ["fund_key", "date", *(c for c in df.columns if c.startswith("momentum"))])


def series_ma_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = series.with_levels(funds(spark, sf_dir), KEYS, "date", "valor_cuota")
    return shown(df, ["fund_key", "date", *(f"valor_cuota_ma_{k}" for k in series.AVERAGES), "valor_cuota_vs_ma20", "ma5_vs_ma20"])


def series_drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.with_levels(funds(spark, sf_dir), KEYS, "date", "valor_cuota"), ["fund_key", "date", "rolling_max_20", "drawdown_20"])


FLOWS = ["net_flow_cuotas_raw", "net_flow_cuotas_lag1", "net_flow_cuotas_lag2", "net_flow_cuotas_roll3_lag1", "net_flow_cuotas_roll5_lag1", "net_flow_cuotas_roll10_lag1", "patrimonio_return_1d", "patrimonio_return_lag1", "participes_change_1d", "participes_change_lag1"]


def series_netflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.with_flows(funds(spark, sf_dir), KEYS, "date"), ["fund_key", "date", *FLOWS], 4)


def series_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.with_calendar(funds(spark, sf_dir), "date"), ["fund_key", "date", "day_of_week", "day_of_month", "month", "is_month_start", "is_month_end", "is_weekend_fund_date"])


def series_target_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = series.with_target(funds(spark, sf_dir), KEYS, 5, 0.01)
    return shown(df, ["fund_key", "date", "future_exit_date", "future_valor_cuota", "future_return_h", "target_up"])


def fund_load_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as fund files: of each flag and day the row that arrived last, prices over zero."""
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("fund_key"), F.col("l_shipdate").cast("date").alias("date"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("valor_cuota"))
    return series.last_of_day(rows, KEYS, "date", ["l_orderkey", "l_linenumber", "valor_cuota"], "valor_cuota").select("fund_key", "date", "valor_cuota")


def fund_series_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("fund_key"), F.col("l_returnflag").alias("serie"), "l_extendedprice")
    return series.choose_series(rows, KEYS, "serie", ["Z"], "l_extendedprice").select("fund_key", "selected_series", F.round("mean_weight", 4).alias("mean_weight"))


def fund_series_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("fund_key"), F.col("l_returnflag").alias("serie"), "l_extendedprice")
    return series.choose_series(rows, KEYS, "serie", ["Z", "R", "A"], "l_extendedprice").select("fund_key", "selected_series")


def calendar_business_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calendars.business_calendar(spark, "1995-12-01", "1997-02-28", holidays=HOLIDAYS)
    d = calendars.days(spark, START, END)
    for n in (1, 4):
        d = calendars.business_offset(d, c, "date", n, f"plus_{n}")
    return d.select("date", "plus_1", "plus_4")


CALENDAR = """c AS (SELECT d::DATE AS date, isodow(d) < 6 AND strftime(d, '%Y-%m-%d') NOT IN ('""" + "', '".join(HOLIDAYS) + """') AS b FROM range(TIMESTAMP '1995-12-01', TIMESTAMP '1997-03-01', INTERVAL 1 DAY) t(d)),
k AS (SELECT date, b, sum(b::INT) OVER (ORDER BY date) AS k FROM c)"""



def asof_decision_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = funds(spark, sf_dir).select("fund_key", F.col("date").alias("quote_date"), "valor_cuota").withColumn("quote_available_date", F.date_add("quote_date", 1))
    decisions = q.select("fund_key").distinct().withColumn("decision_date", F.explode(F.sequence(F.lit(START).cast("date"), F.lit(END).cast("date"))))
    ds = asof.asof_join(decisions, q, "decision_date", "quote_available_date", KEYS).where("quote_date is not null")
    return ds.select("fund_key", "decision_date", "quote_date", "valor_cuota", F.datediff("decision_date", "quote_date").alias("quote_age_calendar_days"))


SCENARIO = scenarios.Scenario("cmf_date_news", "quote_date", 1, 2, holidays=HOLIDAYS)


def _scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = series.with_returns(funds(spark, sf_dir).select("fund_key", "date", "valor_cuota"), KEYS, "date", "valor_cuota")
    news = read(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").cast("double").alias("news_count"))
    return scenarios.scenario_dataset(f, news, START, END, 0.01, SCENARIO, KEYS)


def dataset_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["fund_key", "decision_date", "quote_date", "quote_available_date", "news_reference_date", "withdrawal_start_date", "future_exit_date", "target_available_date", "valor_cuota", "return_1d", "news_count", "quote_age_calendar_days", "decision_day_of_week", "decision_is_weekend", "future_valor_cuota", "future_return_h", "target_up", "prediction_scenario"]
    return shown(_scenario(spark, sf_dir), cols)


def exact_target_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_scenario(spark, sf_dir), ["fund_key", "decision_date", "future_exit_date", "future_valor_cuota", "target_up"])


def label_availability_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, evaluation = scenarios.split(_scenario(spark, sf_dir), START, "1996-06-30", "1996-07-01", END, "decision_date")
    both = train.withColumn("part", F.lit("train")).unionByName(evaluation.withColumn("part", F.lit("eval")))
    return both.groupBy("part", "fund_key").agg(F.count("*").alias("n"), F.min("decision_date").alias("first"), F.max("decision_date").alias("last"))


def dataset_legacy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = series.with_target(series.with_returns(funds(spark, sf_dir).select("fund_key", "date", "valor_cuota"), KEYS, "date", "valor_cuota"), KEYS, 5, 0.01)
    news = read(spark, sf_dir, "events").groupBy((F.date_sub(F.col("ts").cast("date"), 10227)).alias("date")).agg(F.count("*").cast("double").alias("news_count"), F.sum("value").alias("news_value"))
    return shown(scenarios.legacy_dataset(f, news), ["fund_key", "date", "return_1d", "news_count", "news_value", "future_valor_cuota", "future_return_h", "target_up"], 4)


def live_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = series.with_target(funds(spark, sf_dir), KEYS, 5, 0.01)
    return signals.live_rows(f, "2001-01-01", "2001-12-31").select("fund_key", "date", "valor_cuota")


def latest_common_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day on which every fund has a quote."""
    f = funds(spark, sf_dir)
    total = f.agg(F.countDistinct("fund_key").alias("total"))
    by = f.groupBy("date").agg(F.countDistinct("fund_key").alias("n"))
    return by.join(F.broadcast(total), F.col("n") == F.col("total")).agg(F.max("date").alias("latest"))


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed rule as the model: the chance falls with the last return."""
    f = series.features(funds(spark, sf_dir), KEYS)
    f = series.with_target(f, KEYS, 5, 0.0)
    p = F.round(1 / (1 + F.exp(4 * F.coalesce("return_lag_1", F.lit(0.0)))), 4)
    return f.withColumn("pred_prob_up", p).withColumn("pred_up", (F.col("pred_prob_up") >= 0.5).cast("int"))


_PREDICTED = f"""{FUNDS}, {RETURNS},
x AS (SELECT fund_key, date, valor_cuota, lag(return_1d) OVER w AS return_lag_1, lag(valor_cuota, 1) OVER w / lag(valor_cuota, 11) OVER w - 1 AS momentum_10,
  {_rolled('avg', 'valor_cuota', 20)} AS ma20, {_rolled('max', 'valor_cuota', 20)} AS max20, lead(valor_cuota, 5) OVER w AS future FROM r {W}),
p AS (SELECT *, valor_cuota / ma20 - 1 AS vs, valor_cuota / max20 - 1 AS dd, future / valor_cuota - 1 AS ret, round(1 / (1 + exp(4 * coalesce(return_lag_1, 0.0))), 4) AS prob FROM x),
q AS (SELECT *, (prob >= 0.5)::INT AS up, coalesce(ret > 0, false)::INT AS target_up FROM p)"""


def metrics_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = metrics.classification(_predicted(spark, sf_dir).where("future_valor_cuota > 0"), "target_up", "pred_up", KEYS)
    return shown(df, df.columns)


def metrics_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = metrics.auc(_predicted(spark, sf_dir).where("future_valor_cuota > 0"), "target_up", "pred_prob_up", KEYS)
    return shown(df, df.columns)


def _year(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _predicted(spark, sf_dir).where("future_valor_cuota > 0").where(F.col("date").between(F.lit(START), F.lit(END)))
    return p.withColumn("future_return_h", F.round(F.col("future_return_h") / 100, 6))


_STRATEGY = """s AS (SELECT fund_key, product(1 + r) - 1 AS buy_hold_return_compounded, product(1 + CASE WHEN up = 1 THEN r ELSE 0.0 END) - 1 AS strategy_return_compounded,
  coalesce(avg(CASE WHEN up = 1 THEN r END), 0.0) AS avg_future_return_when_pred_up, coalesce(avg(CASE WHEN up = 0 THEN r END), 0.0) AS avg_future_return_when_pred_down,
  count(*) FILTER (up = 1) AS signals_up_mantener, count(*) FILTER (up = 0) AS signals_down_mover_o_retirar
  FROM (SELECT *, round(ret / 100, 6) AS r FROM q WHERE future > 0 AND date BETWEEN '1996-01-01' AND '1996-12-31') GROUP BY 1)"""


def metrics_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = metrics.strategy(_year(spark, sf_dir), "pred_up", "future_return_h", KEYS)
    return shown(df, df.columns)


def score_risk_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = metrics.strategy(_year(spark, sf_dir), "pred_up", "future_return_h", KEYS)
    return df.select("fund_key", F.round(metrics.model_score("risk_adjusted"), 6).alias("model_score"), F.round(metrics.threshold_score("risk_adjusted", 500, 500), 6).alias("threshold_score"))


LIGHT = ["semaforo_cond_pred_up", "semaforo_cond_prob", "semaforo_cond_momentum_10", "semaforo_cond_valor_vs_ma20", "semaforo_cond_drawdown_20", "entry_score", "semaforo", "decision_if_out", "decision_if_in"]


def semaforo(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = signals.semaforo(_predicted(spark, sf_dir), 0.52)
    return df.select("fund_key", "date", "pred_prob_up", *LIGHT)


def semaforo_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = signals.semaforo(_predicted(spark, sf_dir), 0.52)
    return df.groupBy("semaforo", "entry_score").agg(F.count("*").alias("n"))


def prediction_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = signals.output(_predicted(spark, sf_dir), probability_threshold=0.52, target_threshold=0.0, horizon=5, decision_mode="strict_lag", decision_time=None, same_day_returns=True, live=False)
    return shown(df, ["fund_key", "date", "decision", "is_evaluable", "captured_return_if_follow_signal", "decision_mode", "probability_threshold"])


QUERIES = {
    f.__name__: f
    for f in (
        series_returns, series_lags, series_rolling_stats, series_momentum, series_ma_ratio, series_drawdown, series_netflow, series_calendar, series_target_legacy,
        fund_load_dedup, fund_series_choice, fund_series_preferred, calendar_business_offset, asof_decision_quotes, dataset_scenario, exact_target_lookup, label_availability_split,
        dataset_legacy_join, live_rows, latest_common_day, metrics_classification, metrics_auc_exact, metrics_strategy, score_risk_adjusted, semaforo, semaforo_distribution, prediction_output,
    )
}

_TARGET = f"t AS (SELECT *, lead(date, 5) OVER w AS future_exit_date, lead(valor_cuota, 5) OVER w AS future_valor_cuota FROM r {W})"
_SCEN = f"""{FUNDS}, {RETURNS}, {CALENDAR},
n AS (SELECT o_orderdate::DATE AS date, count(*)::DOUBLE AS news_count FROM orders GROUP BY 1),
d AS (SELECT DISTINCT fund_key, k.date AS decision_date FROM f, k WHERE k.date BETWEEN DATE '{START}' AND DATE '{END}'),
a AS (SELECT d.fund_key, d.decision_date, r.date AS quote_date, (r.date + 1)::DATE AS quote_available_date, r.valor_cuota, coalesce(r.return_1d, 0.0) AS return_1d
  FROM d ASOF JOIN r ON d.fund_key = r.fund_key AND d.decision_date >= (r.date + 1)::DATE),
b AS (SELECT a.*, coalesce(n.news_count, 0.0) AS news_count, w1.date AS withdrawal_start_date, w2.date AS future_exit_date
  FROM a LEFT JOIN n ON n.date = a.quote_date JOIN k ON k.date = a.decision_date JOIN k w1 ON w1.b AND w1.k = k.k + 1 JOIN k w2 ON w2.b AND w2.k = k.k + 2),
z AS (SELECT b.*, f.valor_cuota AS future_valor_cuota, f.valor_cuota / b.valor_cuota - 1 AS future_return_h, (future_exit_date + 1)::DATE AS target_available_date
  FROM b LEFT JOIN f ON f.fund_key = b.fund_key AND f.date = b.future_exit_date)"""
_COLS = lambda names, digits=6: ", ".join(f"round({c}, {digits}) AS {c}" for c in names)

ORACLE_SQL = {
    "series_returns": f"WITH {FUNDS}, {RETURNS} SELECT fund_key, date, round(valor_cuota, 6) AS valor_cuota, {_COLS(['return_1d', 'log_return_1d'])} FROM r",
    "series_lags": f"WITH {FUNDS}, {RETURNS} SELECT fund_key, date, " + ", ".join(f"round(lag({c}, {k}) OVER w, 6) AS {n}" for c, k, n in [("return_1d", 1, "return_1d_lag1_safe"), ("log_return_1d", 1, "log_return_1d_lag1_safe"), *((f"{p}return_1d", k, f"{p}return_lag_{k}") for k in series.LAGS for p in ("", "log_"))]) + f" FROM r {W}",
    "series_rolling_stats": f"WITH {FUNDS}, {RETURNS} SELECT fund_key, date, " + ", ".join(f"round({_rolled(h, 'return_1d', k)}, 6) AS return_roll_{n}_{k}" for k in series.WINDOWS for h, n in (("avg", "mean"), ("stddev_samp", "std"))) + " FROM r",
    "series_momentum": f"WITH {FUNDS} SELECT fund_key, date, " + ", ".join(f"round(lag(valor_cuota, 1) OVER w / lag(valor_cuota, {k + 1}) OVER w - 1, 6) AS momentum_{k}" for k in series.WINDOWS) + f" FROM f {W}",
    "series_ma_ratio": f"WITH {FUNDS}, m AS (SELECT *, " + ", ".join(f"{_rolled('avg', 'valor_cuota', k)} AS ma{k}" for k in series.AVERAGES) + " FROM f) SELECT fund_key, date, " + ", ".join(f"round(ma{k}, 6) AS valor_cuota_ma_{k}" for k in series.AVERAGES) + ", round(valor_cuota / ma20 - 1, 6) AS valor_cuota_vs_ma20, round(ma5 / ma20 - 1, 6) AS ma5_vs_ma20 FROM m",
    "series_drawdown": f"WITH {FUNDS}, m AS (SELECT *, {_rolled('max', 'valor_cuota', 20)} AS x FROM f) SELECT fund_key, date, round(x, 6) AS rolling_max_20, round(valor_cuota / x - 1, 6) AS drawdown_20 FROM m",
    "series_netflow": f"""WITH {FUNDS}, g AS (SELECT *, "CUOTAS_APORTADAS" - "CUOTAS_RESCATADAS" AS nf, "PATRIMONIO_NETO" / lag("PATRIMONIO_NETO") OVER w - 1 AS pr, "NUM_PARTICIPES" - lag("NUM_PARTICIPES") OVER w AS pc FROM f {W})
SELECT fund_key, date, round(nf, 4) AS net_flow_cuotas_raw, round(lag(nf, 1) OVER w, 4) AS net_flow_cuotas_lag1, round(lag(nf, 2) OVER w, 4) AS net_flow_cuotas_lag2, """ + ", ".join(f"round({_rolled('sum', 'nf', k)}, 4) AS net_flow_cuotas_roll{k}_lag1" for k in (3, 5, 10)) + f", round(pr, 4) AS patrimonio_return_1d, round(lag(pr) OVER w, 4) AS patrimonio_return_lag1, round(pc, 4) AS participes_change_1d, round(lag(pc) OVER w, 4) AS participes_change_lag1 FROM g {W}",
    "series_calendar": f"WITH {FUNDS} SELECT fund_key, date, (isodow(date) - 1)::INT AS day_of_week, day(date)::INT AS day_of_month, month(date)::INT AS month, (day(date) = 1)::INT AS is_month_start, (date = last_day(date))::INT AS is_month_end, (isodow(date) > 5)::INT AS is_weekend_fund_date FROM f",
    "series_target_legacy": f"WITH {FUNDS}, {RETURNS}, {_TARGET} SELECT fund_key, date, future_exit_date, round(future_valor_cuota, 6) AS future_valor_cuota, round(future_valor_cuota / valor_cuota - 1, 6) AS future_return_h, coalesce(future_valor_cuota / valor_cuota - 1 > 0.01, false)::INT AS target_up FROM t",
    "fund_load_dedup": "SELECT l_returnflag AS fund_key, l_shipdate::DATE AS date, arg_max(l_extendedprice, {'a': l_orderkey, 'b': l_linenumber, 'c': l_extendedprice}) AS valor_cuota FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1, 2",
    "fund_series_choice": "WITH m AS (SELECT l_linestatus AS fund_key, l_returnflag AS s, avg(l_extendedprice) AS m FROM lineitem GROUP BY 1, 2) SELECT fund_key, s AS selected_series, round(m, 4) AS mean_weight FROM m QUALIFY row_number() OVER (PARTITION BY fund_key ORDER BY m DESC, s) = 1",
    "fund_series_preferred": "SELECT l_linestatus AS fund_key, CASE WHEN bool_or(l_returnflag = 'R') THEN 'R' WHEN bool_or(l_returnflag = 'A') THEN 'A' ELSE 'N' END AS selected_series FROM lineitem GROUP BY 1",
    "calendar_business_offset": f"WITH {CALENDAR} SELECT k.date, a.date AS plus_1, d.date AS plus_4 FROM k JOIN k a ON a.b AND a.k = k.k + 1 JOIN k d ON d.b AND d.k = k.k + 4 WHERE k.date BETWEEN DATE '{START}' AND DATE '{END}'",
    "asof_decision_quotes": f"WITH {_SCEN} SELECT fund_key, decision_date, quote_date, valor_cuota, datediff('day', quote_date, decision_date)::INT AS quote_age_calendar_days FROM a",
    "dataset_scenario": f"WITH {_SCEN} SELECT fund_key, decision_date, quote_date, quote_available_date, quote_date AS news_reference_date, withdrawal_start_date, future_exit_date, target_available_date, {_COLS(['valor_cuota', 'return_1d', 'news_count', 'future_valor_cuota', 'future_return_h'])}, datediff('day', quote_date, decision_date)::INT AS quote_age_calendar_days, (isodow(decision_date) - 1)::INT AS decision_day_of_week, (isodow(decision_date) > 5)::INT AS decision_is_weekend, (future_return_h > 0.01)::DOUBLE AS target_up, 'cmf_date_news' AS prediction_scenario FROM z",
    "exact_target_lookup": f"WITH {_SCEN} SELECT fund_key, decision_date, future_exit_date, round(future_valor_cuota, 6) AS future_valor_cuota, (future_return_h > 0.01)::DOUBLE AS target_up FROM z",
    "label_availability_split": f"WITH {_SCEN}, v AS (SELECT *, CASE WHEN decision_date <= DATE '1996-06-30' AND target_available_date <= DATE '1996-06-30' THEN 'train' WHEN decision_date >= DATE '1996-07-01' THEN 'eval' END AS part FROM z WHERE future_valor_cuota > 0) SELECT part, fund_key, count(*) AS n, min(decision_date) AS \"first\", max(decision_date) AS \"last\" FROM v WHERE part IS NOT NULL GROUP BY 1, 2",
    "dataset_legacy_join": f"WITH {FUNDS}, {RETURNS}, {_TARGET}, n AS (SELECT (ts::DATE - 10227)::DATE AS date, count(*)::DOUBLE AS news_count, sum(value) AS news_value FROM events GROUP BY 1) SELECT fund_key, t.date, round(coalesce(return_1d, 0.0), 4) AS return_1d, coalesce(news_count, 0.0) AS news_count, round(coalesce(news_value, 0.0), 4) AS news_value, round(coalesce(future_valor_cuota, 0.0), 4) AS future_valor_cuota, round(coalesce(future_valor_cuota / valor_cuota - 1, 0.0), 4) AS future_return_h, coalesce(future_valor_cuota / valor_cuota - 1 > 0.01, false)::INT AS target_up FROM t LEFT JOIN n ON n.date = t.date",
    "live_rows": f"WITH {FUNDS}, {RETURNS}, {_TARGET} SELECT fund_key, date, valor_cuota FROM t WHERE date BETWEEN DATE '2001-01-01' AND DATE '2001-12-31' AND (future_valor_cuota <= 0 OR future_valor_cuota IS NULL)",
    "latest_common_day": f"WITH {FUNDS} SELECT max(date) AS latest FROM (SELECT date FROM f GROUP BY date HAVING count(DISTINCT fund_key) = (SELECT count(DISTINCT fund_key) FROM f))",
    "metrics_classification": f"""WITH {_PREDICTED}, c AS (SELECT fund_key, count(*) FILTER (target_up = 0 AND up = 0) AS tn, count(*) FILTER (target_up = 0 AND up = 1) AS fp, count(*) FILTER (target_up = 1 AND up = 0) AS fn, count(*) FILTER (target_up = 1 AND up = 1) AS tp FROM q WHERE future > 0 GROUP BY 1)
SELECT fund_key, tn, fp, fn, tp, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy, round(tp / (tp + fp), 6) AS precision_up, round(tp / (tp + fn), 6) AS recall_up, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_up FROM c""",
    "metrics_auc_exact": f"WITH {_PREDICTED}, a AS (SELECT fund_key, target_up, rank() OVER (PARTITION BY fund_key ORDER BY prob) + (count(*) OVER (PARTITION BY fund_key, prob) - 1) / 2 AS mid FROM q WHERE future > 0) SELECT fund_key, round((sum(CASE WHEN target_up = 1 THEN mid ELSE 0 END) - sum(target_up) * (sum(target_up) + 1) / 2) / (sum(target_up) * (count(*) - sum(target_up))), 6) AS roc_auc FROM a GROUP BY 1",
    "metrics_strategy": f"WITH {_PREDICTED}, {_STRATEGY} SELECT fund_key, {_COLS(['buy_hold_return_compounded', 'strategy_return_compounded', 'avg_future_return_when_pred_up', 'avg_future_return_when_pred_down'])}, signals_up_mantener, signals_down_mover_o_retirar, round(strategy_return_compounded - buy_hold_return_compounded, 6) AS strategy_improvement_vs_buy_hold FROM s",
    "score_risk_adjusted": f"""WITH {_PREDICTED}, {_STRATEGY}, b AS (SELECT *, avg_future_return_when_pred_up AS u, avg_future_return_when_pred_down AS d, strategy_return_compounded - buy_hold_return_compounded + 0.5 * strategy_return_compounded + 0.5 * (avg_future_return_when_pred_up - avg_future_return_when_pred_down) AS s0, CASE WHEN avg_future_return_when_pred_up <= avg_future_return_when_pred_down THEN 0.02 + abs(avg_future_return_when_pred_down - avg_future_return_when_pred_up) ELSE 0.0 END AS pen FROM s)
SELECT fund_key, round(s0 - pen, 6) AS model_score, round(s0 - 0.02 * (greatest(0, 500 - signals_up_mantener) + greatest(0, 500 - signals_down_mover_o_retirar)) - CASE WHEN signals_up_mantener > 0 AND signals_down_mover_o_retirar > 0 THEN pen ELSE 0.0 END, 6) AS threshold_score FROM b""",
}
_LIGHT = f"""WITH {_PREDICTED}, l AS (SELECT *, up AS c1, (prob >= 0.52)::INT AS c2, coalesce(momentum_10 > 0, false)::INT AS c3, coalesce(vs > 0, false)::INT AS c4, coalesce(dd > -0.04, false)::INT AS c5 FROM q),
g AS (SELECT *, CASE WHEN c1 + c2 = 2 AND c3 + c4 + c5 = 3 THEN 'verde' WHEN c3 + c4 + c5 = 0 OR (c1 + c2 < 2 AND c3 + c4 + c5 <= 1) THEN 'rojo' ELSE 'amarillo' END AS semaforo, c1 + c2 + c3 + c4 + c5 AS entry_score FROM l)"""
ORACLE_SQL |= {
    "semaforo": _LIGHT + " SELECT fund_key, date, prob AS pred_prob_up, c1 AS semaforo_cond_pred_up, c2 AS semaforo_cond_prob, c3 AS semaforo_cond_momentum_10, c4 AS semaforo_cond_valor_vs_ma20, c5 AS semaforo_cond_drawdown_20, entry_score, semaforo, CASE semaforo WHEN 'verde' THEN 'entrar' ELSE 'esperar' END AS decision_if_out, CASE semaforo WHEN 'verde' THEN 'mantener' WHEN 'amarillo' THEN 'mantener_con_alerta' ELSE 'salir_o_mover_defensivo' END AS decision_if_in FROM g",
    "semaforo_distribution": _LIGHT + " SELECT semaforo, entry_score, count(*) AS n FROM g GROUP BY 1, 2",
    "prediction_output": f"WITH {_PREDICTED} SELECT fund_key, date, CASE WHEN up = 1 THEN 'mantener' ELSE 'mover_o_retirar' END AS decision, coalesce(future > 0, false) AS is_evaluable, round(CASE WHEN up = 1 THEN ret ELSE 0.0 END, 6) AS captured_return_if_follow_signal, 'strict_lag' AS decision_mode, 0.52::DOUBLE AS probability_threshold FROM q",
}

"""Series features against pandas, as-of joins, calendars, leakage."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, calendars, metrics, series, signals
from tidemark.plans import scenarios


def _series(seed: int, n: int = 60) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    days = pd.to_datetime("2024-01-01") + pd.to_timedelta(np.cumsum(rng.integers(1, 4, n)), "D")
    return pd.DataFrame({"fund_key": f"f{seed}", "date": days.date, "valor_cuota": 100 * np.exp(np.cumsum(rng.normal(0, 0.01, n))), "CUOTAS_APORTADAS": rng.integers(0, 9, n) * 1.0, "CUOTAS_RESCATADAS": rng.integers(0, 9, n) * 1.0, "PATRIMONIO_NETO": rng.random(n) + 1, "NUM_PARTICIPES": rng.integers(10, 20, n) * 1.0})


@pytest.fixture(scope="module")
def both(spark):
    pdf = pd.concat([_series(1), _series(2, 15), _series(3, 1)])
    got = series.with_target(series.features(spark.createDataFrame(pdf), ["fund_key"]), ["fund_key"], 3, 0.01).toPandas().sort_values(["fund_key", "date"])
    parts = []
    for _, g in pdf.groupby("fund_key"):
        g = g.sort_values("date").copy()
        v, r = g.valor_cuota, g.valor_cuota.pct_change()
        g["return_1d"] = r
        for w in series.WINDOWS:
            g[f"return_roll_mean_{w}"], g[f"return_roll_std_{w}"] = r.rolling(w).mean().shift(1), r.rolling(w).std().shift(1)
            g[f"momentum_{w}"] = v.pct_change(w).shift(1)
        g["valor_cuota_vs_ma20"] = v / v.rolling(20).mean().shift(1) - 1
        g["drawdown_20"] = v / v.rolling(20).max().shift(1) - 1
        g["net_flow_cuotas_roll5_lag1"] = (g.CUOTAS_APORTADAS - g.CUOTAS_RESCATADAS).rolling(5).sum().shift(1)
        g["future_return_h"] = v.shift(-3) / v - 1
        parts.append(g)
    return got, pd.concat(parts)


@pytest.mark.parametrize("column", ["return_1d", "return_roll_mean_3", "return_roll_std_10", "momentum_20", "valor_cuota_vs_ma20", "drawdown_20", "net_flow_cuotas_roll5_lag1", "future_return_h"])
def test_like_pandas(both, column):
    got, want = both
    np.testing.assert_allclose(got[column].astype(float), want[column].astype(float), atol=1e-10, equal_nan=True)


def test_unknown_future_is_no_rise(both):
    got, _ = both
    assert (got[got.future_return_h.isna()].target_up == 0).all()


def test_asof_is_inclusive_and_backward(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("b", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 5, 51), ("c", 1, 1)], "k string, r int, v int")
    got = {(r.k, r.t): r.v for r in asof.asof_join(left, right, "t", "r", ["k"]).collect()}
    assert got == {("a", 1): None, ("a", 5): 51, ("a", 9): 51, ("b", 5): None}
    strict = {(r.k, r.t): r.v for r in asof.asof_join(left, right, "t", "r", ["k"], strict=True).collect()}
    assert strict[("a", 5)] == 20
    with pytest.raises(ValueError, match="both sides"):
        asof.asof_join(left, right.withColumnRenamed("v", "t"), "t", "r", ["k"])


def test_business_days(spark):
    holidays = ["2024-01-01", "2024-01-17"]
    c = calendars.business_calendar(spark, "2023-12-01", "2024-03-01", holidays=holidays)
    got = calendars.business_offset(calendars.days(spark, "2024-01-01", "2024-01-31"), c, "date", 4, "x").toPandas()
    off = pd.offsets.CustomBusinessDay(holidays=holidays)
    for d, x in zip(got.date, got.x):
        assert pd.Timestamp(x) == pd.Timestamp(d) + 4 * off


def _quotes(spark, pdf):
    return series.with_returns(spark.createDataFrame(pdf[["fund_key", "date", "valor_cuota"]]), ["fund_key"], "date", "valor_cuota")


def test_unpublished_quotes_change_no_feature(spark):
    pdf = _series(1)
    start, end = pdf.date.iloc[10], pdf.date.iloc[20]
    s = scenarios.Scenario("cmf_date_news", quote_lag_days=2, horizon_business_days=1)
    news = spark.createDataFrame([(d, float(k)) for k, d in enumerate(pdf.date)], "date date, news_count double")
    one = scenarios.scenario_dataset(_quotes(spark, pdf), news, start, end, 0.0, s, ["fund_key"]).toPandas()
    changed = pdf.copy()
    changed.loc[pd.to_datetime(changed.date) > pd.Timestamp(end - timedelta(days=2)), "valor_cuota"] *= 7
    two = scenarios.scenario_dataset(_quotes(spark, changed), news, start, end, 0.0, s, ["fund_key"]).toPandas()
    cols = ["decision_date", "quote_date", "valor_cuota", "return_1d", "news_count", "quote_age_calendar_days"]
    pd.testing.assert_frame_equal(one[cols].sort_values("decision_date", ignore_index=True), two[cols].sort_values("decision_date", ignore_index=True))
    assert (pd.to_datetime(one.quote_date) + pd.Timedelta(days=2) <= pd.to_datetime(one.decision_date)).all()


def test_missing_target_stays_unknown_and_late_labels_dont_train(spark):
    pdf = _series(1)
    s = scenarios.Scenario("x", quote_lag_days=1, horizon_business_days=1)
    news = spark.createDataFrame([], "date date, news_count double")
    ds = scenarios.scenario_dataset(_quotes(spark, pdf), news, pdf.date.iloc[5], pdf.date.iloc[40], 0.0, s, ["fund_key"])
    rows = ds.toPandas()
    known = set(pdf.date)
    assert all((e in known) == (not np.isnan(v)) for e, v in zip(rows.future_exit_date, rows.future_valor_cuota.astype(float)))
    cut = pdf.date.iloc[20]
    train, _ = scenarios.split(ds, pdf.date.iloc[5], cut, cut + timedelta(days=1), pdf.date.iloc[40], "decision_date")
    assert train.agg(F.max("target_available_date")).first()[0] <= cut
    with pytest.raises(ValueError):
        scenarios.split(ds, cut, cut, cut, cut, "decision_date")


def test_scenario_identity():
    s = scenarios.Scenario("cmf_date_news", horizon_business_days=4)
    assert s.label(s.label("night")) == s.label("night") and s.signature() != scenarios.Scenario("cmf_date_news").signature()
    assert scenarios.report_tag([scenarios.Scenario()]) == "" and scenarios.report_tag([s]).startswith("_cmf_date_news_")
    with pytest.raises(ValueError):
        scenarios.Scenario("x", quote_lag_days=0)


def test_light_truth_table(spark):
    rows = [(up, p, m, v, d) for up in (0, 1) for p in (0.4, 0.6) for m in (0.0, 0.1) for v in (0.0, 0.1) for d in (-0.04, 0.0)]
    df = spark.createDataFrame(rows, "pred_up int, pred_prob_up double, momentum_10 double, valor_cuota_vs_ma20 double, drawdown_20 double")
    for r in signals.semaforo(df, 0.6).collect():
        model, tech = r.pred_up == 1 and r.pred_prob_up >= 0.6, (r.momentum_10 > 0) + (r.valor_cuota_vs_ma20 > 0) + (r.drawdown_20 > -0.04)
        want = "verde" if model and tech == 3 else "rojo" if tech == 0 or not model and tech <= 1 else "amarillo"
        assert r.semaforo == want and (r.decision_if_out == "entrar") == (want == "verde")
    bare = signals.semaforo(spark.createDataFrame([(1,)], "pred_up int"), 0.5).first()
    assert bare.semaforo == "amarillo" or bare.entry_score == 2


def test_metrics_with_one_class_and_total_loss(spark):
    df = spark.createDataFrame([(1, 1, 0.9, -1.0), (1, 0, 0.2, 0.1)], "y int, g int, p double, r double")
    assert metrics.auc(df, "y", "p").first().roc_auc is None
    m = metrics.classification(df, "y", "g").first()
    assert m.balanced_accuracy == 0.5 and m.precision_up == 1.0
    s = metrics.strategy(df, "g", "r").first()
    assert s.buy_hold_return_compounded == -1.0 and s.avg_future_return_when_pred_down == pytest.approx(0.1)
    with pytest.raises(ValueError):
        metrics.model_score("nonsense")


def test_series_choice(spark):
    df = spark.createDataFrame([("f", "A", 1.0), ("f", "B", 9.0), ("g", "A", 1.0), ("g", "Z", None)], "k string, s string, w double")
    got = {r.k: r.selected_series for r in series.choose_series(df, ["k"], "s", ["Z"], "w").collect()}
    assert got == {"f": "B", "g": "Z"}


def test_days_of_a_split():
    assert scenarios.split_days("2024-01-01", "2024-01-10", 70) == ("2024-01-07", "2024-01-08")
    assert date.fromisoformat(scenarios.split_days("2024-01-01", "2024-01-02", 1)[0]) == date(2024, 1, 1)

"""Learning, search, configuration, streams, reports, registered queries."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boost, cluster
from tidemark.plans import catalog, config, learning, reports
from tidemark.streaming import news

SMALL = "/root/testdata/sf0.001"


def test_boosting_learns_and_repeats():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    p = boost.merged({"n_estimators": 60, "learning_rate": 0.2})
    m = boost.Booster(p).fit(x[:300], y[:300])
    assert ((m.predict(x[300:]) >= 0.5) == y[300:]).mean() > 0.85
    assert np.array_equal(m.predict(x), boost.Booster(p).fit(x[:300], y[:300]).predict(x))
    assert m.importance().argmax() == 0 and m.importance().sum() == pytest.approx(1)
    assert boost.tuned(x[:50], y[:50], 1.0, 3) == boost.merged()


def test_models_are_saved_and_checked(tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 3))
    e = learning.Experiment("f", 0.4, 0.01)
    m = boost.Booster(boost.merged({"n_estimators": 5})).fit(x, (x[:, 0] > 0).astype(float))
    path = str(tmp_path / "m.json")
    learning.save_model(path, m, e, ["a", "b", "c"])
    again, _ = learning.load_model(path, e)
    assert np.allclose(again.predict(x), m.predict(x))
    with pytest.raises(ValueError):
        learning.load_model(path, learning.Experiment("f", 0.5))
    assert e.key() == "f_strict_lag_prob0p400_target0p0100"


def test_few_rows_are_a_note(spark):
    df = spark.createDataFrame([("f", date(2024, 1, k + 1), [float(k)], 0.1) for k in range(9)], "fund_key string, day date, x array<double>, future_return double")
    r = learning.train_predict(df, [learning.Experiment("f")], ("2024-01-01", "2024-01-05", "2024-01-06", "2024-01-09")).collect()
    assert len(r) == 1 and "5 training rows" in r[0].note


def test_search_is_seeded_and_bounded():
    s = learning.Search({"a": (0.01, 1.0, "log"), "n": (1, 9, "int"), "m": (["x", "y"], None, "choice")}, start=3)
    history: list = []
    for _ in range(12):
        t = s.propose(history)[0]
        assert 0.01 <= t["a"] <= 1 and 1 <= t["n"] <= 9 and t["m"] in ("x", "y")
        history.append((t, -abs(t["n"] - 5)))
    assert s.propose(history) == s.propose(history)


def test_runtime_configuration():
    presets = {"presets": {"national_equity_dia": {"probability_threshold": 0.3}}, "scenarios": {"national_equity_dia": {"decision_date_news": {"quote_lag_days": 3}}}, "models": {"national_equity_dia": {"max_depth": 2}}}
    c = config.runtime("national_equity_dia", presets, overrides={"target_threshold": 0.02})
    assert (c["probability_threshold"], c["target_threshold"], c["decision_mode"], c["params"]) == (0.3, 0.02, "same_day_close", {"max_depth": 2})
    s = config.scenario_of("national_equity_dia", c)
    assert s.quote_lag_days == 3 and s.horizon_business_days == 2
    assert config.selected(["ALL"]) == list(config.FUNDS)
    with pytest.raises(ValueError):
        config.selected(["nothing"])
    assert config.option_by_terms([("1", "Fondo Á"), ("2", "Otro")], terms=["fondo"]) == ("1", "Fondo Á")


def test_days_to_load():
    assert news.days_to_load(None, date(2024, 1, 9)) == 3
    assert news.days_to_load("2024-01-09", date(2024, 1, 9)) == 2
    assert news.days_to_load("2024-01-01", date(2024, 1, 9)) == 8
    for last in ("2023-01-01", "2025-01-01"):
        with pytest.raises(RuntimeError):
            news.days_to_load(last, date(2024, 1, 9))


def test_one_run_at_a_time(tmp_path):
    lock = str(tmp_path / "lock")
    with news.exclusive(lock), pytest.raises(RuntimeError), news.exclusive(lock):
        pass
    news.save_success(str(tmp_path / "s.json"), "m", date(2024, 1, 2), "now")
    assert news.load_state(str(tmp_path / "s.json"))["m"]["last_successful_date"] == "2024-01-02"
    assert not news.succeeded([]) and not news.succeeded([{"status": "error"}])


def test_stream_drops_copies_and_goes_on(tmp_path, spark):
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("t"))
    src = str(tmp_path / "in")
    rows(0, 10).unionByName(rows(0, 5)).write.mode("append").parquet(src)

    def load() -> int:
        s = news.read_stream(spark, src, "k long, t timestamp")
        news.available_now(news.deduplicated(s, "k", "t", "30 days"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert load() == 10
    rows(5, 12).write.mode("append").parquet(src)
    assert load() == 12


def test_rebuild_only_what_changed(tmp_path, spark):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    seen = []

    def build(df):
        seen.append(df.count())
        return df

    for values in ([(1, "a"), (2, "b")], [(1, "a"), (2, "c")]):
        spark.createDataFrame(values, "k int, h string").write.mode("append").parquet(src)
        news.rebuild_changed(news.read_stream(spark, src, "k int, h string"), "k", "h", build, out, state).awaitTermination()
    assert sum(seen[:1]) == 2 and sum(seen[1:]) == 1


def test_clusters_find_groups():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.1, (40, 2)), rng.normal(5, 0.1, (40, 2)), rng.uniform(-20, 20, (8, 2))])
    label = cluster.hdbscan(x)
    assert len(set(label[:40])) == 1 and len(set(label[40:80])) == 1 and label[0] != label[40] and label[0] >= 0
    assert (cluster.hdbscan(x[:5]) == -1).all()


def test_clusters_are_of_density_at_every_size(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([np.repeat(rng.normal(0, 1, (70, 16)), 140, 0) + rng.normal(0, 0.1, (9800, 16)), rng.normal(0, 3, (300, 16))])
    rows = [(int(i), v) for i, v in enumerate(x.tolist())]
    got = {r.k: r.cluster for r in cluster.clusters(spark.createDataFrame(rows, "k int, v array<double>"), "k", "v").collect()}
    label = np.array([got[k] for k in range(len(x))])
    whole = cluster.hdbscan(x)
    assert len(x) > 10_000 and (label == -1).sum() > 50 and ((label < 0) == (whole < 0)).all() and len(set(zip(label, whole))) == len(set(label)) == len(set(whole))
    main = [np.bincount(g[g >= 0]).argmax() for g in label[:9800].reshape(70, 140)]
    assert len(set(main)) == 70


def test_clusters_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.2, (120, 3)), rng.normal(4, 0.3, (150, 3)), np.full((40, 3), 9.0), rng.uniform(-20, 20, (90, 3))])
    df = spark.createDataFrame([(int(i), v) for i, v in enumerate(x.tolist())], "k int, v array<double>")
    seen = []
    for block in (10_000, 50):
        monkeypatch.setattr(cluster, "BLOCK", block)
        got = {r.k: r.cluster for r in cluster.clusters(df, "k", "v").collect()}
        seen.append([got[k] for k in range(len(x))])
    seen.append(cluster.hdbscan(x).tolist())
    assert -1 in seen[0] and len(set(seen[0])) >= 4 and seen[0][270] >= 0
    for other in seen[1:]:
        assert len(set(zip(seen[0], other))) == len(set(seen[0])) == len(set(other)) and [c < 0 for c in seen[0]] == [c < 0 for c in other]


def test_reports(tmp_path, spark):
    assert reports.flat({"a": 1, "b": [1], "metrics": {"x": 0.5, "cm": [[1]]}}) == {"a": 1, "metric_x": 0.5}
    reports.write_atomic(str(tmp_path / "d" / "r.json"), [{"a": 1}])
    assert reports.read_reports(spark, str(tmp_path / "d" / "r.json")).first().a == 1
    q = spark.createDataFrame([("f", 1), ("g", 1), ("f", 2)], "fund string, day int")
    n = spark.createDataFrame([("m", 1), ("m", 2)], "medium string, day int")
    assert reports.latest_common_day(q, n, "fund", "medium", 2, 1).first().latest == 1


def test_stages_are_built_once(tmp_path, spark):
    from tidemark.plans import stages

    built = []

    def build():
        built.append(1)
        return spark.range(3)

    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, v string")
    key = stages.fingerprint(stages.input_fingerprint(df), {"b": 1, "a": 2}, build)
    assert key == stages.fingerprint(stages.input_fingerprint(df.orderBy(F.desc("i"))), {"a": 2, "b": 1}, build)
    assert stages.input_fingerprint(df) != stages.input_fingerprint(df.where("i = 1"))
    for _ in range(2):
        assert stages.kept(spark, str(tmp_path), "s", key, build).count() == 3
    assert len(built) == 1


def test_mining_report(spark):
    from tidemark.plans import stages

    docs = spark.createDataFrame([(k, "alza del cobre " * 2 if k % 2 else "baja del dolar", "a" if k < 8 else "b") for k in range(12)], "k int, t string, s string")
    r = stages.mining_report(docs, "k", "t", "s", min_df=2)
    assert r["metadata"]["sections"] == {"a": 8, "b": 4} and len(r["b"]["samples"]) == 4
    assert {x["term"] for x in r["a"]["ngrams_top"]} >= {"cobre", "dolar", "baja del"}


@pytest.mark.parametrize("name", ["semaforo", "dataset_scenario", "family_match", "enrich_audit", "news_rolling", "mine_ngrams", "url_article_key", "discovery_merge", "html_extract_struct", "stream_dedup_daily", "report_table"])
def test_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SMALL).count() > 0


def test_every_sql_has_its_query():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)

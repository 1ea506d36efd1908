"""Text, dates, addresses, matching, identity, pages."""

from __future__ import annotations

import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.operators import daily, enrich, html, identity, matching, mining, normalise
from tidemark.sources import dictionaries, funds, news, pages


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_match_text_agrees_with_the_driver(spark):
    texts = ["El <b>Banco Central</b> &amp; la CMF", "Donald, Trump", "EE.UU. y José Antonio Kast", "DÓLAR:  sube 3,5%", None, "", "ﬁnanzas Ñandú"]
    assert column(spark, texts, lambda c: T.match_text(c, exact=True)) == [T.match_term(t) for t in texts]
    assert T.match_term("EE.UU.") == "estados_unidos" and T.match_term("ministro de hacienda") == "ministro_de_hacienda"


def test_safe_names_and_numbers(spark):
    assert column(spark, ["  Ñandú-Río  ", "", None, "a__b", "x" * 99], T.safe_name) == ["nandu_rio", "unknown", "unknown", "a_b", "x" * 80]
    assert column(spark, ["1,5", "1.234,5", "", None, " 7 "], T.to_number) == [1.5, None, None, None, 7.0]
    assert column(spark, ["“a” \"b\" \"c"], T.quotes_scraped) == [2]


def test_mojibake_and_html(spark):
    assert column(spark, ["dÃ©ficit", "fine", None], T.repair_mojibake) == ["déficit", "fine", ""]
    assert column(spark, ["<p>a</p><script>x</script> &amp; b", "1 < 2"], T.strip_html) == ["a & b", "1 < 2"]
    assert column(spark, [" https://x.cl/publicidad ", "ver publicidad  aqui"], lambda c: T.prose(c, ["publicidad"])) == ["https://x.cl/publicidad", "ver aqui"]


def test_publication_times(spark):
    values = ["4 enero, 2026", "Lunes 25 mayo 2026 | 09:30", "2026-05-01", "2026-05-01T23:30:00-04:00", "2026-05-01T23:30:00Z", "ayer", "31 febrero 2026", None]
    got = column(spark, values, D.publication)
    assert [(r.day.isoformat(), r.clock) if r else None for r in got] == [("2026-01-04", ""), ("2026-05-25", "09:30:00"), ("2026-05-01", ""), ("2026-05-01", "23:30:00"), ("2026-05-01", "19:30:00"), None, None, None]


def test_clock_cutoff_is_inclusive_and_unknown_is_out(spark):
    df = spark.createDataFrame([("21:30:00", ""), ("21:30:01", ""), ("", ""), ("", "2026-01-01T21:29:00-03:00"), ("9:05", "")], "t string, a string")
    df = df.withColumn("c", D.article_clock("t", "a"))
    assert [r.t or r.a for r in df.where(F.col("c") <= "21:30:00").collect()] == ["21:30:00", "2026-01-01T21:29:00-03:00", "9:05"]


def test_ranges_and_user_dates(spark):
    r = D.ranges(date(2024, 1, 1), date(2024, 2, 5))
    assert r == [(date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 5))]
    one = spark.range(1).select(D.ranges_column(F.lit("2024-01-01").cast("date"), F.lit("2024-02-05").cast("date")).alias("r")).first().r
    assert [(x.start, x.end) for x in one] == r
    assert D.parse_date("05/02/2024") == date(2024, 2, 5) and D.parse_time("21:30") == "21:30:00"
    with pytest.raises(ValueError):
        D.parse_date("2024")
    assert column(spark, ["05_02_2024", "5_2_2024", "x"], D.folder_date) == [date(2024, 2, 5), None, None]


SAME = ["http://www.x.cl/a/b/?utm_source=q&b=2&a=1#top", "https://x.cl/a/b?a=1&b=2&fbclid=9", "https://X.cl:443/a/b/?b=2&a=1&UTM_medium=z"]


def test_article_keys(spark):
    assert set(column(spark, SAME, U.article_key)) == {"https://x.cl/a/b?a=1&b=2"}
    assert column(spark, ["ftp://x.cl/a", "", None, "/a"], U.article_key) == ["", "", "", ""]
    assert column(spark, ["https://x.cl/2024/05/06/a", "https://x.cl/2024/13/06/a"], U.url_date) == [date(2024, 5, 6), None]


def test_ngram_join_equals_patterns(spark):
    random.seed(4)
    words = ["aaa", "bbb", "ccc", "ddd"]
    texts = ["".join(random.choice(words) + random.choice([" ", "  ", ", ", "-", "_", ". "]) for _ in range(random.randint(0, 12))) for _ in range(200)]
    terms = {"f": {"aaa": 1.0, "aaa bbb": 2.0, "bbb ccc ddd": 1.0, "ccc-ddd": 1.5, "ddd_aaa": 1.0}}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").withColumn("t", T.match_text("v"))
    got = {(r.i, r.norm_term): r.occurrences for r in matching.term_counts(df, "i", "t", matching.dictionary(spark, terms)).collect()}
    norm = {r.i: r.t for r in df.select("i", "t").collect()}
    want = {}
    for i, t in norm.items():
        for term in terms["f"]:
            pattern = r"(?<![a-z0-9_])" + re.escape(term).replace(r"\ ", r"\s+") + r"(?![a-z0-9_])"
            if n := len(re.findall(pattern, t)):
                want[i, term] = n
    assert got == want


def test_family_scores_and_rules(spark):
    d = matching.dictionary(spark, {"riesgo_alerta": {"crisis": 2.0, "alerta": 1.7}, "sentimiento_negativo": {"crisis": 1.8}, "geopolitico_mercado": {"irán": 2.8}})
    docs = spark.createDataFrame([(1, "crisis crisis alerta Irán", "Mundo"), (2, "nada", "Deportes")], "i int, v string, section string").withColumn("t", T.match_text("v"))
    m = matching.family_matches(matching.term_counts(docs, "i", "t", d), "i")
    risk = m.where("i = 1 and family = 'riesgo_alerta'").first()
    assert risk.hits == ["crisis", "alerta"] and risk.hit_count == 2 and risk.active and risk.score == pytest.approx(2 * 1.0986 + 1.7 * 0.6931, abs=1e-3)
    out = enrich.audit(enrich.entities(enrich.impact(enrich.general_flags(enrich.section_flags(enrich.wide(docs.withColumn("hits", matching.matched(docs["t"], d))), ["section"])))), "t")
    a, b = out.orderBy("i").collect()
    assert a.has_iran and a.is_geopolitical_news and a.expected_impact_direction == "negative" and a.expected_impact_horizon == "short_term" and a.classification_reason.startswith("Familias activas: geopolitico_mercado: iran")
    assert b.is_social_noise and b.confidence <= 0.25 and b.classification_reason == enrich.NO_FAMILY and b.expected_impact_direction == "unknown"


def test_unchanged_rows_are_skipped(spark):
    old = enrich.fingerprint(spark.createDataFrame([(1, "a"), (2, "b")], "i int, v string"), ["v"])
    new = enrich.fingerprint(spark.createDataFrame([(1, "a"), (2, "c")], "i int, v string"), ["v"])
    assert [r.i for r in enrich.changed(new, old, "i").collect()] == [2]


def test_flattened_values(spark):
    df = spark.createDataFrame([({"n": 2.0, "s": "Alto Riesgo", "t": "3,5", "b": True, "l": [1, 2], "e": None},)], "impact struct<n:double,s:string,t:string,b:boolean,l:array<int>,e:string>").withColumn("source", F.lit("m"))
    row = df.select(daily.article_features(df, "source", blocks=["impact"]).alias("p")).first().p
    assert {x.feature: x.value for x in row} == {"news_count": 1.0, "news_count_m": 1.0, "news_impact_n_sum": 2.0, "news_impact_n_mean": 2.0, "news_impact_s_alto_riesgo_count": 1.0, "news_impact_t_sum": 3.5, "news_impact_t_mean": 3.5, "news_impact_b_sum": 1.0, "news_impact_b_mean": 1.0, "news_impact_l_items_sum": 2.0, "news_impact_l_items_mean": 2.0}


def test_keep_best_is_idempotent(spark):
    df = spark.createDataFrame([("k", 0, True, 5), ("k", 1, True, 9), ("k", 2, False, 99), ("k", 3, True, 9), ("", 4, True, 1)], "key string, pos int, ok boolean, n int")
    q = [F.col("ok"), F.col("n")]
    once = identity.keep_best(df, "key", q, "pos").drop("first_position")
    assert [tuple(r) for r in once.collect()] == [("k", 1, True, 9)]
    assert [tuple(r) for r in identity.keep_best(once, "key", q, "pos").drop("first_position").collect()] == [("k", 1, True, 9)]
    assert identity.first_wins(df, "key", "pos").count() == 2


def test_repeated_addresses_over_days_are_an_error(spark):
    df = spark.createDataFrame([("m", "k", 1), ("m", "k", 2), ("n", "k", 1)], "m string, k string, d int")
    with pytest.raises(ValueError, match="more than one day"):
        identity.assert_unique(df, "m", "k", "d")
    identity.assert_unique(df.where("d = 1"), "m", "k", "d")


def test_normalised_twice_is_once(spark):
    df = spark.createDataFrame([(["<p>Uno dos</p>", "ver resumen", "Uno dos"], "tres\n\ncuatro cinco\nPublicidad", "<b>T</b>")], "paragraphs array<string>, body_text_raw string, title string")
    one = normalise.normalised(df)
    r = one.first()
    assert r.paragraphs == ["tres", "cuatro cinco"] and r.title == "T" and r.body_length_words == 3
    assert normalise.normalised(one).first() == r
    assert normalise.unified(one).first().classification_text.startswith("T ")


PAGE = """<html><head><title>t</title><link rel="canonical" href="/a"><meta name="description" content="D">
<script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"H","author":{"name":"Ana"},"datePublished":"2024-01-02"}]}</script>
<script type="application/ld+json">broken</script></head><body><nav>menu</nav><article><h1>X</h1><h2>Sub</h2>
<p>Primer párrafo con más de veinticinco letras.</p><p>corto</p><p>Primer párrafo con más de veinticinco letras.</p><img src="i.jpg" alt="alt">
<a href="/b">int</a><a href="https://o.cl/x">ext</a><a href="d.pdf">doc</a></article></body></html>"""


def test_page_record():
    r = html.record(PAGE, "https://x.cl/n")
    assert (r["title"], r["subtitle"], r["author_name"], r["published_at_raw"], r["canonical_url"]) == ("H", "D", "Ana", "2024-01-02", "https://x.cl/a")
    assert r["paragraphs"] == ["Primer párrafo con más de veinticinco letras."] and r["internal_subheadings"] == ["Sub"] and r["main_image"] == "https://x.cl/i.jpg"
    assert [x["kind"] for x in r["links"]] == ["internal", "external", "document"] and r["parse_success"]
    assert html.record(None, None)["parse_errors"] == ["missing_title", "missing_body"]


def test_sitemaps_and_attributes(spark):
    x = "<urlset><url><loc>https://x.cl/1</loc><lastmod>2024-01-02T00:00</lastmod></url><url><loc><![CDATA[https://x.cl/2]]></loc></url></urlset>"
    assert [(e.loc, e.day) for e in column(spark, [x], pages.sitemap)[0]] == [("https://x.cl/1", date(2024, 1, 2)), ("https://x.cl/2", None)]
    assert column(spark, ["<c :a='1' :b=\"2\" :a='3'>"], pages.attributes) == [{"a": "3", "b": "2"}]


def test_keywords_and_rules(spark):
    k = mining.keywords_of("Central Bank raises rates. Central Bank warns markets. Rates rise.")
    assert k and k[0][1] <= k[-1][1] and any("bank" in t for t, _ in k)
    assert mining.keywords_of("") == []
    assert mining.corpus_clean("<p>Alza del 5% el 25 mayo 2026</p> https://x.cl 77", {}) == "alza del % el" or "alza" in mining.corpus_clean("Alza", {})
    got = column(spark, ["de la", "mercado de capitales", "abc", "radio xx"], lambda c: mining.is_bad_term(c, ["de", "la"], ["radio"]))
    assert got == [True, False, True, True]


def test_dictionary_files(tmp_path, spark):
    (tmp_path / "petroleo.txt").write_text("# c\ncrudo, 2.5\nbrent; x\ncobre, litio, oro\n", encoding="utf-8")
    (tmp_path / "z.json").write_text('{"riesgo": [{"term": "quiebra", "peso": 3}, "default"], "fiscal": {"terms": ["iva"]}}', encoding="utf-8")
    (tmp_path / "bad.json").write_text("{", encoding="utf-8")
    e = dictionaries.deduplicated(dictionaries.load(str(tmp_path), base=[]))
    assert {(f, t, w) for f, t, w, _ in e} == {("energia_commodities", "crudo", 2.5), ("energia_commodities", "brent", 1.0), ("energia_commodities", "cobre", 1.0), ("riesgo_alerta", "quiebra", 3.0), ("riesgo_alerta", "default", 1.0), ("macro_fiscal", "iva", 1.0)}
    assert len(dictionaries.from_text("cobre, litio, oro", "energia", layout="list")) == 3
    c = dictionaries.from_candidates({"political_risk": {"ngrams_top": [{"term": "gobierno"}, {"term": "ley corta", "df_pct": 0.05}, {"term": "comun", "df_pct": 0.5}], "tfidf_top": [{"term": "senado", "score": 9}]}}, {"gobierno"})
    assert [(t, w) for _, t, w, _ in c] == [("ley corta", 0.95), ("senado", 1.0)]
    assert dictionaries.as_frame(spark, e).count() == 6


def test_fund_files(tmp_path, spark):
    head = "RUN_FM;FECHA_INF;SERIE;VALOR_CUOTA;PATRIMONIO_NETO"
    (tmp_path / "a.txt").write_text(f"{head}\n1;20240102;A;1,5;10\n1;20240102;A;1,6;10\n1;20240103;B;2;99\n1;bad;A;1;1\n1;20240104;A;0;1\nmalformed;line\n", encoding="utf-8")
    (tmp_path / "b.txt").write_bytes(f"{head}\n1;20240105;A;1,7;Ñ\n2;20240105;A;9;1\n".encode("latin-1"))
    df = funds.load(spark, [str(tmp_path / "*.txt")], "1", ["A"], "2024-01-01", "2024-12-31").orderBy("date")
    assert [(str(r.date), r.valor_cuota) for r in df.collect()] == [("2024-01-02", 1.6), ("2024-01-05", 1.7)]
    by_assets = funds.load(spark, [str(tmp_path / "*.txt")], "1", ["none"], "2024-01-01", "2024-12-31")
    assert [r.SERIE for r in by_assets.collect()] == ["B"]


def test_news_files(tmp_path, spark):
    import json

    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("articles array<struct<raw: struct<url: string, published_at: string>>>")
    for day, body in (("01_02_2024", json.dumps({"articles": [{"raw": {"url": "https://x.cl/a", "published_at": "2024-02-01"}}, {"raw": {"url": "https://x.cl/b", "published_at": "2024-02-09"}}]})), ("02_02_2024", "{broken")):
        (tmp_path / "m" / day).mkdir(parents=True)
        (tmp_path / "m" / day / "noticias_dia.txt").write_text(body)
    files = news.read_days(spark, str(tmp_path), ["m", "missing"], schema)
    assert files.count() == 2
    arts = news.articles(files)
    good, bad = news.with_integrity(arts, [F.col("article.raw.published_at")], F.col("article.raw.url"))
    assert good.count() == 1 and bad.count() == 1
    assert news.read_days(spark, str(tmp_path), ["m"], schema, days=["2024-02-02"]).count() == 1


def test_mining_takes_every_language_and_three_words(tmp_path, spark):
    from tidemark.plans import text_queries

    rows = [(k, ["the red house", "casa roja déficit", "maison rouge neuve"][k % 3], ["en", "es", None][k % 3]) for k in range(18)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.term: (r["count"], r.df, r.df_pct) for r in text_queries.mine_ngrams(spark, str(tmp_path)).collect()}
    third = {"red", "house", "red house", "casa", "roja", "déficit", "casa roja", "roja déficit", "casa roja déficit", "maison", "rouge", "neuve", "maison rouge", "rouge neuve", "maison rouge neuve"}
    assert got == {t: (6, 6, round(1 / 3, 6)) for t in third}
    score = {r.term: r.score for r in text_queries.mine_tfidf(spark, str(tmp_path)).collect()}
    assert set(score) == third
    assert all(abs(v - (1 / 3) / (3 if "hous" in t or "red" in t.split() else 6) ** 0.5) < 1e-7 for t, v in score.items())
    assert sorted(tuple(r) for r in text_queries.mojibake_repair(spark, str(tmp_path)).collect()) == [(k, True) for k in range(18)]

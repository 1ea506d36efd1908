"""Queries on texts, matches, addresses, pages and daily news, with their SQL.

``documents`` plays the articles (a document's day is derived from its id), ``events`` the
daily stream, ``pages`` the raw pages. The Spanish seeds hardly occur in the invented
texts, so a small dictionary of frequent words stands in for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.operators import calendars, daily, editorial, enrich, html, identity, matching, mining
from tidemark.plans.series_queries import read, shown
from tidemark.session import spread

# A demonstration dictionary: two or three terms for each family.
DEMO = {
    "macro_fiscal": {"for": 2.0, "the in": 2.5, "que": 1.5},
    "mercado_financiero": {"that": 2.5, "with": 2.0, "los": 1.5},
    "energia_commodities": {"and": 1.8, "and the": 2.2},
    "empresas_instituciones": {"der": 1.5, "les": 2.0},
    "politico_regulatorio": {"idiot": 2.0, "das": 1.2},
    "geopolitico_mercado": {"mit": 1.8, "pour": 1.8},
    "riesgo_alerta": {"scum": 2.5, "moron": 2.0},
    "sentimiento_positivo": {"from": 1.4, "for the": 1.4},
    "sentimiento_negativo": {"trash": 2.2, "clown": 1.6, "loser": 1.8},
    "ruido_social": {"stupid": 1.5, "pathetic": 1.2},
}
NORM = "trim(regexp_replace(regexp_replace(strip_accents(lower(regexp_replace(coalesce(text, ''), '<[^>]+>', ' ', 'g'))), '[^a-z0-9_%$/\\-.\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
NORMED = f"n AS (SELECT doc_id, source, {NORM} AS t FROM documents)"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "documents")).withColumn("t", T.match_text("text", {}))


def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.md5(F.col("t").cast("binary")).alias("norm_md5"), F.length("t").alias("norm_length"), T.words("t").alias("norm_words"))


def text_safe_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", T.safe_name("url").alias("name"))


def text_boilerplate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    rules = ("^licensed under", "^released under", r"^this work is licensed", r"\| ")
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(T.is_boilerplate("line", rules)).alias("n_boilerplate"))


def text_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(T.strip_accents(F.col("text")).cast("binary")).alias("plain_md5"), T.quotes("text").alias("quotes"), T.quotes_scraped("text").alias("quotes_scraped"))


def text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals with comma: part prices as written numbers."""
    p = read(spark, sf_dir, "part")
    written = F.replace(F.format_string("%.2f", "p_retailprice"), F.lit("."), F.lit(","))
    return p.select("p_partkey", T.to_number(written).alias("price"), T.to_number(F.concat(F.lit("1."), written)).alias("two_separators"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.term_counts(_docs(spark, sf_dir), "doc_id", "t", matching.dictionary(spark, DEMO, "demo"))


_TERMS = [(f, t, w) for f, x in DEMO.items() for t, w in x.items()]
_COUNTS = f"""{NORMED}, s AS (SELECT doc_id, replace(' ' || trim(regexp_replace(regexp_replace(t, '[^a-z0-9_ ]+', ' | ', 'g'), ' +', ' ', 'g')) || ' ', ' ', '  ') AS p FROM n),
c AS (""" + "\nUNION ALL ".join(f"SELECT doc_id, '{f}' AS family, '{t}' AS norm_term, {w}::DOUBLE AS weight, {sum(1 for a in _TERMS if a[0] == f and (-len(a[1].split()), -a[2], a[1]) < (-len(t.split()), -w, t))} AS pos, ((length(p) - length(replace(p, ' {'  '.join(t.split())} ', ''))) // {len('  '.join(t.split())) + 2})::BIGINT AS occurrences FROM s" for f, t, w in _TERMS) + """),
h AS (SELECT *, weight * ln(1 + occurrences) AS raw FROM c WHERE occurrences > 0),
m AS (SELECT doc_id, family, sum(raw) >= 1.0 AS active, round(sum(raw), 4) AS score, count(*)::INT AS hit_count, list(norm_term ORDER BY round(raw, 4) DESC, pos) AS hits FROM h GROUP BY 1, 2)"""


def term_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir).select("doc_id", "family", "norm_term", "weight", "occurrences")


def family_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = matching.family_matches(_counts(spark, sf_dir), "doc_id")
    return m.select("doc_id", "family", "active", "score", "hit_count", F.array_join("hits", ",").alias("hits"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "source", "lang", "t")
    df = enrich.wide(docs.withColumn("hits", matching.matched(F.col("t"), matching.dictionary(spark, DEMO, "demo"))))
    df = enrich.section_flags(df.withColumn("section", F.when(F.col("lang") == "de", "Deportes").when(F.col("lang") == "es", "Economía").when(F.col("lang") == "fr", "Mundo").otherwise("policial")), ["section"])
    return enrich.impact(enrich.general_flags(df))


_WIDE = _COUNTS + """,
w AS (SELECT n.doc_id, n.t, d.lang, """ + ", ".join(f"coalesce(max(m.score) FILTER (m.family = '{f}'), 0.0) AS {f}, coalesce(bool_or(m.active) FILTER (m.family = '{f}'), false) AS on_{f}, coalesce(max(m.hits) FILTER (m.family = '{f}'), []) AS hits_{f}" for f in enrich.FAMILIES) + """
  FROM n JOIN documents d USING (doc_id) LEFT JOIN m USING (doc_id) GROUP BY 1, 2, 3),
g AS (SELECT *, on_macro_fiscal OR on_mercado_financiero OR on_energia_commodities OR on_empresas_instituciones OR lang = 'es' AS is_economic_news,
  on_politico_regulatorio AS is_political_news, on_geopolitico_mercado OR lang = 'fr' AS is_geopolitical_news, on_empresas_instituciones AS is_company_news, on_mercado_financiero AS is_market_news,
  on_energia_commodities AS is_energy_news, lang = 'en' OR on_ruido_social AS is_crime_or_police_news, lang = 'de' AS is_sports_or_entertainment_news FROM w),
g2 AS (SELECT *, (is_sports_or_entertainment_news OR is_crime_or_police_news) AND NOT is_economic_news AND NOT on_geopolitico_mercado AS is_social_noise FROM g),
i AS (SELECT *, round(least(1.0, greatest(0.0, (""" + " + ".join(f"{f} * {w}" for f, w in enrich.IMPACT.items()) + """) / 18.0)), 4) AS score FROM g2)"""
FLAGS = ["is_economic_news", "is_political_news", "is_geopolitical_news", "is_company_news", "is_market_news", "is_energy_news", "is_social_noise", "is_crime_or_police_news", "is_sports_or_entertainment_news"]


def enrich_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("doc_id", *FLAGS)


def enrich_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("doc_id", "market_impact_score", "expected_impact_direction", "expected_volatility_effect", "expected_impact_horizon", "market_impact_candidate", "risk_score", "uncertainty_score", "confidence")


def enrich_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = enrich.entities(_enriched(spark, sf_dir))
    return df.select("doc_id", F.array_join("entities_relevant_terms", ",").alias("terms"), "has_china", "has_iran")


def enrich_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = enrich.audit(_enriched(spark, sf_dir), "t")
    return df.select("doc_id", F.array_join("active_families", ",").alias("active_families"), F.array_join("matched_terms_all", ",").alias("matched_terms"), "matched_terms_count", "classification_text_length")


def enrich_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.file_summary(_enriched(spark, sf_dir), "source")


def enrich_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("published_date"), F.date_format("ts", "HH:mm:ss").alias("published_time"))
    return enrich.temporal(e).select("event_id", "published_weekday", "is_weekend", "published_hour")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    e = e.select(F.concat(F.lit("m"), F.col("user_id") % 2).alias("source"), F.col("ts").cast("date").alias("day"), F.date_format("ts", "HH:mm:ss").alias("clock"), F.struct("event_type", "value", "k").alias("impact"))
    return e.withColumn("pairs", daily.article_features(e, "source", blocks=["impact"]))


CUTOFF = "21:30:00"
_LONG = """e AS (SELECT 'm' || (user_id % 2) AS source, ts::DATE AS day, strftime(ts, '%H:%M:%S') AS clock, event_type, value, (props->>'$.k')::DOUBLE AS k FROM events),
a AS (SELECT source, day, count(*) AS n FROM e GROUP BY 1, 2),
l AS (SELECT source, day, 'news_count' AS feature, 1.0 AS v, clock FROM e UNION ALL SELECT source, day, 'news_count_' || source, 1.0, clock FROM e
  UNION ALL SELECT source, day, 'news_impact_event_type_' || event_type || '_count', 1.0, clock FROM e
  UNION ALL SELECT source, day, 'news_impact_value_sum', value, clock FROM e UNION ALL SELECT source, day, 'news_impact_value_mean', value, clock FROM e
  UNION ALL SELECT source, day, 'news_impact_k_sum', k, clock FROM e WHERE k IS NOT NULL UNION ALL SELECT source, day, 'news_impact_k_mean', k, clock FROM e WHERE k IS NOT NULL),
f AS (SELECT source, day, feature, CASE WHEN feature LIKE '%\\_mean' ESCAPE '\\' THEN sum(v) / max(n) ELSE sum(v) END AS value FROM l JOIN a USING (source, day) GROUP BY 1, 2, 3),
m AS (SELECT day AS date, feature, sum(value) AS value FROM f GROUP BY 1, 2),
dd AS (SELECT d::DATE AS date FROM range(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-05', INTERVAL 1 DAY) t(d)),
x AS (SELECT dd.date, n.feature, coalesce(m.value, 0.0) AS value FROM dd CROSS JOIN (SELECT DISTINCT feature FROM m) n LEFT JOIN m ON m.date = dd.date AND m.feature = n.feature)"""


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.across_sources(daily.daily_long(_events(spark, sf_dir), "source", "day", "pairs"), "day")


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.dense(_matrix(spark, sf_dir), calendars.days(spark, "2023-12-30", "2024-02-04"))


def news_daily_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(daily.daily_long(_events(spark, sf_dir), "source", "day", "pairs"), ["source", "day", "feature", "value"])


def news_daily_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_dense(spark, sf_dir), ["date", "feature", "value"])


def news_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(daily.lagged(_dense(spark, sf_dir)), ["date", "feature", "value"], 4)


def news_weekend_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.weekend_pressure(_dense(spark, sf_dir))


def news_cutoff_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(daily.with_partial(_events(spark, sf_dir), "source", "day", "pairs", "clock", CUTOFF), ["date", "feature", "value", "value_until"])


def news_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = daily.to_wide(_matrix(spark, sf_dir), [f"news_impact_event_type_{t}_count" for t in ("click", "error", "purchase", "signup", "view")])
    return wide


def _grams(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    d = spread(read(spark, sf_dir, "documents"))
    return mining.gram_counts(d, "doc_id", "text", stop=["the", "and"]), d.count()


# Accented letters of words as capitals and other letters as Z, so that the engine's word boundaries, which know ASCII alone, hold.
_GRAMS = r"""d0 AS (SELECT doc_id, regexp_replace(regexp_replace(translate(lower(coalesce(text, '')), 'áéíóúñü', 'AEIOUNW'), '[^\x00-\x7F\p{L}\p{M}\p{Nd}\p{Pc}]', ' ', 'g'), '[^\x00-\x7F]', 'Z', 'g') AS t FROM documents),
d AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(t, '\b[a-zAEIOUNW][a-zAEIOUNW0-9_\-]{2,}\b'), lambda x: translate(x, 'AEIOUNW', 'áéíóúñü')), lambda x: x NOT IN ('the', 'and')) AS w FROM d0),
g AS (SELECT doc_id, unnest(w) AS term FROM d UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM d
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM d),
c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2), z AS (SELECT count(*)::DOUBLE AS n FROM documents)"""


def mine_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, n = _grams(spark, sf_dir)
    return shown(mining.ngram_table(counts, n), ["term", "count", "df", "df_pct"])


def mine_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, n = _grams(spark, sf_dir)
    return shown(mining.tfidf_table(counts, "doc_id", n, top=None), ["term", "score"], 8)


SEEDS = dict(zip(mining.SEED_SETS, [{t: 1.0} for t in ("that", "for", "der", "gas", "with", "mit", "idiot", "from", "this", "not", "was", "are", "his", "une", "dans", "les", "los", "que")]))


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = matching.dictionary(spark, SEEDS | {"political": {"with": 1.0, "from": 1.0}, "noise": {"idiot": 1.0, "scum": 1.0}, "hard_event": {"les": 1.0, "pour": 1.0}}, "demo")
    docs = _docs(spark, sf_dir)
    return matching.seed_hits(docs, matching.term_counts(docs, "doc_id", "t", terms), "doc_id", list(mining.SEED_SETS))


def mine_seed_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _seeds(spark, sf_dir)
    return h.select("doc_id", *(F.array_join(c, ",").alias(c) for c in ("market", "political", "noise", "hard_event")))


CLASSES = ["has_amount_context", "has_geopolitical_market_context", "strict_score", "is_financial_strict", "is_political_risk", "is_geopolitical_market", "is_social_noise_dominant"]


def mine_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.seed_rules(_seeds(spark, sf_dir)).select("doc_id", *CLASSES)


def mine_subcorpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.subcorpora(mining.seed_rules(_seeds(spark, sf_dir))).groupBy("section").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


_HAS = {s: (["with", "from"] if s == "political" else ["idiot", "scum"] if s == "noise" else ["les", "pour"] if s == "hard_event" else list(SEEDS[s])) for s in mining.SEED_SETS}
_SEEDS = f"""{NORMED}, p AS (SELECT doc_id, ' ' || regexp_replace(t, '[^a-z0-9_]+', ' ', 'g') || ' ' AS p FROM n),
h AS (SELECT doc_id, """ + ", ".join(f"list_filter({sorted(t)!r}, lambda x: contains(p, ' ' || x || ' ')) AS {s}" for s, t in _HAS.items()) + """ FROM p),
r AS (SELECT *, len(amount) > 0 AND len(amount_context) > 0 AS amt, len(energy_word) > 0 AND len(energy_context) > 0 AS energy, list_contains(commodity, 'gas') AND (len(gas_strong) > 0 OR (len(gas_weak) > 0 AND len(direct_context) > 0)) AS gas,
  len(market) + CASE WHEN len(ambiguous) > 0 AND len(market_context) > 0 THEN len(ambiguous) ELSE 0 END AS m FROM h),
q AS (SELECT *, len(direct_context) > 0 OR gas OR ((len(list_filter(commodity, lambda x: x <> 'gas')) > 0 OR energy) AND len(hard_event) > 0) OR (len(market) > 0 AND len(hard_event) > 0) OR ((amt OR len(support_context) > 0) AND len(hard_event) >= 2) AS ctx,
  len(commodity) + energy::INT AS c FROM r),
k AS (SELECT *, (3 * (m + len(fiscal) + len(company) + c) + amt::INT)::INT AS strict FROM q),
y AS (SELECT doc_id, amt AS has_amount_context, ctx AS has_geopolitical_market_context, strict AS strict_score, strict >= 4 OR len(fiscal) > 0 OR len(company) > 0 OR c > 0 OR m >= 2 AS is_financial_strict,
  len(political) >= 2 AND (len(fiscal) > 0 OR m > 0 OR len(company) > 0 OR c > 0) AS is_political_risk, len(geopolitical) >= 1 AND ctx AS is_geopolitical_market, len(noise) >= 2 AND strict = 0 AND len(geopolitical) = 0 AS is_social_noise_dominant FROM k)"""


def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", U.without_fragment("url").alias("url_a"), U.without_utm("url").alias("url_b"))


def url_article_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with parameters in another order and spelling, tracking among them."""
    p = read(spark, sf_dir, "pages")
    more = F.concat(F.lit("?id2="), F.col("page_id"), F.lit("&id=2&q=a%20b+c&fbclid=z&UTM_x=1&k&id=10#top"))
    address = F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.concat(F.regexp_replace("url", r"[?#].*$", ""), more))
    return p.select("page_id", U.article_key(address).alias("article_key"))


def url_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", U.host(F.col("url")).alias("host"), U.segments("url").alias("s"), U.slug_of("url", ".html").alias("slug"))
    return p.select("page_id", "host", F.size("s").alias("depth"), F.coalesce(F.try_element_at("s", F.lit(1)), F.lit("")).alias("first_segment"), "slug")


_URL = r"""u AS (SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', ['scheme', 'host', 'path', 'query']) AS p FROM pages),
v AS (SELECT page_id, url, p.scheme AS scheme, regexp_replace(regexp_replace(lower(p.host), ':\d*$', ''), '^www\.', '') AS host, regexp_replace(p.path, '/+$', '') AS path, list_filter(string_split(p.query, '&'), lambda x: x <> '') AS q, list_filter(string_split(p.path, '/'), lambda x: x <> '') AS s FROM u)"""


def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles under a shared key: texts with the same first words."""
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat(F.lit("k"), F.length("text") % 97).alias("key"), (F.col("doc_id") % 3 != 0).alias("parse_success"), "n_chars", "source", (F.col("doc_id") % 30).cast("int").alias("day"))


def dedup_keep_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = identity.keep_best(_copies(spark, sf_dir), "key", [F.col("parse_success"), F.col("n_chars")], "doc_id")
    return d.select("key", "doc_id", "n_chars", "first_position")


def dup_across_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.repeated_over_days(_copies(spark, sf_dir), "source", "key", "day")


def incremental_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _copies(spark, sf_dir)
    return identity.new_only(d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1 and parse_success"), "key").select("doc_id", "key")


def discovery_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _copies(spark, sf_dir).select(F.col("key").alias("url"), F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("t"), "doc_id")).alias("title"), (F.col("n_chars") > 9000).alias("featured"), "source")
    m = identity.merge_discoveries(d, "url", "pos", ["title"], ["featured"], "source")
    return m.select("url", "title", "featured", F.array_join("source", ",").alias("sources"))


def html_paragraphs_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", html.paragraphs("html").alias("p"))
    return p.select("page_id", F.size("p").alias("n_paragraphs"), F.md5(F.array_join("p", "\n").cast("binary")).alias("body_md5"))


def html_links_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", F.explode(html.hrefs("html")).alias("href"))


def html_extract_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def article_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").withColumn("body", F.array_join(html.paragraphs("html"), "\n"))
    return p.select("page_id", editorial.kind("dated", F.col("url"), body=F.col("body")).alias("kind"), editorial.agency("body").alias("agency"))


def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts read in the wrong encoding and repaired; ``same`` where the original came back."""
    d = read(spark, sf_dir, "documents")
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return d.select("doc_id", (T.repair_mojibake(broken) == F.col("text")).alias("same"))


def keywords_yake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.keyword_table(mining.keywords(spread(read(spark, sf_dir, "documents")), "doc_id", "text"))


def entities_heuristic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.entity_table(mining.capitalised(read(spark, sf_dir, "documents"), "doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        text_normalize, text_safe_name, text_boilerplate_filter, text_accents, text_numbers, term_occurrences, family_match, enrich_flags, enrich_impact, enrich_entities, enrich_audit, enrich_summary, enrich_temporal,
        news_daily_long, news_daily_matrix, news_rolling, news_weekend_pressure, news_cutoff_partial, news_onehot, mine_ngrams, mine_tfidf, mine_seed_hits, mine_classify, mine_subcorpora,
        url_normalize, url_article_key, url_sections, dedup_keep_best, dup_across_days, incremental_new, discovery_merge, html_paragraphs_regex, html_links_regex, html_extract_struct, article_kind,
        mojibake_repair, keywords_yake, entities_heuristic,
    )
}

_BODY = "p AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))), lambda x: length(x) >= 25) AS p FROM pages), q AS (SELECT page_id, list_filter(p, lambda x, i: list_position(p, x) = i) AS p FROM p)"
_COPIES = "x AS (SELECT doc_id, 'k' || (length(text) % 97) AS key, doc_id % 3 <> 0 AS parse_success, n_chars, source, (doc_id % 30)::INT AS day FROM documents)"
ORACLE_SQL = {
    "text_normalize": f"WITH {NORMED} SELECT doc_id, md5(t) AS norm_md5, length(t)::INT AS norm_length, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END::INT AS norm_words FROM n",
    "text_safe_name": "SELECT page_id, coalesce(nullif(left(trim(regexp_replace(lower(trim(url)), '[^\\p{L}\\p{N}]+', '_', 'g'), '_'), 80), ''), 'unknown') AS name FROM pages",
    "text_boilerplate_filter": "WITH l AS (SELECT doc_id, trim(lower(unnest(string_split(text, chr(10))))) AS line FROM documents) SELECT doc_id, count(*) AS n_lines, count(*) FILTER (length(line) <= 2 OR regexp_matches(line, '(?:^licensed under)|(?:^released under)|(?:^this work is licensed)|(?:\\| )')) AS n_boilerplate FROM l GROUP BY 1",
    "text_accents": "SELECT doc_id, md5(strip_accents(text)) AS plain_md5, len(regexp_extract_all(text, '[“”]'))::INT AS quotes, (len(regexp_extract_all(text, '“')) + len(regexp_extract_all(text, '\"')) // 2)::INT AS quotes_scraped FROM documents",
    "text_numbers": "SELECT p_partkey, round(p_retailprice, 2) AS price, NULL::DOUBLE AS two_separators FROM part",
    "term_occurrences": f"WITH {_COUNTS} SELECT doc_id, family, norm_term, weight, occurrences FROM h",
    "family_match": f"WITH {_COUNTS} SELECT doc_id, family, active, score, hit_count, array_to_string(hits, ',') AS hits FROM m",
    "enrich_flags": f"WITH {_WIDE} SELECT doc_id, {', '.join(FLAGS)} FROM i",
    "enrich_impact": f"""WITH {_WIDE} SELECT doc_id, score AS market_impact_score, CASE WHEN sentimiento_positivo = 0 AND sentimiento_negativo = 0 THEN 'unknown' WHEN abs(sentimiento_positivo - sentimiento_negativo) < 0.75 THEN 'mixed' WHEN sentimiento_positivo > sentimiento_negativo THEN 'positive' ELSE 'negative' END AS expected_impact_direction,
CASE WHEN sentimiento_negativo + riesgo_alerta + geopolitico_mercado + energia_commodities * 0.5 >= 4 THEN 'increase' WHEN score < 0.15 THEN 'neutral' ELSE 'unknown' END AS expected_volatility_effect,
CASE WHEN on_geopolitico_mercado OR on_mercado_financiero THEN 'short_term' WHEN on_macro_fiscal OR on_politico_regulatorio THEN 'medium_term' WHEN score >= 0.25 THEN 'short_term' ELSE 'unknown' END AS expected_impact_horizon,
score >= 0.20 OR is_economic_news OR on_geopolitico_mercado AS market_impact_candidate, round(least(1.0, greatest(0.0, riesgo_alerta / 10.0)), 4) AS risk_score, round(least(1.0, greatest(0.0, (riesgo_alerta + geopolitico_mercado) / 14.0)), 4) AS uncertainty_score, round(CASE WHEN is_social_noise THEN least(score, 0.25) ELSE score END, 4) AS confidence FROM i""",
    "enrich_entities": f"WITH {_WIDE}, t AS (SELECT doc_id, list_sort(list_distinct(hits_empresas_instituciones || hits_geopolitico_mercado || hits_mercado_financiero)) AS e FROM i) SELECT doc_id, coalesce(array_to_string(e, ','), '') AS terms, list_contains(e, 'china') AS has_china, contains(coalesce(array_to_string(e, ' '), ''), 'iran') AS has_iran FROM t",
    "enrich_audit": f"WITH {_WIDE}, t AS (SELECT doc_id, length(t)::INT AS n, list_filter([{', '.join(f'CASE WHEN on_{f} THEN {f!r} END' for f in enrich.FAMILIES)}], lambda x: x IS NOT NULL) AS a, list_sort(list_distinct({' || '.join(f'hits_{f}' for f in enrich.FAMILIES)})) AS h FROM i) SELECT doc_id, coalesce(array_to_string(a, ','), '') AS active_families, coalesce(array_to_string(h, ','), '') AS matched_terms, len(h)::INT AS matched_terms_count, n AS classification_text_length FROM t",
    "enrich_summary": f"WITH {_WIDE} SELECT d.source, count(*) AS articles, count(*) FILTER (score >= 0.20 OR is_economic_news OR on_geopolitico_mercado) AS impact_candidates, {', '.join(f'count(*) FILTER (on_{f}) AS active_{f}' for f in enrich.FAMILIES)} FROM i JOIN documents d USING (doc_id) GROUP BY 1",
    "enrich_temporal": "SELECT event_id, (isodow(ts) - 1)::INT AS published_weekday, isodow(ts) > 5 AS is_weekend, hour(ts)::INT AS published_hour FROM events",
    "news_daily_long": f"WITH {_LONG} SELECT source, day, feature, round(value, 6) AS value FROM f",
    "news_daily_matrix": f"WITH {_LONG} SELECT date, feature, round(value, 6) AS value FROM x",
    "news_rolling": f"WITH {_LONG}, y AS (SELECT date, feature, " + ", ".join(f"coalesce(sum(value) OVER (PARTITION BY feature ORDER BY date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING), 0.0) AS r{k}" for k in (1, 3, 7)) + " FROM x) SELECT date, feature || '_lag1' AS feature, round(r1, 4) AS value FROM y UNION ALL SELECT date, feature || '_roll3_lag1', round(r3, 4) FROM y UNION ALL SELECT date, feature || '_roll7_lag1', round(r7, 4) FROM y",
    "news_weekend_pressure": f"WITH {_LONG}, y AS (SELECT date, CASE WHEN isodow(date) > 5 THEN value ELSE 0.0 END AS v FROM x WHERE feature = 'news_count') SELECT date, " + ", ".join(f"coalesce(sum(v) OVER (ORDER BY date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING), 0.0) AS news_weekend_pressure_roll{k}_lag1" for k in (3, 7)) + " FROM y",
    "news_cutoff_partial": f"WITH {_LONG}, b AS (SELECT source, day, count(*) FILTER (clock <= '{CUTOFF}') AS ne FROM e GROUP BY 1, 2), g AS (SELECT source, day, feature, CASE WHEN feature LIKE '%\\_mean' ESCAPE '\\' THEN sum(v) / max(n) ELSE sum(v) END AS value, coalesce(CASE WHEN feature LIKE '%\\_mean' ESCAPE '\\' THEN sum(v) FILTER (clock <= '{CUTOFF}') / nullif(max(ne), 0) ELSE sum(v) FILTER (clock <= '{CUTOFF}') END, 0.0) AS u FROM l JOIN a USING (source, day) JOIN b USING (source, day) GROUP BY 1, 2, 3) SELECT day AS date, feature, round(sum(value), 6) AS value, round(sum(u), 6) AS value_until FROM g GROUP BY 1, 2",
    "news_onehot": "SELECT ts::DATE AS date, " + ", ".join(f"count(*) FILTER (event_type = '{t}')::DOUBLE AS news_impact_event_type_{t}_count" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1",
    "mine_ngrams": f"WITH {_GRAMS} SELECT term, sum(tf)::BIGINT AS count, count(*) AS df, round(count(*) / max(n), 6) AS df_pct FROM c, z GROUP BY term HAVING count(*) >= 5 AND count(*) <= 0.6 * max(n) ORDER BY df DESC, count DESC, term LIMIT 2000",
    "mine_tfidf": f"WITH {_GRAMS}, f AS (SELECT term, count(*) AS df FROM c, z GROUP BY term HAVING count(*) >= 3 AND count(*) <= 0.6 * max(n)), w AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN f USING (term), z), q AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1) SELECT term, round(sum(w / norm) / max(n), 8) AS score FROM w JOIN q USING (doc_id), z GROUP BY 1",
    "mine_seed_hits": f"WITH {_SEEDS} SELECT doc_id, " + ", ".join(f"coalesce(array_to_string({c}, ','), '') AS {c}" for c in ("market", "political", "noise", "hard_event")) + " FROM h",
    "mine_classify": f"WITH {_SEEDS} SELECT * FROM y",
    "mine_subcorpora": f"WITH {_SEEDS}, o AS (SELECT * FROM y WHERE NOT is_social_noise_dominant) SELECT section, count(*) AS n, min(doc_id) AS first_doc FROM (SELECT doc_id, 'financial_strict' AS section FROM o WHERE is_financial_strict UNION ALL SELECT doc_id, 'political_risk' FROM o WHERE is_political_risk UNION ALL SELECT doc_id, 'geopolitical_market' FROM o WHERE is_geopolitical_market) GROUP BY 1",
    "url_normalize": f"WITH {_URL} SELECT page_id, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?utm_source.*$', '') AS url_a, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '\\?.*$', '') || CASE WHEN len(list_filter(q, lambda x: NOT starts_with(x, 'utm_'))) > 0 THEN '?' || array_to_string(list_filter(q, lambda x: NOT starts_with(x, 'utm_')), '&') ELSE '' END AS url_b FROM v",
    "url_article_key": r"""WITH a AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE regexp_replace(url, '[?#].*$', '') || '?id2=' || page_id || '&id=2&q=a%20b+c&fbclid=z&UTM_x=1&k&id=10#top' END AS u FROM pages),
v AS (SELECT page_id, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', ['scheme', 'host', 'path', 'query']) AS p FROM a),
q AS (SELECT page_id, p, list_transform(list_filter(string_split(p.query, '&'), lambda x: x <> ''), lambda x: {'n': url_decode(replace(split_part(x, '=', 1), '+', ' ')), 'v': CASE WHEN contains(x, '=') THEN url_decode(replace(substr(x, strpos(x, '=') + 1), '+', ' ')) ELSE '' END}) AS q FROM v),
k AS (SELECT page_id, p, list_sort(list_filter(q, lambda x: NOT starts_with(lower(x.n), 'utm_') AND lower(x.n) NOT IN ('fbclid', 'gclid', 'mc_cid', 'mc_eid'))) AS k FROM q)
SELECT page_id, 'https://' || regexp_replace(regexp_replace(lower(p.host), ':\d*$', ''), '^www\.', '') || regexp_replace(p.path, '/+$', '') || CASE WHEN len(k) > 0 THEN '?' || array_to_string(list_transform(k, lambda x: replace(url_encode(x.n), '%20', '+') || '=' || replace(url_encode(x.v), '%20', '+')), '&') ELSE '' END AS article_key FROM k""",
    "url_sections": f"WITH {_URL} SELECT page_id, host, len(s)::INT AS depth, coalesce(s[1], '') AS first_segment, regexp_replace(coalesce(s[-1], ''), '\\.html$', '') AS slug FROM v",
    "dedup_keep_best": f"WITH {_COPIES} SELECT key, arg_max(doc_id, {{'a': parse_success, 'b': n_chars, 'c': -doc_id}}) AS doc_id, arg_max(n_chars, {{'a': parse_success, 'b': n_chars, 'c': -doc_id}}) AS n_chars, min(doc_id) AS first_position FROM x GROUP BY 1",
    "dup_across_days": f"WITH {_COPIES} SELECT source, key, count(DISTINCT day) AS days, min(day) AS first_day, max(day) AS last_day FROM x GROUP BY 1, 2 HAVING count(DISTINCT day) > 1",
    "incremental_new": f"WITH {_COPIES} SELECT doc_id, key FROM x WHERE doc_id % 2 = 0 AND key NOT IN (SELECT key FROM x WHERE doc_id % 2 = 1 AND parse_success)",
    "discovery_merge": f"WITH {_COPIES}, s AS (SELECT key, source, min(doc_id) AS o FROM x GROUP BY 1, 2), l AS (SELECT key, string_agg(source, ',' ORDER BY o) AS sources FROM s GROUP BY 1) SELECT key AS url, 't' || min(doc_id) FILTER (doc_id % 2 = 0) AS title, bool_or(n_chars > 9000) AS featured, any_value(sources) AS sources FROM x JOIN l USING (key) GROUP BY 1",
    "html_paragraphs_regex": f"WITH {_BODY} SELECT page_id, len(p)::INT AS n_paragraphs, md5(coalesce(array_to_string(p, chr(10)), '')) AS body_md5 FROM q",
    "html_links_regex": "SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href=\"([^\"#]+)[\"#]', 1)) AS href FROM pages",
    # wrongly decoded letters up to U+00FF show a sign, so the text comes back; other letters show none
    "mojibake_repair": "SELECT doc_id, regexp_matches(text, '[\\x{80}-\\x{FF}]') OR NOT regexp_matches(text, '[^\\x00-\\x7F]') AS same FROM documents",
    "entities_heuristic": "WITH e AS (SELECT lower(unnest(regexp_extract_all(text, '(\\p{Lu}[\\p{L}]+(?: \\p{Lu}[\\p{L}]+)*)', 1))) AS entity FROM documents) SELECT entity, count(*) AS n FROM e WHERE length(entity) >= 3 GROUP BY 1 ORDER BY n DESC, entity LIMIT 300",
    "article_kind": f"WITH {_BODY}, v AS (SELECT page_id, lower(url || ' ' || left(array_to_string(p, chr(10)), 500)) AS v, lower(array_to_string(p, chr(10))) AS h FROM q JOIN pages USING (page_id)) SELECT page_id, CASE " + " ".join(f"WHEN {' OR '.join(f'contains(v, {p!r})' for p in parts)} THEN '{n}'" for n, parts in editorial.KINDS["dated"] if parts) + " ELSE 'news' END AS kind, CASE " + " ".join(f"WHEN contains(h, '{a}') THEN '{a}'" for a in editorial.AGENCIES) + " ELSE '' END AS agency FROM v",
}

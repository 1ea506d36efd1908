"""Queries on single rules: texts, addresses, dates, files, dictionaries, configuration. Their SQL is written from the rules.

Inputs that the tables don't have (marked-up texts, Spanish dates, files) are made from
their columns, on both sides alike.
"""

from __future__ import annotations

import json
import tempfile
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import cli
from tidemark.functions import dates as D
from tidemark.functions import text as T
from tidemark.functions import urls as U
from tidemark.operators import editorial, enrich, matching, metrics, mining, normalise, signals
from tidemark.plans import config, reports, scenarios, stages
from tidemark.plans.learning_queries import _folder
from tidemark.plans.series_queries import funds, read
from tidemark.sources import dictionaries, news, pages
from tidemark.sources import funds as fund_files_
from tidemark.sources.seeds import CLASS_SEEDS
from tidemark.streaming import news as stream

def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the signs of markup taken out of their texts."""
    return read(spark, sf_dir, "documents").withColumn("text", F.regexp_replace(F.coalesce("text", F.lit("")), "[<>&{}]", ""))


_DOCS = "d AS (SELECT * REPLACE (regexp_replace(coalesce(text, ''), '[<>&{}]', '', 'g') AS text) FROM documents)"


def _md5(c) -> object:
    return F.md5(c.cast("binary"))


# Texts


def text_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit(" \t\r"), F.replace("text", F.lit(" "), F.lit(" \t ")), F.lit("\n\n\n\n\nend \f"))
    return _docs(spark, sf_dir).select("doc_id", _md5(T.spaces(raw)).alias("md5"), F.length(T.spaces(raw)).alias("n"))


def text_strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit("<div><script>var a = 1;</script><style>p {}</style><p>"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("</p><svg><text>x</text></svg><noscript>off</noscript> tail &amp; caf&eacute; </div>"))
    return _docs(spark, sf_dir).select("doc_id", _md5(T.strip_html(page)).alias("md5"))


def text_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    raw = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("  https://host/"), F.col("doc_id"), F.lit("?a=1  b "))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit(" /path  x"), F.col("doc_id"))).otherwise(F.concat(F.lit("Ver Resumen  "), F.col("text"), F.lit(" PUBLICIDAD &amp; more")))
    return d.select("doc_id", _md5(T.prose(raw, [r"\bver resumen\b", r"\bpublicidad\b"])).alias("md5"))


def text_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir).select("doc_id", F.struct(F.col("text").alias("a"), F.split("text", "\n").alias("b"), F.create_map(F.lit("k"), F.struct(F.col("source").alias("s"), F.col("n_chars").alias("n"))).alias("c")).alias("x"))
    y = T.deep(F.col("x"), d.schema["x"].dataType, lambda c: F.lower(T.collapse(c)))
    return d.select("doc_id", y.alias("y")).select("doc_id", _md5(F.col("y.a")).alias("a"), _md5(F.array_join("y.b", "|")).alias("b"), F.col("y.c")["k"]["s"].alias("s"), F.col("y.c")["k"]["n"].alias("n"))


def text_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("{{a}} "), F.col("text"), F.lit(" {{ad {b} c}}  end"))).otherwise(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", _md5(T.without_templates(raw)).alias("md5"), T.has_templates(raw).alias("has"))


def text_site_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    a = F.concat(F.lit("Ver resumen "), F.col("source"), F.lit(" Resumen generado con una herramienta de inteligencia artificial desarrollada por BioBioChile y revisado por el autor de este artículo. "), F.col("lang"), F.lit(" desarrollada por BioBioChile."))
    b = F.concat(F.lit("Destacados: "), F.col("source"), F.lit(" Noticias del día, VER MÁS y también te puede interesar "), F.col("lang"), F.lit(" Algunos derechos reservados info@elmostrador.cl"))
    return d.select("doc_id", *(T.without_phrases(c, list(T.SITE_PHRASES[k])).alias(k) for k, c in (("shtml", a), ("dated", b))))


def text_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", T.slug(F.concat(F.lit(" Fondo Ñuñoa & Acción: "), F.col("p_brand"), F.lit(" / "), F.col("p_type"))).alias("slug"), T.slug(F.lit(" -- ")).alias("none"))


def text_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.col("text"), F.lit("\nPublicidad\nab\n\nLee también:\n  Visto   ahora \n"), F.col("text"), F.lit("\nlast  line"))
    d = _docs(spark, sf_dir).select("doc_id", T.paragraphs(raw).alias("p"), T.distinct_list(F.split(raw, "\n")).alias("l"))
    return d.select("doc_id", F.size("p").alias("n"), _md5(F.array_join("p", "\n")).alias("md5"), F.size("l").alias("items"))


def article_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a body in paragraphs, or with too few of them and a raw text."""
    d = _docs(spark, sf_dir)
    many = F.col("doc_id") % 2 == 0
    lines = F.split("text", "\n")
    a = d.select("doc_id", F.concat(F.lit("<b> "), F.col("source"), F.lit(" </b> news")).alias("title"), F.when(many, F.concat(lines, F.array(F.lit("<i>second  one</i>"), F.lit("“said”")))).otherwise(F.array(F.lit("only"))).alias("paragraphs"), F.when(many, "").otherwise(F.concat(F.col("text"), F.lit("\nsecond one\n“said”"))).alias("body_text_raw"), F.array(F.lit(" x "), F.lit("Related <b>one</b>"), F.lit("Related one")).alias("related_titles"))
    n = normalise.normalised(a)
    return n.select("doc_id", "title", F.array_join("related_titles", "|").alias("related"), "paragraph_count", "body_length_chars", "body_length_words", "quote_count", _md5(F.col("body_text_clean")).alias("body"))


def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that enrichment and clustering read, and the flat projection."""
    d = _docs(spark, sf_dir)
    a = d.select("doc_id", F.col("source"), F.concat(F.lit("T "), F.col("doc_id")).alias("title"), F.lit("").alias("subtitle"), F.lit("lead").alias("lead"), F.col("lang").alias("main_section"), F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("text", r"\s+", " ")).otherwise("").alias("body_text_clean"), F.array(F.lit("one"), F.lit("two")).alias("paragraphs"), F.lit("u").alias("url"))
    flat = normalise.unified(a).select(F.regexp_extract("title", r"\d+", 0).cast("long").alias("doc_id"), F.col("classification_text_length").alias("unified_length"), F.col("source").alias("unified_source"), F.size("related_titles").alias("n_related"))
    own = a.select("doc_id", _md5(normalise.classification_text(a)).alias("classification"), F.length(normalise.embedding_text(a)).alias("embedding_length"))
    return own.join(flat, "doc_id")


# Addresses and dates

_URL = "CASE doc_id % 6 WHEN 0 THEN 'https://www.biobiochile.cl/Noticias/economia/2024/0' || (1 + doc_id % 9) || '/15/nota-' || doc_id || '.shtml' WHEN 1 THEN 'https://www.biobiochile.cl/noticias/especial/x.shtml' WHEN 2 THEN 'https://www.elmostrador.cl/mercados/2024/0' || (1 + doc_id % 9) || '/07/nota/' WHEN 3 THEN 'https://elmostrador.cl/tag/2024/01/02/x' WHEN 4 THEN 'https://other.cl/noticias/2023/13/40/a.shtml' ELSE '' END"


def url_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "documents").select("doc_id", F.expr(_URL).alias("u"))
    return u.select("doc_id", U.article_address("u", "shtml").alias("shtml"), U.article_address("u", "dated").alias("dated"), U.url_date("u").alias("day"), U.file_name("u").alias("file"))


def url_named_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("https://x.cl/noticias/"), F.element_at(F.array(*map(F.lit, ("economia", "region-de-los-rios", "pais"))), (F.col("doc_id") % 3 + 1).cast("int")), F.lit("/sub-tema/2024/01/02/a.shtml")).alias("u"))
    s = editorial.sections("u")
    return u.select("doc_id", s.alias("s")).select("doc_id", "s.main_section", "s.subsection", "s.region_section")


_WRITTEN = "CASE o_orderkey % 5 WHEN 0 THEN day(d) || ' ' || mon || ', ' || year(d) || ' | 9:05' WHEN 1 THEN 'Publicado ' || day(d) || ' ' || upper(mon) || ' ' || year(d) WHEN 2 THEN strftime(d, '%Y-%m-%d') WHEN 3 THEN strftime(d, '%Y-%m-%d') || 'T22:30:15' ELSE 'ayer' END"


def dates_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("d", F.add_months(F.col("o_orderdate").cast("date"), 360))
    names = F.array(*map(F.lit, list(dict.fromkeys(m for m in D.MONTHS if m != "setiembre"))))
    o = o.withColumn("mon", F.element_at(names, F.month("d")))
    iso, k = F.date_format("d", "yyyy-MM-dd"), F.col("o_orderkey") % 5
    w = F.when(k == 0, F.concat(F.day("d"), F.lit(" "), F.col("mon"), F.lit(", "), F.year("d"), F.lit(" | 9:05"))).when(k == 1, F.concat(F.lit("Publicado "), F.day("d"), F.lit(" "), F.upper("mon"), F.lit(" "), F.year("d"))).when(k == 2, iso).when(k == 3, F.concat(iso, F.lit("T22:30:15"))).otherwise("ayer")
    url = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://x/"), F.date_format("d", "yyyy/MM/dd"), F.lit("/a"))).otherwise("https://x/a")
    c = D.corrected([w], url)
    return o.select("o_orderkey", c.alias("c")).select("o_orderkey", "c.day", "c.clock", "c.basis")


def dates_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    formats = ("yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy", "dd_MM_yyyy", "yyyy.MM.dd")
    w = F.coalesce(*(F.when(F.col("o_orderkey") % 5 == k, F.date_format("d", f)) for k, f in enumerate(formats)))
    return o.select("o_orderkey", D.any_date(w).alias("any"), D.folder_of("d").alias("folder"), D.folder_date(D.folder_of("d")).alias("back"), D.folder_date(w).alias("of_written"))


def dates_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return o.select("o_orderpriority", F.inline(D.ranges_column(F.col("a"), F.col("b"))))


def dates_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = {"range": ("2024-02-27", "02/03/2024", None), "back": (None, "2024_01_02".replace("_", "-"), 4), "ranges": None}
    rows = [(k, x) for k, v in asked.items() if v for x in cli.allowed_days(*v)]
    rows += [("ranges", f"{a}:{b}") for a, b in D.ranges(date(2024, 1, 1), date(2024, 3, 5))]
    return spark.createDataFrame(rows, "asked string, value string")


def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of listing pages made from the documents, in order, with the date in them."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.expr(_URL).alias("u"))
    d = d.select("doc_id", F.concat(F.lit('<ul><li><a class="t" href="'), F.col("u"), F.lit('">x</a></li><li><a href="https://x.cl/2024/02/03/b#c">y</a></li></ul>')).alias("html"))
    return pages.listing(d, "html", "doc_id", F.col("url") != "").select("doc_id", F.col("position").cast("int").alias("position"), "url", "date")


def sitemap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("<urlset><url><loc> https://x/"), F.col("o_orderkey"), F.lit(" </loc><lastmod>"), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"), F.lit("T10:00:00</lastmod></url><url><loc><![CDATA[https://y]]></loc></url></urlset>")).alias("x"))
    return o.select("o_orderkey", F.posexplode(pages.sitemap("x")).alias("position", "e")).select("o_orderkey", F.col("position").cast("int").alias("position"), "e.loc", "e.day")


# Filters and records


def editorial_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 7 == 0).alias("is_opinion"), F.when(F.col("doc_id") % 5 == 0, True).alias("is_culture"), F.element_at(F.array(*map(F.lit, ("Economía", "DEPORTES", "País", "Cartas al director"))), (F.col("doc_id") % 4 + 1).cast("int")).alias("main_section"), F.lit(None).cast("string").alias("subsection"), F.when(F.col("doc_id") % 3 == 0, " ").otherwise("x").alias("t"))
    return mining.record_status(d, "t", mining.usable(d, ["main_section", "subsection"])).select("doc_id", "status")


def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editorial_exclusion(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


def day_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose publication is the day of their folder, and those that are put aside."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.add_months(F.col("o_orderdate").cast("date"), 360).alias("day"))
    w = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(F.date_add("day", 1), "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format("day", "yyyy-MM-dd")).otherwise("?")
    good, bad = news.with_integrity(o, [w], F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://x/"), F.date_format("day", "yyyy/MM/dd"), F.lit("/"))).otherwise(""))
    return good.select("o_orderkey", F.lit(True).alias("good"), F.col("publication.basis")).unionByName(bad.select("o_orderkey", F.lit(False).alias("good"), F.col("publication.basis")))


def bad_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("t"))
    return t.select("p_partkey", mining.is_bad_term(F.col("t"), ["part", "1", "12"], ["part 3", "77"]).alias("bad"))


def entity_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("el Banco Central de "), F.initcap("source"), F.lit(" y Ee Uu con Trump")).alias("t"))
    e = mining.capitalised(d, "doc_id", "t", {"ee uu": "estados unidos", "trump": "donald trump"})
    return mining.entity_table(e)


def corpus_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.samples(read(spark, sf_dir, "documents"), "lang", "doc_id", ["source"], 20)


def enrich_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of documents that were worked on, those that changed since, and new ones."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    done = enrich.fingerprint(d.where("doc_id % 3 <> 0").withColumn("text", F.when(F.col("doc_id") % 5 == 0, "old").otherwise(F.col("text"))), ["text", "source"])
    return enrich.changed(enrich.fingerprint(d, ["source", "text"]), done, "doc_id").select("doc_id")


def fund_latest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = funds(spark, sf_dir).select(F.date_format("date", "yyyyMMdd").alias("FECHA_INF"), *(F.lit(None).cast("string").alias(c) for c in ("VALOR_CUOTA", *fund_files_.NUMERIC)))
    return fund_files_.latest_day(fund_files_.typed(f))


def common_day_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day with quotes of all funds and news of all media."""
    q = funds(spark, sf_dir).select("fund_key", F.col("date").alias("day"))
    m = read(spark, sf_dir, "events").select(F.concat(F.lit("m"), F.col("user_id") % 3).alias("medium"), F.add_months(F.col("ts").cast("date"), -312).alias("day"))
    return reports.latest_common_day(q, m, "fund_key", "medium", 5, 3)


# Files


def _put(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file on whatever file system the folder is on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(content))
    out.close()


ARTICLE = "metadata struct<n:int>, articles array<struct<id:long,n:long>>"


def news_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two media and six days: one broken, one under a second name, one outside of the days asked for."""
    base = _folder(spark)
    nations = [(r.n_nationkey, r.n_regionkey) for r in read(spark, sf_dir, "nation").collect()]
    for m in ("a", "b"):
        for k in range(6):
            mine = [{"id": i, "n": r} for i, r in nations if i % 6 == k]
            text = json.dumps({"metadata": {"n": len(mine)}, "articles": mine})
            _put(spark, f"{base}/{m}/0{k + 1}_03_2024/noticias_dia.txt", b"{broken" if (m, k) == ("b", 2) else text.encode())
            _put(spark, f"{base}/{m}/0{k + 1}_03_2024/noticias_dia", b'{"metadata": {"n": 9}, "articles": []}')
    _put(spark, f"{base}/b/10_03_2024/noticias_dia", b'{"metadata": {"n": 0}, "articles": [{"id": 99, "n": 1}]}')
    files = news.read_days(spark, base, ["a", "b", "missing"], StructType.fromDDL(ARTICLE), [date(2024, 3, k) for k in (1, 2, 3, 4, 10)])
    rows = news.articles(files)
    return rows.groupBy("medium", "day").agg(F.count("*").alias("n"), F.sum("article.id").alias("ids"), F.max("position").cast("int").alias("last"))


def news_days_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written, one of them again; a key that another stored day has is refused."""
    path = _folder(spark)
    o = read(spark, sf_dir, "orders").where("o_orderdate >= '1996-01-02' and o_orderdate < '1996-01-09'").select(F.lit("m").alias("medium"), F.col("o_orderdate").cast("date").alias("day"), F.concat(F.lit("k"), F.col("o_orderkey")).alias("key"), F.lit(1).alias("v"))
    news.write_days(o, path, "key")
    news.write_days(o.where("day = '1996-01-02'").withColumn("v", F.lit(2)), path, "key")
    try:
        news.write_days(o.where("day = '1996-01-02'").limit(1).withColumn("day", F.lit("1996-02-01").cast("date")), path, "key")
        refused = 0
    except ValueError:
        refused = 1
    return spark.read.parquet(path).groupBy("medium", F.col("day").cast("date").alias("day")).agg(F.count("*").alias("n"), F.sum("v").alias("v")).withColumn("refused", F.lit(refused))


def fund_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in two encodings with decimal commas, a broken line, a repeated day and two series."""
    base = _folder(spark)
    head = "RUN_FM;FECHA_INF;SERIE;NOM_ADM;VALOR_CUOTA;PATRIMONIO_NETO"
    rows = [(r.n_nationkey, r.n_regionkey) for r in read(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]
    for name, codec in (("one", "utf-8"), ("two", "latin-1")):
        mine = [(k, r) for k, r in rows if (k < 13) == (name == "one")]
        lines = [head, *(f"8305;202401{k + 1:02};{s};Administración;{k + 1},{r};{k * 10}" for k, r in mine for s in ("F1", "APV")), "8305;20240101;F1;short", f"8305;202401{mine[0][0] + 1:02};F1;again;{mine[0][0] + 100},5;1", f"8305;202401{mine[1][0] + 1:02};F1;none;-1;1"]
        _put(spark, f"{base}/{name}.txt", "\n".join(lines).encode(codec))
    f = fund_files_.load(spark, [f"{base}/*.txt"], "8305", ["F1", "APV"], "2024-01-01", "2024-01-31")
    return f.select("RUN_FM", "SERIE", "date", "valor_cuota", "PATRIMONIO_NETO")


def fund_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a fund's folder and of folders named after its number."""
    base = _folder(spark)
    for r in read(spark, sf_dir, "region").collect():
        for folder in ("8305_own", f"8305_{r.r_regionkey}", f"9936_{r.r_regionkey}"):
            _put(spark, f"{base}/{folder}/{r.r_name.lower().replace(' ', '-')}.txt", b"x")
        _put(spark, f"{base}/8305_own/{r.r_regionkey}.csv", b"x")
    found = [p.split("/")[-2:] for p in fund_files_.discover(spark, base, "8305_own", "8305")]
    return spark.createDataFrame([tuple(p) for p in found], "folder string, file string")


def response_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").collect()
    rows = [(r.n_nationkey, fund_files_.response_name(f"{r.n_nationkey}_fondo", "01/02/2024", "03/03/2024", ("", 'attachment; filename="a b.txt"', "attachment; filename=c.txt")[r.n_nationkey % 3], frozenset({"7_fondo_a b.txt"}))) for r in n]
    return spark.createDataFrame(rows, "n_nationkey long, name string")


def normalised_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file changed in place twice, and as a sibling; the backup stays the original, a broken file stays as it is."""
    base, n = _folder(spark), read(spark, sf_dir, "nation").count()
    path = f"{base}/noticias_dia.txt"
    _put(spark, path, json.dumps({"n": n}).encode())
    _put(spark, f"{base}/broken.txt", b"{")
    more = lambda p: {"n": p["n"] + 1}
    written = [news.rewrite_file(spark, path, more), news.rewrite_file(spark, path, more), news.rewrite_file(spark, path, more, overwrite=False), news.rewrite_file(spark, f"{base}/broken.txt", more)]
    rows = [(name, spark.read.text(f"{base}/{name}", wholetext=True).select(F.get_json_object("value", "$.n").cast("long")).first()[0]) for name in ("noticias_dia.txt", "noticias_dia.txt.bak", "noticias_dia_normalizado.txt")]
    return spark.createDataFrame([*rows, ("refused", sum(w is None for w in written))], "file string, n long")


def term_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first terms of a nested report of parts, with how often each occurs."""
    parts = read(spark, sf_dir, "part").groupBy("p_brand").agg(F.sum("p_size").alias("n")).orderBy("p_brand").collect()
    report = {"a": [{"term": r.p_brand, "count": r.n * 100, "more": {"token": f"{r.p_brand}x", "frecuencia": 0.4}} for r in parts], "b": {"term": "late", "count": 1}}
    return spark.createDataFrame([(k, t, n) for k, (t, n) in enumerate(dictionaries.preview(report))], "place int, term string, n string")


def dictionary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionaries of all kinds of files, in one order; the weights of terms given twice, the families of names."""
    with tempfile.TemporaryDirectory() as folder:  # read on the driver alone
        Path(folder, "fiscal.txt").write_text("# note\nGasto Público, 2.5\nab\ndeuda; x\ndeuda;1.5\n", encoding="utf-8")
        Path(folder, "risk.json").write_text(json.dumps({"items": [{"term": "Alza Fuerte", "peso": 3}, "quiebra total", {"petroleo": ["crudo", {"name": "Brent"}]}, {"plazo": 1.2, "largo plazo": "x"}]}), encoding="utf-8")
        Path(folder, "broken.json").write_text("{", encoding="utf-8")
        entries = dictionaries.load(folder, base=[])
    report = {"financial_strict": {"ngrams_top": [{"term": "tasa alta", "df_pct": 0.1}, {"term": "común", "df_pct": 0.5}], "tfidf_top": [{"term": "uf", "score": 3}, {"term": "dato", "count": 100}, {"term": "tope", "score": 0.01}]}, "political_risk": None}
    entries += dictionaries.from_candidates(report, {"gobierno"}, most=2)
    f = dictionaries.as_frame(spark, entries)
    return f.select("family", "norm_term", F.round("weight", 6).alias("weight"), "n_words", "position")


def dictionary_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of the seeds by family, and their total weight."""
    f = dictionaries.as_frame(spark, dictionaries.seeds())
    return f.groupBy("family").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 4).alias("weight"), F.max("n_words").alias("most_words"))


SENTENCES = ("El Banco Central subió la tasa de interés por la inflación", "Codelco y ENAP anuncian inversión en litio y cobre", "Trump y China: aranceles y guerra comercial", "El fútbol y la música llenan el estadio", "EE.UU. teme una recesión y caída del petróleo", "Nada que decir aquí")


def seed_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production dictionary over Spanish sentences, phrases and references resolved."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.element_at(F.array(*map(F.lit, SENTENCES)), (F.col("doc_id") % len(SENTENCES) + 1).cast("int")).alias("s"))
    d = d.withColumn("t", T.match_text(F.concat(F.col("s"), F.lit(" &amp; <b>m&aacute;s</b>")), exact=True))
    m = matching.family_matches(matching.term_counts(d, "doc_id", "t", dictionaries.as_frame(spark, dictionaries.seeds())), "doc_id")
    return m.select("doc_id", "family", "active", "score", "hit_count", F.array_join(F.array_sort("hits"), ",").alias("hits"))


def seed_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production seed sets and class rules over Spanish sentences; texts without hits stay."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.element_at(F.array(*map(F.lit, SENTENCES)), (F.col("doc_id") % len(SENTENCES) + 1).cast("int")).alias("s"))
    d = d.withColumn("t", T.match_text("s", exact=True))
    terms = matching.dictionary(spark, {f: dict.fromkeys(ts, 1.0) for f, ts in CLASS_SEEDS.items()}, least=1)
    h = matching.seed_hits(d, matching.term_counts(d, "doc_id", "t", terms), "doc_id", list(CLASS_SEEDS))
    c = mining.seed_rules(h)
    return c.select("doc_id", F.array_join("market", ",").alias("market"), F.array_join("hard_event", ",").alias("hard_event"), "strict_score", "is_financial_strict", "is_political_risk", "is_geopolitical_market", "is_social_noise_dominant")


# By sentence: market, hard events, strict score and the four classes.
_CLASSES = (
    (0, "banco_central,inflacion,tasa_de_interes", "", 9, "true", "false", "false", "false"),
    (1, "", "", 12, "true", "false", "false", "false"),
    (2, "", "aranceles,guerra", 0, "false", "false", "true", "false"),
    (3, "", "", 0, "false", "false", "false", "false"),
    (4, "recesion", "", 6, "true", "false", "true", "false"),
    (5, "", "", 0, "false", "false", "false", "false"),
)

_FOUND = (  # by sentence: family, terms, total weight of terms that occur once
    (0, "mercado_financiero", "banco_central,inflacion,tasa_de_interes", (3.0, 2.5, 2.5)),
    (0, "empresas_instituciones", "banco_central", (2.0,)),
    (1, "energia_commodities", "cobre,codelco,enap,litio", (2.8, 2.5, 2.5, 2.5)),
    (1, "empresas_instituciones", "codelco,enap", (2.5, 2.3)),
    (1, "sentimiento_positivo", "inversion", (1.4,)),
    (2, "geopolitico_mercado", "aranceles,china,donald_trump,guerra", (2.5, 2.0, 1.8, 1.2)),
    (3, "ruido_social", "futbol,musica", (1.5, 1.2)),
    (4, "geopolitico_mercado", "estados_unidos", (1.8,)),
    (4, "riesgo_alerta", "caida,recesion", (1.8, 2.5)),
    (4, "sentimiento_negativo", "caida", (1.5,)),
    (4, "energia_commodities", "petroleo", (3.0,)),
)


def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written as one file each and read again, with the flat form of nested results."""
    rows = [{"fund": r.n_name, "rows": r.n_nationkey, "metrics": {"accuracy": r.n_regionkey / 4, "matrix": [[1, 2]]}, "params": {"depth": 3}} for r in read(spark, sf_dir, "nation").collect()]
    path = f"{_folder(spark)}/report.json"
    _put(spark, path, json.dumps([reports.flat(r) for r in rows]).encode())
    with tempfile.TemporaryDirectory() as folder:  # the driver's own state, replaced as a whole
        reports.write_atomic(f"{folder}/state.json", {"n": 1})
        reports.write_atomic(f"{folder}/state.json", {"n": len(rows)})
        n = json.loads(Path(folder, "state.json").read_text())["n"]
    found = reports.read_reports(spark, path)
    return found.select("fund", "rows", "metric_accuracy", F.lit(len(found.columns)).alias("n_columns"), F.lit(n).cast("long").alias("n_rows"))


# Configuration and runs


def feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns a model may see, with and without returns of the day itself."""
    kinds = {"return_1d": "double", "valor_cuota": "double", "momentum_10": "double", "news_count": "long", "SERIE": "string", "date": "date", "target_up": "double", "log_return_1d": "double", "quote_age_calendar_days": "int"}
    df = spark.createDataFrame([], ", ".join(f"{k} {v}" for k, v in kinds.items()))
    return spark.createDataFrame([(same, c) for same in (True, False) for c in scenarios.feature_columns(df, same)], "same_day boolean, feature string")


def split_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(p, *scenarios.split_days("2024-01-01", "2024-03-31", p)) for p in (1.0, 50.0, 77.5, 90.0)]
    return spark.createDataFrame(rows, "percent double, train_end string, eval_start string")


def scenario_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for s in (scenarios.Scenario(), scenarios.Scenario("decision_date_news", "decision_date", 1, 4)):
        rows.append((s.name, s.label("strict_lag"), s.label(s.label("strict_lag")), scenarios.report_tag([s])))
    return spark.createDataFrame(rows, "name string, label string, again string, tag string")


def experiment_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(f, t, signals.experiment_key(f, "night_partial", 0.5 + t, t)) for f in ("fund.a", "b") for t in (0.0, 0.0125)]
    return spark.createDataFrame(rows, "fund string, target double, key string")


def config_runtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How presets, scenarios and wishes make a run."""
    presets = {"presets": {"national_equity": {"target_threshold": 0.001, "decision_mode": "night_partial", "decision_time": "21:30"}}, "scenarios": {"national_equity": {"cmf_date_news": {"probability_threshold": 0.6}}}, "models": {"national_equity": {"max_depth": 3}}}
    rows = []
    for name, scenario, wish in (("plain", None, None), ("scenario", "cmf_date_news", None), ("wish", None, {"decision_mode": "strict_lag", "probability_threshold": 0.7})):
        c = config.runtime("national_equity", presets, scenario, wish)
        rows.append((name, c["decision_mode"], c["decision_time"] or "", float(c["probability_threshold"]), float(c["target_threshold"]), c["scenario"], c["params"]["max_depth"]))
    code, label = config.option_by_terms([("1", "Fondo Acción Nacional"), ("2", "Fondo Deuda")], None, ["accion", "nacional"])
    rows.append(("option", label, code, float(len(config.selected(["all"]))), float(len(config.selected(["Toesca_Equity", "toesca_equity"]))), config.mode("night_partial")["decision_time"], 0))
    return spark.createDataFrame(rows, "name string, decision_mode string, decision_time string, probability double, target double, scenario string, max_depth int")


def confusion_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = funds(spark, sf_dir).select("fund_key", (F.col("valor_cuota") > 150_000).cast("int").alias("y"), (F.col("NUM_PARTICIPES") > 2).cast("int").alias("g"))
    rows = metrics.classification(p, "y", "g", ["fund_key"]).collect()
    return spark.createDataFrame([(r.fund_key, metrics.confusion_lines(r.asDict())) for r in rows], "fund_key string, lines string")


def load_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that a scheduled run goes back; -1 where it refuses."""
    rows = []
    for last in (None, "2024-03-10", "2024-03-09", "2024-03-01", "2024-02-01", "2024-03-11"):
        try:
            rows.append((last or "", stream.days_to_load(last, date(2024, 3, 10))))
        except RuntimeError:
            rows.append((last or "", -1))
    return spark.createDataFrame(rows, "last string, days int")


def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The high-water mark after a success, and one run at a time."""
    with tempfile.TemporaryDirectory() as folder:  # state of one machine's scheduler
        stream.save_success(f"{folder}/s.json", "a", date(2024, 3, 1), "now")
        stream.save_success(f"{folder}/s.json", "b", date(2024, 3, 2), "now")
        stream.save_success(f"{folder}/s.json", "a", date(2024, 3, 3), "now")
        state = stream.load_state(f"{folder}/s.json")
        with stream.exclusive(f"{folder}/lock"):
            try:
                with stream.exclusive(f"{folder}/lock"):
                    second = True
            except RuntimeError:
                second = False
    return spark.createDataFrame([(k, v["last_successful_date"], second) for k, v in state.items()], "source string, last string, second boolean")


def stream_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a stream twice; only changed ones are built again."""
    base, schema = _folder(spark), "doc_id long, text string, round int"
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    for k, rows in enumerate((d, d.withColumn("text", F.when(F.col("doc_id") % 4 == 0, "new").otherwise(F.col("text"))))):
        rows.withColumn("round", F.lit(k)).write.mode("append").parquet(f"{base}/in")
        s = enrich.fingerprint(spark.readStream.schema(schema).parquet(f"{base}/in"), ["text"])
        stream.rebuild_changed(s, "doc_id", "input_sha256", lambda x: x.withColumn("n", F.length("text")), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("round").agg(F.count("*").alias("rows"), F.sum("n").alias("chars"))


QUERIES = {
    f.__name__: f
    for f in (
        text_spaces, text_strip_html, text_prose, text_deep, text_templates, text_site_phrases, text_slug, text_paragraphs, article_normalised, article_texts,
        url_articles, url_named_sections, dates_publication, dates_user, dates_ranges, dates_allowed, listing_scan, sitemap_scan,
        editorial_exclusion, record_counts, day_mismatch, bad_terms, entity_aliases, corpus_samples, enrich_unchanged, fund_latest_day, common_day_of_all,
        news_files, news_days_stored, fund_files, fund_discovery, response_names, normalised_files, term_preview, dictionary_files, dictionary_seeds, seed_families, seed_classes, report_files,
        feature_selection, split_percent, scenario_labels, experiment_keys, config_runtime, confusion_text, load_days, run_state, stream_rebuild,
    )
}

_COLLAPSE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


def _nested(c: str, patterns) -> str:
    """Each pattern in turn, whatever its case, to a space."""
    for p in patterns:
        c = f"regexp_replace({c}, '(?i){p}', ' ', 'g')"
    return c


_BOILER = "length(x) <= 2 OR regexp_matches(lower(x), '" + "|".join(f"(?:{p})" for p in T.BOILERPLATE) + "')"
_PARAS = "list_filter(list_transform(regexp_split_to_array({}, '\\n+'), lambda x: " + _COLLAPSE.format("x") + "), lambda x: NOT (" + _BOILER + "))"
_DISTINCT = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
_MON = "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre']"
_EXCLUDED = "CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 OR doc_id % 4 IN (1, 3) THEN 'excluded' WHEN doc_id % 3 = 0 THEN 'empty' ELSE 'ok' END"
_FUNDS = "f AS (SELECT o_orderpriority AS fund_key, o_orderdate::DATE AS date, round(avg(o_totalprice), 4) AS valor_cuota, count(DISTINCT o_custkey) AS people FROM orders GROUP BY 1, 2)"


def _values(rows, columns: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(repr(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows) + f") t({columns})"


ORACLE_SQL = {
    "text_spaces": f"WITH {_DOCS}, x AS (SELECT doc_id, chr(32) || chr(9) || chr(13) || replace(text, ' ', ' ' || chr(9) || ' ') || repeat(chr(10), 5) || 'end ' || chr(12) AS t FROM d), y AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(t, chr(160), ' '), '[ \\t\\r\\f\\v]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g') AS t FROM x) SELECT doc_id, md5(t) AS md5, length(t)::INT AS n FROM y",
    "text_strip_html": f"WITH {_DOCS} SELECT doc_id, md5(trim(regexp_replace(trim(replace(text, chr(10), ' '), ' ' || chr(9) || chr(13) || chr(11) || chr(12)) || ' tail & café', '[ \\t\\r\\f\\v]+', ' ', 'g'))) AS md5 FROM d",
    "text_prose": f"WITH {_DOCS} SELECT doc_id, md5(CASE doc_id % 4 WHEN 0 THEN 'https://host/' || doc_id || '?a=1  b' WHEN 1 THEN '/path  x' || doc_id ELSE {_COLLAPSE.format(_nested(chr(39) + 'Ver Resumen  ' + chr(39) + ' || text || ' + chr(39) + ' PUBLICIDAD & more' + chr(39), ['\\bver resumen\\b', '\\bpublicidad\\b']))} END) AS md5 FROM d",
    "text_deep": f"WITH {_DOCS} SELECT doc_id, md5(lower({_COLLAPSE.format('text')})) AS a, md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x: lower({_COLLAPSE.format('x')})), '|')) AS b, lower({_COLLAPSE.format('source')}) AS s, n_chars AS n FROM d",
    "text_templates": f"WITH {_DOCS} SELECT doc_id, md5({_COLLAPSE.format('text || CASE WHEN doc_id % 2 = 0 THEN ' + chr(39) + '  end' + chr(39) + ' ELSE ' + chr(39) * 2 + ' END')}) AS md5, doc_id % 2 = 0 AS has FROM d",
    "text_site_phrases": "SELECT doc_id, trim(source) || ' ' || trim(lang) AS shtml, ': ' || trim(source) || ' , y ' || trim(lang) AS dated FROM documents",
    "text_slug": "SELECT p_partkey, trim(regexp_replace(translate(lower(trim(' Fondo Ñuñoa & Acción: ' || p_brand || ' / ' || p_type)), 'áéíóúüñ', 'aeiouun'), '[^a-z0-9]+', '_', 'g'), '_') AS slug, 'fondo' AS none FROM part",
    "text_paragraphs": f"WITH {_DOCS}, x AS (SELECT doc_id, text || chr(10) || 'Publicidad' || chr(10) || 'ab' || chr(10) || chr(10) || 'Lee también:' || chr(10) || '  Visto   ahora ' || chr(10) || text || chr(10) || 'last  line' AS t FROM d), y AS (SELECT doc_id, {_PARAS.format('t')} AS p, list_filter(list_transform(string_split(t, chr(10)), lambda x: {_COLLAPSE.format('x')}), lambda x: x <> '') AS l FROM x), z AS (SELECT doc_id, {_DISTINCT.format('p')} AS p, {_DISTINCT.format('l')} AS l FROM y) SELECT doc_id, len(p)::INT AS n, md5(coalesce(array_to_string(p, chr(10)), '')) AS md5, len(l)::INT AS items FROM z",
    "article_normalised": f"WITH {_DOCS}, x AS (SELECT doc_id, source, {_PARAS.format('text')} || ['second one', '“said”'] AS p FROM d), y AS (SELECT doc_id, source, {_DISTINCT.format('p')} AS p FROM x), z AS (SELECT *, array_to_string(p, ' ') AS b FROM y) SELECT doc_id, trim(source) || ' news' AS title, 'Related one' AS related, len(p)::INT AS paragraph_count, length(b)::INT AS body_length_chars, len(string_split(b, ' '))::INT AS body_length_words, len(regexp_extract_all(b, '[“”]'))::INT AS quote_count, md5(b) AS body FROM z",
    "article_texts": f"WITH {_DOCS}, x AS (SELECT doc_id, source, lang, CASE WHEN doc_id % 2 = 0 THEN regexp_replace(text, '\\s+', ' ', 'g') ELSE '' END AS b FROM d) SELECT doc_id, md5('T ' || doc_id || ' lead ' || CASE WHEN b <> '' THEN b ELSE 'one two' END || ' ' || lang) AS classification, least(1200, length('T ' || doc_id) + CASE WHEN b <> '' THEN 1 + length(b) ELSE 0 END)::INT AS embedding_length, (length('T ' || doc_id || ' lead') + CASE WHEN trim(b) <> '' THEN 1 + length(trim(b)) ELSE 0 END)::INT AS unified_length, source AS unified_source, 0 AS n_related FROM x",
    "url_articles": f"WITH u AS (SELECT doc_id, {_URL} AS u FROM documents) SELECT doc_id, doc_id % 6 = 0 AS shtml, doc_id % 6 = 2 AS dated, CASE doc_id % 6 WHEN 0 THEN make_date(2024, (1 + doc_id % 9)::INT, 15) WHEN 2 THEN make_date(2024, (1 + doc_id % 9)::INT, 7) WHEN 3 THEN DATE '2024-01-02' END AS day, CASE doc_id % 6 WHEN 0 THEN 'nota-' || doc_id WHEN 1 THEN 'x' WHEN 2 THEN 'nota' WHEN 3 THEN 'x' WHEN 4 THEN 'a' ELSE '' END AS file FROM u",
    "url_named_sections": "SELECT doc_id, ['Economia', 'Region De Los Rios', 'Pais'][doc_id % 3 + 1] AS main_section, 'Sub Tema' AS subsection, CASE WHEN doc_id % 3 = 1 THEN 'Region De Los Rios' ELSE '' END AS region_section FROM documents",
    "dates_publication": "WITH orders AS (SELECT o_orderkey, (o_orderdate::DATE + INTERVAL 30 YEAR)::DATE AS o_orderdate FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 OR o_orderkey % 2 = 0 THEN o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 5 = 0 THEN '09:05:00' WHEN o_orderkey % 5 = 3 THEN '22:30:15' WHEN o_orderkey % 5 < 4 OR o_orderkey % 2 = 0 THEN '' END AS clock, CASE WHEN o_orderkey % 5 < 4 THEN 'published' WHEN o_orderkey % 2 = 0 THEN 'url_fallback' END AS basis FROM orders",
    "dates_user": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN o_orderdate::DATE END AS any, strftime(o_orderdate, '%d_%m_%Y') AS folder, o_orderdate::DATE AS back, CASE WHEN o_orderkey % 5 = 3 THEN o_orderdate::DATE END AS of_written FROM orders",
    "dates_ranges": "WITH o AS (SELECT o_orderpriority, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1), s AS (SELECT o_orderpriority, b, unnest(range(a::TIMESTAMP, b::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 31 DAY))::DATE AS start FROM o) SELECT o_orderpriority, start, least(start + 30, b) AS \"end\" FROM s",
    "dates_allowed": _values([("range", x) for x in ("2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02")] + [("back", x) for x in ("2024-01-02", "2024-01-01", "2023-12-31", "2023-12-30")] + [("ranges", x) for x in ("2024-01-01:2024-01-31", "2024-02-01:2024-03-02", "2024-03-03:2024-03-05")], "asked, value"),
    "listing_scan": f"WITH u AS (SELECT doc_id, {_URL} AS u FROM documents) SELECT doc_id, CASE WHEN u = '' THEN 0 ELSE 0 END AS position, u AS url, CASE doc_id % 6 WHEN 0 THEN make_date(2024, (1 + doc_id % 9)::INT, 15) WHEN 2 THEN make_date(2024, (1 + doc_id % 9)::INT, 7) WHEN 3 THEN DATE '2024-01-02' END AS date FROM u WHERE u <> '' UNION ALL SELECT doc_id, CASE WHEN u = '' THEN 0 ELSE 1 END, 'https://x.cl/2024/02/03/b', DATE '2024-02-03' FROM u",
    "sitemap_scan": "SELECT o_orderkey, 0 AS position, 'https://x/' || o_orderkey AS loc, o_orderdate::DATE AS day FROM orders UNION ALL SELECT o_orderkey, 1, 'https://y', NULL FROM orders",
    "editorial_exclusion": f"SELECT doc_id, {_EXCLUDED} AS status FROM documents",
    "record_counts": f"SELECT {_EXCLUDED} AS status, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1",
    "day_mismatch": "SELECT o_orderkey, o_orderkey % 3 = 1 OR (o_orderkey % 3 = 2 AND o_orderkey % 2 = 0) AS good, CASE WHEN o_orderkey % 3 < 2 THEN 'published' WHEN o_orderkey % 2 = 0 THEN 'url_fallback' END AS basis FROM orders",
    "bad_terms": "SELECT p_partkey, length(trim(t)) < 4 OR len(list_filter(string_split(trim(t), ' '), lambda x: x NOT IN ('part', '1', '12'))) = 0 OR contains(t, 'part 3') OR contains(t, '77') AS bad FROM (SELECT p_partkey, lower(p_name) AS t FROM part)",
    "entity_aliases": "WITH e AS (SELECT lower(unnest(regexp_extract_all('el Banco Central de ' || upper(source[1]) || lower(source[2:]) || ' y Ee Uu con Trump', '(\\p{Lu}[\\p{L}]+(?: \\p{Lu}[\\p{L}]+)*)', 1))) AS e FROM documents) SELECT CASE e WHEN 'ee uu' THEN 'estados unidos' WHEN 'trump' THEN 'donald trump' ELSE e END AS entity, count(*) AS n FROM e WHERE length(e) >= 3 GROUP BY 1 ORDER BY n DESC, entity LIMIT 300",
    "corpus_samples": "SELECT lang, doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 20",
    "enrich_unchanged": "SELECT doc_id FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0",
    "fund_latest_day": "SELECT max(o_orderdate)::DATE AS latest FROM orders",
    "common_day_of_all": "WITH q AS (SELECT o_orderdate::DATE AS day FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 5), m AS (SELECT (ts::DATE - INTERVAL 312 MONTH)::DATE AS day FROM events GROUP BY 1 HAVING count(DISTINCT user_id % 3) = 3) SELECT max(day) AS latest FROM q JOIN m USING (day)",
    "news_files": "WITH n AS (SELECT n_nationkey AS id, n_nationkey % 6 AS k FROM nation), x AS (SELECT m, make_date(2024, 3, (k + 1)::INT) AS day, id FROM n, (VALUES ('a'), ('b')) t(m) WHERE k < 4 AND NOT (m = 'b' AND k = 2) UNION ALL SELECT 'b', DATE '2024-03-10', 99) SELECT m AS medium, day, count(*) AS n, sum(id)::BIGINT AS ids, (count(*) - 1)::INT AS last FROM x GROUP BY 1, 2",
    "news_days_stored": "SELECT 'm' AS medium, o_orderdate::DATE AS day, count(*) AS n, (count(*) * CASE WHEN o_orderdate::DATE = DATE '1996-01-02' THEN 2 ELSE 1 END)::BIGINT AS v, 1 AS refused FROM orders WHERE o_orderdate >= '1996-01-02' AND o_orderdate < '1996-01-09' GROUP BY o_orderdate",
    "fund_files": "SELECT '8305' AS RUN_FM, 'F1' AS SERIE, make_date(2024, 1, (n_nationkey + 1)::INT) AS date, CASE WHEN n_nationkey IN (0, 13) THEN n_nationkey + 100.5 ELSE n_nationkey + 1 + n_regionkey / 10 END::DOUBLE AS valor_cuota, CASE WHEN n_nationkey IN (0, 13) THEN 1 ELSE n_nationkey * 10 END::DOUBLE AS PATRIMONIO_NETO FROM nation",
    "dictionary_files": _values([("macro_fiscal", "gasto publico", 2.5, 2, 0), ("macro_fiscal", "deuda", 1.5, 1, 1), ("riesgo_alerta", "alza fuerte", 3.0, 2, 2), ("riesgo_alerta", "quiebra total", 1.0, 2, 3), ("riesgo_alerta", "largo plazo", 1.0, 2, 4), ("riesgo_alerta", "plazo", 1.2, 1, 5), ("energia_commodities", "crudo", 1.0, 1, 6), ("energia_commodities", "brent", 1.0, 1, 7), ("mercado_financiero", "tasa alta", 0.9, 2, 8)], "family, norm_term, weight, n_words, position"),
    "dictionary_seeds": _values([("macro_fiscal", 12, 24.5, 2), ("mercado_financiero", 15, 36.0, 1), ("energia_commodities", 13, 28.7, 2), ("empresas_instituciones", 12, 24.9, 3), ("politico_regulatorio", 12, 19.5, 3), ("geopolitico_mercado", 16, 32.7, 3), ("riesgo_alerta", 11, 21.0, 1), ("sentimiento_positivo", 8, 11.0, 1), ("sentimiento_negativo", 9, 14.8, 1), ("ruido_social", 9, 11.4, 1)], "family, n, weight, most_words"),
    "report_files": "SELECT n_name AS fund, n_nationkey::BIGINT AS rows, n_regionkey / 4 AS metric_accuracy, 3 AS n_columns, (SELECT count(*) FROM nation) AS n_rows FROM nation",
    "feature_selection": _values([("true", "return_1d"), ("true", "momentum_10"), ("true", "news_count"), ("true", "log_return_1d"), ("true", "quote_age_calendar_days"), ("false", "momentum_10"), ("false", "news_count"), ("false", "quote_age_calendar_days")], "s, feature").replace("SELECT *", "SELECT s::BOOLEAN AS same_day, feature"),
    "split_percent": "SELECT p::DOUBLE AS percent, strftime(DATE '2024-01-01' + greatest(1, round(91 * p / 100)::INT) - 1, '%Y-%m-%d') AS train_end, strftime(DATE '2024-01-01' + greatest(1, round(91 * p / 100)::INT), '%Y-%m-%d') AS eval_start FROM (VALUES (1.0), (50.0), (77.5), (90.0)) t(p)",
    "scenario_labels": "WITH s AS (SELECT left(sha256('{\"decision_mode\": \"strict_lag\", \"decision_time\": null, \"holidays\": [], \"horizon_business_days\": 4, \"name\": \"decision_date_news\", \"news_reference\": \"decision_date\", \"quote_lag_days\": 1, \"weekmask\": \"1111100\"}'), 12) AS h, left(sha256('[{\"decision_mode\": \"strict_lag\", \"decision_time\": null, \"holidays\": [], \"horizon_business_days\": 4, \"name\": \"decision_date_news\", \"news_reference\": \"decision_date\", \"quote_lag_days\": 1, \"weekmask\": \"1111100\"}]'), 12) AS g) SELECT 'legacy' AS name, 'strict_lag' AS label, 'strict_lag' AS again, '' AS tag UNION ALL SELECT 'decision_date_news', 'decision_date_news_h4_' || h || '_strict_lag', 'decision_date_news_h4_' || h || '_strict_lag', '_decision_date_news_' || g FROM s",
    "config_runtime": _values([("plain", "night_partial", "21:30", 0.5, 0.001, "legacy", 3), ("scenario", "same_day_close", "", 0.6, 0.001, "cmf_date_news", 3), ("wish", "strict_lag", "", 0.7, 0.001, "legacy", 3), ("option", "Fondo Acción Nacional", "1", 7.0, 1.0, "21:30", 0)], "name, decision_mode, decision_time, probability, target, scenario, max_depth"),
    "confusion_text": f"WITH {_FUNDS}, c AS (SELECT fund_key, count(*) FILTER (valor_cuota <= 150000 AND people <= 2) AS tn, count(*) FILTER (valor_cuota <= 150000 AND people > 2) AS fp, count(*) FILTER (valor_cuota > 150000 AND people <= 2) AS fn, count(*) FILTER (valor_cuota > 150000 AND people > 2) AS tp FROM f GROUP BY 1) SELECT fund_key, rpad('', 18, ' ') || lpad('pred. leave', 14, ' ') || lpad('pred. hold', 14, ' ') || chr(10) || rpad('real not up', 18, ' ') || lpad(tn::VARCHAR, 14, ' ') || lpad(fp::VARCHAR, 14, ' ') || chr(10) || rpad('real up', 18, ' ') || lpad(fn::VARCHAR, 14, ' ') || lpad(tp::VARCHAR, 14, ' ') AS lines FROM c",
    "load_days": "SELECT last, CASE WHEN last = '' THEN 3 WHEN last > '2024-03-10' OR DATE '2024-03-10' - last::DATE > 30 THEN -1 ELSE greatest(2, DATE '2024-03-10' - last::DATE) END::INT AS days FROM (VALUES (''), ('2024-03-10'), ('2024-03-09'), ('2024-03-01'), ('2024-02-01'), ('2024-03-11')) t(last)",
    "run_state": _values([("a", "2024-03-03", "false"), ("b", "2024-03-02", "false")], "source, last, s").replace("SELECT *", "SELECT source, last, s::BOOLEAN AS second"),
    "stream_rebuild": "SELECT 0 AS round, count(*) AS rows, sum(length(text))::BIGINT AS chars FROM documents UNION ALL SELECT 1, count(*) FILTER (text <> 'new'), (3 * count(*) FILTER (text <> 'new'))::BIGINT FROM documents WHERE doc_id % 4 = 0",
}
ORACLE_SQL |= {
    "term_preview": "WITH g AS (SELECT p_brand, sum(p_size) * 100 AS n FROM part GROUP BY p_brand), b AS (SELECT p_brand, n, row_number() OVER (ORDER BY p_brand) AS r FROM g) SELECT (2 * r - 2)::INT AS place, p_brand AS term, replace(format('{:,}', n::BIGINT), ',', '.') AS n FROM b WHERE r <= 10 UNION ALL SELECT (2 * r - 1)::INT, p_brand || 'x', '0' FROM b WHERE r <= 10",
    "fund_discovery": "SELECT f AS folder, lower(replace(r_name, ' ', '-')) || '.txt' AS file FROM region, (VALUES ('own'), ('own number')) t(k), (SELECT CASE WHEN k = 'own' THEN '8305_own' ELSE '8305_' || r_regionkey END AS f) x",
    "response_names": "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 THEN n_nationkey || '_fondo_c.txt' WHEN n_nationkey % 3 = 1 AND n_nationkey <> 7 THEN n_nationkey || '_fondo_a b.txt' ELSE 'cmf_' || n_nationkey || '_fondo_01-02-2024_03-03-2024.txt' END AS name FROM nation",
    "normalised_files": "SELECT f AS file, CASE WHEN f = 'refused' THEN 1 ELSE n + d END::BIGINT AS n FROM (SELECT count(*) AS n FROM nation), (VALUES ('noticias_dia.txt', 2), ('noticias_dia.txt.bak', 0), ('noticias_dia_normalizado.txt', 3), ('refused', 0)) t(f, d)",
    "seed_classes": "SELECT doc_id, market, hard_event, strict_score, f::BOOLEAN AS is_financial_strict, p::BOOLEAN AS is_political_risk, g::BOOLEAN AS is_geopolitical_market, n::BOOLEAN AS is_social_noise_dominant FROM documents JOIN (" + _values(_CLASSES, "k, market, hard_event, strict_score, f, p, g, n") + f") c ON doc_id % {len(SENTENCES)} = k",
    "seed_families": "WITH f(k, family, hits, hit_count, raw) AS (" + " UNION ALL ".join(f"SELECT {k}, '{f}', '{n}', {len(w)}, ln(2.0) * ({' + '.join(map(str, w))})" for k, f, n, w in _FOUND) + f") SELECT doc_id, family, raw >= 1.0 AS active, round(raw, 4) AS score, hit_count::INT AS hit_count, hits FROM documents JOIN f ON doc_id % {len(SENTENCES)} = k",
    "experiment_keys": _values([("fund.a", 0.0, "fundpa_night_partial_prob0p500_target0p0000"), ("fund.a", 0.0125, "fundpa_night_partial_prob0p512_target0p0125"), ("b", 0.0, "b_night_partial_prob0p500_target0p0000"), ("b", 0.0125, "b_night_partial_prob0p512_target0p0125")], "fund, target, key"),
}

"""What an address and a text say about section, kind and origin of an article."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import text_of
from tidemark.functions.urls import segments

# News agencies, in the order in which they are looked for; fixed values.
AGENCIES = ("agencia efe", "agencia uno", "reuters", "france presse", "afp", "europa press", "radio france internationale", "rfi")
# Kinds by the first fragment found in address, breadcrumb and text; fixed values, one list for each site style.
KINDS = {
    "shtml": (("opinion", ("opinion", "columna de opinión", "columnas-bbcl")), ("agencia", ("agencia de noticias", "agencia efe")), ("reportaje", ("reportajes", "bbcl investiga")), ("entrevista", ("entrevistas",)), ("noticia", ())),
    "dated": (("letter_to_editor", ("cartas-al-director", "cartas al director")), ("editorial", ("editorial", "editoriales")), ("column", ("opinion", "opinión", "columna")), ("multimedia", ("multimedia", "vodcast", "punto-por-punto")), ("markets_news", ("mercados",)), ("news", ())),
}


def title_case(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))


def sections(url: Column | str) -> Column:
    """``main_section, subsection, region_section``: path segments after ``noticias`` and before a year."""
    s = segments(url)
    start = F.coalesce(F.nullif(F.array_position(s, "noticias"), F.lit(0)), F.lit(0)).cast("int")
    after = F.slice(s, start + 1, F.greatest(F.size(s), F.lit(1)))
    year = F.array_position(F.transform(after, lambda x: x.rlike(r"^\d{4}$")), F.lit(True)).cast("int")
    parts = F.when(year > 0, F.slice(after, 1, F.greatest(year - 1, F.lit(0)))).otherwise(F.when(start > 0, after).otherwise(F.array().cast("array<string>")))
    pick = lambda k: title_case(F.coalesce(F.try_element_at(parts, F.lit(k)), F.lit("")))
    region = F.filter(parts, lambda x: x.startswith("region-") | x.startswith("aqui-") | x.startswith("zona-"))
    return F.struct(pick(1).alias("main_section"), pick(2).alias("subsection"), title_case(F.coalesce(F.try_element_at(region, F.lit(-1)), F.lit(""))).alias("region_section"))


def kind(style: str, *texts: Column, body: Column) -> Column:
    """The kind of article by the first fragment that occurs in the texts or the first 500 characters of the body."""
    value = F.lower(F.concat_ws(" ", *(text_of(t) for t in texts), F.left(text_of(body), F.lit(500))))
    out = None
    for name, parts in KINDS[style]:
        if parts:
            hit = F.lit(False)
            for p in parts:
                hit = hit | value.contains(p)
            out = F.when(hit, name) if out is None else out.when(hit, name)
        else:
            out = out.otherwise(name)
    return out


def agency(body: Column | str) -> Column:
    """The first agency of the list that a text names, else empty."""
    low = F.lower(text_of(body))
    out = F.lit("")
    for a in reversed(AGENCIES):
        out = F.when(low.contains(a), a).otherwise(out)
    return out


def attribution(body: Column | str, kind_: Column, columnist: str = "opinion") -> Column:
    found = agency(body)
    return F.struct(found.alias("source_attribution"), (found != "").alias("is_agency_content"), ((found == "") & (kind_ != columnist)).alias("is_staff_writer"), (kind_ == columnist).alias("is_external_columnist"))


def media_type(video: Column, audio: Column) -> Column:
    return F.when(video & audio, "mixed").when(video, "video").when(audio, "audio").otherwise("text")


def section_flags(section: Column, url: Column, kind_: Column) -> Column:
    v = F.lower(F.concat_ws(" ", text_of(section), text_of(url), text_of(kind_)))
    has = lambda *p: v.rlike("|".join(p))
    return F.struct(
        has("opinion", "opinión").alias("is_opinion"),
        has("econom", "mercados").alias("is_economy_section"),
        has("mercados").alias("is_market_section"),
        has("nacional").alias("is_national_section"),
        has("internacional").alias("is_international_section"),
        has("pais", "país").alias("is_country_section"),
        has("mundo").alias("is_world_section"),
        has("multimedia").alias("is_multimedia"),
        has("cultura").alias("is_culture"),
        has("deportes").alias("is_deportes"),
    )

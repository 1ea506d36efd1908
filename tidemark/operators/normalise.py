"""Articles brought to one clean form, and the flat projection that mining reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import distinct_list, is_boilerplate, joined, paragraphs, quotes, spaces, strip_html, strip_html_list, text_of, words

TEXTS = ("title", "subtitle", "lead", "summary", "ai_summary", "author_name", "author_role", "main_section", "subsection", "breadcrumb_raw", "main_image_alt")
LISTS = ("read_also_titles", "read_also_dates", "related_titles", "internal_subheadings", "also_interesting_titles", "featured_titles", "same_day_titles", "mentioned_documents_raw")
KEPT_FLAGS = ("is_opinion", "is_investigation", "is_economy_section", "is_national_section", "is_international_section", "is_market_section", "is_country_section", "is_world_section", "is_multimedia", "is_culture", "is_deportes", "has_ai_summary")


def body(paragraphs_: Column, *sources: Column) -> Column:
    """Clean paragraphs; fewer than two give way to the first non-empty source split by lines if that has more."""
    own = F.filter(distinct_list(strip_html_list(paragraphs_)), lambda x: ~is_boilerplate(x))
    other = paragraphs(strip_html(F.coalesce(*(F.nullif(s, F.lit("")) for s in sources), F.lit(""))))
    return F.when((F.size(own) < 2) & (F.size(other) > F.size(own)), other).otherwise(own)


def normalised(df: DataFrame) -> DataFrame:
    """Text fields without markup, lists cleaned, body repaired, its counts worked out anew. Applying it again changes nothing."""
    have = set(df.columns)
    fix: dict[str, Column] = {c: strip_html(F.col(c)) for c in TEXTS if c in have}
    fix |= {c: F.filter(distinct_list(strip_html_list(F.col(c))), lambda x: ~is_boilerplate(x)) for c in LISTS if c in have}
    df = df.withColumns(fix)
    col = lambda c: F.col(c) if c in have else F.lit("")
    own = F.col("paragraphs") if "paragraphs" in have else F.array().cast("array<string>")
    df = df.withColumn("paragraphs", body(own, col("body_text_raw"), col("body_text_clean"), col("ai_summary"), col("subtitle")))
    clean = spaces(F.array_join("paragraphs", " "))
    df = df.withColumns({"body_text_raw": F.array_join("paragraphs", "\n"), "body_text_clean": clean})
    b = F.col("body_text_clean")
    return df.withColumns({"paragraph_count": F.size("paragraphs"), "body_length_chars": F.length(b), "body_length_words": words(b), "quote_count": quotes(b)})


def classification_text(df: DataFrame) -> Column:
    """What enrichment reads: titles, summaries, body (or paragraphs) and sections."""
    part = lambda c: text_of(c) if c in df.columns else F.lit("")
    rest = F.array_join("paragraphs", " ") if "paragraphs" in df.columns else F.lit("")
    body_ = F.coalesce(F.nullif(part("body_text_clean"), F.lit("")), rest)
    return joined([*(part(c) for c in ("title", "subtitle", "lead", "summary", "ai_summary")), body_, *(part(c) for c in ("main_section", "subsection", "breadcrumb_raw"))])


def embedding_text(df: DataFrame, limit: int = 1200) -> Column:
    part = lambda c: text_of(c) if c in df.columns else F.lit("")
    return joined([part(c) for c in ("title", "subtitle", "summary", "body_text_clean")], limit)


def unified(df: DataFrame) -> DataFrame:
    """The flat projection for mining; fields that are missing are empty or null."""
    have = set(df.columns)
    text = ("source", "source_file", "published_date", "published_time", "published_at", "url", "canonical_url", "slug", "main_section", "subsection", "article_type_editorial", "region_section", "title", "subtitle", "lead", "summary", "ai_summary", "author_name", "author_role", "source_attribution", "body_text_clean", "parser_version")
    kept = [*KEPT_FLAGS, "body_length_words", "paragraph_count", "parse_success", "parse_errors"]
    joint = joined([strip_html(text_of(c)) if c in have else F.lit("") for c in ("title", "subtitle", "lead", "summary", "ai_summary", "body_text_clean")])
    cols = [strip_html(F.col(c)).alias(c) if c in have else F.lit("").alias(c) for c in text]
    cols += [F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in kept]
    cols += [(distinct_list(strip_html_list(F.col(c))) if c in have else F.array().cast("array<string>")).alias(c) for c in ("internal_subheadings", "related_titles")]
    return df.select(*cols, joint.alias("classification_text")).withColumn("classification_text_length", F.length("classification_text"))

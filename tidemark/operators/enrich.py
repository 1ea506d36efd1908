"""Rules that turn family matches into article features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import match_text

FAMILIES = ("macro_fiscal", "mercado_financiero", "energia_commodities", "empresas_instituciones", "politico_regulatorio", "geopolitico_mercado", "riesgo_alerta", "sentimiento_positivo", "sentimiento_negativo", "ruido_social")
# Weights of family scores in the impact of an article, fixed values.
IMPACT = {"macro_fiscal": 0.20, "mercado_financiero": 0.30, "energia_commodities": 0.25, "empresas_instituciones": 0.20, "politico_regulatorio": 0.15, "geopolitico_mercado": 0.30, "riesgo_alerta": 0.20}
# Fragments of section names, fixed values.
SECTIONS = {
    "section_economy": ("economia", "mercados", "market"),
    "section_politics": ("pais", "nacional", "politica", "opinion"),
    "section_world": ("mundo", "internacional"),
    "section_sports": ("deportes", "futbol"),
    "section_entertainment": ("espectaculos", "tv", "cultura", "braga"),
    "section_police": ("policial", "tribunales"),
}
ENTITY_FAMILIES = ("empresas_instituciones", "geopolitico_mercado", "mercado_financiero")
# Entity flags and the terms that raise them, fixed values.
ENTITIES = {
    "has_banco_central": ("banco_central",),
    "has_hacienda": ("hacienda", "ministerio_de_hacienda"),
    "has_cmf": ("cmf",),
    "has_codelco": ("codelco",),
    "has_enap": ("enap",),
    "has_sqm": ("sqm",),
    "has_china": ("china",),
    "has_estados_unidos": ("estados_unidos",),
    "has_donald_trump": ("donald_trump",),
    "has_iran": ("iran",),
    "has_rusia": ("rusia",),
    "has_ucrania": ("ucrania",),
}
NO_FAMILY = "No se detectaron familias relevantes con el diccionario actual."


def wide(articles: DataFrame, hits: str = "hits", active_from: float = 1.0) -> DataFrame:
    """Articles with score, activity, hit count and hits of every family (0, false and empty without hits), from the column of terms found in them.

    Everything is worked out in the row; nothing is shuffled.
    """
    raw = lambda x: x["weight"] * F.log1p(x["occurrences"])
    new: dict[str, Column] = {}
    for f in FAMILIES:
        mine = F.filter(hits, lambda x: x["family"] == f)  # noqa: B023
        total = F.aggregate(mine, F.lit(0.0), lambda a, x: a + raw(x))
        order = F.array_sort(F.transform(mine, lambda x: F.struct((-F.round(raw(x), 4)).alias("s"), x["position"].alias("p"), x["norm_term"].alias("t"))))
        new |= {f"{f}_score": F.round(total, 4), f"{f}_active": total >= active_from, f"{f}_hit_count": F.size(mine), f"{f}_hits": F.transform(order, lambda x: x["t"])}
    return articles.withColumns(new).drop(hits)


def section_flags(df: DataFrame, fields: list[str]) -> DataFrame:
    text = match_text(F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in fields)))
    return df.withColumns({name: text.rlike("|".join(parts)) for name, parts in SECTIONS.items()})


def general_flags(df: DataFrame) -> DataFrame:
    """What kind of news an article is; social noise is sport, show or police news without economy or markets abroad."""
    on = lambda f: F.col(f"{f}_active")
    df = df.withColumns(
        {
            "is_economic_news": on("macro_fiscal") | on("mercado_financiero") | on("energia_commodities") | on("empresas_instituciones") | F.col("section_economy"),
            "is_political_news": on("politico_regulatorio") | F.col("section_politics"),
            "is_geopolitical_news": on("geopolitico_mercado") | F.col("section_world"),
            "is_company_news": on("empresas_instituciones"),
            "is_market_news": on("mercado_financiero"),
            "is_energy_news": on("energia_commodities"),
            "is_crime_or_police_news": F.col("section_police") | on("ruido_social"),
            "is_sports_or_entertainment_news": F.col("section_sports") | F.col("section_entertainment"),
        }
    )
    noise = (F.col("is_sports_or_entertainment_news") | F.col("is_crime_or_police_news")) & ~F.col("is_economic_news") & ~on("geopolitico_mercado")
    return df.withColumn("is_social_noise", noise)


def unit(value: Column, full: float) -> Column:
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), value / full)), 4)


def impact(df: DataFrame) -> DataFrame:
    """Strength, direction, horizon and risk of an article for markets."""
    s = lambda f: F.col(f"{f}_score")
    on = lambda f: F.col(f"{f}_active")
    up, down, risk, abroad = s("sentimiento_positivo"), s("sentimiento_negativo"), s("riesgo_alerta"), s("geopolitico_mercado")
    df = df.withColumn("market_impact_score", unit(sum(s(f) * w for f, w in IMPACT.items()), 18.0))
    m = F.col("market_impact_score")
    return df.withColumns(
        {
            "expected_impact_direction": F.when((up == 0) & (down == 0), "unknown").when(F.abs(up - down) < 0.75, "mixed").when(up > down, "positive").otherwise("negative"),
            "expected_volatility_effect": F.when(down + risk + abroad + s("energia_commodities") * 0.5 >= 4, "increase").when(m < 0.15, "neutral").otherwise("unknown"),
            "expected_impact_horizon": F.when(on("geopolitico_mercado") | on("mercado_financiero"), "short_term").when(on("macro_fiscal") | on("politico_regulatorio"), "medium_term").when(m >= 0.25, "short_term").otherwise("unknown"),
            "market_impact_candidate": (m >= 0.20) | F.col("is_economic_news") | on("geopolitico_mercado"),
            "risk_score": unit(risk, 10.0),
            "uncertainty_score": unit(risk + abroad, 14.0),
            "confidence": F.round(F.when(F.col("is_social_noise"), F.least(m, F.lit(0.25))).otherwise(m), 4),
        }
    )


def entities(df: DataFrame) -> DataFrame:
    """Terms of institutions, markets and countries, sorted, and a flag for each one of interest."""
    df = df.withColumn("entities_relevant_terms", F.array_sort(F.array_distinct(F.concat(*(F.col(f"{f}_hits") for f in ENTITY_FAMILIES)))))
    t = F.col("entities_relevant_terms")
    flags = {name: F.arrays_overlap(t, F.array(*map(F.lit, terms))) for name, terms in ENTITIES.items()}
    flags["has_iran"] = F.contains(F.array_join(t, " "), F.lit("iran"))
    return df.withColumns(flags)


def temporal(df: DataFrame, day: str = "published_date", clock: str = "published_time") -> DataFrame:
    d = F.col(day).try_cast("date")
    return df.withColumns({"published_weekday": F.weekday(d), "is_weekend": F.weekday(d) >= 5, "published_hour": F.split(F.coalesce(F.col(clock).cast("string"), F.lit("")), ":")[0].try_cast("int")})


def audit(df: DataFrame, text: str) -> DataFrame:
    """Active families, all matched terms and a sentence that says why."""
    active = F.filter(F.array(*(F.when(F.col(f"{f}_active"), F.lit(f)) for f in FAMILIES)), lambda x: x.isNotNull())
    terms = F.array_sort(F.array_distinct(F.concat(*(F.col(f"{f}_hits") for f in FAMILIES))))
    said = F.filter(F.array(*(F.when(F.col(f"{f}_active"), F.when(F.size(f"{f}_hits") > 0, F.concat(F.lit(f"{f}: "), F.array_join(F.slice(f"{f}_hits", 1, 5), ", "))).otherwise(f)) for f in FAMILIES)), lambda x: x.isNotNull())
    df = df.withColumns({"active_families": active, "matched_terms_all": terms, "classification_text_length": F.length(text)})
    reason = F.when(F.size("active_families") == 0, NO_FAMILY).otherwise(F.concat(F.lit("Familias activas: "), F.array_join(said, " | "), F.lit(" | market_impact_score="), F.col("market_impact_score").cast("string")))
    return df.withColumns({"matched_terms_count": F.size("matched_terms_all"), "classification_reason": reason})


def fingerprint(df: DataFrame, columns: list[str], name: str = "input_sha256") -> DataFrame:
    """A hash of what enrichment reads, so that unchanged rows can be skipped."""
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*sorted(columns))), 256))


def changed(df: DataFrame, done: DataFrame, key: str, name: str = "input_sha256") -> DataFrame:
    """Rows whose hash hasn't been worked on yet."""
    return df.join(done.select(key, name).distinct(), [key, name], "left_anti")


def file_summary(df: DataFrame, file: str) -> DataFrame:
    """Articles, impact candidates and how often each family is active, for each file."""
    return df.groupBy(file).agg(F.count("*").alias("articles"), F.count_if("market_impact_candidate").alias("impact_candidates"), *(F.count_if(f"{f}_active").alias(f"active_{f}") for f in FAMILIES))

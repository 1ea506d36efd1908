"""Corpus mining: n-gram and TF-IDF tables, keywords, seed rules, sub-corpora."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions.text import text_of

MARKED = "a-záéíóúñü0-9_"  # word signs of mining, accents kept


# A word of mining: a letter, then at least two letters, digits, hyphens or underscores, between word boundaries; fixed value.
TOKEN = r"\b[a-záéíóúñü][a-záéíóúñü0-9_\-]{2,}\b"


def grams(text: str, most: int = 3, stop: frozenset[str] = frozenset(), pattern: re.Pattern = re.compile(TOKEN)) -> Counter:
    """Runs of 1 to ``most`` words of a text and how often each occurs; stop words go before runs are made."""
    words = [w for w in pattern.findall(text.lower()) if w not in stop]
    found = Counter(words)
    runs = words
    for n in range(1, most):
        runs = [f"{a} {b}" for a, b in zip(runs, words[n:])]
        found.update(runs)
    return found


def gram_counts(docs: DataFrame, key: str, text: str, most: int = 3, stop: list[str] = []) -> DataFrame:  # noqa: B006
    """``key, term, tf``, counted within each row: rows are documents, and nothing is shuffled."""
    out = frozenset(stop)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 200):
                part = b.slice(k, 200)
                found = [grams(t or "", most, out) for t in part.column(1).to_pylist()]
                at = np.repeat(np.arange(part.num_rows), [len(c) for c in found])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array([t for c in found for t in c], pa.string()), pa.array([n for c in found for n in c.values()], pa.int64())], [key, "term", "tf"])

    rows = docs.select(key, text)
    return rows.mapInArrow(go, StructType([rows.schema[key], StructField("term", StringType()), StructField("tf", LongType())]))


def ngram_table(counts: DataFrame, total: int, min_df: int = 5, max_df: float = 0.6, top: int | None = 2000) -> DataFrame:
    """``term, count, df, df_pct`` within the limits, by falling df and count, then term."""
    t = counts.groupBy("term").agg(F.sum("tf").alias("count"), F.count("*").alias("df")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * total))
    t = t.withColumn("df_pct", F.col("df") / F.lit(float(total)))
    return t.orderBy(F.desc("df"), F.desc("count"), "term").limit(top) if top else t


def tfidf_table(counts: DataFrame, key: str, total: int, min_df: int = 3, max_df: float = 0.6, top: int | None = 2000) -> DataFrame:
    """Mean over all documents of ``(1 + ln tf)(ln((1+n)/(1+df)) + 1)``, each document of length 1 over the kept terms."""
    df = counts.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * total))
    w = (1 + F.ln("tf")) * (F.ln(F.lit(1.0 + total) / (1 + F.col("df"))) + 1)
    kept = counts.join(df, "term").select(key, "term", w.alias("w"))
    norm = kept.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    t = kept.join(norm, key).groupBy("term").agg((F.sum(F.col("w") / F.col("norm")) / F.lit(float(total))).alias("score"))
    return t.orderBy(F.desc("score"), "term").limit(top) if top else t


def is_bad_term(term: Column, stop: list[str], fragments: list[str]) -> Column:
    """Empty, short, of stop words alone, or with a fragment of boilerplate."""
    t = F.trim(text_of(term))
    bad = F.length(t) < 4
    if stop:
        bad |= F.size(F.filter(F.split(t, " "), lambda x: ~x.isin(stop))) == 0
    for f in fragments:
        bad |= t.contains(f)
    return bad


def keywords_of(text: str, most: int = 3, top: int = 20, window: int = 1) -> list[tuple[str, float]]:
    """Keywords of one text by the statistics of the YAKE paper (Campos et al., 2020): the lower, the better."""
    sentences = [re.findall(r"\w+", s) for s in re.split(r"[.!?\n]+", text) if s.strip()]
    tf: Counter = Counter()
    upper: Counter = Counter()
    where: dict[str, list[int]] = defaultdict(list)
    left: dict[str, Counter] = defaultdict(Counter)
    right: dict[str, Counter] = defaultdict(Counter)
    for k, s in enumerate(sentences):
        low = [w.lower() for w in s]
        for i, (raw, w) in enumerate(zip(s, low)):
            tf[w] += 1
            where[w].append(k)
            upper[w] += raw.isupper() and len(raw) > 1 or i > 0 and raw[0].isupper()
            for other in low[max(0, i - window) : i]:
                left[w][other] += 1
                right[other][w] += 1
    if not tf:
        return []
    mean = sum(tf.values()) / len(tf)
    dev = math.sqrt(sum((v - mean) ** 2 for v in tf.values()) / len(tf))
    largest = max(tf.values())
    score = {}
    for w, n in tf.items():
        case = upper[w] / (1 + math.log(n))
        places = sorted(where[w])
        position = math.log(math.log(3 + places[len(places) // 2]))
        frequency = n / (mean + dev)
        spread = [len(c) / max(sum(c.values()), 1) for c in (left[w], right[w])]
        related = 1 + sum(spread) * n / largest
        sentence = len(set(places)) / max(len(sentences), 1)
        score[w] = related * position / (case + (frequency + sentence) / related)
    found: Counter = Counter()
    for s in sentences:
        low = [w.lower() for w in s]
        for n in range(1, most + 1):
            for i in range(len(low) - n + 1):
                g = low[i : i + n]
                if len(g[0]) > 2 and len(g[-1]) > 2 and not any(w.isdigit() for w in g):
                    found[" ".join(g)] += 1
    out = []
    for term, n in found.items():
        parts = [score[w] for w in term.split()]
        out.append((term, math.prod(parts) / (n * (1 + sum(parts)))))
    return sorted(out, key=lambda x: (x[1], x[0]))[:top]


def keywords(docs: DataFrame, key: str, text: str, top: int = 20) -> DataFrame:
    """``key, keyword, score`` of every document, each distinct text worked on once."""
    unique = docs.select(F.sha2(text_of(text), 256).alias("sha"), F.col(text).alias("t")).groupBy("sha").agg(F.min("t").alias("t"))

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, k, v) for s, t in zip(b.sha, b.t) for k, v in keywords_of(t or "", top=top)]
            yield pd.DataFrame(rows, columns=["sha", "keyword", "score"])

    found = unique.mapInPandas(go, "sha string, keyword string, score double")
    return docs.select(key, F.sha2(text_of(text), 256).alias("sha")).join(found, "sha").select(key, "keyword", "score")


def keyword_table(found: DataFrame, top: int = 1000) -> DataFrame:
    """Keywords of a corpus by the sum of their inverse scores."""
    return found.groupBy("keyword").agg(F.sum(1 / (F.col("score") + 1e-9)).alias("weight")).orderBy(F.desc("weight"), "keyword").limit(top)


def capitalised(docs: DataFrame, key: str, text: str, aliases: dict[str, str] = {}) -> DataFrame:  # noqa: B006
    """Runs of capitalised words as entity candidates, aliases resolved. No substitute for a trained recogniser."""
    runs = F.regexp_extract_all(text_of(text), F.lit(r"(\p{Lu}[\p{L}]+(?: \p{Lu}[\p{L}]+)*)"), 1)
    e = F.lower(F.col("entity"))
    if aliases:
        e = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)), e), e)
    return docs.select(key, F.explode(runs).alias("entity")).select(key, e.alias("entity")).where(F.length("entity") >= 3)


def entity_table(found: DataFrame, top: int = 300) -> DataFrame:
    return found.groupBy("entity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity").limit(top)


def seed_rules(h: DataFrame) -> DataFrame:
    """Context rules and classes from arrays of seed hits.

    Needs the arrays market, fiscal, company, commodity, political, geopolitical, noise,
    ambiguous, market_context, amount, amount_context, energy_word, energy_context,
    gas_word (if gas isn't among the commodities), gas_strong, gas_weak, hard_event, direct_context, support_context.
    """
    any_ = lambda c: F.size(c) > 0
    gas = F.array_contains("commodity", "gas") | (any_("gas_word") if "gas_word" in h.columns else F.lit(False))
    h = h.withColumns(
        {
            "has_market_context": any_("market_context"),
            "has_amount_context": any_("amount") & any_("amount_context"),
            "has_energy_market_context": any_("energy_word") & any_("energy_context"),
            "has_geopolitical_gas_context": gas & (any_("gas_strong") | (any_("gas_weak") & any_("direct_context"))),
        }
    )
    hard = F.size("hard_event")
    without_gas = F.size(F.array_except("commodity", F.array(F.lit("gas")))) > 0
    context = (
        any_("direct_context")
        | F.col("has_geopolitical_gas_context")
        | ((without_gas | F.col("has_energy_market_context")) & (hard > 0))
        | (any_("market") & (hard > 0))
        | ((F.col("has_amount_context") | any_("support_context")) & (hard >= 2))
    )
    h = h.withColumn("has_geopolitical_market_context", context)
    h = h.withColumns(
        {
            "market_hits": F.when(any_("ambiguous") & F.col("has_market_context"), F.array_union("market", "ambiguous")).otherwise(F.col("market")),
            "commodity_hits": F.when(F.col("has_energy_market_context"), F.array_union("commodity", F.array(F.lit("energia_contextual")))).otherwise(F.col("commodity")),
        }
    )
    m, c, f, k = (F.size(x) for x in ("market_hits", "commodity_hits", "fiscal", "company"))
    h = h.withColumns({"strict_score": 3 * (m + f + k + c) + F.col("has_amount_context").cast("int"), "political_score": F.size("political"), "geopolitical_score": F.size("geopolitical"), "social_noise_score": F.size("noise")})
    return h.withColumns(
        {
            "is_financial_strict": (F.col("strict_score") >= 4) | (f > 0) | (k > 0) | (c > 0) | (m >= 2),
            "is_political_risk": (F.col("political_score") >= 2) & ((f > 0) | (m > 0) | (k > 0) | (c > 0)),
            "is_geopolitical_market": (F.col("geopolitical_score") >= 1) & F.col("has_geopolitical_market_context"),
            "is_social_noise_dominant": (F.col("social_noise_score") >= 2) & (F.col("strict_score") == 0) & (F.col("geopolitical_score") == 0),
        }
    )


SEED_SETS = ("market", "fiscal", "company", "commodity", "political", "geopolitical", "noise", "ambiguous", "market_context", "amount", "amount_context", "energy_word", "energy_context", "gas_strong", "gas_weak", "hard_event", "direct_context", "support_context")
# Articles that the financial dictionary leaves out, fixed values: flags, and fragments of section names.
EXCLUDED_FLAGS = ("is_deportes", "is_culture", "is_multimedia", "is_opinion", "is_column", "is_letter_to_editor", "is_editorial")
EXCLUDED_SECTIONS = ("deportes", "cultura", "multimedia", "opinión", "opinion", "cartas", "editorial", "espectáculos", "espectaculos")


def usable(df: DataFrame, sections: list[str]) -> Column:
    """Whether an article may enter the financial dictionary: no excluded flag, no excluded section."""
    flags = [F.coalesce(F.col(f), F.lit(False)) for f in EXCLUDED_FLAGS if f in df.columns]
    text = F.lower(F.concat_ws(" ", *(F.coalesce(F.col(s), F.lit("")) for s in sections)))
    good = ~text.rlike("|".join(EXCLUDED_SECTIONS))
    for f in flags:
        good &= ~f
    return good


def record_status(df: DataFrame, text: str, use: Column) -> DataFrame:
    """``status``: excluded, empty or ok."""
    return df.withColumn("status", F.when(~use, "excluded").when(F.trim(text_of(text)) == "", "empty").otherwise("ok"))


def subcorpora(df: DataFrame) -> DataFrame:
    """One row for each record and sub-corpus it belongs to; dominant noise belongs to none."""
    names = {"financial_strict": "is_financial_strict", "political_risk": "is_political_risk", "geopolitical_market": "is_geopolitical_market"}
    mine = F.filter(F.array(*(F.when(F.col(flag), F.lit(n)) for n, flag in names.items())), lambda x: x.isNotNull())
    return df.where("not is_social_noise_dominant").withColumn("section", F.explode(mine))


def corpus_clean(value: str | None, phrases: dict[str, str], patterns: list[str] = [], fragments: list[str] = []) -> str:  # noqa: B006
    """The form in which a corpus is mined: no markup, addresses, boilerplate, dates or loose numbers; accents stay.

    Boilerplate patterns and fragments are parameters, as they depend on the sites read.
    """
    import html

    from tidemark.functions.dates import MONTHS
    from tidemark.functions.text import SURNAMES

    s = html.unescape(value or "")
    for p in (r"<script.*?</script>", r"<style.*?</style>"):
        s = re.sub(p, " ", s, flags=re.I | re.S)
    s = unicodedata.normalize("NFKC", re.sub(r"https?://\S+", " ", re.sub(r"<[^>]+>", " ", s))).lower()
    for a, b in phrases.items():
        s = s.replace(a, b)
    for p, b in SURNAMES:
        s = re.sub(p, b, s)
    for p in patterns:
        s = re.sub(p, " ", s, flags=re.I)
    for f in fragments:
        s = s.replace(f, " ")
    months = "|".join(MONTHS)
    s = re.sub(rf"\b(?:\d{{1,2}}\s+)?(?:{months})\s+\d{{4}}\b", " ", s)
    s = re.sub(rf"[^{MARKED}%$/\-.\s]", " ", s)
    return " ".join(re.sub(r"\b\d+\b", " ", s).split())


def corpus_cleaned(docs: DataFrame, text: str, phrases: dict[str, str], patterns: list[str] = [], fragments: list[str] = []) -> DataFrame:  # noqa: B006
    @F.pandas_udf("string")
    def go(s: pd.Series) -> pd.Series:
        return s.map(lambda x: corpus_clean(x, phrases, patterns, fragments))

    return docs.withColumn(text, go(text))

"""Dictionary terms in texts: one pass that looks words up among the first words of terms, in place of one regular expression per term and text.

Texts aren't shuffled: the terms found are a column of their row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window

from tidemark.functions.text import match_term, term_pattern

MOST = 1_000_000  # terms of a dictionary, at most: every task holds all of them
WORDS = "a-z0-9_"
HITS = "family string, norm_term string, occurrences long, weight double, source string, position int"


class Finder:
    """How often each term occurs in a normalised text: whole words, counted as a regular expression would, from left to right without overlap."""

    def __init__(self, terms: list[str], letters: str = WORDS):
        plain, self.signs = re.compile(f"[{letters} ]+"), re.compile(f"[^{letters}\\s]+")
        self.single: set[str] = set()
        self.longer: dict[str, list[list[str]]] = {}
        self.odd: list[tuple[str, str, re.Pattern]] = []
        for t in terms:
            words = t.split()
            if not plain.fullmatch(t):
                self.odd.append((t, words[0], re.compile(term_pattern(t))))
            elif len(words) == 1:
                self.single.add(t)
            else:
                self.longer.setdefault(words[0], []).append(words)
        self.first = self.single | self.longer.keys()

    def counts(self, text: str) -> Counter:
        words = self.signs.sub(" . ", text).split()
        found: Counter = Counter()
        end: dict[str, int] = {}
        for i in [i for i, w in enumerate(words) if w in self.first]:
            if words[i] in self.single:
                found[words[i]] += 1
            for term in self.longer.get(words[i], ()):
                if words[i : i + len(term)] == term and end.get(name := " ".join(term), 0) <= i:
                    found[name] += 1
                    end[name] = i + len(term)
        for term, start, pattern in self.odd:
            if start in text and (n := len(pattern.findall(text))):
                found[term] = n
        return found


def matched(text: Column, terms: DataFrame, letters: str = WORDS) -> Column:
    """The terms that occur in a text, as an array of ``HITS``; null texts have none."""
    rows = [r.asDict() for r in terms.select("family", "norm_term", "weight", "source", "position").limit(MOST + 1).collect()]
    if len(rows) > MOST:
        raise ValueError(f"a dictionary has {MOST} terms at most")
    by: dict[str, list[dict]] = {}
    for r in rows:
        by.setdefault(r["norm_term"], []).append(r)

    @F.pandas_udf(ArrayType(StructType.fromDDL(HITS)))
    def go(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(list(by), letters)
        for s in batches:
            yield s.map(lambda x: [r | {"occurrences": n} for t, n in finder.counts(x or "").items() for r in by[t]])

    return go(text)


def dictionary(spark, terms: dict[str, dict[str, float]], source: str = "", least: int = 3) -> DataFrame:
    """``family, term, norm_term, weight, source, n_words, position``: best weight of each normal form of ``least`` signs or more, first of equals."""
    rows: dict[tuple[str, str], tuple] = {}
    for family, found in terms.items():
        for k, (term, weight) in enumerate(found.items()):
            norm = match_term(term)
            if len(norm) >= least and ((family, norm) not in rows or weight > rows[family, norm][3]):
                rows[family, norm] = (family, term, norm, float(weight), source, len(norm.split()), k)
    ordered = sorted(rows.values(), key=lambda r: (r[0], -r[5], -r[3], r[1]), reverse=False)
    return spark.createDataFrame([(*r[:6], i) for i, r in enumerate(ordered)], "family string, term string, norm_term string, weight double, source string, n_words int, position int")


def term_counts(df: DataFrame, key: str, text: str, terms: DataFrame, letters: str = WORDS) -> DataFrame:
    """``key`` and ``HITS``: one row for each term that occurs in a text."""
    return df.select(key, F.inline(matched(F.col(text), terms, letters)))


def family_matches(counts: DataFrame, key: str, active_from: float = 1.0, details: int = 50) -> DataFrame:
    """One row for each text and family with hits: score, activity, terms by falling score (ties: dictionary order)."""
    raw = F.col("weight") * F.log1p("occurrences")
    c = counts.withColumn("raw", raw).withColumn("score", F.round("raw", 4))
    c = c.withColumn("n", F.row_number().over(Window.partitionBy(key, "family").orderBy(F.desc("score"), "position")))
    hit = F.struct("n", F.col("norm_term").alias("term"), "weight", "occurrences", "score", "source")
    out = c.groupBy(key, "family").agg(F.sum("raw").alias("raw"), F.count("*").alias("hit_count"), F.sort_array(F.collect_list(hit)).alias("h"))
    return out.select(
        key,
        "family",
        (F.col("raw") >= active_from).alias("active"),
        F.round("raw", 4).alias("score"),
        F.col("hit_count").cast("int").alias("hit_count"),
        F.transform("h", lambda x: x["term"]).alias("hits"),
        F.slice(F.transform("h", lambda x: x.dropFields("n")), 1, details).alias("hit_details"),
    )


def seed_hits(texts: DataFrame, counts: DataFrame, key: str, families: list[str]) -> DataFrame:
    """One row for each text, one array of distinct hits for each seed set; all are empty for a text without hits."""
    hits = lambda f: F.sort_array(F.collect_set(F.when(F.col("family") == f, F.col("norm_term"))))
    found = texts.select(key).distinct().join(counts.groupBy(key).agg(*(hits(f).alias(f) for f in families)), key, "left")
    return found.select(key, *(F.coalesce(F.col(f), F.array().cast("array<string>")).alias(f) for f in families))

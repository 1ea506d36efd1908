"""Command line: normalise, enrich, mine, dataset, train."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.dates import days_back, parse_date
from tidemark.session import session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)
    for name, about in (("normalise", "clean articles"), ("enrich", "dictionary features"), ("mine", "candidate terms")):
        s = sub.add_parser(name, help=about)
        s.add_argument("input", help="Parquet of articles")
        s.add_argument("output")
    sub.choices["enrich"].add_argument("--dictionary", help="folder of dictionaries")
    sub.choices["enrich"].add_argument("--layout", choices=["line", "list"], default="line")
    sub.choices["enrich"].add_argument("--key", default="url")
    sub.choices["enrich"].add_argument("--from", dest="start")
    sub.choices["enrich"].add_argument("--to", dest="end")
    sub.choices["enrich"].add_argument("--days-back", type=int)
    sub.choices["mine"].add_argument("--min-df", type=int, default=5)
    sub.choices["mine"].add_argument("--key", default="url")
    s = sub.add_parser("features", help="technical features of fund files")
    s.add_argument("files", nargs="+")
    s.add_argument("output")
    s.add_argument("--fund", required=True)
    s.add_argument("--start", required=True)
    s.add_argument("--end", required=True)
    return p


def allowed_days(start: str | None, end: str | None, back: int | None) -> list[str] | None:
    """Days by a range or back from the end; both ends or none."""
    from datetime import date, timedelta

    if bool(start) != bool(end) and back is None:
        raise ValueError("give both ends of a range")
    if start and end:
        a, b = parse_date(start), parse_date(end)
        if a > b:
            raise ValueError("the range ends before it starts")
        return [str(a + timedelta(days=k)) for k in range((b - a).days + 1)]
    if back:
        return [str(d) for d in days_back(parse_date(end) if end else date.today(), back)]
    return None


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = session()
    if a.command == "features":
        from tidemark.operators.series import features
        from tidemark.plans.config import FUNDS
        from tidemark.sources.funds import load

        f = FUNDS[a.fund]
        features(load(spark, a.files, f.run_fm, list(f.preferred), parse_date(a.start), parse_date(a.end)), ["RUN_FM"]).write.mode("overwrite").parquet(a.output)
        return 0
    from tidemark.operators import enrich, matching, mining
    from tidemark.operators.normalise import classification_text, normalised

    df = spark.read.parquet(a.input)
    if a.command == "normalise":
        normalised(df).write.mode("overwrite").parquet(a.output)
    elif a.command == "enrich":
        from tidemark.sources import dictionaries

        days = allowed_days(a.start, a.end, a.days_back)
        if days is not None:
            df = df.where(F.col("published_date").isin(days))
        terms = dictionaries.as_frame(spark, dictionaries.load(a.dictionary, layout=a.layout) if a.dictionary else dictionaries.seeds())
        df = df.withColumn("t", T.match_text(classification_text(df), exact=True))
        df = df.withColumn("hits", matching.matched(F.col("t"), terms))
        fields = [c for c in ("source", "main_section", "subsection", "site_vertical", "article_type_editorial", "breadcrumb_raw") if c in df.columns]
        out = enrich.impact(enrich.general_flags(enrich.section_flags(enrich.wide(df), fields)))
        enrich.audit(enrich.entities(out), "t").drop("t").write.mode("overwrite").parquet(a.output)
    else:
        docs = mining.corpus_cleaned(df.withColumn("t", classification_text(df)), "t", T.PHRASES)
        counts, n = mining.gram_counts(docs, a.key, "t"), docs.count()
        mining.ngram_table(counts, n, a.min_df).write.mode("overwrite").parquet(f"{a.output}/ngrams")
        mining.tfidf_table(counts, a.key, n).write.mode("overwrite").parquet(f"{a.output}/tfidf")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only.

Token counts are summed to cells, one for each combination of source, language and topic.
Raking multiplies the cells' weights, one dimension after the other, until the sums over
every dimension meet their target shares. A document's probability is its cell's weight
over its cell's tokens, scaled so that the expected tokens meet the wanted part of the
corpus. Where targets ask for more than there is, a value over one is an expected number of
copies (``repeat``): documents of scarce cells are repeated. Without ``repeat`` the part is
lowered until no value passes one. The targets are met either way.

Raking finds one factor for each value of a dimension. The dimension with most values is
kept as rows, each with its tokens by the other two, which are narrow vocabularies; a round
works out its factors row by row and sums the rest to a table of the other two, whose
factors are numbers in the plan. Cells are pre-aggregated before any shuffle, so a source
with a third of all rows is a few cells like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, with_class

DIMS = ("source", "lang", "topic")
ROUNDS, CLOSE = 200, 1e-12  # rounds of raking, at most, and the relative gap to the targets at which it ends
FRACTION = 0.7  # part of the corpus' tokens that the sample is to hold
TEMPER = 0.5  # target shares are proportional to tokens to this power
FEW_CELLS = 100_000  # a cell table of up to so many rows is broadcast to the documents

# Topics by the first rule that a text meets, fixed values.
TOPICS = (("tables", r" \| "), ("legal", r"[Ll]icen[sc]e|[Cc]opyright"), ("contact", r"@|\+[0-9]"), ("symbols", r"&&&|###|\*\*\*|%%%|\$\$\$"))
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    c = F.lit("general")
    for name, pattern in reversed(TOPICS):
        c = F.when(text.rlike(pattern), name).otherwise(c)
    return c


def tokens_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def chance(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, the three dimensions (null: ``(none)``) and tokens of each document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", *(F.coalesce(F.col(d), F.lit("(none)")).alias(d) for d in DIMS[:2]), topic_of(text).alias("topic"), tokens_of(text).alias("n_tokens"))


def cells_of(rows: DataFrame) -> DataFrame:
    """Tokens and number of documents of every cell."""
    return rows.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))


def targets(cells: DataFrame, shares: dict[str, dict[str, float]] | None, temper: float) -> DataFrame:
    """``dim, value, want``: target shares of every value; they add up to one over the values of a dimension that have tokens."""
    each = cells.select("tokens", F.posexplode(F.array(*DIMS)).alias("k", "value")).groupBy(F.element_at(F.array(*map(F.lit, DIMS)), F.col("k") + 1).alias("dim"), "value").agg(F.sum("tokens").alias("own"))
    want = F.pow(F.col("own").cast("double"), F.lit(temper))
    for d, named in (shares or {}).items():
        known = F.create_map(*(F.lit(x) for kv in named.items() for x in kv))
        want = F.when(F.col("dim") == d, F.coalesce(F.try_element_at(known, F.col("value")), F.lit(0.0))).otherwise(want)
    each = each.withColumn("raw", F.when(F.col("own") > 0, want).otherwise(0.0))
    return each.join(each.groupBy("dim").agg(F.sum("raw").alias("all")), "dim").select("dim", "value", F.coalesce(F.try_divide("raw", "all"), F.lit(0.0)).alias("want"))


def rake(cells: DataFrame, shares: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, rounds: int = ROUNDS) -> tuple[DataFrame, float]:
    """``cells`` with ``share``, the raked part of all tokens, and the largest gap that is left between a target share and what the cells hold of it.

    ``shares`` may name target shares of a dimension's values; a value that it doesn't
    name gets 0. Dimensions it leaves out have shares in proportion to tokens to the
    power ``temper``. A gap that stays says that no weights meet all targets (a value
    whose cells other targets empty).
    """
    cells = cut(cells)
    wants = cut(targets(cells, shares, temper))
    values = {r.dim: r.n for r in wants.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not values:
        return cells.withColumn("share", F.lit(0.0)), 0.0
    wide = max(DIMS, key=lambda d: (values[d], -DIMS.index(d)))
    narrow = [d for d in DIMS if d != wide]
    want: dict[str, dict[str, float]] = {d: {} for d in narrow}
    for r in wants.where(F.col("dim") != wide).collect():
        want[r.dim][r.value] = r.want
    # One row for each value of the wide dimension; its list has one entry for each pair of the narrow ones at most.
    mine = wants.where(F.col("dim") == wide).select(F.col("value").alias(wide), "want")
    rows = cut(cells.where("tokens > 0").groupBy(wide).agg(F.collect_list(F.struct(*narrow, F.col("tokens").cast("double").alias("tokens"))).alias("held")).join(mine, wide))
    factor = {d: dict.fromkeys(want[d], 1.0) for d in narrow}

    def by(d: str, c: Column) -> Column:
        return F.element_at(F.create_map(*(F.lit(x) for kv in factor[d].items() for x in kv)), c)

    def own() -> DataFrame:
        """The rows with their own factor."""
        held = F.aggregate("held", F.lit(0.0), lambda a, x: a + x["tokens"] * by(narrow[0], x[narrow[0]]) * by(narrow[1], x[narrow[1]]))
        return rows.withColumn("held_now", held).withColumn("factor", F.when(F.col("held_now") > 0, F.col("want") / F.col("held_now")).otherwise(0.0))

    gap = float("inf")
    for _ in range(rounds):
        summed = own().select("factor", F.inline("held")).groupBy(*narrow).agg(F.sum(F.col("tokens") * F.col("factor")).alias("w")).collect()
        gap = 0.0
        for d in narrow:
            other = narrow[1 - narrow.index(d)]
            have = dict.fromkeys(want[d], 0.0)
            for r in summed:
                have[r[d]] += r.w * factor[d][r[d]] * factor[other][r[other]]
            gap = max([gap, *(abs(have[v] - want[d][v]) for v in have)])
            factor[d] = {v: factor[d][v] * want[d][v] / have[v] if have[v] > 0 else 0.0 for v in have}
        if gap <= CLOSE:
            break
    weight = F.col("x.tokens") * F.col("factor") * by(narrow[0], F.col(f"x.{narrow[0]}")) * by(narrow[1], F.col(f"x.{narrow[1]}"))
    raked = own().select(wide, "factor", F.explode("held").alias("x")).select(wide, *(F.col(f"x.{d}").alias(d) for d in narrow), weight.alias("share"))
    return cells.join(raked, list(DIMS), "left").withColumn("share", F.coalesce("share", F.lit(0.0))), gap


def weights(cells: DataFrame, shares: dict[str, dict[str, float]] | None = None, fraction: float = FRACTION, repeat: bool = False) -> DataFrame:
    """Adds ``expected``, the expected number of copies, to cells. A cell without tokens costs nothing: one copy."""
    raked, _ = rake(cells, shares)
    raked = cut(raked)
    per = F.when(F.col("tokens") > 0, F.col("share") / F.col("tokens"))
    total, most = raked.agg(F.sum("tokens"), F.max(per)).first() or (0, 0)
    scale = fraction * (total or 0)
    if not repeat and most:
        scale = min(scale, 1 / most)
    return raked.withColumn("expected", F.coalesce(per * scale, F.lit(1.0)))


def copies(doc_id: Column, expected: Column) -> Column:
    """How often a document is in the sample: the whole part, and once more by chance for the rest."""
    whole = F.floor(expected)
    return (whole + F.when(chance(doc_id) < expected - whole, 1).otherwise(0)).cast("int")


def _joined(rows: DataFrame, cells: DataFrame, spread: Column) -> DataFrame:
    """Rows with their cell's ``expected``. A table of few cells is broadcast; of many, frequent cells are dealt out."""
    cells = cells.select(F.struct(*DIMS).alias("cell of mixing"), "n", F.col("expected").alias("expected of mixing"))
    if cells.count() <= FEW_CELLS:
        return rows.join(F.broadcast(cells.drop("n")), "cell of mixing").drop("cell of mixing")
    none = F.struct(spread.cast("string").alias("source"), F.lit("").alias("lang"), F.lit("").alias("topic"))
    return with_class(rows, cells, "cell of mixing", "n", none)


def mixed(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None, fraction: float = FRACTION, repeat: bool = False) -> DataFrame:
    """One row for each row of ``docs``: dimensions, tokens, probability, expected and actual copies, and whether it is sampled.

    Null sources and languages are a value of their own, a null text has no tokens, a null
    doc_id is sampled as one fixed id. Repeated rows are sampled alike. Further columns
    are ignored; an empty table gives no rows. Without ``repeat`` there is one copy at most.
    Texts are read once; whole texts count, however long.
    """
    d = cut(described(docs))
    cells = cut(weights(cells_of(d), shares, fraction, repeat))
    found = _joined(d.withColumn("cell of mixing", F.struct(*DIMS)), cells, F.xxhash64("doc_id"))
    e = F.col("expected of mixing")
    n = copies(F.col("doc_id"), e)
    return found.select("doc_id", *DIMS, "n_tokens", F.round(F.least(F.lit(1.0), e), 6).alias("probability"), (n > 0).alias("sampled"), F.round(e, 6).alias("expected"), n.alias("copies"))


def sample(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None, fraction: float = FRACTION, repeat: bool = False) -> DataFrame:
    """The rows of ``docs`` that :func:`mixed` samples, as often as it says; columns unchanged.

    Nulls, repeated rows and empty tables as there. Texts aren't shuffled where cells are few.
    """
    cells = cut(weights(cells_of(described(docs)), shares, fraction, repeat))
    mine = F.struct(*(F.coalesce(F.col(d), F.lit("(none)")).alias(d) for d in DIMS[:2]), topic_of(F.coalesce("text", F.lit(""))).alias("topic"))
    found = _joined(docs.withColumn("cell of mixing", mine), cells, F.xxhash64("doc_id"))
    found = found.withColumn("copy of mixing", F.explode(F.sequence(F.lit(0), copies(F.col("doc_id"), F.col("expected of mixing")))))
    return found.where(F.col("copy of mixing") > 0).select(*docs.columns)


def _sql(rounds: int = 24) -> str:
    """The same from the rule: shares by dimension in turn, over and over, then expected copies."""
    case = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS) + " ELSE 'general' END"
    parts = [
        f"d AS MATERIALIZED (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, {case} AS topic, len(regexp_extract_all(text, '{WORD}')) AS n_tokens FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents))",
        "c AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)",
        "o AS (SELECT *, " + ", ".join(f"sum(tokens) OVER (PARTITION BY {x}) AS own_{x}" for x in DIMS) + " FROM c WHERE tokens > 0)",
        "w0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens AS w, " + ", ".join(f"pow(own_{x}, {TEMPER}) / sum(tokens * pow(own_{x}, {TEMPER - 1})) OVER () AS want_{x}" for x in DIMS) + " FROM o)",
    ]
    k = 0
    for _ in range(rounds):
        for x in DIMS:
            k += 1
            parts.append(f"w{k} AS MATERIALIZED (SELECT * REPLACE (w * want_{x} / sum(w) OVER (PARTITION BY {x}) AS w) FROM w{k - 1})")
    parts.append(f"p AS MATERIALIZED (SELECT source, lang, topic, w / sum(w) OVER () * (SELECT sum(tokens) FROM c) * {FRACTION} / tokens AS e FROM w{k} UNION ALL SELECT source, lang, topic, 1.0 FROM c WHERE tokens = 0)")
    parts.append("s AS (SELECT *, (floor(e) + CASE WHEN ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < e - floor(e) THEN 1 ELSE 0 END)::INT AS copies FROM d JOIN p USING (source, lang, topic))")
    return "WITH " + ",\n".join(parts) + "\nSELECT doc_id, source, lang, topic, n_tokens, round(least(1.0, e), 6) AS probability, copies > 0 AS sampled, round(e, 6) AS expected, copies FROM s"


ORACLE = _sql()

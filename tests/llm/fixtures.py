"""Small tables with every awkward case, for all operators."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed: int = 0, n: int = 60) -> list[tuple]:
    """Invented texts with exact copies, near copies, shared passages, nulls, empties, one long text."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ba", "lo", "ti", "re", "na", "mu"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage, out = prose(30), []
    for i in range(n):
        t = prose(rng.randint(5, 80))
        if i % 5 == 1 and out:
            t = rng.choice(out)[1] or ""
        elif i % 5 == 2:
            t = f"{prose(5)} {passage} {prose(5)}"
        elif i % 5 == 3 and out and out[-1][1]:
            w = out[-1][1].split()
            w[len(w) // 2] = "edited"
            t = " ".join(w)
        out.append((i * 3, t, rng.choice(["en", "es", None]), rng.choice(["s0", "s0", "s1"]), len(t)))
    out += [(1000, None, "en", "s0", None), (1001, "", "en", None, 0), (1002, " \n\t ", None, None, 3), (1003, prose(4000), "en", "s1", 9), (1004, "aaaa" * 200, "en", "s1", 9), (1005, "uno", "es", "s1", 3)]
    return out


def documents(spark, rows=None, extra: bool = True):
    """The fixture as a table, with repeated rows and columns that clash with names used inside."""
    rows = texts() if rows is None else rows
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:
        for c in ("fp", "key", "bucket", "blob", "kind", "probability", "tokens", "component", "score", "cell_source"):
            df = df.withColumn(c, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)

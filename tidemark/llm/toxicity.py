"""Toxicity: gradient-boosted trees over dense features, isotonically calibrated.

The features of a text are densities of a lexicon (whole words and word beginnings, which
also meet inflected and compounded forms), how near second-person words stand to lexicon
words, capitals, punctuation and obfuscation. The lexicon is mined from labelled rows.
So that the trees don't learn from a lexicon that has seen their own rows, rows are in two
folds and each fold's features use the other fold's lexicon. Out-of-fold margins of the
trees give the isotonic calibration.

Fitting uses at most ``max_labelled`` labelled rows, those of the smallest hash; scoring
reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

MAX_LABELLED = 20_000  # labelled rows that are fitted on, at most
MAX_TERMS = 20_000  # lexicon candidates counted, at most
LEXICON = 600  # terms kept, at most
STEP = 1 << 22  # characters of a text held as words at a time
BEGINNINGS = (4, 5, 6)  # lengths of word beginnings
NEAR = 5  # words between a lexicon word and a second-person word
THRESHOLD = 0.7

# Second-person words of the four languages, fixed values.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tú tu te ti tus usted ustedes vosotros vous toi ton ta tes votre vos".split())
# What stands for a letter in obfuscated words, fixed values.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "*": "", ".": "", "-": "", "_": ""})

FEATURES = ("log_words", "hit_density", "hits", "weight_density", "heaviest", "distinct", "beginning_density", "near_second_person", "second_person", "capitals", "shouted", "exclamations", "questions", "punctuation", "punctuation_runs", "obfuscated", "obfuscated_hits", "stretched")

_WORD = re.compile(r"\w+")
_DISGUISED = re.compile(r"[0-9@$*!|._-](?=[a-z])")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b")
_RUN = re.compile(r"[!?]{2,}")
_SPACE = re.compile(r"\s")


def _steps(text: str) -> Iterator[str]:
    """The text in pieces of ``STEP`` characters, each up to the next white space, so that no word is cut."""
    at = 0
    while at < len(text):
        end = min(len(text), at + STEP)
        if end < len(text):
            end = m.start() if (m := _SPACE.search(text, end)) else len(text)
        yield text[at:end]
        at = end


class _Near:
    """Counts lexicon words with a second-person word at most ``NEAR`` words away, over pieces of a text."""

    def __init__(self) -> None:
        self.count, self.words = 0, 0
        self.hits = self.you = np.zeros(0, np.int64)

    def add(self, words: int, hits: np.ndarray, you: np.ndarray, last: bool = False) -> None:
        """A piece of so many words, and the places of both kinds in it. Hits near its end wait for the next piece."""
        self.hits, self.you = np.concatenate([self.hits, hits + self.words]), np.concatenate([self.you, you + self.words])
        self.words += words
        sure = len(self.hits) if last else int(np.searchsorted(self.hits, self.words - NEAR))
        h, y = self.hits[:sure], self.you
        if len(h) and len(y):
            k = np.searchsorted(y, h)
            gap = np.minimum(np.abs(y[np.minimum(k, len(y) - 1)] - h), np.abs(y[np.maximum(k - 1, 0)] - h))
            self.count += int((gap <= NEAR).sum())
        self.hits, self.you = self.hits[sure:], y[np.searchsorted(y, self.words - 2 * NEAR) :]


def terms(text: str) -> set[str]:
    """What a text offers the lexicon: words, and beginnings of longer words with a ``^``."""
    words = {w for t in _steps(text) for w in _WORD.findall(t.lower()) if 2 < len(w) < 40}
    return words | {"^" + w[:n] for w in words for n in BEGINNINGS if len(w) > n}


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    seen: dict[str, float] = field(default_factory=dict)

    def of(self, word: str) -> float:
        """The weight of a word: positive as a whole word, negative if only its beginning is known, else 0."""
        if (found := self.weights.get(word)) is None:
            found = -max((self.weights.get("^" + word[:n], 0.0) for n in BEGINNINGS if len(word) > n), default=0.0)
        if len(self.seen) > 200_000:
            self.seen.clear()
        self.seen[word] = found
        return found

    def features(self, text: str) -> list[float]:
        n = hits = begun = second = caps = letters = shouts = bangs = asks = points = marks = odd = odd_hits = long = size = 0
        total = top = 0.0
        found: set[str] = set()
        near = _Near()
        get, of = self.seen.get, self.of
        for piece in _steps(text):
            low = piece.lower()
            words = _WORD.findall(low)
            n += len(words)
            w = np.array([of(x) if (v := get(x)) is None else v for x in words]) if words else np.zeros(0)
            at = np.flatnonzero(w)
            you = np.array([i for i, x in enumerate(words) if x in SECOND_PERSON], np.int64)
            second += len(you)
            near.add(len(words), at, you)
            if len(at):
                hits += len(at)
                begun += int((w[at] < 0).sum())
                total += float(np.abs(w[at]).sum())
                top = max(top, float(np.abs(w[at]).max()))
                found.update(words[i] for i in at)
            done = -1
            for m in _DISGUISED.finditer(low):
                if m.start() < done or not m.start() or not low[m.start() - 1].isalpha():
                    continue
                a = max(low.rfind(" ", 0, m.start()), low.rfind("\n", 0, m.start())) + 1
                done = min(x for x in (low.find(" ", m.end()), low.find("\n", m.end()), len(low)) if x >= 0)
                odd += 1
                if done - a < 40 and of(low[a:done].strip(".,;:?").translate(LEET)):
                    odd_hits += 1
            data = np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8)
            c = np.bincount(data, minlength=256)
            size += len(piece)
            caps += int(c[65:91].sum())
            letters += int(c[65:91].sum() + c[97:123].sum() + c[0xC3:0xC5].sum())
            bangs, asks = bangs + int(c[33]), asks + int(c[63])
            points += int(c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum())
            shouts += len(_SHOUT.findall(piece)) if caps else 0
            marks += len(_RUN.findall(piece)) if c[33] + c[63] > 1 else 0
            if len(data) > 2:
                long += int(((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] >= 97) & (data[2:] < 123)).sum())
        none = np.zeros(0, np.int64)
        near.add(0, none, none, last=True)
        n1, l1, s1 = max(n, 1), max(letters, 1), max(size, 1)
        return [math.log1p(n), hits / n1, hits, total / n1, top, len(found), begun / n1, near.count / max(hits, 1), second / n1, caps / l1, shouts / n1, bangs / s1, asks / s1, points / s1, marks / n1, odd / n1, odd_hits, long / l1]


class Trees:
    """Binary logistic boosting over binned features; second-order splits, depth-wise growth."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, ridge: float = 1.0, least: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge, self.least = rounds, depth, rate, bins, ridge, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        p = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
        self.base = math.log(p / (1 - p))
        edges = [np.unique(np.quantile(c[c > c.min()] if (c > c.min()).any() else c, np.linspace(0, 1, self.bins)[:-1])) for c in x.T]
        q = np.stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T)], 1)
        b = self.bins + 1
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            node = np.zeros(len(y), np.int64)
            split: dict[int, tuple[int, float]] = {}
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                local = node - first
                live = local >= 0
                best = np.full(width, 1e-6)
                for f in range(x.shape[1]):
                    at = local[live] * b + q[live, f]
                    gs, hs = (np.bincount(at, v[live], width * b).reshape(width, b).cumsum(1) for v in (g, h))
                    gl, hl, gr, hr = gs[:, :-1], hs[:, :-1], gs[:, -1:] - gs[:, :-1], hs[:, -1:] - hs[:, :-1]
                    gain = gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - gs[:, -1:] ** 2 / (hs[:, -1:] + self.ridge)
                    gain[(hl < self.least) | (hr < self.least)] = 0
                    k = gain.argmax(1)
                    for i in range(width):
                        if gain[i, k[i]] > best[i] and k[i] < len(edges[f]):
                            best[i], split[first + i] = gain[i, k[i]], (f, float(edges[f][k[i]]))
                for i in range(first, first + width):
                    if i in split:
                        f, t = split[i]
                        mine = node == i
                        node[mine] = 2 * i + 1 + (x[mine, f] >= t)
            value = np.zeros(2 ** (self.depth + 1) - 1)
            gs, hs = np.bincount(node, g, len(value)), np.bincount(node, h, len(value))
            value = -self.rate * gs / (hs + self.ridge)
            self.trees.append((split, value))
            margin += value[node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for split, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for i in sorted(split):
                f, t = split[i]
                mine = node == i
                node[mine] = 2 * i + 1 + (x[mine, f] >= t)
            out += value[node]
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots to interpolate between."""
    o = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, sum of margins
    for m, v in zip(margin[o], y[o]):
        blocks.append([float(v), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, m2 = blocks.pop()
            v1, w1, m1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, m1 + m2]
    return np.array([m / w for _, w, m in blocks]), np.array([v for v, _, _ in blocks])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    rate: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.rate)
        return np.interp(self.trees.margin(x), *self.knots).clip(0, 1)


def _counted(sample: DataFrame, known: set[str] | None) -> Counter:
    """``(fold, toxic, term)`` to documents, over the sample; only ``known`` terms if given."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for text, toxic, fold in zip(*(b.column(i) for i in range(3))):
                mine = terms(text.as_py() or "")
                n.update((fold.as_py(), toxic.as_py(), t) for t in (mine if known is None else mine & known))
        rows = list(n.items())
        for k in range(0, len(rows), 50_000):
            some = rows[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0][0] for r in some], pa.int32()), pa.array([r[0][1] for r in some], pa.int32()), pa.array([r[0][2] for r in some], pa.string()), pa.array([r[1] for r in some], pa.int64())], ["fold", "toxic", "term", "n"])

    counted = sample.select("text", "toxic", "fold").mapInArrow(go, "fold int, toxic int, term string, n long")
    if known is None:  # candidates: terms of several toxic documents, the most frequent ones
        total = counted.groupBy("term").agg(F.sum("n").alias("n")).where("n >= 3").orderBy(F.desc("n"), "term").limit(MAX_TERMS)
        return Counter({r.term: r.n for r in total.collect()})
    return Counter({(r.fold, r.toxic, r.term): r.n for r in counted.groupBy("fold", "toxic", "term").agg(F.sum("n").alias("n")).collect()})


def _weigh(n: Counter, candidates: list[str], sizes: dict[tuple[int, int], int], folds: tuple[int, ...]) -> Lexicon:
    """Terms that stand out in toxic documents of the folds, by a smoothed log ratio of document rates."""
    bad, good = (sum(sizes.get((f, y), 0) for f in folds) for y in (1, 0))
    found = []
    for t in candidates:
        a, b = (sum(n[f, y, t] for f in folds) for y in (1, 0))
        ratio = math.log((a + 0.5) / (bad + 1)) - math.log((b + 0.5) / (good + 1))
        if a >= 3 and ratio > 1.5:
            found.append((-ratio * math.sqrt(a), t, ratio))
    return Lexicon({t: r for _, t, r in sorted(found)[:LEXICON]})


def _featured(rows: DataFrame, lexicons: list[Lexicon]) -> DataFrame:
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fold = b.column(2).to_pylist()
            x = [lexicons[f].features(t.as_py() or "") for f, t in zip(fold, b.column(0))]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(fold, pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["toxic", "fold", "x"])

    return rows.select("text", "toxic", "fold").mapInArrow(go, "toxic int, fold int, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learns from the rows of ``labels`` whose crc32(doc_id as text) mod 3 is not 1.

    Rows with a null doc_id or label are left out, of repeated ones the highest label
    counts. Without two classes the score is the rate of the only class, without rows 0.
    """
    labels = labels.where("doc_id is not null and toxic is not null").where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    labels = labels.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).select("doc_id", "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))).cast("int").alias("fold"))
    sample = cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "fold"))
    sizes = {(r.fold, r.toxic): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    n1, n = sum(v for (_, y), v in sizes.items() if y == 1), sum(sizes.values())
    if n1 in (0, n):
        return Model(Lexicon(), None, None, n1 / n if n else 0.0)
    candidates = sorted(_counted(sample.where("toxic = 1"), None))
    n = _counted(sample, set(candidates))
    by_fold = [_weigh(n, candidates, sizes, (1,)), _weigh(n, candidates, sizes, (0,))]
    rows = _featured(sample, by_fold).collect()
    x, y = np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)
    order = np.lexsort((*x.T, y))  # the fit doesn't depend on the order in which rows arrive
    x, y = x[order], y[order]
    part = np.arange(len(y)) % 3
    out = np.zeros(len(y))
    for k in range(3):
        out[part == k] = Trees().fit(x[part != k], y[part != k]).margin(x[part == k])
    return Model(_weigh(n, candidates, sizes, (0, 1)), Trees().fit(x, y), isotonic(out, y))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    ``score`` depends on the text alone, the whole of it, however long. A null text counts
    as empty and gets a score like any other; a score of exactly ``threshold`` predicts 1.
    Repeated rows and further columns change nothing; a null doc_id has a null
    ``held_out``; an empty table gives no rows.
    """
    model = fit(docs, labels, max_labelled)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([model.lexicon.features(t.as_py() or "") for t in b.column(1)]).reshape(-1, len(FEATURES))
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(go, "doc_id long, score double, predicted int")
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score", "predicted")


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, columns unchanged, in one pass over the texts.

    A null text counts as empty, a score of exactly ``threshold`` goes; repeated rows go or
    stay alike, a null doc_id changes nothing; an empty table gives no rows. Without
    labelled rows nothing goes.
    """
    model = fit(docs, labels)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index("text")
            x = np.array([model.lexicon.features(t.as_py() or "") for t in b.column(i)]).reshape(-1, len(FEATURES))
            kept = b.filter(pa.array(model.score(x) < threshold))
            if kept.num_rows:
                yield kept

    return docs.mapInArrow(go, docs.schema)

"""Maximum inner product search with score-aware (anisotropic) quantisation.

Vectors are put into coarse cells: each half of the components has its own centres, and a
cell is a pair of them, so that a bounded sample fits as many cells as the root of the
number of vectors. What is left after taking off the cell's centre is cut into subspaces of
two dimensions, each coded in four bits. Codes and codebooks minimise the score-aware loss
(Guo et al., 2020): the part of the error that is parallel to the vector weighs more than
the part across it, because it is what changes large inner products. A query reads a table
of 16 entries for each subspace, scores all codes of the cells it probes by table sums (two
subspaces at a time, so 256 entries), and reranks exactly in double precision. The index
keeps the length of what a code misses, which bounds the error of a quantised score: the
best ``FIRST`` are scored exactly, then every other row whose score may still be among the
nearest. No row of a probed cell is lost to its code, however many codes of a dense group
are equal, and results don't depend on how cells are dealt out to shards.

Centres and codebooks are fitted on at most ``SAMPLE`` vectors; every vector is indexed.
The number of cells to probe is the smallest that reaches ``AIM`` of the exact neighbours
within the sample, and more where these cells hold too few rows. Vectors of each length
have an index of their own. Equal vectors are one row of the index, which carries as many
of their identifiers as a query can need.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import by_run, cut, parts, runs, sorted_by, with_class
from tidemark.llm.vectors import classes, elsewhere, keyed, kind, lists, matrix

SAMPLE = 20_000  # vectors that the index is fitted on, at most
CODED = 6_000  # of these, vectors that the codebooks are fitted on, at most
TRIED = 400  # queries of the sample that choose the number of probes
AIM = 0.98  # recall within the sample
SHARD, LEAST = 20_000, 2_048  # vectors of a shard, at most and at least
FIRST = 64  # vectors that a query scores exactly first in a shard; they decide which others it has to score
THRESHOLD = 0.2  # cosine from which a pair's score matters: weighs the parallel error
SWEEPS, ROUNDS = 2, 6
SCORES = 1 << 18  # scores worked out in one go


@dataclass
class Index:
    """Centres of both halves, codebooks (subspace, code, dimension), cells to probe, and the weight of the parallel error beyond that of the error across."""

    halves: tuple[np.ndarray, np.ndarray]
    books: np.ndarray
    probes: int
    weight: float

    @property
    def cells(self) -> int:
        return len(self.halves[0]) * len(self.halves[1])

    def centers(self, cell: np.ndarray) -> np.ndarray:
        a, b = self.halves
        return np.concatenate([a[cell // len(b)], b[cell % len(b)]], 1)

    def scores(self, q: np.ndarray) -> np.ndarray:
        """Inner products of queries with the centres of all cells."""
        a, b = self.halves
        k = a.shape[1]
        return ((q[:, :k] @ a.T)[:, :, None] + (q[:, k:] @ b.T)[:, None, :]).reshape(len(q), -1)

    def cut(self, x: np.ndarray) -> np.ndarray:
        s, _, w = self.books.shape
        return np.pad(x, ((0, 0), (0, s * w - x.shape[1]))).reshape(len(x), s, w)

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves
        k = a.shape[1]
        return _closest(x[:, :k], a) * len(b) + _closest(x[:, k:], b)

    def encode(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Codes by coordinate descent on the score-aware loss."""
        return _assign(self.cut(x - self.centers(cell)), self.cut(_unit(x)), self.books, self.weight, None)

    def missed(self, x: np.ndarray, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Length of the part of each vector that its code leaves out, with room for rounding."""
        made = np.stack([book[codes[:, s]] for s, book in enumerate(self.books)], 1)
        center = self.centers(cell)
        room = np.sqrt((x * x).sum(1)) + np.sqrt((center**2).sum(1))
        return np.sqrt(((self.cut(x - center) - made) ** 2).sum((1, 2))) + 1e-12 * room

    def packed(self, codes: np.ndarray) -> np.ndarray:
        if codes.shape[1] % 2:
            codes = np.pad(codes, ((0, 0), (0, 1)))
        return (codes[:, ::2] | codes[:, 1::2] << 4).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each query, tables of 256 entries for each two subspaces."""
        t = np.einsum("qsw,scw->qsc", self.cut(q), self.books)
        if t.shape[1] % 2:
            t = np.concatenate([t, np.zeros((len(q), 1, 16))], 1)
        return (t[:, 1::2, :, None] + t[:, ::2, None, :]).reshape(len(q), -1, 256)


def _closest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for k in range(0, len(x), 4096):
        out[k : k + 4096] = ((centers**2).sum(1) - 2 * x[k : k + 4096] @ centers.T).argmin(1)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(n > 0, n, 1)


def _assign(r: np.ndarray, u: np.ndarray, books: np.ndarray, weight: float, codes: np.ndarray | None) -> np.ndarray:
    """Codes of remainders ``r`` of vectors with directions ``u``: first the nearest, then in turn the best by the whole loss."""
    turned = books.transpose(0, 2, 1)
    across = (r * r).sum(2).T[:, :, None] - 2 * np.matmul(r.transpose(1, 0, 2), turned) + (books**2).sum(2)[:, None, :]
    along = (r * u).sum(2).T[:, :, None] - np.matmul(u.transpose(1, 0, 2), turned)
    rows = np.arange(len(r))
    codes = across.argmin(2).T.astype(np.uint8) if codes is None else codes
    total = sum(along[s, rows, codes[:, s]] for s in range(len(books)))
    for _ in range(SWEEPS):
        for s in range(len(books)):
            rest = total - along[s, rows, codes[:, s]]
            codes[:, s] = best = (across[s] + weight * (rest[:, None] + along[s]) ** 2).argmin(1)
            total = rest + along[s, rows, best]
    return codes


def _books(r: np.ndarray, u: np.ndarray, weight: float, rng: np.random.Generator) -> np.ndarray:
    """Codebooks: assignment in turn with the weighted least squares centre of every code."""
    n, s, w = r.shape
    books = np.stack([r[rng.choice(n, 16, n < 16), k] for k in range(s)])
    codes = None
    for _ in range(ROUNDS):
        codes = _assign(r, u, books, weight, codes)
        error = np.stack([r[:, k] - books[k][codes[:, k]] for k in range(s)], 1)
        along = (error * u).sum((1, 2))
        for k in range(s):
            c = codes[:, k]
            rest = along - (error[:, k] * u[:, k]).sum(1)
            right = r[:, k] + weight * (rest + (r[:, k] * u[:, k]).sum(1))[:, None] * u[:, k]
            size = np.bincount(c, minlength=16)
            left = weight * np.stack([[np.bincount(c, u[:, k, i] * u[:, k, j], 16) for j in range(w)] for i in range(w)]).transpose(2, 0, 1)
            left += np.maximum(size, 1)[:, None, None] * np.eye(w)
            sums = np.stack([np.bincount(c, right[:, i], 16) for i in range(w)], 1)
            books[k] = np.where(size[:, None] > 0, np.linalg.solve(left, sums[:, :, None])[:, :, 0], books[k])
            error[:, k] = r[:, k] - books[k][c]
            along = rest + (error[:, k] * u[:, k]).sum(1)
    return books


def _centers(x: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    centers = x[rng.choice(len(x), count, False)].copy()
    for _ in range(10):
        cell = _closest(x, centers)
        size = np.bincount(cell, minlength=count)
        total = np.stack([np.bincount(cell, c, count) for c in x.T], 1) if x.shape[1] else np.zeros((count, 0))
        centers[size > 0] = total[size > 0] / size[size > 0][:, None]
    return centers


def fit(x: np.ndarray, total: int, nearest: int, seed: int = 5) -> Index:
    """Centres, codebooks and the number of probes from a sample of ``total`` vectors."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    half = (d + 1) // 2
    each = max(1, min(n // 8, round(total**0.25)))
    halves = _centers(x[:, :half], each, rng), _centers(x[:, half:], each if d > 1 else 1, rng)
    weight = max(0.0, (d - 1) * THRESHOLD**2 / (1 - THRESHOLD**2) - 1)
    index = Index(halves, np.zeros(((d + 1) // 2, 16, 2)), 1, weight)
    cell = index.cell(x)
    some = rng.choice(n, min(n, CODED), False)
    index.books = _books(index.cut(x[some] - index.centers(cell[some])), index.cut(_unit(x[some])), weight, rng)
    need = [0]
    for t in rng.choice(n, min(TRIED, n), False):
        score = x @ x[t]
        score[t] = -np.inf
        top = np.argsort(-score, kind="stable")[: min(nearest, n - 1)]
        to = index.scores(x[t : t + 1])[0]
        need += [int((to > to[c]).sum()) for c in cell[top]]
    need.sort()
    index.probes = min(index.cells, need[min(len(need) - 1, math.ceil(AIM * len(need)) - 1)] + 1)
    return index


def exact(d: int) -> Index:
    """An index of one cell that scores everything exactly, for a length of which the sample has no vector."""
    half = (d + 1) // 2
    return Index((np.zeros((1, half)), np.zeros((1, d - half))), np.zeros((half, 16, 2)), 1, 0.0)


@dataclass
class Plan:
    """Indexes by length, where the cells of each length begin, and size and shards of every cell."""

    indexes: dict[int, Index]
    begin: dict[int, int]
    size: np.ndarray
    shards: list[list[int]]

    def index(self, d: int) -> Index:
        return self.indexes[d]

    def probed(self, q: np.ndarray, need: int) -> list[np.ndarray]:
        """The cells that each query looks into, at least as many as hold ``need`` rows (or all of them)."""
        d = q.shape[1]
        ix = self.indexes[d]
        size = self.size[self.begin[d] : self.begin[d] + ix.cells]
        out = []
        for k in range(0, len(q), max(1, SCORES // ix.cells)):
            to = ix.scores(q[k : k + max(1, SCORES // ix.cells)])
            near = np.argpartition(-to, ix.probes - 1, axis=1)[:, : ix.probes]
            for row, cells in zip(to, near):
                if size[cells].sum() < need:
                    order = np.argsort(-row, kind="stable")
                    cells = order[: max(ix.probes, int(np.searchsorted(np.cumsum(size[order]), need)) + 1)]
                out.append(cells + self.begin[d])
        return out


def planned(cls: DataFrame, nearest: int) -> Plan:
    """Fits the indexes and deals out the cells: small cells share a shard, a large cell has several."""
    count = {r.d: r.n for r in cls.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}
    sample = cls.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow()
    fitted = {x.shape[1]: fit(x, count[x.shape[1]], nearest) for _, x in matrix(sample.column("vec"))}
    indexes = {d: fitted.get(d) or exact(d) for d in sorted(count)}
    ends = np.cumsum([ix.cells for ix in indexes.values()])
    begin = dict(zip(indexes, [0, *ends[:-1].tolist()]))
    shared = cls.sparkSession.sparkContext.broadcast((indexes, begin))

    def cell_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ixs, first = shared.value
        for b in batches:
            for _, x in matrix(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(ixs[x.shape[1]].cell(x) + first[x.shape[1]])], ["cell"])

    size = np.zeros(int(ends[-1]), np.int64)
    for r in cls.select("vec").mapInArrow(cell_of, "cell long").groupBy("cell").count().collect():
        size[r["cell"]] = r["count"]
    last, room, shards = 0, 0, []
    least = max(LEAST, min(SHARD, math.ceil(sum(count.values()) / parts(cls))))
    for n in size.tolist():
        if n > SHARD:
            k = math.ceil(n / SHARD)
            shards.append(list(range(last + 1, last + 1 + k)))
            last, room = last + k, 0
            continue
        if n > room:
            last, room = last + 1, least
        shards.append([last])
        room -= n
    return Plan(indexes, begin, size, shards)


_NAMES = ["shard", "query", "id", "cells", "code", "missed", "members", "vec"]


def _spread(plan, nearest: int, kind_: str):
    """Rows of the index, and of each query for every shard it has to look in."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                b = whole.slice(k, 1000)
                ids, asks = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
                for at, x in matrix(b.column(3)):
                    ix, first = p.index(x.shape[1]), p.begin[x.shape[1]]
                    cell = ix.cell(x)
                    codes = ix.encode(x, cell)
                    code, missed = ix.packed(codes), ix.missed(x, cell, codes)
                    mine = [p.shards[c + first] for c in cell.tolist()]
                    shard = np.array([s[i % len(s)] for s, i in zip(mine, (ids[at] * 0x9E3779B1 & 0x7FFFFFFF).tolist())], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.zeros(len(at), bool)), pa.array(ids[at]), pa.array((cell + first).astype(np.int32)[:, None].tolist(), pa.list_(pa.int32())), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(missed), b.column(2).take(pa.array(at)), lists(x, kind_)], _NAMES)
                    q = np.flatnonzero(asks[at])
                    rows, shards, cells_ = [], [], []
                    for i, cells in zip(q.tolist(), p.probed(x[q], nearest + 1)):
                        to: dict[int, list[int]] = {}
                        for c in cells.tolist():
                            for s in p.shards[c]:
                                to.setdefault(s, []).append(c)
                        rows += [i] * len(to)
                        shards += to.keys()
                        cells_ += to.values()
                    for j in range(0, len(rows), 1000):
                        r = rows[j : j + 1000]
                        yield pa.RecordBatch.from_arrays([pa.array(np.array(shards[j : j + 1000], np.int64)), pa.array(np.ones(len(r), bool)), pa.array(ids[at][r]), pa.array(cells_[j : j + 1000], pa.list_(pa.int32())), pa.array([b""] * len(r), pa.binary()), pa.array(np.zeros(len(r))), pa.array([[]] * len(r), b.column(2).type), lists(x[r], kind_)], _NAMES)

    return go


def _best(ix: Index, q: np.ndarray, x: np.ndarray, columns: list[np.ndarray], place: np.ndarray, here: np.ndarray, allowed: np.ndarray, missed: np.ndarray, ids: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and exact score of the ``nearest`` rows of each query among the cells allowed; ``place`` is a row's cell among ``here``."""
    guess = (q @ ix.centers(here).T)[:, place]
    add = np.empty_like(guess)
    for k, t in enumerate(ix.tables(q).transpose(1, 0, 2)):
        guess += np.take(t, columns[k], axis=1, out=add)
    guess[~allowed[:, place]] = -np.inf
    may, length = np.isfinite(guess), np.sqrt((q * q).sum(1))
    if len(x) > max(FIRST, nearest):
        top = np.argpartition(-guess, FIRST, axis=1)[:, :FIRST]
        sure = np.einsum("qfd,qd->qf", x[top], q)
        sure[~np.take_along_axis(may, top, 1)] = -np.inf
        least = -np.partition(-sure, nearest - 1, axis=1)[:, nearest - 1]
        may &= guess + length[:, None] * missed[None, :] * (1 + 1e-9) >= least[:, None]
        some = np.flatnonzero(may.any(0))
        near = np.full(may.shape, -np.inf)
        near[:, some] = np.where(may[:, some], q @ (x if len(some) == len(x) else x[some]).T, -np.inf)
        room = 1e-12 * length * np.sqrt((x * x).sum(1).max())  # these products may be rounded in another order
        may &= near >= (-np.partition(-near, nearest - 1, axis=1)[:, nearest - 1] - room)[:, None]
    who, row = np.nonzero(may)
    score = np.concatenate([np.einsum("ij,ij->i", x[row[k : k + 50_000]], q[who[k : k + 50_000]]) for k in range(0, len(who), 50_000)] or [np.zeros(0)])
    order = np.lexsort((ids[row], -score, who))
    who, row, score = who[order], row[order], score[order]
    at = runs(who)
    kept = np.arange(len(who)) - np.repeat(at[:-1], np.diff(at)) < nearest
    return who[kept], row[kept], score[kept]


def _searched(plan, nearest: int):
    def handle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        shard = t.column("shard").to_numpy()
        asks, ids, missed = (t.column(c).to_numpy() for c in ("query", "id", "missed"))
        cells, code, members, vec = (t.column(c).combine_chunks() for c in ("cells", "code", "members", "vec"))
        at = runs(shard)
        for lo, hi in zip(at, at[1:]):
            groups = {x.shape[1]: (where + lo, x) for where, x in matrix(vec.slice(lo, hi - lo))}
            for d, (where, every) in groups.items():
                ix, first = p.index(d), p.begin[d]
                item, query = np.flatnonzero(~asks[where]), np.flatnonzero(asks[where])
                if not len(item) or not len(query):
                    continue
                x, mine = every[item], where[item]
                here, place = np.unique(cells.take(pa.array(mine)).flatten().to_numpy(), return_inverse=True)
                c = np.frombuffer(b"".join(code.take(pa.array(mine)).to_pylist()), np.uint8).reshape(len(mine), -1)
                columns = [np.ascontiguousarray(v) for v in c.T]
                step = max(1, SCORES // len(item))
                for k in range(0, len(query), step):
                    some = query[k : k + step]
                    probed = cells.take(pa.array(where[some]))
                    size = np.asarray(probed.value_lengths())
                    flat = probed.flatten().to_numpy()
                    allowed = np.zeros((len(some), len(here)), bool)
                    known = np.minimum(np.searchsorted(here, flat), len(here) - 1)
                    there = here[known] == flat
                    allowed[np.repeat(np.arange(len(some)), size)[there], known[there]] = True
                    who, row, score = _best(ix, every[some], x, columns, place, here - first, allowed, missed[mine], ids[mine], nearest + 1)
                    if len(who):
                        yield pa.RecordBatch.from_arrays([pa.array(ids[where[some]][who]), members.take(pa.array(mine[row])), pa.array(score)], ["query", "members", "score"])

    return handle


def search(embeddings: DataFrame, every: int = 20, nearest: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each vec_id divisible by ``every`` the ``nearest`` other rows by inner product.

    Ties go to the smaller vec_id. A vector that is null, empty, zero or holds a null or
    non-finite component takes no part, nor does a row without vec_id; vectors are
    candidates of queries of their own length, for others there is no inner product. Of
    repeated rows of a vec_id one is a query; all are candidates of others. Further columns
    are ignored; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    embeddings = embeddings.select("vec_id", "embedding")
    rows = cut(keyed(embeddings, vectors=False))
    mine = Window.partitionBy("key").orderBy("vec_id")
    members = rows.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= nearest + 1).groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    cls = cut(classes(embeddings, F.max(F.col("vec_id") % every == 0).alias("asks")).join(members, "key"))
    if cls.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    plan = spark.sparkContext.broadcast(planned(cls, nearest))
    k = kind(embeddings)
    spread = cls.select("id", "asks", "members", "vec").mapInArrow(_spread(plan, nearest, k), f"shard long, query boolean, id long, cells array<int>, code binary, missed double, members array<long>, vec {k}")
    found = sorted_by(spread, "shard").mapInArrow(by_run("shard", _searched(plan, nearest), 20_000), "query long, members array<long>, score double")
    found = found.select("query", F.explode("members").alias("vec_id"), "score")
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= nearest + 1)
    near = found.groupBy(F.col("query").alias("id")).agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))  # nearest + 1 entries at most
    near = cls.select("id", "key", "n").join(near, "id").drop("id")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("key").alias("key"))
    asked = with_class(asked, near, "key", "n", elsewhere("query_id"))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)
    out = asked.select("query_id", F.posexplode(others).alias("pos", "x"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))

"""Embedding near-dedup by E8 lattice hashing.

Every table projects vectors of unit length at random to ``BLOCKS`` blocks of eight
dimensions and decodes each block to the nearest point of the E8 lattice: together the
vector's cell. A vector is stored in its cell and also looks into neighbouring cells: one
block moved by those of the 240 shortest lattice vectors that point most nearly where its
remainder points. The spread of the projections is the same whatever the dimension of the
vectors, so the chance to meet depends on the cosine alone; ``TABLES`` tables find more
than 0.99 of the pairs at a cosine of exactly 0.95. Nothing of this depends on the number
of rows.

Rows of cells carry an identifier and a sketch of 64 signs of random projections, no
vectors. Of a cell's rows only those go on that have another one with at most ``REACH``
differing signs there (pairs at a cosine of 0.95 differ in more once in 5,000 times). These
fetch their vectors and are verified by cosine in double precision.

Equal vectors are one row from the start. A cell of many rows is dealt out as pairs of
blocks. A linked pair that meets in several cells counts in one of them only, which both
codes together tell, so links are summed in place and pairs are never emitted; for the
components, each group of rows emits a spanning forest.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_run, components, cut, runs, sorted_by, with_class
from tidemark.llm.vectors import classes, elsewhere, keyed, matrix

SPREAD = 0.55  # standard deviation of a unit vector's projections, where shortest lattice vectors have length 1.41
BLOCKS, TABLES, PROBES = 2, 12, 1  # tables: 16 at most
SIGNS, REACH = 64, 17
CELL = 4096  # rows of a cell that are compared in one go
MOST_LARGE = 200_000  # cells that are dealt out, at most: their list is broadcast
ACTIVE = 1000  # rows whose codes are worked out in one go


def _short_vectors() -> np.ndarray:
    whole = [np.array([s * (k == i) + t * (k == j) for k in range(8)], float) for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    return np.array(whole + [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0])


SHORT = _short_vectors()


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of every row: the better of the two cosets of D8 (Conway and Sloane)."""

    def even(y: np.ndarray) -> np.ndarray:
        r = np.rint(y)
        rest = y - r
        odd = (r.sum(1).astype(np.int64) & 1) == 1
        k = np.abs(rest).argmax(1)
        row = np.flatnonzero(odd)
        r[row, k[row]] += np.where(rest[row, k[row]] >= 0, 1.0, -1.0)
        return r

    a, b = even(x), even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def _moves() -> np.ndarray:
    """Shortest vectors worth looking at, for a remainder whose components fall in size: two whole steps, or halves with some signs turned."""
    pairs = [(0, 1), (0, 2), (0, 3), (0, 4), (1, 2)]
    turned = {0: [(), (6, 7), (5, 7), (5, 6), (4, 7)], 1: [(7,), (6,), (5,), (4,), (5, 6, 7)]}
    out = np.zeros((2, 10, 8))
    for odd in (0, 1):
        for i, (a, b) in enumerate(pairs):
            out[odd, i, [a, b]] = 1
        for i, t in enumerate(turned[odd]):
            out[odd, 5 + i] = 0.5
            out[odd, 5 + i, list(t)] = -0.5
    return out


MOVES = _moves()


def toward(rest: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` (4 at most) shortest lattice vectors that point most nearly where each remainder points."""
    order = np.argsort(-np.abs(rest), axis=1, kind="stable")
    sorted_ = np.take_along_axis(rest, order, 1)
    sign = np.where(sorted_ < 0, -1.0, 1.0)
    moves = MOVES[(sorted_ < 0).sum(1) & 1]
    size = np.abs(sorted_)
    gain = np.zeros(moves.shape[:2])
    for k in range(8):  # in a fixed order
        gain += moves[:, :, k] * size[:, k : k + 1]
    best = np.argsort(-gain, axis=1, kind="stable")[:, :count]
    chosen = np.take_along_axis(moves, best[:, :, None], 1) * sign[:, None, :]
    out = np.empty_like(chosen)
    np.put_along_axis(out, np.broadcast_to(order[:, None, :], chosen.shape), chosen, 2)
    return out


def _hash(points: np.ndarray, seed: int) -> np.ndarray:
    """A hash of integer rows; its lowest four bits are left for the table's number."""
    h = np.full(len(points), seed * 2 + 1, np.uint64)
    with np.errstate(over="ignore"):
        for c in points.T:
            h = (h ^ c.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) << np.uint64(4)).view(np.int64)


class Codes:
    """Cells and sketches of unit vectors. Sums are taken in a fixed order, so a vector has the same code in any batch."""

    def __init__(self, dim: int):
        self.seed = 17 + 1000 * dim
        self.to = np.random.default_rng(self.seed).normal(size=(dim, TABLES * BLOCKS * 8 + SIGNS)) * SPREAD

    def _decoded(self, unit: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        y = np.zeros((len(unit), columns))
        for k, row in enumerate(self.to[:, :columns]):
            y += unit[:, k : k + 1] * row
        part = y[:, : TABLES * BLOCKS * 8].reshape(-1, 8)
        return y, part, nearest(part)

    def _keys(self, twice: np.ndarray, t: int) -> np.ndarray:
        return _hash(twice.reshape(len(twice), BLOCKS * 8), self.seed + t) | t

    def homes(self, unit: np.ndarray) -> np.ndarray:
        """The cell of each row in each table."""
        _, _, point = self._decoded(unit, TABLES * BLOCKS * 8)
        twice = (2 * point).astype(np.int64).reshape(len(unit), TABLES, BLOCKS, 8)
        return np.stack([self._keys(twice[:, t], t) for t in range(TABLES)], 1)

    def __call__(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``home`` (rows, tables), ``probes`` (rows, tables, probes) and ``sketch`` (rows)."""
        y, part, point = self._decoded(unit, self.to.shape[1])
        shape = len(unit), TABLES, BLOCKS, 8
        twice = (2 * point).astype(np.int64).reshape(shape)
        steps = (2 * toward(part - point, PROBES)).astype(np.int64).reshape(len(unit), TABLES, BLOCKS, PROBES, 8)
        home = np.stack([self._keys(twice[:, t], t) for t in range(TABLES)], 1)
        probes = np.empty((len(unit), TABLES, BLOCKS * PROBES), np.int64)
        for t, b, p in itertools.product(range(TABLES), range(BLOCKS), range(PROBES)):
            other = twice[:, t].copy()
            other[:, b] += steps[:, t, b, p]
            probes[:, t, b * PROBES + p] = self._keys(other, t)
        sketch = np.packbits(y[:, TABLES * BLOCKS * 8 :] > 0, axis=1).view(np.uint64).ravel()
        return home, probes, sketch


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches in steps of ``ACTIVE`` rows, and for each length of vector the rows' places and unit vectors."""
    for whole in batches:
        for k in range(0, whole.num_rows, ACTIVE):
            b = whole.slice(k, ACTIVE)
            for at, x in matrix(b.column(b.schema.get_field_index(column))):
                yield b, at, _unit(x)


def _codes(made: dict[int, Codes], dim: int) -> Codes:
    if dim not in made:
        made[dim] = Codes(dim)
    return made[dim]


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: dict[int, Codes] = {}
    for _, _, unit in _steps(batches, "vec"):
        code = _codes(made, unit.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(code.homes(unit).ravel())], ["key"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, id, sketch, own``: one for a vector's own cell of each table and one for each cell it looks into."""
    made: dict[int, Codes] = {}
    for b, at, unit in _steps(batches, "vec"):
        code = _codes(made, unit.shape[1])
        home, probes, sketch = code(unit)
        key = np.concatenate([home[:, :, None], probes], 2).reshape(len(at), -1)
        width = key.shape[1]
        own = np.tile(np.arange(width) % (1 + BLOCKS * PROBES) == 0, len(at))
        ids = np.repeat(b.column(b.schema.get_field_index("id")).to_numpy()[at], width)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(ids), pa.array(np.repeat(sketch, width).view(np.int64)), pa.array(own)], ["key", "id", "sketch", "own"])


# What a row is in its task, as bits: the vector's own cell, compared with the other side only, of that other side.
OWN, ACROSS, OTHER = 1, 2, 4


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of kinds ``a`` and ``b`` are compared in their task."""
    return ((a | b) & OWN).astype(bool) & ((a & ACROSS == 0) | ((a ^ b) & OTHER).astype(bool))


def _close(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows that have another one near by sketch in the same task."""
    key, ids, kind = (t.column(c).to_numpy() for c in ("key", "id", "kind"))
    sketch = t.column("sketch").to_numpy().view(np.uint64)
    at = runs(key)
    size = np.diff(at)
    live = np.zeros(len(key), bool)
    small = np.flatnonzero(np.repeat(size <= 16, size))
    k, s, i, m = key[small], sketch[small], ids[small], kind[small]
    for gap in range(1, 16):
        same = np.flatnonzero(k[gap:] == k[:-gap])
        if not len(same):
            break
        a, b = same, same + gap
        near = (np.bitwise_count(s[a] ^ s[b]) <= REACH) & (i[a] != i[b]) & _meet(m[a], m[b])
        live[small[a[near]]] = live[small[b[near]]] = True
    for r in np.flatnonzero(size > 16):
        lo, hi = at[r], at[r + 1]
        every = np.arange(lo, hi)
        for h in np.array_split(every[kind[lo:hi] & OWN > 0], max(1, (hi - lo) // 512)):
            if not len(h):
                continue
            near = (np.bitwise_count(sketch[h, None] ^ sketch[None, lo:hi]) <= REACH) & (ids[h, None] != ids[None, lo:hi]) & _meet(kind[h, None], kind[None, lo:hi])
            live[h] |= near.any(1)
            live[every[near.any(0)]] = True
    some = np.flatnonzero(live)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (key, ids, kind)], ["key", "id", "kind"])


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``size`` nodes reaches over the edges."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verified(least: float):
    def handle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, ids, n, kind = (t.column(c).to_numpy() for c in ("key", "id", "n", "kind"))
        made: dict[int, Codes] = {}
        nodes, adds, src, dst = [], [], [], []
        for where, x in matrix(t.column("vec")):
            every = _unit(x)
            code = _codes(made, x.shape[1])
            coded = [np.concatenate(c) for c in zip(*(code(every[k : k + ACTIVE]) for k in range(0, len(every), ACTIVE)))]
            at = runs(key[where])
            for lo, hi in zip(at, at[1:]):
                if hi - lo < 2:
                    continue
                pos, unit = where[lo:hi], every[lo:hi]
                home, probes, sketch = (c[lo:hi] for c in coded)
                names, mine, now = ids[pos], kind[pos], int(key[pos[0]]) & 15
                own = mine & OWN > 0
                homes = np.flatnonzero(own)
                left, right = [], []
                for k in range(0, len(homes), 512):
                    h = homes[k : k + 512]
                    dot = unit[h] @ unit.T
                    link = (dot >= least - 1e-9) & (np.bitwise_count(sketch[h, None] ^ sketch[None, :]) <= REACH) & _meet(mine[h, None], mine[None, :])
                    link &= (names[h, None] != names[None, :]) & (~own[None, :] | (names[h, None] < names[None, :]))
                    # only in the first cell where the two meet; if each looks into the other's cell, in that of the smaller id
                    for s in range(now):
                        if not link.any():
                            break
                        link &= home[h, s, None] != home[None, :, s]
                        for p in range(probes.shape[2]):
                            link &= (probes[h, s, p, None] != home[None, :, s]) & (probes[None, :, s, p] != home[h, s, None])
                    if now < TABLES and link.any():
                        both = (probes[h, now][:, :, None] == home[None, None, :, now]).any(1)
                        link &= own[None, :] | ~both | (names[h, None] < names[None, :])
                    r, c = np.nonzero(link)
                    # near the threshold a cosine is summed in a fixed order, so that it doesn't depend on the cell
                    edge = np.flatnonzero(dot[r, c] < least + 1e-9)
                    low, high = np.minimum(h[r[edge]], c[edge]), np.maximum(h[r[edge]], c[edge])
                    turned = names[low] > names[high]
                    low, high = np.where(turned, high, low), np.where(turned, low, high)
                    good = np.ones(len(r), bool)
                    good[edge] = np.einsum("ij,ij->i", unit[low], unit[high]) >= least
                    left.append(h[r[good]])
                    right.append(c[good])
                ca, cb = np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])
                if len(ca):
                    add = np.zeros(len(pos), np.int64)
                    np.add.at(add, ca, n[pos[cb]])
                    np.add.at(add, cb, n[pos[ca]])
                    some = np.flatnonzero(add)
                    nodes.append(ids[pos[some]])
                    adds.append(add[some])
                    who, inv = np.unique(np.concatenate([ids[pos[ca]], ids[pos[cb]]]), return_inverse=True)
                    label = _forest(len(who), inv[: len(ca)], inv[len(ca) :])
                    child = np.flatnonzero(label != np.arange(len(who)))
                    src.append(who[child])
                    dst.append(who[label[child]])
        if nodes:
            node, add, s, d = (np.concatenate(v) for v in (nodes, adds, src, dst))
            pad = lambda v, k, front: pa.array(np.concatenate([np.zeros(k, np.int64), v] if front else [v, np.zeros(k, np.int64)]))
            yield pa.RecordBatch.from_arrays([pad(node, len(s), False), pad(add, len(s), False), pad(s, len(node), True), pad(d, len(node), True), pa.array(np.arange(len(node) + len(s)) >= len(node))], ["id", "links", "src", "dst", "edge"])

    return handle


def _dealt(cells: DataFrame, large: DataFrame) -> DataFrame:
    """Rows ``key, id, sketch, kind`` of tasks: those of a large cell in every pair of blocks that theirs belongs to."""
    cells = cells.join(F.broadcast(large), "key", "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("nb", F.lit(1))).cast("int"))
    cells = cells.withColumn("o", F.explode(F.when(F.col("nb").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("nb") - 1))))
    low, high = F.least("part", "o"), F.greatest("part", "o")
    task = F.when(F.col("nb").isNull(), F.col("key")).otherwise(F.xxhash64("key", low, high).bitwiseAND(F.lit(-16)).bitwiseOR(F.col("key").bitwiseAND(F.lit(15))))
    kind = F.col("own").cast("int") + F.when(low != high, ACROSS + F.when(F.col("part") == high, OTHER).otherwise(0)).otherwise(0)
    return cells.select(task.alias("key"), "id", "sketch", kind.cast("byte").alias("kind"))


def lattice_links(embeddings: DataFrame, least: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``embeddings``.

    ``n_links`` counts other rows linked directly (cosine of at least ``least`` in double
    precision), copies too. A vector that is null, empty, zero or holds a null or
    non-finite component links with nothing; vectors of different lengths never link. A
    row with a null vec_id stays, with no links and a null component. Repeated rows count
    as rows. Further columns are ignored; an empty table gives no rows.
    """
    embeddings = embeddings.select("vec_id", "embedding")
    cls = cut(classes(embeddings))
    base = cls.select("id", "vec")
    # At most TABLES homes a class, so at most MOST_LARGE cells have more than this many.
    cell = max(CELL, -(-TABLES * cls.count() // MOST_LARGE))
    large = cut(base.mapInArrow(_homes, "key long").groupBy("key").count().where(F.col("count") > cell).select("key", F.ceil(F.col("count") / cell).cast("int").alias("nb")))
    cells = _dealt(base.mapInArrow(_cells, "key long, id long, sketch long, own boolean"), large)
    close = sorted_by(cells, "key").mapInArrow(by_run("key", _close), "key long, id long, kind byte")
    close = close.join(cls.select("id", "n", "vec"), "id").select("key", "id", "kind", "n", "vec")
    found = cut(sorted_by(close, "key").mapInArrow(by_run("key", _verified(least), 20_000), "id long, links long, src long, dst long, edge boolean"))
    links = found.where("not edge").groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(found.where("edge").select("src", "dst")).select(F.col("node").alias("id"), "component")
    named = cls.select("key", "id", "n").join(links, "id", "left").join(comp, "id", "left")
    named = cut(named.select("key", "n", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    rows = with_class(keyed(embeddings, all_rows=True), named, "key", "n", elsewhere("vec_id"))
    out = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))

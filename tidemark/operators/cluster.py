"""Density clusters of embeddings, by one method at every size.

Rows are dealt out to blocks. Each two blocks give the nearest distances, from which come
the core distances, and then the spanning tree of their rows by mutual reachability. The
spanning tree of all rows is a part of the union of those trees, which are merged a few at
a time; edges are in a total order, so it doesn't matter how. The condensed tree is built
from the n - 1 edges that are left, in one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 4096  # rows of a block; a task holds two
MERGED = 8  # trees that a task merges


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances; what can't be told from rounding is 0 or equal."""
    both = (x**2).sum(1)[:, None] + (y**2).sum(1)
    d = both - 2 * x @ y.T
    return np.sqrt(np.where(d < 1e-13 * both, 0, d)).astype(np.float32).astype(float)


def _nearest(x: np.ndarray, y: np.ndarray, most: int, own: bool) -> np.ndarray:
    """Distances to the ``most`` nearest rows of ``y``; with ``own`` the two are the same rows, and a row isn't its own neighbour."""
    out = []
    for k in range(0, len(x), 1024):
        d = _apart(x[k : k + 1024], y)
        if own:
            d[np.arange(len(d)), np.arange(k, k + len(d))] = np.inf
        out.append(np.sort(np.partition(d, min(most, d.shape[1]) - 1, axis=1)[:, :most], axis=1))
    return np.concatenate(out)


def _tree(x: np.ndarray, core: np.ndarray) -> list[tuple[float, int, int]]:
    """Spanning tree by mutual reachability, edges ordered by weight, then ends (Prim)."""
    n = len(x)
    square = (x**2).sum(1)
    rows, best, frm = np.arange(1, n), np.full(n - 1, np.inf), np.zeros(n - 1, int)
    y, ys, yc = x[1:], square[1:], core[1:]
    live = np.ones(n - 1, bool)
    edges, at = [], 0
    for left in range(n - 1, 0, -1):
        if 2 * left < len(rows):
            rows, best, frm, y, ys, yc = (v[live] for v in (rows, best, frm, y, ys, yc))
            live = np.ones(len(rows), bool)
        both = ys + square[at]
        d = both - 2 * y @ x[at]
        d = np.sqrt(np.where(d < 1e-13 * both, 0, d)).astype(np.float32)
        w = np.maximum(np.maximum(d, yc), core[at])
        new = live & ((w < best) | (w == best) & (at < frm))
        best[new], frm[new] = w[new], at
        tied = np.flatnonzero(best == best.min())
        if len(tied) > 1:
            tied = tied[np.lexsort((np.maximum(rows[tied], frm[tied]), np.minimum(rows[tied], frm[tied])))]
        k = tied[0]
        at = int(rows[k])
        edges.append((float(best[k]), min(at, int(frm[k])), max(at, int(frm[k]))))
        best[k], live[k] = np.inf, False
    return edges


def _forest(w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of the edges of the least spanning forest, in order (Kruskal)."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent, kept, m = list(range(len(names))), [], len(a)
    u, v = ends[:m].tolist(), ends[m:].tolist()
    for k in np.lexsort((b, a, w)).tolist():
        i, j = u[k], v[k]
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        while parent[j] != j:
            parent[j] = j = parent[parent[j]]
        if i != j:
            parent[i] = j
            kept.append(k)
    return np.array(kept, int)


def hdbscan(x: np.ndarray, min_cluster: int = 15, min_samples: int = 5) -> np.ndarray:
    """Labels by the HDBSCAN paper (Campello et al., 2013), excess of mass; -1 is noise. Quadratic in rows."""
    n = len(x)
    if n < max(min_cluster, 2):
        return np.full(n, -1)
    core = _nearest(x, x, min(min_samples, n - 1), True)[:, -1]
    return _labels(n, _tree(x, core), min_cluster)


def _labels(n: int, edges: list[tuple[float, int, int]], min_cluster: int) -> np.ndarray:
    """Labels from the edges of a spanning tree of rows 0 to n - 1."""
    parent, size = list(range(2 * n - 1)), [1] * n + [0] * (n - 1)
    children: dict[int, tuple[int, int, float]] = {}

    def root(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for k, (w, a, b) in enumerate(sorted(edges)):
        ra, rb, new = root(a), root(b), n + k
        children[new] = (ra, rb, w)
        size[new] = size[ra] + size[rb]
        parent[ra] = parent[rb] = new
    # Condensed tree: clusters of at least min_cluster, with what falls out of them and when.
    stability: dict[int, float] = {}
    members: dict[int, list[tuple[int, float]]] = {}
    kids: dict[int, list[int]] = {}

    def leaves(v: int) -> list[int]:
        out, stack = [], [v]
        while stack:
            u = stack.pop()
            if u < n:
                out.append(u)
            else:
                stack += children[u][:2]
        return out

    todo = [(2 * n - 2, 0.0)]
    while todo:
        top, born = todo.pop()
        v, lost = top, []
        kids[top] = []
        while True:
            if v < n:
                lost.append((v, np.inf))
                break
            a, b, w = children[v]
            lam = 1 / w if w > 0 else np.inf
            big = [c for c in (a, b) if size[c] >= min_cluster] if w > 0 else []  # equal rows don't part
            if len(big) == 2:
                lost += [(u, lam) for u in leaves(v)]
                kids[top] = big
                todo += [(c, lam) for c in big]
                break
            if not big:
                lost += [(u, lam) for u in leaves(v)]
                break
            lost += [(u, lam) for u in leaves(b if big[0] == a else a)]
            v = big[0]
        members[top] = lost
        cap = max((x_ for _, x_ in lost if np.isfinite(x_)), default=born)
        stability[top] = sum(min(x_, cap) - born for _, x_ in lost)
    chosen: set[int] = set()
    value: dict[int, float] = {}
    for top in sorted(members):  # children have smaller numbers
        below = sum(value[c] for c in kids[top])
        if kids[top] and (below > stability[top] or top == 2 * n - 2):
            value[top] = below
        else:
            value[top] = stability[top]
            if top != 2 * n - 2 or not kids[top]:
                chosen.add(top)
    label, stack, number = np.full(n, -1), [2 * n - 2], 0
    while stack:
        top = stack.pop()
        if top in chosen and top != 2 * n - 2:
            label[leaves(top)] = number
            number += 1
        else:
            stack += kids[top]
    return label


def clusters(df: DataFrame, key: str, vector: str, min_cluster: int = 15, min_samples: int = 5) -> DataFrame:
    """``key, cluster``: the labels of :func:`hdbscan`, whatever the number of rows; -1 is noise."""
    n = df.count()
    if n < max(min_cluster, 2):
        return df.select(key, F.lit(-1).alias("cluster"))
    blocks = math.ceil(n / BLOCK)
    most = min(min_samples, n - 1)
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", "v"), F.lit(blocks)).cast("long"))
    rows = rows.withColumn("node", (F.row_number().over(Window.partitionBy("block").orderBy("key", "v")) - 1) * F.lit(blocks) + F.col("block"))

    def paired(d: DataFrame, own: bool) -> DataFrame:
        """Each row once for every two blocks it is of, ``own``: also its block with itself."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        d = d.withColumn("other", other) if own or blocks == 1 else d.withColumn("other", other).where("other <> block")
        return d.withColumn("pair", F.least("block", "other") * F.lit(blocks) + F.greatest("block", "other"))

    def near(pdf: pd.DataFrame) -> pd.DataFrame:
        x, block = np.stack(pdf["v"].to_numpy()), pdf["block"].to_numpy()
        one = block == block.min()
        sides = [(one, one)] if one.all() else [(one, ~one), (~one, one)]
        if one.all() and int(pdf["pair"].iloc[0]) != int(block[0]) * (blocks + 1):
            return pd.DataFrame({"node": [], "d": []})  # the other block is empty
        found = [(pdf["node"].to_numpy()[a], _nearest(x[a], x[b], most, one.all())) for a, b in sides]
        node, d = np.concatenate([np.repeat(i, v.shape[1]) for i, v in found]), np.concatenate([v.ravel() for _, v in found])
        return pd.DataFrame({"node": node, "d": d})[np.isfinite(d)]

    def spanned(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        node = pdf["node"].to_numpy()
        edges = _tree(np.stack(pdf["v"].to_numpy()), pdf["core"].to_numpy())
        return pd.DataFrame({"part": pdf["pair"].iloc[0], "w": [e[0] for e in edges], "a": [node[e[1]] for e in edges], "b": [node[e[2]] for e in edges]})

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[_forest(pdf["w"].to_numpy(), pdf["a"].to_numpy(), pdf["b"].to_numpy())]

    def labelled(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = merged(pdf)
        names, ends = np.unique(np.concatenate([pdf["a"], pdf["b"]]), return_inverse=True)
        edges = list(zip(pdf["w"].tolist(), ends[: len(pdf)].tolist(), ends[len(pdf) :].tolist()))
        return pd.DataFrame({"node": names, "cluster": _labels(len(names), edges, min_cluster).astype("int32")})

    core = paired(rows, True).groupBy("pair").applyInPandas(near, "node long, d double")
    core = core.groupBy("node").agg(F.element_at(F.sort_array(F.collect_list("d")), most).alias("core"))
    edges = paired(rows.join(core, "node"), False).groupBy("pair").applyInPandas(spanned, "part long, w double, a long, b long")
    parts = blocks * blocks
    while parts > MERGED:
        parts = math.ceil(parts / MERGED)
        edges = edges.withColumn("part", F.floor(F.col("part") / MERGED)).groupBy("part").applyInPandas(merged, "part long, w double, a long, b long")
    found = edges.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(labelled, "node long, cluster int")
    return rows.join(found, "node").select(F.col("key").alias(key), "cluster")

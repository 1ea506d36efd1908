"""Operators on embeddings and conversations against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, chat, common, lattice
from tidemark.llm import vectors as vectors_

VEC = "vec_id long, embedding array<float>"


def vectors(seed=0, n=300, d=64):
    """Random vectors with copies, scaled copies and near copies around the threshold; unusable ones at the end."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[n // 2 : n // 2 + 30] = x[:30]
    x[n // 2 + 30 : n // 2 + 60] = 2.5 * x[30:60]
    for k, i in enumerate(range(n // 2 + 60, n)):
        near = rng.normal(size=d)
        near *= np.linalg.norm(x[k]) / np.linalg.norm(near)
        x[i] = x[k] + near * rng.choice([0.05, 0.2, 0.3, 0.36])
    rows = [(int(i) * 2, [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    bad = [(9001, None), (9002, [0.0] * d), (9003, [float("nan")] * d), (9004, [float("inf")] + [1.0] * (d - 1)), (9005, [None] + [1.0] * (d - 1)), (9006, []), (9007, [1.0, 2.0]), (9009, [2.0, 4.0])]
    return rows, bad


def plain_links(rows, least=0.95):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], *(label[near[i]])) if near[i].any() else label[i] for i in range(len(ids))])
        if (new == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), label)}
        label = new


@pytest.mark.parametrize("cell", [lattice.CELL, 6])
def test_lattice_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(lattice, "CELL", cell)
    rows, bad = vectors()
    df = spark.createDataFrame(rows + bad + [(None, rows[0][1])], VEC).repartition(3).withColumn("id", F.lit("clash")).withColumn("n", F.lit(0)).withColumn("key", F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.lattice_links(df).collect()}
    want = plain_links(rows)
    assert {k: got[k] for k in want} == want
    assert all(got[k] == (0, k) for k, _ in bad if k < 9007) and got[9007] == (1, 9007) and got[9009] == (1, 9007)
    assert got[None] == (0, None)
    assert lattice.lattice_links(df.limit(0)).count() == 0


def test_dense_groups_count_every_link(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, [float(v) for v in np.float32(base + rng.normal(size=16) * 0.02)]) for i in range(400)]
    got = lattice.lattice_links(spark.createDataFrame(rows, VEC)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(399, 0)} and sum(r.kept for r in got) == 1


def test_repeated_rows_count(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    got = sorted((r.vec_id, r.n_links) for r in lattice.lattice_links(spark.createDataFrame(rows, VEC)).collect())
    assert got == [(1, 1), (1, 1), (2, 0)]


def test_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    p = lattice.nearest(x)
    for q, v in zip(p, x):
        assert np.allclose(q * 2, np.rint(q * 2)) and q.sum() % 2 == pytest.approx(0) and (np.allclose(q, np.rint(q)) or np.allclose(q + 0.5, np.rint(q + 0.5)))
        assert all(((q + s - v) ** 2).sum() >= ((q - v) ** 2).sum() - 1e-9 for s in lattice.SHORT)


@pytest.mark.parametrize("dim", [16, 64, 768])
def test_tables_reach_the_recall_in_any_dimension(dim):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * off
    code = lattice.Codes(dim)
    (ha, pa, sa), (hb, pb, sb) = code(x), code(y)
    assert (code.homes(x) == ha).all()
    met = (ha == hb).any(1) | (pa == hb[:, :, None]).any((1, 2)) | (pb == ha[:, :, None]).any((1, 2))
    met &= np.bitwise_count(sa ^ sb) <= lattice.REACH
    assert met.mean() > 0.98, met.mean()


def test_moves_are_the_best_of_all_short_vectors():
    rest = np.random.default_rng(2).normal(size=(300, 8)) * 0.3
    best = np.sort(rest @ lattice.SHORT.T, axis=1)[:, :-5:-1]
    mine = lattice.toward(rest, 4)
    assert np.allclose(np.einsum("rpk,rk->rp", mine, rest), best)
    assert all((lattice.SHORT == m).all(1).any() for m in mine.reshape(-1, 8))


def test_keys_are_of_the_whole_vector(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 1.0]), (4, [0.0, 1.0]), (5, [-0.0, 1.0]), (6, [1.0]), (7, [1.0, 0.0]), (8, None), (None, [1.0])]
    got = {r.vec_id: r.key for r in vectors_.keyed(spark.createDataFrame(rows, VEC), all_rows=True).collect()}
    assert got[1] == got[2] and got[4] == got[5] and len({got[k] for k in (1, 3, 4, 6, 7)}) == 5 and got[8] is got[None] is None
    assert sorted((r.id, r.n) for r in vectors_.classes(spark.createDataFrame(rows, VEC)).collect()) == [(1, 2), (3, 1), (4, 2), (6, 1), (7, 1)]


def test_frequent_classes_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 5)
    rows, bad = vectors(n=200)
    rows += [(k, rows[0][1]) for k in range(5000, 5050)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.lattice_links(spark.createDataFrame(rows + bad, VEC)).collect()}
    want = plain_links(rows)
    assert {k: got[k] for k in want} == want


def test_search_against_brute_force(spark):
    rows, bad = vectors(4, 2000, 32)
    df = spark.createDataFrame(rows + bad, VEC).withColumn("rank", F.lit("clash"))
    got = ann.search(df).collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    by: dict = {}
    for r in got:
        by.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    asked = np.flatnonzero(ids % 20 == 0)
    assert set(by) == set(ids[asked].tolist()) and all(sorted(v) == list(range(1, 21)) for v in by.values())
    hits = 0
    place = {i: k for k, i in enumerate(ids.tolist())}
    for q in asked:
        s = x @ x[q]
        s[q] = -np.inf
        hits += len({v for v, _ in by[ids[q]].values()} & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
        seen = [by[ids[q]][k] for k in range(1, 21)]
        assert all(a[1] > b[1] or a[1] == b[1] and a[0] < b[0] for a, b in zip(seen, seen[1:]))
        assert all(abs(x[place[v]] @ x[q] - sc) < 1e-9 for v, sc in seen)
    assert hits / (20 * len(asked)) >= 0.95


def test_search_in_a_dense_group(spark):
    rng = np.random.default_rng(6)
    n, group, d = 12_000, 4000, 64
    x = rng.normal(size=(n, d))
    x[:group] = rng.normal(size=d) + rng.normal(size=(group, d)) * 0.1
    x = np.float32(x / np.linalg.norm(x, axis=1, keepdims=True))
    x = x[rng.permutation(n)].astype(float)
    got: dict = {}
    for r in ann.search(spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], VEC)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall, dense = [], []
    for q in range(0, n, 20):
        s = x @ x[q]
        s[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-s)[:20].tolist())) / 20)
        dense.append((s > 0.9).sum() > 1000)
    recall, dense = np.array(recall), np.array(dense)
    assert dense.sum() > 100 and recall[dense].mean() >= 0.95 and recall.mean() >= 0.95, (recall[dense].mean(), recall.mean())


def test_search_with_copies_and_few(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 1.0]), (7, None)]
    got: dict = {}
    for r in ann.search(spark.createDataFrame(rows, VEC)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[0] == list(range(1, 21)) and got[20] == list(range(20)) and got[40] == list(range(20)) and got[100] == list(range(20))
    few = ann.search(spark.createDataFrame([(0, [1.0]), (20, [2.0]), (3, [1.0])], VEC)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in few] == [(0, 20), (0, 3), (20, 0), (20, 3)]
    assert ann.search(spark.createDataFrame([(7, None)], VEC)).count() == 0
    assert ann.search(spark.createDataFrame([], VEC)).count() == 0


def test_search_in_every_length(spark):
    """Vectors of rare lengths take part; few rows in the cells probed make a query look further."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in np.float32(rng.normal(size=d))]) for i, d in enumerate([8] * 400 + [5] * 45 + [3] * 30 + [1] * 25)]
    got: dict = {}
    for r in ann.search(spark.createDataFrame(rows, VEC)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q, v in rows[::20]:
        same = sorted(((-float(np.dot(np.array(v), np.array(w))), i) for i, w in rows if len(w) == len(v) and i != q))[:20]
        assert len(got[q]) == 20
        if len(v) != 8:
            assert [i for i, _ in got[q]] == [i for _, i in same]


def test_shards_change_nothing(spark, monkeypatch):
    rows, _ = vectors(11, 1500, 16)
    df = spark.createDataFrame(rows, VEC)
    want = sorted(map(tuple, ann.search(df).collect()))
    monkeypatch.setattr(ann, "SHARD", 40)
    monkeypatch.setattr(ann, "LEAST", 10)
    assert sorted(map(tuple, ann.search(df).collect())) == want


def test_parallel_error_weighs_more():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ix = ann.fit(x, 600, 10)
    cell = ix.cell(x)
    assert ix.cells > 1 and np.allclose(ix.scores(x[:5]), x[:5] @ ix.centers(np.arange(ix.cells)).T)
    parallel = []
    for weight in (0.0, 8.0):
        codes = ann._assign(ix.cut(x - ix.centers(cell)), ix.cut(x), ix.books, weight, None)
        made = ix.centers(cell) + np.concatenate([ix.books[s][codes[:, s]] for s in range(len(ix.books))], 1)[:, :16]
        parallel.append((((x - made) * x).sum(1) ** 2).mean())
    assert parallel[1] < parallel[0]


TURNS = "conv_id long, turn long, role string, text string"


def test_preferences(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "a"), (0, 2, "user", "x"), (1, 0, "user", "hi"), (1, 1, "assistant", "b"),
        (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, None, None), (4, 0, None, None), (5, 0, "", ""), (5, 7, "assistant", "late"), (8, 0, "user", "alone"), (None, 0, "user", "?"), (6, None, "user", "?"),
    ]
    turns = spark.createDataFrame(rows * 3, TURNS).withColumn("pair_id", F.lit("clash")).withColumn("part", F.lit(1)).repartition(3)
    two = chat.neighbours(turns)
    got = sorted((r.pair_id, r.part, r.turn, r.trained_from, r.trained_to, r.start, r.end) for r in chat.rendered(two).collect() if r.pair_id != 4)
    assert got == [(0, "chosen", 1, 14, 22, 0, 23), (0, "chosen", 2, -1, -1, 23, 41), (0, "prompt", 0, -1, -1, 0, 19), (0, "rejected", 1, 14, 22, 0, 23), (1, "prompt", 0, -1, -1, 0, 21), (2, "prompt", 0, -1, -1, 0, 13), (2, "rejected", 7, 14, 25, 0, 26)]
    rec = {r.pair_id: r for r in chat.records(two).collect()}
    assert set(rec) == {0, 1, 2}
    assert rec[0].prompt == "<|user|>\nhi<|end|>\n" and rec[0].chosen == "<|assistant|>\na<|end|>\n<|user|>\nx<|end|>\n" and rec[0].rejected == "<|assistant|>\nb<|end|>\n"
    assert rec[0].chosen_mask == "14:22" and rec[0].chosen[14:22] == "a<|end|>" and rec[1].chosen == "" and rec[1].chosen_mask == "" and rec[1].prompt_turns == 1
    pairs = spark.createDataFrame([(70, 0, 1), (71, 1, 2), (71, 1, 2), (72, 2, 99), (73, None, 1)], "pair_id long, chosen long, rejected long")
    assert {(r.pair_id, r.prompt_turns) for r in chat.records(chat.sides(turns, pairs)).collect()} == {(70, 1), (71, 0)}
    assert chat.records(chat.neighbours(turns.limit(0))).count() == 0 and chat.rendered(chat.neighbours(turns.limit(0))).count() == 0


def test_marks_in_texts_are_no_marks(spark):
    rows = [(0, 0, "user", "q"), (1, 0, "user", "q"), (0, 1, "assistant", "x<|end|>\n<|user|>\n<\\|end|>"), (1, 1, "as|>\nb", "y")]
    r = chat.records(chat.neighbours(spark.createDataFrame(rows, TURNS))).first()
    assert r.chosen.count("<|") == 2 and r.rejected == "<|as___b|>\ny<|end|>\n" and r.rejected_mask == ""
    assert all(chat.restored(chat.escaped(t)) == t and "<|" not in chat.escaped(t) for t in ("<|", "<\\|", "a<\\\\|b<|", "", "<||>", "\\<|"))


def test_long_conversations_add_up(spark):
    turns = spark.range(14_000).select((F.col("id") % 2).alias("conv_id"), F.floor(F.col("id") / 2).alias("turn"), F.lit("user").alias("role"), F.when(F.col("id") < 600, "s").otherwise(F.col("id").cast("string")).alias("text"))
    two = chat.neighbours(turns)
    p = chat.rendered(two).toPandas().sort_values(["part", "turn"])
    for _, g in p.groupby("part"):
        assert (g.end.to_numpy()[:-1] == g.start.to_numpy()[1:]).all() and g.start.iloc[0] == 0
    assert (p.part == "prompt").sum() == 300
    assert chat.records(two).first().chosen == "".join(p[p.part == "chosen"].segment)

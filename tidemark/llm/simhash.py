"""SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint has 64 bits. Two fingerprints link if they differ in at most three. The
64 positions are taken in two halves. As three differing bits lie in two halves, one
half has at most one of them; the other way round, in at least one of the two
projections (a half with the other half masked) at most two bits differ, or none do.
Every fingerprint emits all variants of each projection within half the radius, that is
one flipped bit (33 a half, 66 in all). Two fingerprints that differ in at most two bits
of a half meet at a variant that lies between them. Rows are shuffled on the variant,
colliding fingerprints are verified on all 64 bits, and links that meet at several
variants are deduplicated.

Equal fingerprints are one node from the start, so groups of copies cost one row. Within
a variant's group links are gathered by a search that looks at each fingerprint once and
emits a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_run, components, cut, runs, sorted_by, with_class

PIECE = 4 << 20  # bytes of a text held as words at a time
LONG_RUN = 1 << 16  # fingerprints of one variant that are compared in one go


def _count(words: list[bytes], shingle: int, bits: np.ndarray) -> int:
    """Adds the set bits of every shingle of ``words`` to ``bits``."""
    n = len(words) - shingle + 1
    if n < 1:
        return 0
    joined = b" ".join(words)
    at = np.cumsum([0, *map(len, words)]) + np.arange(len(words) + 1)
    starts, ends = at[:n].tolist(), (at[shingle:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends)], np.uint64)
    for k in range(0, n, 65_536):
        bits += np.unpackbits(h[k : k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return n


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text; 0 for one without words (null and empty too)."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() maps A-Z alone
    bits, n, words, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        words = words[-(shingle - 1) :] + data[at:end].split() if shingle > 1 else data[at:end].split()
        n += _count(words, shingle, bits)
        at = end
    if not n:
        if not words:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    return int.from_bytes(np.packbits(bits * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``; ``fp`` is the fingerprint as a signed long."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(go, "doc_id long, fp long")


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[0], np.uint64(1) << np.arange(32, dtype=np.uint64)]).astype(np.uint64)
    for b in batches:
        every = b.column(0).to_numpy().view(np.uint64)
        for k in range(0, len(every), 2000):
            fp = every[k : k + 2000]
            low, high = fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32)
            key = np.concatenate([(low[:, None] ^ flips).ravel(), (high[:, None] ^ flips).ravel() | np.uint64(1 << 32)])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.tile(np.repeat(fp, 33), 2).view(np.int64))], ["key", "fp"])


def forest(fp: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among distinct fingerprints; each is looked at once."""
    out, left = [], fp
    while len(left) > 1:
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            nodes = queue.pop()
            for x in nodes:
                near = np.bitwise_count(left ^ x) <= radius
                if near.any():
                    found = left[near]
                    out.append((np.full(len(found), x), found))
                    queue.append(found)
                    left = left[~near]
                    if not len(left):
                        break
    return out


def _links(radius: int):
    def handle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, fp = t.column("key").to_numpy(), t.column("fp").to_numpy().view(np.uint64)
        at = runs(key)
        size = np.diff(at)
        out = []
        small = np.repeat(size <= 8, size)
        k, f = key[small], fp[small]
        for gap in range(1, 8):
            same = np.flatnonzero(k[gap:] == k[:-gap])
            if not len(same):
                break
            a, b = f[same], f[same + gap]
            near = np.bitwise_count(a ^ b) <= radius
            out.append((a[near], b[near]))
        for i in np.flatnonzero(size > 8):
            group = np.unique(fp[at[i] : at[i + 1]])
            if len(group) <= LONG_RUN:
                out += forest(group, radius)
                continue
            # Three differing bits leave at least one of four 16-bit blocks equal: an exact split of a long run.
            for block in range(4):
                v = (group >> np.uint64(16 * block)) & np.uint64(0xFFFF)
                o = np.argsort(v, kind="stable")
                cuts = runs(v[o])
                for lo, hi in zip(cuts, cuts[1:]):
                    out += forest(group[o[lo:hi]], radius)
        if out:
            e = np.stack([np.concatenate([x[i] for x in out]) for i in (0, 1)], 1)
            e = np.unique(np.sort(e.view(np.int64), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0].copy()), pa.array(e[:, 1].copy())], ["src", "dst"])

    return handle


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Edges ``(src, dst)`` that connect all distinct fingerprints ``fp`` within ``radius`` (3 at most)."""
    if not 0 <= radius <= 3:
        raise ValueError("two halves and one flipped bit reach a radius of 3 at most")
    v = sorted_by(nodes.select("fp").mapInArrow(_variants, "key long, fp long"), "key")
    return v.mapInArrow(by_run("key", _links(radius)), "src long, dst long").distinct()


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every document.

    Reads ``doc_id`` and ``text``; other columns are ignored. A null text counts as
    empty; a text without words has fingerprint 0 and links like any other. Repeated rows
    of a doc_id give repeated result rows; a null doc_id keeps its row but names no
    component unless it stands alone (then null). An empty table gives no rows.
    """
    docs = cut(fingerprints(docs, shingle))
    nodes = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    comp = components(links(nodes, radius)).select(F.col("node").alias("fp"), "component")
    named = nodes.join(comp, "fp", "left").select("fp", "rep", "n", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = cut(named.join(least, "component").select(F.col("fp").alias("key"), "n", "component_id"))
    found = with_class(docs.withColumn("key", F.col("fp")), named, "key", "n", F.xxhash64("doc_id"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_keep(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The documents that are the smallest doc_id of their component, columns unchanged.

    A null text counts as empty, texts without words are copies of each other. Rows with a
    null doc_id stay, and so do repeated rows of a kept doc_id; an empty table gives no
    rows. Whole rows are joined by doc_id with those that go, the same way at every size.
    """
    gone = simhash_components(docs.select("doc_id", "text"), shingle, radius).where("doc_id <> component_id").select(F.col("doc_id").alias("gone of simhash")).distinct()
    there = docs.where("doc_id is not null")
    kept = there.join(gone.hint("merge"), there["doc_id"].cast("long") == gone["gone of simhash"], "left_anti")
    return kept.unionByName(docs.where("doc_id is null"))

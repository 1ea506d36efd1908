"""Suffix-array dedup with run-length indexes over content-defined shards.

A byte of a document goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id. One Burrows-Wheeler transform of a whole corpus can't be
built in parts, so windows of ``LENGTH`` bytes are first dealt out by content:

* Every window has an anchor, its gram of ``GRAM`` bytes of least hash (leftmost of equal
  ones). Equal windows have equal anchors at equal places. Consecutive windows with the
  same anchor form a context; contexts split all windows of a document among themselves.
* Grams that would be the anchor of very many contexts, as those at the ends of a passage
  that stands in many places, come last in this order: a sample finds them. Which grams
  they are changes the division of work alone.
* Contexts are grouped by anchor. Of equal contexts (64 bits of the anchor's hash and 64 of
  the context's) all but those of the smallest doc_id go whole. Different contexts under
  one anchor can share windows only if they agree on the bytes left or right of the anchor;
  where two do, their bytes are fetched.
* For fetched contexts run-length indexes are built, each over whole anchors and a bounded
  number of bytes: the Burrows-Wheeler transform as runs, with the suffix positions at run
  starts and ends sampled and, for classes of suffixes that share ``LENGTH`` bytes, the
  smallest doc_id. All contexts are streamed through it from right to left, and matching
  statistics of at least ``LENGTH`` whose class has a smaller doc_id mark the window.

Windows marked in documents are joined to runs of removed bytes. Equal contexts are
pre-aggregated before the shuffle, so a passage that a third of all documents share costs
one row for each piece of input. Documents are dealt out to buckets twice, compressed; the
plan is the same at every size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_run, cut, parts

LENGTH, GRAM = 50, 16
SIDE = (LENGTH - GRAM + 1) // 2  # a window has at least so many bytes on one side of its anchor
PIECE = 1 << 20  # bytes hashed at a time
GATHER = 32 << 20  # bytes of input whose equal contexts are pre-aggregated
SHARD = 64 << 20  # bytes of input for each shard
INDEX = 4 << 20  # bytes of an index, if an anchor has no more
SAMPLE, RATE = 64 << 20, 10_000  # bytes in which frequent grams are looked for: so many, or that part of all if it is more
SPLIT = 200_000  # contexts of a gram from which it comes last
MOST = 2_000_000  # frequent grams, at most: their list is broadcast
LAST = np.uint64(1 << 63)
WHOLE = -1  # all windows of a context

_U = np.uint64


def _mixed(x: np.ndarray, by: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x * _U(by)
        x ^= x >> _U(31)
        return x


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """Minima over windows of ``width``."""
    p = 1
    while 2 * p <= width:
        x = np.minimum(x[:-p], x[p:])
        p *= 2
    return np.minimum(x[: len(x) - (width - p)], x[width - p :]) if width > p else x


def _words(buf: bytes) -> np.ndarray:
    """The eight bytes from every position, as integers; ``buf`` must be padded."""
    return np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))


class Often:
    """Frequent grams by hash."""

    def __init__(self, grams: np.ndarray):
        self.grams = np.sort(grams)
        self.there = np.zeros(1 << 22, bool)
        self.there[(self.grams >> _U(20)) & _U((1 << 22) - 1)] = True

    def among(self, h: np.ndarray) -> np.ndarray:
        """Places of frequent grams."""
        if not len(self.grams):
            return np.zeros(0, np.int64)
        may = np.flatnonzero(self.there[(h >> _U(20)) & _U((1 << 22) - 1)])
        at = np.minimum(np.searchsorted(self.grams, h[may]), len(self.grams) - 1)
        return may[self.grams[at] == h[may]]


NONE = Often(np.zeros(0, np.uint64))


def _grams(u: np.ndarray, m: int) -> np.ndarray:
    """Hashes (63 bits) of the grams from each of ``m`` positions."""
    return _mixed(_mixed(u[:m], 0x9E3779B97F4A7C15) ^ u[8 : 8 + m], 0x94D049BB133111EB) >> _U(1)


def contexts(buf: bytes, ends: np.ndarray, often: Often = NONE) -> tuple[np.ndarray, ...]:
    """Contexts of documents that lie side by side in ``buf`` up to ``ends``; 64 bytes of padding follow.

    Returns for each context: document, first window, end of windows, anchor (64 bits),
    hash of its bytes (64 bits), and 12 bits each for the bytes up to the anchor's end and
    from its start (0: the context doesn't reach so far).
    """
    n = len(buf) - 64
    none = tuple(np.zeros(0, np.int64) for _ in range(7))
    if n < LENGTH:
        return none
    u = _words(buf)
    m = n - GRAM + 1
    h = _grams(u, m)
    h[often.among(h)] |= LAST
    low = (h & ~_U((1 << 26) - 1)) | np.arange(m, dtype=np.uint64)
    del h
    low = _slide(low, LENGTH - GRAM + 1)
    pos = (low & _U((1 << 26) - 1)).astype(np.int64)
    del low
    starts = np.concatenate([[0], ends[:-1]])
    valid = np.zeros(n + 1, np.int32)
    long = ends - starts >= LENGTH
    if not long.any():
        return none
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - LENGTH + 1, -1)
    valid = np.cumsum(valid)[: len(pos)] > 0
    edge = np.zeros(len(pos), bool)
    edge[0] = True
    edge[1:] = (pos[1:] != pos[:-1]) | (valid[1:] != valid[:-1])
    edge[starts[long]] = True
    st = np.flatnonzero(edge)
    en = np.append(st[1:], len(pos))
    keep = valid[st]
    st, en = st[keep], en[keep]
    at = pos[st]
    doc = np.searchsorted(ends, st, "right")
    anchor = _mixed(_mixed(u[at], 0xBF58476D1CE4E5B9) ^ u[at + 8], 0xD6E8FEB86659FD93)
    view, digest = memoryview(buf), xxhash.xxh3_64_intdigest
    ctx = np.array([digest(view[a:b]) for a, b in zip(st.tolist(), (en + LENGTH - 1).tolist())], np.uint64)
    left = at - st >= SIDE
    right = en + LENGTH - 1 - at >= GRAM + SIDE
    sides = []
    for ok, frm in ((left, np.maximum(at - SIDE, 0)), (right, at)):
        x = np.zeros(len(at), np.uint64)
        for k in (0, 8, 16, 24, GRAM + SIDE - 8):
            x = _mixed(x ^ u[frm + k], 0x9FB21C651E98DF25)
        sides.append(np.where(ok, (x >> _U(20)) % _U(4095) + _U(1), _U(0)).astype(np.int64))
    return doc, st, en, anchor, ctx, *sides


def _pieces(ids: list, texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, np.ndarray]]:
    """Documents, and where a long one is cut its parts, gathered to about ``PIECE`` bytes: ids, offsets in their documents, padded bytes, ends."""
    held, who, off, size = [], [], [], 0

    def out():
        return np.array(who, np.int64), np.array(off, np.int64), b"".join([*held, b"\0" * 64]), np.cumsum([len(x) for x in held])

    for i, text in zip(ids, texts):
        for k in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            part = text[k : k + PIECE + LENGTH - 1]
            if size and size + len(part) > PIECE:
                yield out()
                held, who, off, size = [], [], [], 0
            held.append(part)
            who.append(i)
            off.append(k)
            size += len(part)
    if held:
        yield out()


def _utf8(x) -> bytes:
    return (x.as_py() or "").encode("utf-8", "surrogatepass")


def _packed(arrays: list[np.ndarray], bucket: np.ndarray, count: int) -> Iterator[tuple[int, bytes]]:
    """Columns dealt out by bucket, each bucket's rows as one string of bytes (row count, then column by column)."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(count + 1))
    arrays = [a[order] for a in arrays]
    for b in np.flatnonzero(np.diff(cuts)):
        lo, hi = cuts[b], cuts[b + 1]
        yield int(b), np.int64(hi - lo).tobytes() + b"".join(np.ascontiguousarray(a[lo:hi]).tobytes() for a in arrays)


def _unpacked(blobs: list[bytes], kinds: list[tuple[type, int]]) -> list[np.ndarray]:
    """``kinds``: type and values a row of each column."""
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = int(np.frombuffer(blob, np.int64, 1)[0]), 8
        for k, (kind, each) in enumerate(kinds):
            out[k].append(np.frombuffer(blob, kind, n * each, at).reshape(n, each) if each > 1 else np.frombuffer(blob, kind, n, at))
            at += n * each * np.dtype(kind).itemsize
    return [np.concatenate(x) if x else np.zeros((0, e) if e > 1 else 0, k) for x, (k, e) in zip(out, kinds)]


def _rows(pairs: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    held = list(pairs)
    for k in range(0, len(held), 512):
        some = held[k : k + 512]
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in some], pa.int32()), pa.array([x for _, x in some], pa.binary())], ["bucket", "blob"])


def _bucket(x: np.ndarray, count: int) -> np.ndarray:
    return (_mixed(np.asarray(x).astype(np.int64).view(np.uint64), 0xD1342543DE82EF95) >> _U(17)) % _U(count)


# A context on its way to its anchor's shard: low 32 bits of the anchor (the others choose the shard), hash, both sides in three bytes, document's index in the blob's list.
def _shown(anchor, ctx, left, right, doc, ids, count) -> Iterator[tuple[int, bytes]]:
    side = (left | right << 12).astype(np.uint32)
    bucket = (anchor >> _U(32)) % _U(count)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(count + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        o = order[cuts[b] : cuts[b + 1]]
        names, index = np.unique(ids[doc[o]], return_inverse=True)
        small = len(names) < 1 << 16
        parts_ = [np.int64(len(o)).tobytes(), np.int64(len(names) if small else -len(names)).tobytes(), names.tobytes(), index.astype(np.uint16 if small else np.uint32).tobytes(), anchor[o].astype(np.uint32).tobytes()]
        parts_ += [ctx[o].tobytes(), side[o].view(np.uint8).reshape(-1, 4)[:, :3].tobytes()]
        yield int(b), b"".join(parts_)


def _read_shown(blob: bytes) -> tuple[np.ndarray, ...]:
    n, k = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    at = 16
    names = np.frombuffer(blob, np.int64, abs(k), at)
    at += 8 * abs(k)
    index = np.frombuffer(blob, np.uint16 if k > 0 else np.uint32, n, at)
    at += n * (2 if k > 0 else 4)
    anchor = np.frombuffer(blob, np.uint32, n, at).astype(np.uint64)
    at += 4 * n
    side = np.zeros((n, 4), np.uint8)
    side[:, :3] = np.frombuffer(blob, np.uint8, 3 * n, at + 8 * n).reshape(n, 3)
    return anchor, np.frombuffer(blob, np.uint64, n, at), side.view(np.uint32).ravel(), names[index]


_DECIDED = [(np.int64, 1), (np.uint64, 1), (np.int64, 1)]  # document, context, its windows that go as bits
_ASKED = [(np.int64, 1), (np.uint64, 1), (np.int32, 1)]  # document, context, shard that wants the bytes


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams that several different contexts of a piece share, where these have one anchor: ``gram, n``."""
    for b in batches:
        for _, _, buf, ends in _pieces(b.column(0).to_pylist(), map(_utf8, b.column(1))):
            _, st, en, anchor, ctx, _, _ = contexts(buf, ends)
            if not len(st):
                continue
            order = np.lexsort((ctx, anchor))
            new = np.append(True, (ctx[order][1:] != ctx[order][:-1]) | (anchor[order][1:] != anchor[order][:-1]))
            first = order[new]
            _, inverse, n = np.unique(anchor[first], return_inverse=True, return_counts=True)
            first = first[n[inverse] > 1]
            size = en[first] - st[first] + LENGTH - GRAM
            at = np.repeat(st[first] - np.cumsum(size) + size, size) + np.arange(size.sum())
            gram, n = np.unique(_grams(_words(buf), len(buf) - 64 - GRAM + 1)[at], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram[n > 1].view(np.int64)), pa.array(n[n > 1])], ["gram", "n"])


def often_in(docs: DataFrame, size: int) -> Often:
    """Frequent grams, from a sample of documents of ``size`` bytes in all."""
    part = min(1.0, max(SAMPLE, size // RATE) / max(size, 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < round(part * 1_000_000))
    found = sample.mapInArrow(_frequent, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2, SPLIT * part))
    found = found.orderBy(F.desc("n"), "gram").limit(MOST).select("gram").toArrow()
    return Often(found.column("gram").to_numpy().astype(np.int64).view(np.uint64))


def _show(count: int, often):
    """Contexts of all documents, equal ones of a stretch of input together."""

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        ids, anchor, ctx, left, right = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, anchor, ctx))
        ids, anchor, ctx, left, right = (x[order] for x in (ids, anchor, ctx, left, right))
        new = np.append(True, (ctx[1:] != ctx[:-1]) | (anchor[1:] != anchor[:-1]))
        least = ids[np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))]
        first = new | (ids != np.append(ids[:1], ids[:-1]))
        goes = (ids > least) & first
        gone = _packed([ids[goes], ctx[goes], np.full(int(goes.sum()), WHOLE)], _bucket(ids[goes], count), count)
        for r in _rows(gone):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(r.num_rows, 1, np.int32)), *r.columns], ["kind", "bucket", "blob"])
        index = np.arange(int(new.sum()))
        for r in _rows(_shown(anchor[new], ctx[new], left[new], right[new], index, ids[new], count)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(r.num_rows, 0, np.int32)), *r.columns], ["kind", "bucket", "blob"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for ids, _, buf, ends in _pieces(b.column(0).to_pylist(), map(_utf8, b.column(1))):
                doc, _, _, anchor, ctx, left, right = contexts(buf, ends, often.value)
                size += len(buf)
                if len(doc):
                    held.append((ids[doc], anchor, ctx, left, right))
                if size >= GATHER and held:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return go


def _decide(count: int):
    """Of a shard's equal contexts all but the smallest document's go; contexts that may share windows are asked for."""

    def handle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        where = t.column("bucket").to_numpy()
        for shard in np.unique(where):
            mine = t.filter(pa.array(where == shard))
            kind = mine.column("kind").to_numpy()
            blobs = mine.column("blob").to_pylist()
            passed = [x for k, x in zip(kind, blobs) if k == 1]
            shown = [_read_shown(x) for k, x in zip(kind, blobs) if k == 0]
            for blob in passed:
                yield _out(1, int(shard), blob)
            if not shown:
                continue
            anchor, ctx, side, ids = (np.concatenate(x) for x in zip(*shown))
            order = np.lexsort((ids, ctx, anchor))
            anchor, ctx, side, ids = (x[order] for x in (anchor, ctx, side, ids))
            new = np.append(True, (ctx[1:] != ctx[:-1]) | (anchor[1:] != anchor[:-1]))
            least = ids[np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))]
            goes = ids > least
            for b, blob in _packed([ids[goes], ctx[goes], np.full(int(goes.sum()), WHOLE)], _bucket(ids[goes], count), count):
                yield _out(1, b, blob)
            anchor, ctx, side, ids = (x[new] for x in (anchor, ctx, side, ids))
            asked = np.zeros(len(ids), bool)
            for part in (side & np.uint32(0xFFF), side >> np.uint32(12)):
                key = anchor << _U(12) | part.astype(np.uint64)
                _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
                asked |= (n[inverse] > 1) & (part > 0)
            for b, blob in _packed([ids[asked], ctx[asked], np.full(int(asked.sum()), shard, np.int32)], _bucket(ids[asked], count), count):
                yield _out(2, b, blob)

    return handle


def _out(kind: int, bucket: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([blob], pa.binary())], ["kind", "bucket", "blob"])


def _beside(kinds: list[tuple[type, int]], each):
    """A ``mapInArrow`` function over rows ``bucket, kind, blob`` sorted by bucket and kind: first what is known, then documents.

    ``each`` gets what a bucket's blobs hold, sorted by document, and doc_ids and texts.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs, known = None, [], None
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for bucket, kind, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if bucket != now:
                    now, blobs, known = bucket, [], None
                if kind == 0:
                    blobs.append(blob.as_py())
                    continue
                if known is None:
                    known = _unpacked(blobs, kinds)
                    order = np.argsort(known[0], kind="stable")
                    known, blobs = [k[order] for k in known], []
                raw = unpack.decompress(blob.as_py())
                n = int(np.frombuffer(raw, np.int64, 1)[0])
                ids, size = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n)
                ends = 8 + 16 * n + np.cumsum(size)
                yield from each(known, ids, [raw[e - k : e] for e, k in zip(ends.tolist(), size.tolist())])

    return go


def _fetch(count: int, often):
    """Bytes of the contexts that shards asked for."""

    def each(known: list[np.ndarray], ids: np.ndarray, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        who, wanted, shard = known
        got: dict[int, list[tuple[int, int, bytes]]] = {}
        for names, _, buf, ends in _pieces(ids.tolist(), iter(texts)):
            doc, st, en, _, ctx, _, _ = contexts(buf, ends, often.value)
            cuts = np.searchsorted(doc, np.arange(len(names) + 1))
            for d, name in enumerate(names):
                lo, hi = np.searchsorted(who, name), np.searchsorted(who, name, "right")
                if lo == hi:
                    continue
                a, b = cuts[d], cuts[d + 1]
                order = np.argsort(wanted[lo:hi])
                w, s = wanted[lo:hi][order], shard[lo:hi][order]
                k = np.searchsorted(w, ctx[a:b])
                hit = np.flatnonzero((k < len(w)) & (w[np.minimum(k, len(w) - 1)] == ctx[a:b]))
                _, once = np.unique(ctx[a:b][hit], return_index=True)
                for i in hit[once]:
                    got.setdefault(int(s[k[i]]), []).append((int(name), int(ctx[a + i]), buf[st[a + i] : en[a + i] + LENGTH - 1]))
        for b, found in got.items():
            n = len(found)
            names, ctx, raw = zip(*found)
            blob = np.int64(n).tobytes() + np.array(names, np.int64).tobytes() + np.array(ctx, np.uint64).tobytes() + np.array([len(x) for x in raw], np.int32).tobytes() + b"".join(raw)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([blob], pa.binary())], ["bucket", "blob"])

    return each


class RunIndex:
    """A run-length Burrows-Wheeler index of texts joined by 0xFF, which UTF-8 never holds."""

    def __init__(self, texts: list[bytes], docs: np.ndarray):
        joined = b"\xff".join([b"", *texts, b""])
        self.n = n = len(joined)
        self.buf = joined + b"\xff" * 128
        self.words = _words(self.buf)
        t = np.frombuffer(joined, np.uint8)
        order = self._suffixes()
        before = t[order - 1]  # of position 0: the last byte
        head = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.start, self.char = head, before[head].astype(np.int64)
        length = np.diff(np.append(head, n))
        self.run_of = np.repeat(np.arange(len(head), dtype=np.int32), length)  # saves a search for every step
        self.first, self.last = order[head], order[np.append(head[1:], n) - 1]  # sampled suffixes at run ends
        count = np.bincount(before, minlength=256)
        below = np.cumsum(count) - count
        by_char = np.argsort(self.char.astype(np.uint8), kind="stable")
        size = length[by_char]
        up = np.cumsum(size) - size
        opens = np.append(True, self.char[by_char][1:] != self.char[by_char][:-1])
        up -= up[np.maximum.accumulate(np.where(opens, np.arange(len(up)), 0))]
        self.to = np.empty(len(head), np.int64)  # where a run's first row goes in the LF mapping
        self.to[by_char] = below[self.char[by_char]] + up
        self.key, self.run = self.char[by_char] * (n + 1) + head[by_char], by_char
        # Classes of suffixes that share LENGTH bytes, with the smallest document of each.
        a, b = order[1:], order[:-1]
        same = np.arange(n - 1)
        for k in (*range(0, LENGTH - 7, 8), LENGTH - 8):  # most neighbours differ early
            same = same[self.words[a[same] + k] == self.words[b[same] + k]]
        differ = np.ones(n, bool)
        differ[same + 1] = False
        self.klass = np.flatnonzero(differ)
        none = np.iinfo(np.int64).max  # a separator belongs to no document
        sizes = np.array([len(x) for x in texts], np.int64)
        owner = np.full(n, none)
        ends = 1 + np.cumsum(sizes + 1)
        owner[1:] = np.repeat(docs, sizes + 1)
        owner[ends - 1] = none
        owner = owner[order]
        self.least = np.minimum.reduceat(owner, self.klass)

    def _suffixes(self) -> np.ndarray:
        """Suffix order by prefix doubling from eight bytes; only suffixes that are still tied are sorted again."""
        n = self.n
        key = self.words[:n].byteswap()
        order = np.argsort(key)
        rank, k = np.empty(n, np.int64), 8
        rank[order] = self._ranks(key[order], np.arange(n))
        tied = np.arange(n)
        while True:
            r = rank[order[tied]]
            same = np.append(r[1:] == r[:-1], False)
            tied = tied[same | np.append(False, same[:-1])]
            if not len(tied):
                return order
            some = order[tied]
            beyond = np.where(some + k < n, rank[np.minimum(some + k, n - 1)] + 1, 0)
            key = rank[some] * (n + 1) + beyond
            o = np.argsort(key)
            order[tied] = some = some[o]
            rank[some] = self._ranks(key[o], tied)
            k *= 2

    @staticmethod
    def _ranks(sorted_keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For keys in order, that stand at places ``at``: the place of the first equal one."""
        new = np.append(True, sorted_keys[1:] != sorted_keys[:-1])
        return at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]

    def _common(self, at: np.ndarray, words: np.ndarray, p: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes that the text from ``at`` and the pattern from ``p`` have in common, up to ``most``."""
        out = np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        k = 0
        while len(live):
            d = self.words[np.minimum(at[live] + k, len(self.words) - 1)] ^ words[np.minimum(p[live] + k, len(words) - 1)]
            low = d & (~d + _U(1))
            run = np.where(d == 0, 8, np.bitwise_count(low - _U(1)) // 8)
            out[live] = k + run
            live = live[(d == 0) & (most[live] > k + 8)]
            k += 8
        return np.minimum(out, most)

    def statistics(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of all positions of ``patterns``, side by side: length, a row of the index that matches so far, and pattern starts."""
        raw = b"".join(patterns) + b"\xfe" * 128
        words, t = _words(raw), np.frombuffer(raw, np.uint8).astype(np.int64)
        size = np.array([len(p) for p in patterns], np.int64)
        end = np.cumsum(size)
        begin = end - size
        length, row = np.zeros(int(end[-1]), np.int64), np.zeros(int(end[-1]), np.int64)
        q, m = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        by_size = np.argsort(-size, kind="stable")
        alive = np.searchsorted(-size[by_size], -np.arange(1, int(size.max(initial=0)) + 1), "right")
        for step, count in enumerate(alive, 1):
            who = by_size[:count]
            p = end[who] - step
            c = t[p]
            run = self.run_of[q[who]]
            goes = self.char[run] == c
            ok = who[goes]
            q[ok] = self.to[run[goes]] + q[ok] - self.start[run[goes]]
            m[ok] += 1
            jump = np.flatnonzero(~goes)
            if len(jump):
                w, cj, pj = who[jump], c[jump], p[jump] + 1
                k = np.searchsorted(self.key, cj * (self.n + 1) + q[w])
                below, above = self.run[np.maximum(k - 1, 0)], self.run[np.minimum(k, len(self.run) - 1)]
                has_b, has_a = (k > 0) & (self.char[below] == cj), (k < len(self.run)) & (self.char[above] == cj)
                lb = np.where(has_b, self._common(self.last[below], words, pj, m[w]), -1)
                la = np.where(has_a, self._common(self.first[above], words, pj, m[w]), -1)
                use_b = lb >= la
                best = np.where(use_b, lb, la)
                r = np.where(use_b, below, above)
                stop = np.append(self.start[1:], self.n)[r] - 1
                to = self.to[r] + np.where(use_b, stop - self.start[r], 0)
                q[w] = np.where(best >= 0, to, 0)
                m[w] = np.where(best >= 0, best + 1, 0)
            length[p], row[p] = m[who], q[who]
        return length, row, begin

    def least_document(self, row: np.ndarray) -> np.ndarray:
        return self.least[np.searchsorted(self.klass, row, "right") - 1]


def _chunks(raw: list[bytes], often: Often) -> Iterator[np.ndarray]:
    """Places of contexts by anchor, in chunks of whole anchors of about ``INDEX`` bytes."""
    size = np.array([len(x) for x in raw], np.int64)
    anchor = contexts(b"".join([*raw, b"\0" * 64]), np.cumsum(size), often)[3]  # each of them is one context
    order = np.argsort(anchor, kind="stable")
    new = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))
    before = np.append(0, np.cumsum(size[order]))[new]
    cut_at = new[np.flatnonzero(np.append(True, before[1:] // INDEX != before[:-1] // INDEX))]
    yield from np.split(order, cut_at[1:])


def _match(count: int, often):
    """Windows of a shard's contexts that also start in a smaller document."""

    def handle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        where = t.column("bucket").to_numpy()
        for shard in np.unique(where):
            docs, ctx, raw = [], [], []
            for blob in t.filter(pa.array(where == shard)).column("blob").to_pylist():
                n = int(np.frombuffer(blob, np.int64, 1)[0])
                docs.append(np.frombuffer(blob, np.int64, n, 8))
                ctx.append(np.frombuffer(blob, np.uint64, n, 8 + 8 * n))
                at = 8 + 20 * n
                for size in np.frombuffer(blob, np.int32, n, 8 + 16 * n).tolist():
                    raw.append(blob[at : at + size])
                    at += size
            docs, ctx = np.concatenate(docs), np.concatenate(ctx)
            mask = np.zeros(len(docs), np.int64)
            for mine in _chunks(raw, often.value):
                texts, owner = [raw[k] for k in mine.tolist()], docs[mine]
                index = RunIndex(texts, owner)
                length, row, begin = index.statistics(texts)
                long = np.flatnonzero(length >= LENGTH)
                who = np.searchsorted(begin, long, "right") - 1
                smaller = index.least_document(row[long]) < owner[who]
                long, who = long[smaller], who[smaller]
                np.bitwise_or.at(mask, mine[who], np.int64(1) << (long - begin[who]))
            some = mask != 0
            for b, blob in _packed([docs[some], ctx[some], mask[some]], _bucket(docs[some], count), count):
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([blob], pa.binary())], ["bucket", "blob"])

    return handle


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _key(ids: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    return _mixed(ids.astype(np.int64).view(np.uint64), 0x9E3779B97F4A7C15) ^ ctx


class Gone:
    """Windows that go, by document and context."""

    def __init__(self, who: np.ndarray, ctx: np.ndarray, mask: np.ndarray):
        key = _key(who, ctx)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else np.zeros(0, np.int64)
        self.key, self.who, self.ctx = key[order][first], who[order][first], ctx[order][first]
        self.mask = np.bitwise_or.reduceat(mask[order], first) if len(key) else mask

    def marks(self, ids: np.ndarray, buf: bytes, ends: np.ndarray, often: Often) -> np.ndarray:
        """Which bytes of documents side by side in ``buf`` go."""
        change = np.zeros(len(buf) + LENGTH, np.int32)
        doc, st, en, _, ctx, _, _ = contexts(buf, ends, often)
        if len(doc) and len(self.key):
            at = np.searchsorted(self.key, _key(ids[doc], ctx))
            at = np.minimum(at, len(self.key) - 1)
            hit = np.flatnonzero((self.who[at] == ids[doc]) & (self.ctx[at] == ctx))
            bits = self.mask[at[hit]]
            whole = hit[bits == WHOLE]
            np.add.at(change, st[whole], 1)
            np.add.at(change, en[whole] + LENGTH - 1, -1)
            part, bits = hit[bits != WHOLE], bits[bits != WHOLE]
            row, window = np.nonzero((bits[:, None] >> np.arange(LENGTH - GRAM + 1)) & 1)
            np.add.at(change, st[part][row] + window, 1)
            np.add.at(change, st[part][row] + window + LENGTH, -1)
        return np.cumsum(change[: len(buf) - 64]) > 0


def _digest(text: bytes, out: np.ndarray | None = None) -> tuple[int, int, int, str]:
    if out is None or not out.any():
        return len(text), 0, 0, hashlib.sha256(text).hexdigest()
    kept = np.frombuffer(text, np.uint8)[~out].tobytes()
    return len(text), int(out.sum()), int((out & ~np.append(False, out[:-1])).sum()), hashlib.sha256(kept).hexdigest()


def _results(rows: list, ids) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.string()]))], _NAMES)


def _finish(often):
    def each(known: list, ids: np.ndarray, raw: list[bytes]) -> Iterator[pa.RecordBatch]:
        if len(known) == 3:
            known[:] = [Gone(*known)]
        marks = [np.zeros(len(t), bool) for t in raw]
        touched = np.isin(ids, known[0].who)
        # Documents are named by their place here, as several rows may have one doc_id.
        some = np.flatnonzero(touched).tolist()
        for place, off, buf, ends in _pieces(some, (raw[k] for k in some)):
            out = known[0].marks(ids[place], buf, ends, often.value)
            for k, lo, hi, o in zip(place.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), off.tolist()):
                marks[k][o : o + hi - lo] |= out[lo:hi]
        yield _results([_digest(t, m) for t, m in zip(raw, marks)], pa.array(ids))

    return each


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _results([_digest(_utf8(t)) for t in b.column(1)], b.column(0))


def _dealt(count: int):
    """Documents on their way to their bucket, those of a stretch of input compressed together."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)

        def flush(ids: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            bucket = _bucket(np.array(ids, np.int64), count)
            for b in np.unique(bucket):
                mine = np.flatnonzero(bucket == b).tolist()
                head = np.array([len(mine), *(ids[k] for k in mine), *(len(texts[k]) for k in mine)], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(b)], pa.int32()), pa.array([1], pa.int32()), pa.array([pack.compress(b"".join([head.tobytes(), *(texts[k] for k in mine)]))], pa.binary())], ["bucket", "kind", "blob"])

        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids.append(i)
                texts.append(_utf8(t))
                size += len(texts[-1])
                if size >= GATHER:
                    yield from flush(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from flush(ids, texts)

    return go


def _by_bucket(df: DataFrame, *order: str) -> DataFrame:
    """Rows of a bucket in one partition, buckets dealt out evenly; the sort spills to disk."""
    n = parts(df)
    return df.repartitionById(n, F.pmod(F.col("bucket"), F.lit(n)).cast("int")).sortWithinPartitions("bucket", *order)


def _together(docs: DataFrame, blobs: DataFrame, count: int) -> DataFrame:
    rows = docs.mapInArrow(_dealt(count), "bucket int, kind int, blob binary")
    return _by_bucket(rows.unionByName(blobs.select("bucket", F.lit(0).alias("kind"), "blob")), "kind")


def repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs``.

    Texts are taken as UTF-8; null counts as empty; texts shorter than ``LENGTH`` lose
    nothing; long texts are read in pieces that overlap. Rows with one doc_id don't count
    against each other, even with different texts. A row with a null doc_id loses nothing
    and counts against no other. Further columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    named = docs.where("doc_id is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = parts(docs) * max(1, -(-size // (SHARD * parts(docs))))  # as many buckets for each partition
    often = docs.sparkSession.sparkContext.broadcast(often_in(named, size))
    schema = "kind int, bucket int, blob binary"
    shown = _by_bucket(named.mapInArrow(_show(count, often), schema))
    decided = cut(shown.mapInArrow(by_run("bucket", _decide(count), 1), schema))
    asked = decided.where("kind = 2").select("bucket", "blob")
    fetched = _together(named, asked, count).mapInArrow(_beside(_ASKED, _fetch(count, often)), "bucket int, blob binary")
    partly = cut(_by_bucket(fetched).mapInArrow(by_run("bucket", _match(count, often), 1), "bucket int, blob binary"))
    gone = decided.where("kind = 1").select("bucket", "blob").unionByName(partly)
    finished = _together(named, gone, count).mapInArrow(_beside(_DECIDED, _finish(often)), _RESULT)
    return finished.unionByName(docs.where("doc_id is null").mapInArrow(_untouched, _RESULT))

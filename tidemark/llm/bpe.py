"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Of all token sequences for a byte prefix, the encoder's own is the one in which every two
neighbours stand as the encoder would leave them. So each prefix has exactly one valid
last token: the token that ends there and is compatible with the last token of the prefix
before it. One such token a prefix is all that is stored. Reading them backwards gives
the encoding; bytes can be appended without looking at more than the longest token's
length of what is there, and an edit is re-encoded only until the stored tokens agree
again with those from before.

Texts are cut into pieces by a pattern and pieces are encoded separately. A piece that is
itself a token is that token. Distinct pieces are encoded once per worker and remembered,
up to a bound.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_TEXT = 1 << 20  # characters; longer texts are worked through in steps
REMEMBERED = 250_000  # entries of each of the two generations of pieces that a worker remembers; four times as many pairs
BEGINNING = 7  # bytes of a piece whose table is kept for other pieces that begin alike


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixEncoder:
    """Encodes byte strings under merge ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.sizes = {v: len(k) for k, v in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.tails = dict.fromkeys((t[i:] for t in ranks for i in range(len(t))), -1) | ranks  # ends of tokens; -1: no token itself
        self._pairs: dict[int, bool] = {}
        self._begun: dict[bytes, list[int]] = {}
        self._spines: dict[tuple[int, int], list[tuple[bytes, int]] | None] = {}

    def _merged(self, data: bytes) -> list[bytes]:
        """The definition: merge the adjacent pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] == 1 << 60:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]] | None:
        """What stands at the left (0) or right (1) edge of a token while it is merged, each with the rank that consumes it.

        None if the token's bytes don't encode to it, or its parts don't have lower ranks
        (then order in time isn't order of rank).
        """
        if (token, side) in self._spines:
            return self._spines[token, side]
        data = self.tokens[token]
        out: list[tuple[bytes, int]] | None = [(data, 1 << 60)]
        while out and len(data) > 1:
            rank = self.ranks[data]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                best = min((self.ranks.get(x + y, 1 << 60), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
                if best[0] >= rank:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            if len(parts) != 2 or any(self.ranks.get(x, 1 << 60) >= rank for x in parts if len(x) > 1):
                out = None
                break
            data = parts[side]
            out.append((data, rank))
        self._spines[token, side] = out
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are what their bytes encode to; ``left`` -1: nothing stands before."""
        key = (left + 1) << 32 | right
        found = self._pairs.get(key)
        if found is None:
            if len(self._pairs) >= 4 * REMEMBERED:
                self._pairs.clear()
            ends, starts = self._spine(left, 1) if left >= 0 else [], self._spine(right, 0)
            if ends is None or starts is None:
                both = [self.tokens[t] for t in (left, right) if t >= 0]
                found = self._merged(b"".join(both)) == both
            else:  # nothing may merge across the boundary before either side is consumed; of equal ranks the left one goes first
                rank = self.ranks.get
                found = not any((m := rank(x + y)) is not None and m < until_x and m <= until_y for x, until_x in ends for y, until_y in starts)
            self._pairs[key] = found
        return found

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> None:
        """Appends to ``last`` the last token of each prefix of ``data`` beyond ``len(last)``.

        One candidate always is valid, so the shortest needs no test once all others have failed.
        """
        ends_in, sizes, known = self.tails.get, self.sizes, self._pairs.get
        for end in range(len(last) + 1, (len(data) if upto is None else upto) + 1):
            length, candidates = 1, []
            while length <= end:
                token = ends_in(data[end - length : end])
                if token is None:
                    break
                if token >= 0:
                    candidates.append(token)
                length += 1
            if not candidates:
                raise ValueError(f"no token ends at byte {end}: the ranks lack a byte")
            i = len(candidates) - 1
            while i:
                token = candidates[i]
                start = end - sizes[token]
                left = last[start - 1] if start else -1
                fit = known((left + 1) << 32 | token)
                if fit or fit is None and self.fits(left, token):
                    break
                i -= 1
            last.append(candidates[i])

    def start(self, data: bytes) -> list[int]:
        """The table of a beginning of ``data`` that earlier pieces share, ready to be extended."""
        if len(data) <= BEGINNING:
            return []
        head = data[:BEGINNING]
        found = self._begun.get(head)
        if found is None:
            found = []
            self.extend(head, found)
            if len(self._begun) >= REMEMBERED:
                self._begun.clear()
            self._begun[head] = found
        return found.copy()

    def read(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= self.sizes[last[end - 1]]
        return out[::-1]

    def piece(self, data: bytes) -> list[int]:
        """Token ids of one piece."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        last = self.start(data)
        self.extend(data, last)
        return self.read(last)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


class Editable:
    """A byte string with its prefix table: append and replace keep the encoding exact."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.encoder.extend(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Puts ``new`` in place of ``[start, end)``; returns how many prefixes were worked out anew."""
        old, moved = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, agreed = old[:start], 0
        while len(self.last) < len(self.data):
            self.encoder.extend(self.data, self.last, len(self.last) + 1)
            at = len(self.last)
            agreed = agreed + 1 if at > start + len(new) and self.last[-1] == old[at - moved - 1] else 0
            if agreed >= self.encoder.longest:  # a later token looks no further back than that
                done = at - start
                self.last += old[at - moved :]
                return done
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.encoder.read(self.last)


class TextCodec:
    """Encodes texts piece by piece and digests ids and decoded bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder, self.find = PrefixEncoder(ranks), regex.compile(pattern)
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def look(self, piece: str) -> tuple[int, str, bytes]:
        found = self.known.get(piece)
        if found is None:
            found = self.older.get(piece)
            if found is None:
                ids = self.encoder.piece(piece.encode("utf-8", "surrogatepass"))
                found = (len(ids), ",".join(map(str, ids)), self.encoder.decode(ids))
            if len(piece) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.older = dict(self.known)  # what is asked for again moves back to the younger one
                    self.known.clear()  # in place: steps() holds its get
                self.known[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        return [i for p in self.find.findall(text) for i in self.encoder.piece(p.encode("utf-8", "surrogatepass"))]

    def steps(self, text: str) -> Iterator[list[tuple[int, str, bytes]]]:
        look = self.look
        if len(text) <= LONG_TEXT:
            get, pieces = self.known.get, self.find.findall(text)
            yield [get(p) or look(p) for p in pieces]
            return
        held = []
        for m in self.find.finditer(text):
            held.append(look(m[0]))
            if len(held) == 100_000:
                yield held
                held = []
        yield held

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the ids as decimals joined by commas, SHA-256 of the decoded bytes."""
        n, ids, back, first = 0, hashlib.sha256(), hashlib.sha256(), True
        for found in self.steps(text):
            if found:
                counts, texts, raw = zip(*found)
                n += sum(counts)
                ids.update(("" if first else ",").encode() + ",".join(texts).encode())
                back.update(b"".join(raw))
                first = False
        return n, ids.hexdigest(), back.hexdigest()


_CODECS: dict[int, TextCodec] = {}  # one for each worker process, so that what it remembers outlives a task


def _codec(ranks, pattern: str) -> TextCodec:
    key = hash((pattern, frozenset(ranks.value.items())))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = TextCodec(ranks.value, pattern)
    return _CODECS[key]


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row for each row of ``docs``.

    The ranks are read on the driver and broadcast: a vocabulary's size doesn't grow with
    the data. Null and empty texts have no tokens (digests of nothing). Repeated rows, a
    null doc_id and further columns change nothing; an empty table gives no rows.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for b in batches:
            found = [codec.digest(t.as_py() or "") for t in b.column(1)]
            n, ids, back = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(go, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_ids(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, n_tokens, ids array<int>)``: the encoding itself, with columns ``keep`` of ``docs``."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    names = ["doc_id", *keep, "n_tokens", "ids"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for b in batches:
            for k in range(0, b.num_rows, 200):
                c = b.slice(k, 200)
                ids = [np.concatenate([np.zeros(0, np.int32), *(np.fromstring(",".join([x[1] for x in found]), np.int32, sep=",") for found in codec.steps(t.as_py() or "") if found)]) for t in c.column(0)]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays([*c.columns[1:], pa.array(np.diff(ends).astype(np.int64)), lists], names)

    kept = docs.select("text", "doc_id", *keep)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    return kept.mapInArrow(go, ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *keep)) + ", n_tokens long, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``(doc_id, data binary)`` from ``(doc_id, ids)``; null ids give null, an unknown id is an error."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for b in batches:
            tokens = tokens or {v: k for k, v in ranks.value.items()}
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if i.as_py() is None else b"".join([tokens[x] for x in i.as_py()]) for i in b.column(1)], pa.binary())], ["doc_id", "data"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(go, "doc_id long, data binary")


def default_ranks() -> tuple[str, str]:
    """Path of the ranks and the pattern that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return bpe_digests(docs, *default_ranks())

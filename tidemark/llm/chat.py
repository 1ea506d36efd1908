"""Preference formatting of chat conversations.

A preference pair is a chosen and a rejected conversation. Their longest common prefix of
turns (same role, same text) is rendered once as the prompt; what follows on either side
is rendered as that side's completion, with a mask of what the loss counts: text and end
mark of the assistant's turns, not the header before them.

Turns are dealt out by pair once and sorted there; rows are read as a stream, and of a pair
no more than one turn of each side is held (``rendered``) or one record (``records``). Rows
that repeat are dropped before they are dealt out as far as a batch shows them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts

PARTS = ("prompt", "chosen", "rejected")
MOST = 1000  # rows of a batch of results

_MARK = re.compile(r"<(\\*)\|")
_ROLE = re.compile(r"[^A-Za-z0-9_-]")


def neighbours(turns: DataFrame) -> DataFrame:
    """The two sides of pairs of conversations 2k (chosen) and 2k + 1 (rejected): ``pair_id, side, turn, role, text``."""
    turns = turns.where("conv_id is not null and turn is not null")
    return turns.select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), F.pmod("conv_id", F.lit(2)).cast("int").alias("side"), F.col("turn").cast("long"), "role", "text")


def sides(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """The two sides of the given pairs ``pair_id, chosen, rejected``; a conversation may be in several pairs."""
    turns = turns.where("conv_id is not null and turn is not null").select("conv_id", F.col("turn").cast("long"), "role", "text")
    ends = pairs.select("pair_id", "chosen", "rejected").distinct()
    ends = ends.select("pair_id", F.posexplode(F.array(F.col("chosen").cast("long"), F.col("rejected").cast("long"))).alias("side", "conv_id"))
    return turns.join(ends, "conv_id").select("pair_id", "side", "turn", "role", "text")


def escaped(text: str) -> str:
    """Text in which nothing reads as a mark: each ``<|`` gets one more backslash in between. ``restored`` takes it out."""
    return _MARK.sub(r"<\\\1|", text)


def restored(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def header(role: str) -> str:
    return f"<|{_ROLE.sub('_', role)}|>\n"


END = "<|end|>"


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen, kept = set(), []
        for k, row in enumerate(zip(*(c.to_pylist() for c in b.columns))):
            if row not in seen:
                seen.add(row)
                kept.append(k)
        yield b if len(kept) == b.num_rows else b.take(pa.array(kept))


def _sorted(two: DataFrame) -> DataFrame:
    """Rows of a pair side by side, by turn; a null role or text counts as empty."""
    two = two.select(F.col("pair_id").cast("long"), F.col("side").cast("int"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    two = two.where("pair_id is not null").mapInArrow(_once, two.schema)
    return two.repartition(parts(two), "pair_id").sortWithinPartitions("pair_id", "turn", "side", "role", "text")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``pair, turn, chosen, rejected`` in order; a side is (role, text), or None where it has no such turn. Of repeated turns the first counts."""
    at, said = None, [None, None]
    for b in batches:
        for pair, side, turn, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if (pair, turn) != at:
                if at is not None:
                    yield *at, *said
                at, said = (pair, turn), [None, None]
            if said[side] is None:
                said[side] = role, text
    if at is not None:
        yield *at, *said


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``pair, part, turn, role, segment, start, trained from, trained to`` in order; trained from and to are -1 where the loss counts nothing."""
    now, prompt, size = None, True, {}
    for pair, turn, a, b in _turns(batches):
        if pair != now:
            now, prompt, size = pair, True, dict.fromkeys(PARTS, 0)
        prompt = prompt and a == b
        for part, said in (("prompt", a),) if prompt else (("chosen", a), ("rejected", b)):
            if said is None:
                continue
            role, text = said
            head, body = header(role), escaped(text) + END
            start = size[part]
            size[part] += len(head) + len(body) + 1
            mine = not prompt and role == "assistant"
            yield pair, part, turn, role, f"{head}{body}\n", start, start + len(head) if mine else -1, start + len(head) + len(body) if mine else -1


def rendered(two: DataFrame) -> DataFrame:
    """Rendered turns of every pair: ``pair_id, part, turn, role, segment, start, end, trained_from, trained_to``.

    ``two`` has the sides of pairs (:func:`neighbours`, :func:`sides`). ``part`` is
    ``prompt``, ``chosen`` or ``rejected``; ``segment`` is the rendered turn, ``start`` and
    ``end`` its characters in the part; the loss counts from ``trained_from`` to
    ``trained_to`` (-1 where it counts nothing). A null role or text counts as empty; of
    repeated rows of a turn the smallest (role, text) counts; rows with a null pair, side
    or turn are left out; a pair of which one side has no turns has no prompt, and its
    turns are that of the other side. Signs of a role other than letters, digits, ``_`` and
    ``-`` are written ``_``; marks within texts are escaped. No conversation is held as a
    whole, however long. An empty table gives no rows.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for pair, part, turn, role, segment, start, a, b in _rendered(batches):
            held.append((pair, part, turn, role, segment, start, start + len(segment), a, b))
            if len(held) == MOST:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)

    def _batch(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 4)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["pair_id", "part", "turn", "role", "segment", "start", "end", "trained_from", "trained_to"])

    return _sorted(two.where("side is not null and turn is not null")).mapInArrow(go, "pair_id long, part string, turn long, role string, segment string, start long, end long, trained_from long, trained_to long")


def records(two: DataFrame) -> DataFrame:
    """One record for each pair: ``pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    Masks are the trained spans ``start:end`` (characters of the completion, end
    exclusive), joined by commas. Rows count as in :func:`rendered`, but pairs of which a
    side has no turns are left out. A record has to fit a row; :func:`rendered` has no such
    bound.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        text: dict[str, list[str]] = {}
        mask: dict[str, list[str]] = {}

        def close() -> None:
            # without a common turn both sides need turns of their own
            if now is not None and (text["prompt"] or text["chosen"] and text["rejected"]):
                held.append((now, len(text["prompt"]), *("".join(text[p]) for p in PARTS), ",".join(mask["chosen"]), ",".join(mask["rejected"])))

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), *[pa.string()] * 5)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], ["pair_id", "prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"])

        for pair, part, _, _, segment, _, a, b in _rendered(batches):
            if pair != now:
                close()
                if len(held) >= MOST or size > 32 << 20:
                    if held:
                        yield batch()
                    held, size = [], 0
                now, text, mask = pair, {p: [] for p in PARTS}, {p: [] for p in PARTS}
            text[part].append(segment)
            size += len(segment)
            if a >= 0:
                mask[part].append(f"{a}:{b}")
        close()
        if held:
            yield batch()

    return _sorted(two.where("side is not null and turn is not null")).mapInArrow(go, "pair_id long, prompt_turns long, prompt string, chosen string, rejected string, chosen_mask string, rejected_mask string")


ORACLE = r"""
WITH one AS (
  SELECT conv_id, turn, min({'role': coalesce(role, ''), 'text': coalesce(text, '')}) AS said
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
a AS (SELECT conv_id // 2 AS pair_id, turn, said FROM one WHERE conv_id % 2 = 0),
b AS (SELECT conv_id // 2 AS pair_id, turn, said FROM one WHERE conv_id % 2 = 1),
both_sides AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.turn, b.turn) AS turn, a.said AS a, b.said AS b
  FROM a FULL JOIN b ON a.pair_id = b.pair_id AND a.turn = b.turn),
split AS (
  SELECT pair_id, min(CASE WHEN a IS DISTINCT FROM b THEN turn END) AS split
  FROM both_sides GROUP BY 1 HAVING count(a) > 0 AND count(b) > 0),
told AS (
  SELECT pair_id, turn, 'prompt' AS part, a AS said FROM both_sides JOIN split USING (pair_id) WHERE split IS NULL OR turn < split
  UNION ALL SELECT pair_id, turn, 'chosen', a FROM both_sides JOIN split USING (pair_id) WHERE turn >= split AND a IS NOT NULL
  UNION ALL SELECT pair_id, turn, 'rejected', b FROM both_sides JOIN split USING (pair_id) WHERE turn >= split AND b IS NOT NULL),
segments AS (
  SELECT pair_id, part, turn, said.role AS role, '<|' || regexp_replace(said.role, '[^A-Za-z0-9_-]', '_', 'g') || '|>' || chr(10) AS head,
    regexp_replace(said.text, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' AS body FROM told),
placed AS (
  SELECT *, (sum(length(head) + length(body) + 1) OVER w - length(body) - 1)::BIGINT AS body_start FROM segments
  WINDOW w AS (PARTITION BY pair_id, part ORDER BY turn)),
p AS (
  SELECT pair_id, part, count(*) AS n, string_agg(head || body || chr(10), '' ORDER BY turn) AS text,
    string_agg(body_start || ':' || (body_start + length(body)), ',' ORDER BY turn) FILTER (role = 'assistant') AS mask
  FROM placed GROUP BY 1, 2)
SELECT s.pair_id::BIGINT AS pair_id, coalesce(max(n) FILTER (part = 'prompt'), 0)::BIGINT AS prompt_turns,
  """ + ", ".join(f"coalesce(max(p.text) FILTER (part = '{x}'), '') AS {x}" for x in PARTS) + ", " + ", ".join(f"coalesce(max(p.mask) FILTER (part = '{x}'), '') AS {x}_mask" for x in PARTS[1:]) + """
FROM split s LEFT JOIN p ON s.pair_id = p.pair_id GROUP BY s.pair_id
"""

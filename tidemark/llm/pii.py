"""Personal data in texts, with offset-preserving deobfuscation.

Base detection finds e-mail addresses, IPv4 addresses, payment cards and phone numbers by
fixed rules. Then a chain of transducers rewrites disguised text and keeps, for every
character that it writes, the source span it came from:

1. look-alike letters, digits and signs of other scripts become ASCII ones, invisible
   characters vanish;
2. signs of an address that are set apart one by one are joined;
3. bracketed or spelled ``at`` and ``dot`` become ``@`` and ``.``;
4. letters that stand for digits within a number become digits;
5. runs of spelled digits (English, German, Spanish, French), written ones among them,
   become digits, a leading spelled plus sign becomes ``+``.

Each transducer looks at every place of the text; none has a window, and all take linear
time. What was written is kept as segments, so memory grows with the number of edits.

The detectors run again on what was written, and spans are mapped back to the source. A
found span counts where it overlaps no base span of its kind. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches, found from each ``@`` so that long runs without one cost nothing."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)  # no match can hold this sign
        at = text.find("@", max(done, at + 1))
    return out


def ips(text: str) -> list[Span]:
    """A maximal chain of dotted numbers holds one leftmost match for every four of them."""
    out = []
    for m in _NUMBERS.finditer(text):
        if m.end() - m.start() < 7 or text.count(".", *m.span()) < 3:
            continue
        parts = list(_NUMBER.finditer(text, *m.span()))
        for k in range(0, len(parts) - 3, 4):
            if all(len(p[0].lstrip("0")) < 4 and int(p[0]) < 256 for p in parts[k : k + 4]):
                out.append((parts[k].start(), parts[k + 3].end()))
    return out


def cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15] if "+" in text else []


def base(text: str) -> dict[str, list[Span]]:
    return {"email": emails(text), "ip": ips(text), "card": cards(text), "phone": phones(text)}


# Look-alikes of ASCII letters, fixed values: source characters, then what they stand for.
_GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορυνικχϲϳ", "ABEZHIKMNOPTYXaopuvikxcj")
_CYRILLIC = ("АВЕКМНОРСТУХЅІЈаеорсухѕіјԁԛԝһ", "ABEKMHOPCTYXSIJaeopcyxsijdqwh")
_SIGNS = ("‐‑‒–—−﹣‧․。｡﹒﹫", "-------.....@")
_GONE = "­​‌‍⁠﻿"


def _lookalikes() -> dict[str, str]:
    out = {a: b for pair in (_GREEK, _CYRILLIC, _SIGNS) for a, b in zip(*pair)}
    out |= dict.fromkeys(_GONE, "")
    out |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}  # full width
    for c in range(0x80, 0x20000):
        if chr(c) in out:
            continue
        if unicodedata.category(chr(c)) == "Zs":
            out[chr(c)] = " "
        elif (d := unicodedata.decimal(chr(c), None)) is not None or 0x2070 <= c <= 0x2089 and (d := unicodedata.digit(chr(c), None)) is not None:
            out[chr(c)] = str(d)
    for c in range(0x1D400, 0x1D7CC):  # mathematical letters
        if len(n := unicodedata.normalize("NFKC", chr(c))) == 1 and n.isascii():
            out[chr(c)] = n
    return out


LOOKALIKES = _lookalikes()


def _any_of(chars: str) -> str:
    return "[" + "".join(f"\\U{ord(c):08x}" for c in chars) + "]"


# Spelled digits, fixed values: in each language from zero to nine.
DIGIT_WORDS = {
    w: str(i)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "zéro un deux trois quatre cinq six sept huit neuf",
    )
    for i, w in enumerate(words.split())
} | {"oh": "0"}
AT_WORDS, DOT_WORDS = ("at", "arroba", "ät"), ("dot", "punkt", "punto", "point")
PLUS_WORDS = ("plus", "más", "mas")
# Letters that are written for digits, fixed values.
LETTERS = {"O": "0", "o": "0", "I": "1", "l": "1", "S": "5", "B": "8", "Z": "2"}

_W = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_D = "|".join(DOT_WORDS)
_A = "|".join(AT_WORDS)
_P = "|".join(PLUS_WORDS)
_LOOK = re.compile(_any_of("".join(LOOKALIKES)))
# White space is taken from its beginning on and as a whole, so that long runs of it are looked at once.
_RUN = r"(?<!\s)\s++"
_INNER = rf"\s*+(?:(@|{_A})|(?:{_D}|\.))\s*+"
_BRACKET = re.compile(rf"(?:{_RUN})?+(?:\[{_INNER}\]|\({_INNER}\)|\{{{_INNER}\}}|<{_INNER}>)\s*+", re.I)
_LABELS = re.compile(rf"[A-Za-z0-9-]++(?:(?:\.|\s++(?:{_D})\s++)[A-Za-z0-9-]++)*\s++(?:{_D})\s++[A-Za-z]{{2,}}+\b", re.I)
_AT_END = re.compile(rf"{_RUN}(?:{_A})\s++|(?:{_RUN})?+@\s*+", re.I)
_AT_LITERAL = re.compile(rf"(?<=[A-Za-z0-9])(?:\s++(?:{_A})\s++|\s++@\s*+|@\s++)(?=[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)", re.I)
_DOT_WORD = re.compile(rf"\s++(?:{_D})\s++", re.I)
_LOOKS_LOCAL = re.compile(r"[0-9_]|[A-Za-z0-9][.+%-][A-Za-z0-9]")
_SPELLED = re.compile(rf"(?<!\w)(?:(?:{_P})[\s-]++)?(?:{_W}|[0-9]++)(?!\w)(?:[\s,-]++(?:{_W}|{_D}|[0-9]++)(?!\w)){{3,}}+", re.I)
_TOKEN = re.compile(rf"(?:{_P}|{_W}|{_D}|[0-9]++)(?!\w)", re.I)
_LETTERED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIlSBZ](?:[ ().-]{0,2}+[0-9OoIlSBZ]){6,}+")
_LETTER = re.compile("[OoIlSBZ]")
_IN_BRACKETS = re.compile(rf"[\[({{<]\s*+(?:{_A}|@|{_D}|\.)\s*+[\])}}>]", re.I)
_SPACED_SIGN = re.compile(r"\s@|@\s")
_SPOKEN_DOT = re.compile(rf"\s(?:{_D})\s")
_BEFORE_DOMAIN = re.compile(rf"\s(?:{_A})\s++[a-z0-9-]++\.[a-z0-9]")
_NEAR_DIGIT = re.compile(r"[0-9][ ().-]{0,2}[OoIlSBZ](?![a-z])|(?<![A-Za-z])[OoIlSBZ][ ().-]{0,2}[0-9]")
_RUN_SPOKEN = re.compile(rb"[\1\2]{4,}")


_BEYOND_LATIN = re.compile(r"[^\x00-\x9f\xa1-\xac\xae-\u024f]")
_SPOKEN = frozenset([*DIGIT_WORDS, *DOT_WORDS])


def lookalikes_in(text: str) -> bool:
    return not text.isascii() and bool(_BEYOND_LATIN.search(text)) and not LOOKALIKES.keys().isdisjoint(set(text))


def disguised(text: str) -> bool:
    """Whether a transducer may have something to write; cheap, as most texts have nothing disguised."""
    if lookalikes_in(text):
        return True
    low = text.lower()
    if any(w in low for w in DOT_WORDS) and _SPOKEN_DOT.search(low) or _IN_BRACKETS.search(low):
        return True
    if "@" in low and _SPACED_SIGN.search(low) or _BEFORE_DOMAIN.search(low) or _NEAR_DIGIT.search(text):
        return True
    kinds = bytes(2 if w in _SPOKEN else w.isdigit() for w in low.replace(",", " ").replace("-", " ").split())
    return any(2 in m[0] for m in _RUN_SPOKEN.finditer(kinds))


class Tape:
    """What a transducer wrote, and the source span of each character.

    Segments: where each begins in the text, its source span, and whether it was copied
    character by character (else every character of it comes from the whole span).
    """

    def __init__(self, text: str):
        self.text, self.at, self.start, self.end, self.copied = text, [0], [0], [len(text)], [True]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """``edits``: spans of the present text in order, and what stands for each. Every new character comes from the whole span."""
        if not edits:
            return
        text, place, done = [], 0, 0
        at: list[int] = []
        start: list[int] = []
        end: list[int] = []
        copied: list[bool] = []

        def add(n: int, a: int, b: int, same: bool) -> int:
            if n:
                at.append(place)
                start.append(a)
                end.append(b)
                copied.append(same)
            return place + n

        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            k = bisect_right(self.at, done) - 1
            while k < len(self.at) and self.at[k] < a:
                low, high = max(done, self.at[k]), min(a, self.at[k + 1] if k + 1 < len(self.at) else len(self.text))
                if low < high:
                    shift = self.start[k] - self.at[k]
                    place = add(high - low, low + shift, high + shift, True) if self.copied[k] else add(high - low, self.start[k], self.end[k], False)
                k += 1
            text += (self.text[done:a], new)
            if new:
                place = add(len(new), *self.source((a, b)), False)
            done = b
        self.text, self.at, self.start, self.end, self.copied = "".join(text), at or [0], start or [0], end or [0], copied or [True]

    def source(self, span: Span) -> Span:
        i, j = (bisect_right(self.at, x) - 1 for x in (span[0], span[1] - 1))
        a = self.start[i] + (span[0] - self.at[i] if self.copied[i] else 0)
        return a, self.start[j] + span[1] - self.at[j] if self.copied[j] else self.end[j]


def _join_spaced(tape: Tape) -> None:
    """``b o b @ e x . c o m``: single signs with one space between them, on both sides of the sign."""
    text, edits, done = tape.text, [], 0
    i = text.find("@")
    while i >= 0:
        left = right = i
        while left - 2 >= done and text[left - 1] == " " and text[left - 2] in _LOCAL and (left == 2 or not (text[left - 3] in _LOCAL or text[left - 3].isalnum())):
            left -= 2
        while right + 2 < len(text) and text[right + 1] == " " and text[right + 2] in _LOCAL and (right + 3 == len(text) or not (text[right + 3] in _LOCAL or text[right + 3].isalnum())):
            right += 2
        if left < i and "." in text[i:right]:
            edits += [(k, k + 1, "") for k in range(left + 1, right, 2)]
            done = right + 1
        i = text.find("@", max(done, i + 1))
    tape.rewrite(edits)


def _dots_before(text: str, end: int) -> list[tuple[int, int, str]]:
    """Spelled dots of the local part that ends at ``end``, from the last to the first."""
    out = []
    while True:
        a = end
        while a and text[a - 1] in _LOCAL:
            a -= 1
        b = a
        while b and text[b - 1].isspace():
            b -= 1
        word = next((w for w in DOT_WORDS if text[max(0, b - len(w)) : b].lower() == w), None)
        if a == end or b == a or not word:
            return out
        c = b - len(word)
        while c and text[c - 1].isspace():
            c -= 1
        if c == b - len(word) or not c or text[c - 1] not in _LOCAL:
            return out
        out.append((c, a, "."))
        end = c


def _fold_at_dot(tape: Tape) -> None:
    tape.rewrite([(m.start(), m.end(), "@" if any(m.groups()) else ".") for m in _BRACKET.finditer(tape.text) if m.start() and m.end() < len(tape.text) and tape.text[m.start() - 1].isalnum() and tape.text[m.end()].isalnum()])
    text, edits, at = tape.text, [], 0
    while m := _AT_END.search(text, at):
        at = m.end()
        if not m.start() or text[m.start() - 1] not in _LOCAL or not (labels := _LABELS.match(text, at)):
            continue
        edits += _dots_before(text, m.start())
        edits.append((m.start(), m.end(), "@"))
        edits += [(d.start(), d.end(), ".") for d in _DOT_WORD.finditer(text, at, labels.end())]
        at = labels.end()
    clean, done = [], 0
    for a, b, new in sorted(edits):
        if a >= done:
            clean.append((a, b, new))
            done = b
    tape.rewrite(clean)
    # A literal domain after a spelled sign counts only if the word before looks like an address.
    text, edits = tape.text, []
    for m in _AT_LITERAL.finditer(text):
        a = m.start()
        while a and text[a - 1] in _LOCAL:
            a -= 1
        if "@" in m[0] or _LOOKS_LOCAL.search(text, a, m.start()):
            edits.append((m.start(), m.end(), "@"))
    tape.rewrite(edits)


def _fold_letters(tape: Tape) -> None:
    """Letters within numbers that are digits for the most part."""
    edits = []
    text = tape.text
    for m in _LETTERED.finditer(text):
        a, b = m.span()
        if b < len(text) and text[b].isalnum():  # the beginning of a word is no part of the number
            while b > a and text[b - 1].isalnum():
                b -= 1
        letters = [(x.start(), x.end(), LETTERS[x[0]]) for x in _LETTER.finditer(text, a, b)]
        if letters and len(_NOT_DIGIT.sub("", text[a:b])) >= 2 * len(letters):
            edits += letters
    tape.rewrite(edits)


def _fold_digits(tape: Tape) -> None:
    edits = []
    for m in _SPELLED.finditer(tape.text):
        tokens = list(_TOKEN.finditer(tape.text, m.start(), m.end()))
        if all(t[0].isdigit() for t in tokens):
            continue
        at = m.start()
        for t in tokens:
            word = t[0].lower()
            edits.append((at, t.end(), DIGIT_WORDS.get(word) or ("." if word in DOT_WORDS else "+" if word in PLUS_WORDS else word)))
            at = t.end()  # what stands between two words goes with the second
    tape.rewrite(edits)


def added(text: str, found: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans that only the rewritten text shows; none of them overlaps a base span of its kind."""
    if not disguised(text):
        return {}
    tape = Tape(text)
    if lookalikes_in(text):
        tape.rewrite([(m.start(), m.end(), LOOKALIKES[m[0]]) for m in _LOOK.finditer(text)])
    _join_spaced(tape)
    _fold_at_dot(tape)
    _fold_letters(tape)
    _fold_digits(tape)
    if tape.text == text:
        return {}
    out = {}
    for kind, spans in base(tape.text).items():
        new = [tape.source(s) for s in spans]
        out[kind] = [s for s in new if not any(a < s[1] and s[0] < b for a, b in found[kind])]
    return out


def spans_of(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans of a text, by kind."""
    found = base(text or "")
    return found, added(text or "", found)


def written(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans.get(k, ())))


def pii_spans(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: counts and digest of base spans, all spans, and how many were added.

    Offsets count code points, ends are exclusive. A null text counts as empty; whole texts
    are read, however long. Repeated rows, a null doc_id and further columns change
    nothing; an empty table gives no rows.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                found, more = spans_of(t.as_py())
                rows.append((*(len(found[k]) for k in KINDS), hashlib.sha256(written(found).encode()).hexdigest(), written({k: found[k] + more.get(k, []) for k in KINDS}), sum(map(len, more.values()))))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(go, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans go together under the first."""
    found, more = spans_of(text)
    spans = sorted((a, b, k) for k in KINDS for a, b in found[k] + more.get(k, []))
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += (text[at:a], f"[{k.upper()}]")
        at = max(at, b)
    return "".join([*out, text[at:]])


def pii_redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; null and empty texts stay, other columns are as they were.

    Repeated rows and a null doc_id change nothing; an empty table gives no rows.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index("text")
            new = pa.array([None if (t := x.as_py()) is None else redact(t) for x in b.column(i)], pa.string())
            yield pa.RecordBatch.from_arrays([new if k == i else c for k, c in enumerate(b.columns)], b.schema.names)

    return docs.mapInArrow(go, docs.schema)

"""Operators on documents against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tests.llm.fixtures import DOCS, documents, empty, texts
from tidemark.llm import bpe, common, licenses, mixing, pii, repeats, simhash, toxicity
from tidemark.llm.common import components

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def rows_of(df) -> dict:
    return {r.doc_id: r for r in df.collect()}


# SimHash


def plain_fingerprint(text) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(ids, fps, radius=3) -> dict:
    label = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, fps):
            low = min(label[j] for j, b in zip(ids, fps) if bin(a ^ b).count("1") <= radius)
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_simhash_against_brute_force(spark):
    rows = texts()
    got = rows_of(simhash.simhash_components(documents(spark)))
    fps = [plain_fingerprint(r[1]) for r in rows]
    want = plain_components([r[0] for r in rows], fps)
    assert {k: int(r.fingerprint, 16) for k, r in got.items()} == {r[0]: f for r, f in zip(rows, fps)}
    assert {k: r.component_id for k, r in got.items()} == want
    assert got[1001].component_id == got[1002].component_id == 1000


def test_fingerprints_at_the_radius(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = [base]
    for bits in (1, 2, 3, 4, 5):
        flip = np.array([sum(1 << int(b) for b in rng.choice(64, bits, False)) for _ in base], np.uint64)
        fps.append(base ^ flip)
    every = np.unique(np.concatenate(fps))
    nodes = spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "fp long")
    got = {r.node: r.component for r in components(simhash.links(nodes)).collect()}
    want = plain_components([int(x) for x in every.view(np.int64)], [int(x) for x in every])
    assert all(got.get(k, k) == v for k, v in want.items())


def test_large_groups_keep_every_link():
    rng = np.random.default_rng(1)
    group = np.unique(np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)))
    edges = simhash.forest(group, 3)
    label = {int(x): int(x) for x in group}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in edges:
        for x, y in zip(a.tolist(), b.tolist()):
            assert bin(x ^ y).count("1") <= 3
            label[max(root(x), root(y))] = min(root(x), root(y))
    want = plain_components([int(x) for x in group], [int(x) for x in group])
    assert len({root(int(x)) for x in group}) == len(set(want.values()))
    assert sum(len(a) for a, _ in edges) < len(group)


def test_simhash_keeps_one_of_each_group(spark):
    kept = simhash.simhash_keep(documents(spark))
    want = {k for k, v in plain_components([r[0] for r in texts()], [plain_fingerprint(r[1]) for r in texts()]).items() if k == v}
    assert {r.doc_id for r in kept.collect()} == want and "fp" in kept.columns
    odd = [(5, "a b c d", None, None, 0), (5, "a b c d", None, None, 0), (7, "a b c d", None, None, 0), (None, "a b c d", None, None, 0), (9, None, None, None, 0), (11, " ", None, None, 0)]
    assert sorted((r.doc_id is None, r.doc_id) for r in simhash.simhash_keep(documents(spark, odd)).collect()) == [(False, 5), (False, 5), (False, 9), (True, None)]
    assert simhash.simhash_components(empty(spark)).count() == 0 and simhash.simhash_keep(empty(spark)).count() == 0


def test_frequent_fingerprints_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 3)
    rows = texts() + [(k, "the same words in every one of these", "en", "s", 0) for k in range(3000, 3040)]
    got = rows_of(simhash.simhash_components(documents(spark, rows)))
    assert {k: r.component_id for k, r in got.items()} == plain_components([r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows])


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(t[1] or "" for t in texts())
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 50)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (None, 1), *((100, k) for k in range(101, 300)), *((k, k + 1) for k in range(1000, 1100))], "src long, dst long")
    got = {r.node: r.component for r in components(e).collect()}
    assert got[3] == 1 and got[9] == 7 and 5 not in got and all(got[k] == 100 for k in range(100, 300)) and all(got[k] == 1000 for k in range(1000, 1101))
    assert components(e.limit(0)).count() == 0


# PII


def plain_base(s: str) -> dict:
    out = {}
    for k, p in KINDS.items():
        out[k] = []
        for m in re.finditer(p, s):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": k != "ip" or all(int(x) < 256 for x in m[0].split(".")), "card": k == "card" and 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[k]:
                out[k].append(m.span())
    return out


@pytest.mark.parametrize("alphabet", ["a@.b-1 ", "12.3 5.", "0123456789 -", "+1 ().-23a", "a@b.c@d.e-", "@@.a"])
def test_base_spans(alphabet):
    import random

    rng = random.Random(alphabet)
    for _ in range(4000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert pii.base(s) == plain_base(s), s


def test_long_runs_take_linear_time():
    import time

    began = time.time()
    for s in ("a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "+1" + " " * 1_000_000, "a@" * 300_000, "1 " * 500_000):
        pii.base(s)
    assert time.time() - began < 20


DISGUISED = {
    "write to bob.42 [at] mail8 [dot] example [dot] com now": "bob.42 [at] mail8 [dot] example [dot] com",
    "bob dot 42 at mail8 dot example dot com": "bob dot 42 at mail8 dot example dot com",
    "x ｂｏｂ@ｍａｉｌ.com": "ｂｏｂ@ｍａｉｌ.com",
    "mail bоb@mаil.com": "bоb@mаil.com",
    "ip four two dot one four four dot three five dot two five four ok": "four two dot one four four dot three five dot two five four",
    "call plus one nine eight eight five five five two four eight five": "plus one nine eight eight five five five two four eight five",
    "+１ (988) 555-2485": "+１ (988) 555-2485",
    "42[.]144[.]35[.]254": "42[.]144[.]35[.]254",
    "call plus one 9 eight eight 5 five five two 4 eight five ok": "plus one 9 eight eight 5 five five two 4 eight five",
    "plus one nine oh eight five five five two four eight oh": "plus one nine oh eight five five five two four eight oh",
    "+1 (988) 555-O4B5 x": "+1 (988) 555-O4B5",
    "to b o b @ e x . c o m now": "b o b @ e x . c o m",
    "b.ob" + " " * 300 + "at" + " " * 90 + "mail" + " " * 50 + "dot" + " " * 70 + "com": "b.ob" + " " * 300 + "at" + " " * 90 + "mail" + " " * 50 + "dot" + " " * 70 + "com",
    "a" * 200 + " dot b2 at mail dot " + "x" * 40: "a" * 200 + " dot b2 at mail dot " + "x" * 40,
    "b@x.com cuatro cero cuatro uno ocho nueve cuatro nueve siete cuatro seis cero ocho siete nueve cinco": "cuatro cero cuatro uno ocho nueve cuatro nueve siete cuatro seis cero ocho siete nueve cinco",
}


@pytest.mark.parametrize("text", DISGUISED)
def test_disguised(text):
    found, more = pii.spans_of(text)
    assert [text[a:b] for v in more.values() for a, b in v] == [DISGUISED[text]]
    assert found == plain_base(text)


@pytest.mark.parametrize("text", ["meet at example.com today", "one two three go", "un dos tres", "point a dot b", "Ελληνικά και русский текст", "", "he is at the dot", "1 2 3 4 5 6 7 8 9 10 11 12", "a b c d e f g", "BOB555 IS OLD", "one and two and 3 and four"])
def test_nothing_disguised(text):
    assert not any(pii.spans_of(text)[1].values())


def disguises(rng, kind: str) -> tuple[str, str]:
    """A random identifier in disguise, and what it stands for."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    spelled = lambda d: " ".join(rng.choice([w for w, v in pii.DIGIT_WORDS.items() if v == c and w.isascii()]) if rng.random() < 0.8 else c for c in d)
    wide = lambda x: "".join(chr(0xFEE0 + ord(c)) if c != " " else c for c in x)
    if kind == "email":
        local, labels = rng.choice(["bob.42", "ann_x", "j7", "mia.lee9"]), ["mail" + digits(1), "example", rng.choice(["com", "org", "museum"])]
        plain = f"{local}@{'.'.join(labels)}"
        return rng.choice([f"{local} [at] {' [dot] '.join(labels)}", f"{local} (at) {'(.)'.join(labels)}", f"{local} at {' dot '.join(labels)}", f"{local} arroba {' punto '.join(labels)}", wide(plain), f"{local}@{'.'.join(labels)}".replace("a", "а"), " ".join(plain)]), plain
    if kind == "ip":
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        return rng.choice(["[.]".join(parts), "[dot]".join(parts), wide(".".join(parts))]), ".".join(parts)
    if kind == "card":
        d = digits(15)
        d += next(c for c in "0123456789" if pii.luhn(d + c))
        return rng.choice([spelled(d), wide(d)]), d
    d = "1" + digits(10)
    return rng.choice(["plus " + spelled(d), wide("+" + d)]), "+" + d


@pytest.mark.parametrize("kind", pii.KINDS)
def test_disguises_come_back_with_their_offsets(kind):
    """An exact round trip: what is put into clean text is found, at its place in the source."""
    import random

    rng = random.Random(kind)
    for _ in range(400):
        shown, plain = disguises(rng, kind)
        if kind == "card" and all(t.isdigit() for t in shown.split()) or kind == "phone" and all(t.isdigit() for t in shown.split()[1:]):
            continue
        before, after = rng.choice(["", "x; ", "see: ", "ok ("]), rng.choice(["", "; x", "\nend", ") ok"])
        text = before + shown + after
        found, more = pii.spans_of(text)
        assert not any(found.values()) or kind in ("ip", "card", "phone"), text
        assert (len(before), len(before) + len(shown)) in more.get(kind, []), (text, more)


def test_tape_keeps_the_source(monkeypatch):
    """Random edits over edits, against one span a character."""
    import random

    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 40)))
        tape, spans = pii.Tape(text), [(i, i + 1) for i in range(len(text))]
        for _ in range(rng.randint(1, 4)):
            cuts = sorted(rng.sample(range(len(tape.text) + 1), min(len(tape.text) + 1, 2 * rng.randint(0, 3))))
            edits = [(a, b, "".join(rng.choice("XYZ") for _ in range(rng.randint(0, 3)))) for a, b in zip(cuts[::2], cuts[1::2]) if a < b]
            new, at = [], 0
            for a, b, put in edits:
                new += spans[at:a] + [(spans[a][0], spans[b - 1][1])] * len(put)
                at = b
            tape.rewrite(edits)
            spans = new + spans[at:]
            assert len(tape.text) == len(spans) and [tape.source((i, i + 1)) for i in range(len(spans))] == spans
            if not spans:
                break


def test_long_disguises_take_linear_time_and_little_memory():
    import time
    import tracemalloc

    began = time.time()
    for s in ("x at " * 200_000, "x" + " " * 1_000_000 + "at", "at dot " * 150_000, "one " * 300_000, "1 " * 400_000 + "one", "[ " * 400_000, "a @ " * 250_000, "O0" * 400_000, "a dot " * 200_000, "@ " * 400_000):
        pii.spans_of(s)
    assert time.time() - began < 40
    text = "word " * 2_000_000 + "bob [at] mail [dot] com"
    tracemalloc.start()
    assert pii.spans_of(text)[1]["email"]
    assert tracemalloc.get_traced_memory()[1] < 25 * len(text)


def test_pii_rows(spark):
    rows = [(1, "😀 a@b.co 1.2.3.4", None, None, 0), (2, None, None, None, 0), (3, "", None, None, 0), (1, "😀 a@b.co 1.2.3.4", None, None, 0), (None, "x [at] y [dot] com", None, None, 0)]
    got = pii.pii_spans(documents(spark, rows)).orderBy("doc_id").collect()
    assert len(got) == 5 and got[1].spans == "email:2:8,ip:9:16" and got[1].n_email == 1 and got[1].base_sha256 == hashlib.sha256(b"email:2:8,ip:9:16").hexdigest()
    assert got[0].n_email == 0 and got[0].n_added == 1 and got[0].spans == "email:0:18"
    clean = {r.doc_id: r.text for r in pii.pii_redacted(documents(spark, rows)).collect()}
    assert clean == {1: "😀 [EMAIL] [IP]", 2: None, 3: "", None: "[EMAIL]"}
    assert pii.pii_spans(empty(spark)).count() == 0 and pii.pii_redacted(empty(spark)).count() == 0


# BPE


@pytest.fixture(scope="module")
def codec():
    path, pattern = bpe.default_ranks()
    ranks = bpe.read_ranks(path)
    return bpe.TextCodec(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_bpe_like_the_library(codec):
    import random

    mine, theirs = codec
    rng = random.Random(5)
    letters = "aaab ée中文😀'\"  \n\t019!?.,-_<|endoftext|>ZÄßñ　"
    samples = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for s in [*samples, "a" * 20_000, " " * 5000, "ab" * 5000, "中" * 999, *(t[1] or "" for t in texts())]:
        assert mine.encode(s) == theirs.encode_ordinary(s)
        assert mine.encoder.decode(mine.encode(s)) == s.encode()


def test_edits_keep_the_encoding(codec):
    import random

    rng, e = random.Random(6), codec[0].encoder
    data = " ".join(t[1] or "" for t in texts(3, 20)).encode()[:1500]
    table = bpe.Editable(e, data)
    for _ in range(40):
        i = rng.randrange(len(table.data))
        redone = table.replace(i, min(len(table.data), i + rng.randint(0, 9)), bytes(rng.randrange(97, 110) for _ in range(rng.randint(0, 9))))
        fresh = bpe.Editable(e, table.data)
        assert table.last == fresh.last and table.ids() == fresh.ids() and redone <= 4 * e.longest
    table.append(b" and more")
    assert table.ids() == bpe.Editable(e, table.data).ids()


def test_bpe_rows(spark, codec):
    path, pattern = bpe.default_ranks()
    docs = documents(spark).unionByName(documents(spark, texts()[:2]))
    got = bpe.bpe_digests(docs, path, pattern)
    assert got.count() == docs.count()
    for r, t in ((rows_of(got)[k], t) for k, t, *_ in texts()):
        ids = codec[1].encode_ordinary(t or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    ids = bpe.bpe_ids(docs, path, pattern, ("source",))
    back = {r.doc_id: bytes(r.data).decode() for r in bpe.bpe_decode(ids, path).collect()}
    assert back == {k: t or "" for k, t, *_ in texts()}
    assert bpe.bpe_digests(empty(spark), path, pattern).count() == 0


def test_long_texts_in_steps(codec, monkeypatch):
    text = " ".join(t[1] or "" for t in texts())
    whole = codec[0].digest(text)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    assert codec[0].digest(text) == whole


# Repeated bytes


def plain_repeats(rows) -> dict:
    least: dict[bytes, int] = {}
    raw = [(i, (t or "").encode()) for i, t, *_ in rows if i is not None]
    for i, b in raw:
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            least[w] = min(i, least.get(w, i))
    out = {}
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if least[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("piece", [repeats.PIECE, 700])
def test_repeats_against_brute_force(spark, monkeypatch, piece):
    rows = texts(7, 80) + [(2000, "xy" * 300, None, None, 0), (2001, "yx" * 290, None, None, 0), (2002, "é" * 120, None, None, 0), (1999, "é" * 60, None, None, 0), (2003, "z" * 49, None, None, 0), (2004, "z" * 49, None, None, 0)]
    for name, value in (("PIECE", piece),):
        monkeypatch.setattr(repeats, name, value)
    got = {k: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for k, r in rows_of(repeats.repeats(documents(spark, rows))).items()}
    assert got == plain_repeats(rows)


def test_frequent_grams_come_last(spark, monkeypatch):
    """A passage in many surroundings: the same result, and no anchor keeps more than a few of its contexts."""
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9)))
    passage = " ".join(word() for _ in range(14))
    rows = [(k, f"{' '.join(word() for _ in range(12))} {passage} {' '.join(word() for _ in range(12))}", None, None, 0) for k in range(300)]
    df = documents(spark, rows)
    want = plain_repeats(rows)
    crowd = []
    for split in (200_000, 20):
        monkeypatch.setattr(repeats, "SPLIT", split)
        often = repeats.often_in(df.select("doc_id", "text"), 1)
        raw = [r[1].encode() for r in rows]
        _, _, _, anchor, ctx, _, _ = repeats.contexts(b"".join([*raw, b"\0" * 64]), np.cumsum([len(r) for r in raw]), often)
        pairs = np.unique(np.stack([anchor, ctx]), axis=1)
        crowd.append(int(np.unique(pairs[0], return_counts=True)[1].max()))
        assert {k: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for k, r in rows_of(repeats.repeats(df)).items()} == want
    assert crowd[0] > 100 and crowd[1] < 40, crowd


def test_small_indexes_change_nothing(spark, monkeypatch):
    rows = texts(9, 60)
    monkeypatch.setattr(repeats, "INDEX", 200)
    got = {k: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for k, r in rows_of(repeats.repeats(documents(spark, rows))).items()}
    assert got == plain_repeats(rows)


def test_repeats_odd_rows(spark):
    t = "q" * 30 + "r" * 40
    rows = [(5, t, None, None, 0), (5, t, None, None, 0), (None, t, None, None, 0), (6, t, None, None, 0), (5, "w" * 80, None, None, 0), (7, "w" * 60, None, None, 0)]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed) for r in repeats.repeats(documents(spark, rows)).collect())
    assert got == [(-1, 70, 0), (5, 70, 0), (5, 70, 0), (5, 80, 0), (6, 70, 70), (7, 60, 60)]
    assert repeats.repeats(empty(spark)).count() == 0


def test_index_statistics_like_brute_force():
    import random

    rng = random.Random(2)
    index = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 90))).encode() for _ in range(40)]
    patterns = [("".join(rng.choice("abc") for _ in range(20)) + rng.choice(index).decode()[:60]).encode() for _ in range(25)]
    ix = repeats.RunIndex(index, np.arange(40))
    length, _, begin = ix.statistics(patterns)
    joined = b"\xff".join(index)
    for p, b in zip(patterns, begin):
        for k in range(len(p)):
            n = 0
            while k + n < len(p) and p[k : k + n + 1] in joined:
                n += 1
            assert length[b + k] == n


# Mixing and licences


def plain_rake(cells: dict, want: dict, rounds: int = 300) -> dict:
    w = {k: float(v) for k, v in cells.items()}
    for _ in range(rounds):
        for i, d in enumerate(mixing.DIMS):
            have: dict = {}
            for k, v in w.items():
                have[k[i]] = have.get(k[i], 0) + v
            w = {k: v * want[d][k[i]] / have[k[i]] if have[k[i]] else 0.0 for k, v in w.items()}
    return w


def test_raking_against_brute_force(spark):
    docs = documents(spark, texts(1, 400))
    cells = mixing.cells_of(mixing.described(docs))
    for shares in (None, {"source": {"s0": 0.25, "s1": 0.75, "(none)": 0.0}}, {"lang": {"en": 1.0}}):
        raked, gap = mixing.rake(cells, shares)
        assert gap <= mixing.CLOSE
        rows = raked.collect()
        tokens = {tuple(r[d] for d in mixing.DIMS): r.tokens for r in rows if r.tokens}
        want = {}
        for i, d in enumerate(mixing.DIMS):
            own: dict = {}
            for k, v in tokens.items():
                own[k[i]] = own.get(k[i], 0) + v
            raw = {k: (shares[d].get(k, 0.0) if shares and d in shares else v**0.5) for k, v in own.items()}
            want[d] = {k: v / sum(raw.values()) for k, v in raw.items()}
        plain = plain_rake(tokens, want)
        assert {tuple(r[d] for d in mixing.DIMS): r.share for r in rows if r.tokens} == pytest.approx(plain, abs=1e-9)


def test_targets_that_nothing_meets_are_reported(spark):
    rows = [(1, "one", "en", "a", 0), (2, "two", "es", "b", 0)]
    cells = mixing.cells_of(mixing.described(documents(spark, rows)))
    assert mixing.rake(cells, {"lang": {"en": 0.9, "es": 0.1}, "source": {"a": 0.5, "b": 0.5}}, rounds=5)[1] > 0.1


def test_mixing_without_copies_meets_its_targets(spark):
    docs = documents(spark, texts(1, 400))
    got = mixing.mixed(docs).toPandas()
    assert len(got) == docs.count() and got.expected.max() <= 1 and set(got["copies"]) <= {0, 1}
    for d in mixing.DIMS:
        own = got.groupby(d).n_tokens.sum() ** 0.5
        have = (got.expected * got.n_tokens).groupby(got[d]).sum()
        assert (have / have.sum()).to_dict() == pytest.approx((own / own.sum()).to_dict(), abs=1e-4)
    kept = mixing.sample(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(got[got.sampled].doc_id) and kept.columns == docs.columns
    assert mixing.mixed(empty(spark)).count() == 0 and mixing.sample(empty(spark)).count() == 0


def test_many_cells_are_joined_alike(spark, monkeypatch):
    docs = documents(spark, texts(1, 200) + [(None, "x y", None, None, 0)])
    want = sorted(map(str, mixing.mixed(docs, repeat=True).collect()))
    kept = sorted(r.doc_id or -1 for r in mixing.sample(docs, repeat=True).collect())
    monkeypatch.setattr(mixing, "FEW_CELLS", 0)
    monkeypatch.setattr(common, "HOT", 10)
    assert sorted(map(str, mixing.mixed(docs, repeat=True).collect())) == want
    assert sorted(r.doc_id or -1 for r in mixing.sample(docs, repeat=True).collect()) == kept


def test_repeated_mixing_meets_skewed_targets(spark):
    rows = [(k, "word " * 50 + ("" if k % 20 else " licence"), ["en", "en", "en", "es"][k % 4], ["a", "a", "b"][k % 3], 0) for k in range(2400)]
    docs = documents(spark, rows)
    got = mixing.mixed(docs, repeat=True).toPandas()
    assert len(got) == 2400 and got.expected.max() > 1.5 and (got.sampled == (got["copies"] > 0)).all()
    total = got.n_tokens.sum()
    assert (got.expected * got.n_tokens).sum() / total == pytest.approx(mixing.FRACTION, abs=1e-4)
    for d in mixing.DIMS:
        own = got.groupby(d).n_tokens.sum() ** 0.5
        for n, near in (("expected", 1e-4), ("copies", 0.03)):
            have = (got[n] * got.n_tokens).groupby(got[d]).sum()
            assert (have / have.sum()).to_dict() == pytest.approx((own / own.sum()).to_dict(), abs=near)
    kept = mixing.sample(docs, repeat=True)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(got.doc_id.repeat(got["copies"])) and kept.columns == docs.columns
    assert mixing.mixed(empty(spark), repeat=True).count() == 0 and mixing.sample(empty(spark), repeat=True).count() == 0


def test_mixing_of_nothing(spark):
    rows = [(1, None, None, None, 0), (1, None, None, None, 0), (None, "", "en", "s", 0)]
    got = mixing.mixed(documents(spark, rows)).collect()
    assert len(got) == 3 and all(r.sampled and r.n_tokens == 0 for r in got)


def test_license_rules(spark):
    s = dict(licenses.SENTENCES)
    bsd3 = ". ".join(s[i].capitalize() for i in (5, 6, 7, 8, 9)) + "."
    rows = [(1, bsd3, None, None, 0), (2, ".\n".join(s[i] for i in (5, 6, 7)), None, None, 0), (3, "Text. Licensed under the Apache License,  Version 2.0.\nReleased under the MIT License.", None, None, 0), (4, None, None, None, 0), (5, "", None, None, 0), (6, "no licence here", None, None, 0), (3, "x", None, None, 0), (None, "Licensed under CC BY-NC 4.0.\n" * 2, None, None, 0)]
    got = [(r.doc_id, r.licenses) for r in licenses.license_scan(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, "BSD-3-Clause"), (2, "BSD-2-Clause"), (3, "Apache-2.0,MIT"), (4, ""), (5, ""), (6, ""), (3, ""), (None, "CC-BY-NC-4.0")], key=str)
    assert licenses.license_scan(empty(spark)).count() == 0


# Toxicity


def toxic_fixture(n=1200):
    import random

    rng = random.Random(8)
    words = ["".join(rng.choice(["ba", "lo", "ti", "re", "na", "mu"]) for _ in range(rng.randint(2, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["grobo", "snarfig", "vlkkor" + rng.choice(words)])
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_fixture()
    extra = [(9000, None, None, None, 0), (9001, "", None, None, 0), (9002, "grobo snarfig you grobo snarfig", None, None, 0), (0, docs[0][1], None, None, 0), (None, "x", None, None, 0)]
    lab = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.toxicity(documents(spark, docs + extra), lab).toPandas()
    assert len(got) == len(docs) + 5 and got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    truth = dict(labels)
    held = got[(got.held_out == True) & got.doc_id.isin(truth)]  # noqa: E712
    y = held.doc_id.map(truth)
    assert (held.predicted[y == 1] == 1).mean() > 0.9 and (held.predicted[y == 0] == 0).mean() > 0.98
    assert got[got.doc_id.isna()].held_out.isna().all()
    clean = toxicity.clean(documents(spark, docs), lab)
    assert 0.7 < clean.count() / len(docs) < 0.9 and "fp" in clean.columns


def plain_features(lexicon, text) -> list[float]:
    """The features from their definitions, word by word."""
    low = text.lower()
    words = re.findall(r"\w+", low)
    weight = []
    for w in words:
        v = lexicon.weights.get(w)
        weight.append(v if v is not None else -max([lexicon.weights.get("^" + w[:n], 0.0) for n in toxicity.BEGINNINGS if len(w) > n] or [0.0]))
    hits = [i for i, v in enumerate(weight) if v]
    you = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in hits)
    n, letters, size = max(len(words), 1), max(sum(c.isascii() and c.isalpha() for c in text) + sum(b in (0xC3, 0xC4) for b in text.encode()), 1), max(len(text), 1)
    caps = sum("A" <= c <= "Z" for c in text)
    points = sum(c.isascii() and 33 <= ord(c) < 127 and not c.isalnum() for c in text)
    stretched = sum(a == b == c and "a" <= a <= "z" for a, b, c in zip(text, text[1:], text[2:]))
    runs = len(re.findall(r"[!?]{2,}", text))
    total = sum(abs(weight[i]) for i in hits)
    return [np.log1p(len(words)), len(hits) / n, len(hits), total / n, max([abs(weight[i]) for i in hits] or [0.0]), len({words[i] for i in hits}), sum(weight[i] < 0 for i in hits) / n, near / max(len(hits), 1), len(you) / n, caps / letters, len(re.findall(r"\b[A-Z]{3,}\b", text)) / n, text.count("!") / size, text.count("?") / size, points / size, runs / n, stretched / letters]


@pytest.mark.parametrize("step", [toxicity.STEP, 40, 7])
def test_features_against_brute_force(monkeypatch, step):
    import random

    monkeypatch.setattr(toxicity, "STEP", step)
    rng = random.Random(step)
    words = ["you", "du", "grobo", "snarfig", "snarfigs", "STOP", "nooo", "ok!!", "why?!", "plain", "ÄRGER", "tu", "été", "a.b"]
    lexicon = toxicity.Lexicon({"grobo": 2.0, "^snar": 1.0, "snarfig": 3.0, "stop": 0.5})
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "  "]) for _ in range(rng.randint(0, 60)))
        got = dict(zip(toxicity.FEATURES, lexicon.features(text)))
        del got["obfuscated"], got["obfuscated_hits"]
        assert list(got.values()) == pytest.approx(plain_features(lexicon, text)), text


def test_every_lexicon_word_counts_once():
    lexicon = toxicity.Lexicon({f"w{k}": 1.0 for k in range(3000)})
    got = dict(zip(toxicity.FEATURES, lexicon.features(" ".join(f"w{k}" for k in range(3000)) * 2)))
    assert got["distinct"] == 3000 + 0 and got["hits"] >= 5998


def test_toxic_rows_go_whatever_else_they_hold(spark):
    docs, labels = toxic_fixture(600)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    odd = [(9000, None, None, None, 0), (9001, "", None, None, 0), (None, "grobo snarfig grobo snarfig grobo", None, None, 0), (docs[0][0], docs[0][1], None, None, 0)]
    scored = toxicity.toxicity(documents(spark, docs + odd), lab).toPandas()
    kept = toxicity.clean(documents(spark, docs + odd), lab)
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == sorted(int(x) if x == x else -1 for x in scored[scored.score < 0.7].doc_id.astype(float))
    assert kept.columns == documents(spark, docs).columns and toxicity.clean(empty(spark), lab).count() == 0


def test_toxicity_without_classes(spark):
    docs = documents(spark, texts())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(0, 1), (3, 1), (6, 1), (9, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, one).collect()} == {1.0}
    assert toxicity.toxicity(empty(spark), one).count() == 0


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    m = rng.normal(size=500)
    x, y = toxicity.isotonic(m, (rng.random(500) < 1 / (1 + np.exp(-m))).astype(float))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all()


def test_pipeline_against_brute_force(spark):
    """Every stage on its own input, and the whole."""
    import os

    import corpus_pipeline
    from tidemark.llm.common import shared_folder, table

    folder = "/root/testdata/sf0.001"
    labels, before = table(spark, folder, "labels"), spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(before, labels)
    rows = [tuple(r) for r in before.collect()]
    tame = [r for r in rows if model.score(np.array([model.lexicon.features(r[1] or "")]))[0] < toxicity.THRESHOLD]
    fps = plain_components([r[0] for r in tame], [plain_fingerprint(r[1]) for r in tame])
    unique = [r for r in tame if fps[r[0]] == r[0]]

    def redacted(t: str) -> str:
        found, more = plain_base(t), pii.spans_of(t)[1]
        out, end = "", 0
        for a, b, k in sorted((a, b, k) for k in KINDS for a, b in found[k] + more.get(k, [])):
            out += (t[end:a] + f"[{k.upper()}]") if a >= end else ""
            end = max(end, b)
        return out + t[end:]

    clean = [(i, redacted(t), lang, source, len(redacted(t))) for i, t, lang, source, _ in unique]
    cells: dict = {}
    for _, t, lang, source, _ in clean:
        topic = next((n for n, p in mixing.TOPICS if re.search(p, t)), "general")
        cells.setdefault((source, lang, topic), []).append((t, len(re.findall(mixing.WORD, t))))
    tokens = {k: sum(n for _, n in v) for k, v in cells.items()}
    want = {}
    for i, d in enumerate(mixing.DIMS):
        own: dict = {}
        for k, v in tokens.items():
            own[k[i]] = own.get(k[i], 0) + v
        want[d] = {k: v**0.5 / sum(x**0.5 for x in own.values()) for k, v in own.items()}
    raked = plain_rake({k: v for k, v in tokens.items() if v}, want)
    mixed = []
    for r in clean:
        topic = next((n for n, p in mixing.TOPICS if re.search(p, r[1])), "general")
        k = r[3], r[2], topic
        e = raked[k] * mixing.FRACTION * sum(tokens.values()) / tokens[k] if tokens[k] else 1.0
        u = int(hashlib.md5(str(r[0]).encode()).hexdigest()[:8], 16) / 2**32
        mixed += [r] * (int(e) + (u < e - int(e)))
    path, pattern = bpe.default_ranks()
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "source", "lang", "n_tokens", "ids"]
    assert sorted((r.doc_id, r.source, r.lang, r.n_tokens, list(r.ids)) for r in got.collect()) == sorted((i, s, g, len(x := theirs.encode_ordinary(t)), x) for i, t, g, s, _ in mixed)
    docs, plain = before, (tame, unique, clean, mixed)
    for (name, stage), rows_ in zip(corpus_pipeline.STAGES[:-1], plain):
        docs = stage(spark, docs, folder)
        assert docs.columns == before.columns and sorted(tuple(r) for r in docs.collect()) == sorted(rows_), name
    home = shared_folder(spark).removeprefix("file:")
    assert not [x for x in os.listdir(home) if x.startswith("cuts-")]
    kept = [x for x in os.listdir(home) if x.startswith("pipeline-")]
    assert kept and all(os.listdir(f"{home}/{x}") == ["4"] for x in kept)


def test_stages_on_odd_rows(spark):
    import corpus_pipeline

    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", "en", "s", 15), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), "/root/testdata/sf0.001").count() == 0, name
        out = stage(spark, spark.createDataFrame(odd, DOCS), "/root/testdata/sf0.001")
        assert out.count() >= 1, name


MIT = """Copyright (c) 2024 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
STYLES = [lambda t: t, lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.splitlines()) + " */\n", lambda t: "".join(f"# {x}\r\n" for x in t.splitlines()), lambda t: "".join(f"// {x}\n" for x in t.splitlines()), lambda t: " ".join(t.split())]


def wrapped(sentence: str, width: int = 60) -> str:
    import textwrap

    return "\n".join(textwrap.wrap(sentence.capitalize(), width)) + ".\n"


def test_wrapped_licence_texts(spark):
    want = [(MIT, "1,2,3,4", "MIT"), (APACHE, "11,12,13,14", "Apache-2.0"), (GPL, "15,17,18", "GPL-3.0-or-later"), (ISC, "31", "ISC"), (MPL, "32,70", "MPL-2.0"), (BSD, "5,6,7,9", "BSD-2-Clause"), (ZLIB, "83,84,85,86", "Zlib"), (LGPL, "60", "LGPL-2.1-or-later")]
    rows = [(10 * k + j, f(t), None, None, 0) for k, (t, _, _) in enumerate(want) for j, f in enumerate(STYLES) if j < 4 or t is not APACHE]  # on one line its short sentences have no end
    rows += [(1000, "Notes\nReleased under the MIT License\nmore words", None, None, 0), (1001, "He released under the MIT License what he had.", None, None, 0)]
    rows += [(1002, "// SPDX-License-Identifier: GPL-2.0-only\nint x;", None, None, 0), (1003, "This project is distributed under the terms of the Mozilla Public License 2.0.", None, None, 0), (1004, "long text " * 20_000 + "\n" + MIT, None, None, 0)]
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in licenses.license_scan(documents(spark, rows)).collect()}
    assert {i: got[i] for i in got if i < 1000 and got[i] != want[i // 10][1:]} == {}
    assert got[1000] == ("21", "MIT") and got[1001] == ("", "") and got[1002] == ("=GPL-2.0-only", "GPL-2.0-only") and got[1003] == ("=MPL-2.0", "MPL-2.0") and got[1004][1] == "MIT"


def test_every_licence_in_every_form(spark):
    """Each rule's sentences wrapped, commented and, where all of them are long, on one line; each name in a notice; each tag."""
    s = dict(licenses.SENTENCES)
    assert len(licenses.LICENSES) >= 45 and all(any(t in x for t in licenses.TRIGGERS) for x in [*s.values(), licenses.SPDX, *(f"licensed under {n}" for n in licenses.NAMES)])
    cases = []
    for name, ids in licenses.RULES:
        text = "\n".join(wrapped(s[i]) for i in ids)
        every = all(len(s[i].split()) >= licenses.LONG for i in ids)
        cases += [(f(text), name) for f in (STYLES if every else STYLES[:4])]
    cases += [(f"Licensed under the {k}.", v) for k, v in licenses.NAMES.items()] + [(f"# SPDX-License-Identifier: {n}\n", n) for n in licenses.LICENSES]
    got = {r.doc_id: r.licenses for r in licenses.license_scan(documents(spark, [(k, t, None, None, 0) for k, (t, _) in enumerate(cases)])).collect()}
    assert {cases[k]: v for k, v in got.items() if v.split("-only")[0].split("-or-")[0] != cases[k][1].split("-only")[0].split("-or-")[0]} == {}

"""Suffix-array repeats (8): brute force over all windows, interval trees, hot anchors, edge rows."""

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logsieve.llm import repeats as rp

DOCS = "doc_id long, text string, n_bytes string, pieces string, tag string"


def brute(rows, length=100):
    """rows (doc_id, text) in order, one per document."""
    seen, out = set(), []
    for d, t in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                hit[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, h in zip(b, hit) if not h)
        spans = sum(1 for i, h in enumerate(hit) if h and (i == 0 or not hit[i - 1]))
        out.append((d, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _rows(rng):
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [text(rng.choice([90, 100, 101, 130, 260, 700])) for _ in range(12)]
    rows = []
    for i in range(120):
        rows.append((i, "".join(rng.choice([text(rng.choice([0, 1, 20, 150])), rng.choice(passages)]) for _ in range(rng.randrange(7)))))
    rows[5] = (5, rows[2][1])
    rows[9] = (9, "ab" * 300)
    rows[11] = (11, "x" * 350)
    rows[12] = (12, "x" * 99)
    rows[13] = (13, None)
    rows[14] = (14, "")
    rows[60] = (60, passages[5][:50] + passages[5] * 3)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", "clash", "clash") for d, t in rows], DOCS).repartition(4)


def _got(spark, rows):
    return [tuple(r) for r in rp.without_repeats(_frame(spark, rows)).drop("kept").orderBy("doc_id").collect()]


def test_all_windows(spark):
    rows = _rows(random.Random(6))
    assert _got(spark, rows) == brute(rows)


def test_hot_anchors_and_small_blocks(spark, monkeypatch):
    rows = _rows(random.Random(7))
    monkeypatch.setattr(rp, "HOT", 6)
    monkeypatch.setattr(rp, "ARRAY_BYTES", 500)
    assert _got(spark, rows) == brute(rows)


def test_repeated_ids_and_empty(spark):
    rng = random.Random(1)
    t = "".join(rng.choice("abcdefgh") for _ in range(300))
    got = _got(spark, [(None, t), (1, t), (1, t), (2, "y" + t)])
    assert [r[2] for r in got] == [0, 300, 300, 300] and got[1] == got[2]
    assert _got(spark, []) == []


def test_copies_are_removed_whole(spark):
    """Many copies of some texts, and texts that repeat a part of one of the copies; short texts are no repeats."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdé") for _ in range(n))
    bases = [text(n) for n in (40, 99, 100, 300, 900)]
    rows = [(i, rng.choice(bases)) for i in range(60)] + [(60 + i, text(30) + rng.choice(bases)[rng.randrange(60):] + text(9)) for i in range(40)]
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert _got(spark, rows) == brute(rows)


def test_many_texts_without_id(spark, monkeypatch):
    """More texts of one id than 16 bits tell apart; each holds a passage of its own twice, or a common one."""
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    common, own = text(120), [text(101) for _ in range(1500)]
    texts = [o + "-" * (1 + i % 40) + o if i % 3 else text(i % 50) + "=" + common for i, o in enumerate(own)]
    docs = _frame(spark, [(5, "y")] + [(None, t) for t in dict.fromkeys(texts)])
    ordered = [(r.doc_id, r.text) for r in docs.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()]
    for hot in (rp.HOT, 50):
        monkeypatch.setattr(rp, "HOT", hot)
        got = [tuple(r) for r in rp.without_repeats(docs).drop("kept").collect()]
        assert sorted(got, key=str) == sorted(brute(ordered), key=str)


def test_repeat_groups(spark):
    rng = random.Random(3)
    t = "".join(rng.choice("abcdefgh") for _ in range(110))
    rows = [(1, "1" + t + "X"), (2, "2" + t + "XY"), (3, "3" + t + "XY" + "q" * 5)]
    got = {(r.length, r.did, r.place % 2**40) for r in rp.repeat_groups(_frame(spark, rows)).collect()}
    # occurrences share 111 bytes in all three, 112 in two; segments show pieces of them with all occurrences
    for length in {n for n, _, _ in got}:
        assert {d for n, d, _ in got if n == length} in ({1, 2, 3}, {2, 3})
    assert all(100 <= n <= 113 for n, _, _ in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.text(alphabet="ab", min_size=8, max_size=30)), min_size=1, max_size=8))
def test_suffix_array_block(segs):
    raw = [t.encode() for _, t in segs]
    place = np.array([i * 1000 for i in range(len(segs))])
    s = rp.Suffixes(np.array([d for d, _ in segs]), place, np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]), length=5)
    cover = {}
    for d, p, n in zip(s.doc.tolist(), s.place.tolist(), s.covered().tolist()):
        for x in range(p, p + n):
            cover[d, x] = True
    want = {}
    where = {}
    for (d, _), p, b in zip(segs, place.tolist(), raw):
        for i in range(len(b) - 4):
            where.setdefault(b[i : i + 5], []).append((d, p + i))
    for occ in where.values():
        for d, p in occ:
            if (d, p) > min(occ):
                want.update({(d, x): True for x in range(p, p + 5)})
    assert cover == want

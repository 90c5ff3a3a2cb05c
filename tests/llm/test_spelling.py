"""Spelling variants (12): counts, near words and roots against brute force; edge rows and tiles."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from logsieve.llm import spelling
from logsieve.llm.blocks import text_bytes

SCHEMA = "doc_id long, text string, word string, n string, form string, root string, key string, chars string"
_UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, *["clash"] * 6) for i, t in rows], SCHEMA)


def _words(rows, mod=97, min_chars=5, min_count=3):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % mod == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            if len(run) >= min_chars:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= min_count}


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(rows, **options):
    words = _words(rows, **options)
    near = {w: [v for v in words if v != w and _near(v, w)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), words[w], len(near[w]), words.get(form[w], -1)) for w in words)


def _rows(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def _texts(seed, n, alphabet, lengths):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice(alphabet) for _ in range(rng.choice(lengths))) for _ in range(n)]
    return [(i, " ".join(rng.choices(vocab, weights=[1 / (k + 1) for k in range(n)], k=400))) for i in range(40)]


EDGE = [(1, None), (2, ""), (None, "Straße straße STRASSE straße " * 3), (3, "colour color colours colour,colour;colour colors " * 5),
        (4, "naïve naive naïves Naïve " * 4), (5, "é" * 9 + " x " + "É" * 9), (6, "word" * 50_000 + " "), (6, "word" * 50_000 + " "),
        (7, "word" * 50_000), (8, "WORD" * 49_999 + "wor"), (9, "word" * 49_999 + "wor"), (9, "word" * 49_999 + "wor"),
        (10, "ab÷cd ab×cd ab÷cd ab×cd ab÷cd ab×cd"), (11, "abcde-abcde\nabcdeΔabcde Āabcdeſabcdf abcdf abcdf"), (12, "tieda tiedb tiedc " * 3)]


@pytest.mark.parametrize("options", [{}, {"mod": 3}])
def test_edge_rows(spark, options):
    assert _rows(spelling.variants(_frame(spark, EDGE), **options)) == _brute(EDGE, **options)


@pytest.mark.parametrize("tile", [spelling.TILE, 7])
def test_by_brute_force(spark, tile):
    """Dense words of few letters, in whole buckets and in buckets cut into many tiles."""
    rows = _texts(1, 500, "abé", (5, 6, 7)) + _texts(2, 200, "etaoinzäq", (5, 6, 9))
    got = _rows(spelling.variants(_frame(spark, rows).repartition(6), tile=tile))
    assert got == _brute(rows)
    assert any(r[1] and r[1] != r[2] for r in got)  # some chain of forms


def test_deleted_code_points(spark):
    rows = _texts(5, 80, "abcdeü", (5, 6))
    assert _rows(spelling.variants(_frame(spark, rows), mod=2)) == _brute(rows, mod=2)


def test_runs_and_their_hashes():
    texts = ["Ab cÃ¿÷d", "", "Āxé", "tail", "next" * 30]
    data, off = text_bytes(pa.array(texts))
    tokens, row = spelling.runs(data, off)
    want = [(m.translate(_UP), i) for i, t in enumerate(texts) for m in re.findall("[A-Za-zÀ-ÿ]+", t)]
    assert list(zip(tokens.to_pylist(), row.tolist())) == want
    raw = [t.encode() for t in tokens.to_pylist()]
    prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(texts))], np.uint32)
    h = spelling.run_hashes(prefix, row, np.arange(len(raw)), np.array([zlib.crc32(w) for w in raw], np.uint32), np.array([len(w) for w in raw]))
    assert h.tolist() == [zlib.crc32(f"{i}:{w}".encode()) for w, i in want]


def test_roots_of_a_long_chain(spark):
    """A word that a third of all words end at, and a chain of 40."""
    forms = [(f"w{i:02}", f"w{i + 1:02}") for i in range(40)] + [(f"x{i}", "w39") for i in range(300)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "w40" for w, _ in forms}


def test_empty(spark):
    assert _rows(spelling.variants(_frame(spark, []))) == []
    assert _rows(spelling.variants(_frame(spark, [(1, "no such word"), (2, None)]))) == []

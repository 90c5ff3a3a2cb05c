"""HyperMinHash near-duplicates (5): brute force over all pairs, estimates, edge rows."""

import random
import re

import numpy as np

from logsieve.llm import hyperminhash as hmh
from logsieve.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, node long, digest string, key string, component string"


def _shingles(text, k):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def brute(rows, k, percent):
    sets = [(d, _shingles(t, k)) for d, t in rows]
    up = {d: d for d, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                up[hi] = lo
    return sorted(((d, len(s), find(d)) for d, s in sets), key=str)


def _rows(rng):
    vocab = [f"w{i}" for i in range(400)]
    rows, base = [], [[rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 8, 30, 120, 400]))] for _ in range(40)]
    for i in range(300):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 8])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i * 3 % 301, rng.choice([" ", "\n", " \t"]).join(w)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "Éa B c"), (904, "Éa b C"), (905, "éa b c"),
                   (7, "another text of document seven"), (950, "another text of document seven"),
                   (951, "x " * 20000), (952, "x " * 30000), (None, "no id here"), (None, "no id here")]


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "clash", "clash", "clash") for d, t in rows], DOCS).repartition(3)


def test_components_of_all_pairs(spark):
    rows = _rows(random.Random(5))
    for k, percent in ((3, 85), (5, 80)):
        got = hmh.near_duplicates(_frame(spark, rows), k, percent).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, k, percent)
        assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_texts_of_one_doc_id_are_told_apart(spark):
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    stay = [(5, text("a")), (5, text("b")), (3, text("c")), (9, text("d")), (None, text("a")), (None, text("e")), (5, None), (5, "")]
    go = [(9, text("c") + " more"), (7, text("b")), (5, text("c") + " end")]
    got = hmh.deduplicated(_frame(spark, stay + go + [stay[0], stay[5]])).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, stay))


def test_empty(spark):
    assert hmh.near_duplicates(_frame(spark, [])).count() == 0


def test_components_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


def test_registers_and_estimate():
    rng = np.random.default_rng(3)
    for n, shared in ((40, 30), (500, 400), (5000, 3000), (20000, 18000)):
        x = rng.integers(0, 2**64, size=n * 2 - shared, dtype=np.uint64)
        a, b = np.unique(x[:n]), np.unique(x[n - shared :])
        ra, rb = hmh.registers(a), hmh.registers(b)
        for u, reg in ((a, ra), (b, rb)):  # bit by bit
            for i in np.flatnonzero(reg)[:40]:
                low = min(int(v) & (2**56 - 1) for v in u if int(v) >> 56 == i)
                bits = f"{low:056b}" + "0" * 12
                zeros = bits.index("1")
                assert reg[i] == ((zeros + 1) << 10) | int(bits[zeros + 1 : zeros + 11], 2)
        j, used = hmh.estimate(ra[None], rb[None], [len(a)], [len(b)])
        true = shared / (2 * n - shared)
        assert abs(j[0] - true) < 5 * np.sqrt(true * (1 - true) / used[0]) + 0.01
    apart = [np.unique(rng.integers(0, 2**64, size=100000, dtype=np.uint64)) for _ in range(40)]
    regs = np.array([hmh.registers(u) for u in apart])
    equal = np.mean([(regs[i] == regs[i + 1]).sum() for i in range(39)])
    assert abs(equal - hmh.expected_collisions([100000], [100000])[0]) < 0.25


def test_bitmaps_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(9)
    for n in (1, 5, 100, 1500):
        x = rng.integers(0, 2**64, size=2 * n, dtype=np.uint64)
        a, b = np.unique(x[: n + n // 10]), np.unique(x[n // 10 :][: n * 2])
        ma, mb = hmh.bitmap(a)[None], hmh.bitmap(b)[None]
        w = min(ma.shape[1], mb.shape[1])
        apart = int(np.bitwise_count(hmh.folded(ma, w) ^ hmh.folded(mb, w)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_crowded_buckets_in_blocks(spark, monkeypatch):
    """A large group of near copies, some linked and some not, compared in small blocks."""
    monkeypatch.setattr(hmh, "BUCKET_ROWS", 40)
    rng = random.Random(8)
    base, rows = [f"b{i}" for i in range(120)], []
    for i in range(260):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = hmh.near_duplicates(_frame(spark, rows), 3, 85).collect()
    want = brute(rows, 3, 85)
    assert len({c for _, _, c in want}) > 20
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want

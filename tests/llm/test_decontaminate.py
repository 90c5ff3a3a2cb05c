"""Spaced-seed decontamination (1): brute force over all offsets, planted overlaps, edge rows."""

import random
import re

import numpy as np

from logsieve.llm import decontaminate as dc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, item_id string, n_words string"


def _words(t):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))


def brute(docs, items, percent):
    out = set()
    for d, t in docs:
        w = _words(t)
        for i, x in items:
            x = _words(x)
            for at in range(-len(x) + 1, len(w)) if x else ():
                n = sum(1 for j, y in enumerate(x) if 0 <= at + j < len(w) and w[at + j] == y)
                if n == len(x) if len(x) < 5 else 100 * n >= percent * len(x):
                    out.add((d, i))
    return out


def _data(rng):
    vocab = [f"v{i}" for i in range(60)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, text(rng.choice([2, 4, 5, 6, 10, 15, 31, 50]))) for i in range(40)]
    docs = []
    for d in range(250):
        w, x = text(rng.choice([0, 3, 40, 200])), list(rng.choice(items)[1])
        for _ in range(rng.randrange(0, max(1, len(x) // 4) + 1)):
            x[rng.randrange(len(x))] = "changed"
        cut = rng.choice([0, 0, 0, 1, 3])
        at = rng.randrange(len(w) + 1)
        docs.append((d, rng.choice([" ", "\n", "  "]).join(w[:at] + x[cut:] + w[at:])))
    return docs, [(i, " ".join(x).upper()) for i, x in items]


def _frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "clash", "clash") for d, t in docs], DOCS).repartition(3),
            spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, doc_id long"))


def test_all_overlaps(spark):
    docs, items = _data(random.Random(2))
    docs += [(900, None), (901, ""), (None, items[0][1]), (902, "v1 " * 30000 + items[7][1]), (5, items[3][1]), (5, items[3][1])]
    items += [(100, None), (101, " \n"), (None, "v1 v2 v3 v4 v5 v6"), (7, items[7][1]), (102, "É v1 é V2 Ü")]
    docs.append((903, "x é v1 É v2 ü"))
    docs.append((904, "x É V1 é v2 Ü"))
    d, b = _frames(spark, docs, items)
    got = dc.contaminated(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items, 80)
    assert all(5 * r.n_matched >= 4 * r.n_words for r in got)
    small = [x for x in dc.item_blocks(b, block_hashes=300)]
    assert len(small) > 3 and sum(len(x.ids) for x in small) == len(items)
    kept = dc.clean(d, b)
    bad = {x for x, _ in brute(docs, items, 80)}
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x) for x, _ in docs if x not in bad)


def test_passages_and_joined_stretches(spark):
    rng = random.Random(9)
    other = lambda n: [f"o{rng.randrange(10**6)}" for _ in range(n)]
    items = [[f"i{k}w{j}" for j in range(n)] for k, n in enumerate([59, 200, 16, 30, 8, 3])]
    a, b, c, e, g, h = items
    dirty = [(a[3:48], 0), (b[:100], 1), (b[90:103], 1), (b[150:156] + ["x"] + b[157:163], 1), (c[:8] + ["x"] + c[8:], 2),
             (c[:8] + c[9:], 2), (c[:7] + ["x", "y", "z"] + c[7:], 2), (e[:15] + ["x"] + e[15:], 3), (e[:5] + e[7:12] + ["x"] + e[12:18], 3), (g[:4] + ["x"] + g[5:], 4),
             (h, 5)]
    fine = [a[:10], b[20:30], c[:8] + other(4) + c[8:], e[:10] + other(9) + e[20:], e[10:20] + e[:10], g[:5], h[:2], c[:5] + other(1) + e[:5]]
    docs = [(i, " ".join(other(30) + x + other(30))) for i, (x, _) in enumerate(dirty)]
    docs += [(100 + i, " ".join(other(30) + x + other(30))) for i, x in enumerate(fine)]
    docs.append((200, " ".join(b[:13])))
    d, bench = _frames(spark, docs, [(i, " ".join(x)) for i, x in enumerate(items)])
    got = dc.contaminated(d, bench, passage=dc.PASSAGE).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, k) for i, (_, k) in enumerate(dirty)] + [(200, 1)]
    n = {r.doc_id: r.n_matched for r in got}
    assert (n[0], n[1], n[4], n[5], n[7]) == (45, 100, 16, 15, 15)


def test_clean_goes_row_by_row(spark, monkeypatch):
    item, second = " ".join(f"i{j}" for j in range(20)), " ".join(f"j{j}" for j in range(20))
    dirty = [(None, "a " + item + " b"), (7, item), (7, second + " z")]
    fine = [(None, "a clean text"), (None, None), (None, ""), (7, "another text of seven"), (8, "x"), (8, "x")]
    d, b = _frames(spark, dirty + fine, [(1, item), (2, second)])
    want = sorted(map(str, fine))
    assert sorted(str((r.doc_id, r.text)) for r in dc.clean_rows(d, b).collect()) == want
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (1, dc.MASKS))  # a block for each item
    kept = dc.clean_rows(d, b, passage=dc.PASSAGE)
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == want and kept.columns == d.columns
    assert dc.clean_rows(d, b.limit(0)).count() == len(dirty + fine) and dc.clean_rows(d.limit(0), b).count() == 0


def test_joined_is_the_longest_chain():
    rng = np.random.default_rng(5)

    def slow(item, doc, offsets, length):
        best = 0
        for s in range(len(item) - length + 1):
            pairs = [(j, o) for j in range(s, s + length) for o in offsets if 0 <= j + o < len(doc) and doc[j + o] == item[j]]
            f = {}
            for j, o in pairs:
                # the path may pass over unmatched words, and change its offset more than once between matches
                f[j, o] = 1 + max((n for (i, p), n in f.items() if i < j and _reach(i, p, j, o, offsets)), default=0)
            best = max([best, *f.values()])
        return best

    def _reach(i, p, j, o, offsets):
        seen, todo = set(), [(i, p)]
        while todo:
            x, q = todo.pop()
            if (x, q) in seen or x > j:
                continue
            seen.add((x, q))
            if (x, q) == (j, o):
                return True
            todo += [(x + 1 + max(0, q - r), r) for r in offsets if abs(q - r) <= dc.GAP]
        return False

    for _ in range(150):
        item, doc = rng.integers(0, 4, 9).astype(np.uint64), rng.integers(0, 4, 14).astype(np.uint64)
        offsets = np.unique(rng.integers(-3, 9, 4))
        for length in (5, 9):
            assert dc.joined(item, doc, offsets, length) == slow(item, doc, offsets.tolist(), length)


def test_empty(spark):
    d, b = _frames(spark, [(1, "a b c d e f")], [(1, "a b c d e f")])
    assert dc.contaminated(d.limit(0), b).count() == 0
    assert dc.contaminated(d, b.limit(0)).count() == 0
    assert dc.clean(d, b.limit(0)).count() == 1


def test_hits_in_parts(spark, monkeypatch):
    """A phrase that all items have and a document repeats: the same hits, listed some items at a time."""
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghij") * rng.randrange(1, 4)
    phrase = "one two three four five six"
    items = spark.createDataFrame([(i, " ".join(word() for _ in range(6)) + " " + phrase + " " + " ".join(word() for _ in range(4))) for i in range(30)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join([phrase] * 40)), (2, items.first().text), (3, "nothing")], "doc_id long, text string")
    found = []
    for limit in (dc.HITS_AT_ONCE, 500, 1):
        monkeypatch.setattr(dc, "HITS_AT_ONCE", limit)
        found.append(sorted(map(tuple, dc.contaminated(docs, items, percent=50, passage=6).collect())))
    assert found[0] and found[0] == found[1] == found[2]

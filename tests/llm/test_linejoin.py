"""Segment-partition edit join on lines (7): brute force over all pairs, edit distances, edge rows."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from logsieve.llm import linejoin as lj

DOCS = "doc_id long, text string, line string, lh string, key string, a string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abé", max_size=14), st.text(alphabet="abé", max_size=14), st.integers(1, 4))
def test_banded_distance(a, b, t):
    assert lj.edit_distance(a, b, t) == min(distance(a, b), t + 1)


def brute(rows, t):
    lines = [(d, i, x) for d, text in rows for i, x in enumerate((text or "").split("\n")) if x.strip()]
    place = lambda x: (x[0] is not None, x[0] or 0, x[1])
    first, copies = {}, {}
    for d, i, x in sorted(lines, key=place):
        first.setdefault(x, (d, i))
        copies[x] = copies.get(x, 0) + 1
    names = [x for x in first if len(x) > t]
    link = {x: [y for y in names if x != y and abs(len(x) - len(y)) <= t and distance(x, y) <= t] if x in names else [] for x in first}
    out = []
    for d, i, x in lines:
        late = any(place(first[y]) < place(first[x]) for y in link[x])
        out.append((d, i, *first[x], copies[x], len(link[x]), first[x] == (d, i) and not late))
    return sorted(out, key=str)


def test_all_pairs(spark):
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 20, 45]))) + "x" for _ in range(25)]

    def edited():
        x = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(x) + 1)
            x[at : at + rng.randrange(2)] = rng.choice(["", "z", "q"])
        return "".join(x)
    rows = [(d, "\n".join(edited() if rng.random() < 0.9 else rng.choice(["", "  ", "\t"]) for _ in range(rng.randrange(9)))) for d in range(70)]
    rows += [(900, None), (901, ""), (None, base[0] + "\n" + base[1]), (5, rows[3][1]), (902, "long line " * 9000 + "\n" + "long line " * 9000 + "!")]
    small = [r for r in rows if r[0] != 902]
    frame = lambda r: spark.createDataFrame([(d, t, "x", "x", "x", "x") for d, t in r], DOCS).repartition(3)
    for t in (1, 2, 3):
        got = [tuple(r) for r in lj.deduplicated_lines(frame([r for r in small if r[0] != 5]), t).collect()]
        assert sorted(got, key=str) == brute([r for r in small if r[0] != 5], t)
    got = lj.deduplicated_lines(frame(rows)).collect()
    long = sorted((r for r in got if r.doc_id == 902), key=lambda r: r.line_no)
    assert [(r.n_links, r.kept) for r in long] == [(1, True), (1, False)]
    assert lj.deduplicated_lines(frame([])).count() == 0

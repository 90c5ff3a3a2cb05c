"""Merkle manifest (13): trees, proofs and folding against a plain recursive version; edge rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from logsieve.llm import merkle

SCHEMA = ("doc_id long, source string, lang string, n_chars long, text string, tree string, idx string, digest string, "
          "path string, place string, uid string")


def _h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def _climb(nodes):
    """(root, list of sibling digests of each node, list of (place, siblings) steps)."""
    proofs, steps, at, level = [[] for _ in nodes], [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i - i % 3 : i - i % 3 + 3]
            others = run[: i % 3] + run[i % 3 + 1 :]
            proofs[k] += others
            steps[k].append((i % 3, others))
            at[k] = i // 3
        level = [_h(level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], proofs, steps


def _brute(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs, low = [], []
    for s in order:
        mine = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        root, proofs, steps = _climb([_leaf(r) for r in mine])
        subs.append(root)
        low.append((mine, proofs, steps))
    root, tops, top_steps = _climb(subs)
    out = []
    for (mine, proofs, steps), sub, top, more in zip(low, subs, tops, top_steps):
        for r, p, st in zip(mine, proofs, steps):
            tampers = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            now = _leaf([*r[:4], r[4].replace("\n", "")]) if tampers else _leaf(r)
            for place, others in st + more:
                now = _h([*others[:place], now, *others[place:]])
            out.append((r[0], _leaf(r), sub, root, _h(p + top), now, now == root))
    return sorted(out, key=repr)


def _run(spark, rows, parts=5):
    docs = spark.createDataFrame([(*r, *["clash"] * 6) for r in rows], SCHEMA).repartition(parts)
    got = merkle.verified(merkle.manifest(docs, changed=merkle.tampered(F.col("doc_id"), F.col("text"))))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def _docs(n, source, first=0):
    return [(first + i, source, "en", i, f"text {i}\nmore") for i in range(n)]


EDGE = [(1, "a", "en", 3, "x\ny"), (2, "a", None, None, None), (3, None, "de", 0, ""), (None, None, None, None, None),
        (None, "a", "en", 1, "q"), (None, "a", "en", 1, "q"), (4, "b", "en", 5, "one leaf"), (5, "é", "en", 1, "é\n\n" * 300_000),
        (6, "", "en", 1, "empty source"), (7, "-", "en", 1, "dash"), (7, "-", "en", 1, "dash"), (7, "-", "en", 1, "other"), (8, "Z", "", -4, "\n")]


@pytest.mark.parametrize("rows", [EDGE, _docs(1, "a"), _docs(3, None), _docs(4, "a"), _docs(28, "a") + _docs(2, "b", 50),
                                  [(i, f"s{i % 40}", "en", i, f"{i}\n") for i in range(200)]], ids=range(6))
def test_manifest_by_brute_force(spark, rows):
    assert _run(spark, rows) == _brute(rows)


def test_trees_of_several_chunks(spark):
    """A hot source of more than 3^5 leaves, so several rounds, beside small ones."""
    rng = random.Random(2)
    rows = _docs(900, "hot") + [(10_000 + i, rng.choice(["a", "b", None]), "en", i, f"{i}\n") for i in range(250)]
    rng.shuffle(rows)
    assert _run(spark, rows) == _brute(rows)


def test_jumps_by_shuffle(spark):
    """With no broadcast allowed, every jump is a shuffled self-join; the proofs are the same."""
    rows = spark.range(400).select(F.lit("t").alias("tree"), F.col("id").alias("idx"), F.lit(400).cast("long").alias("n"),
                                   F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    rows = rows.withColumn("leaf", F.col("digest"))
    links, roots, height = merkle.trees(rows, ["leaf"])
    root, want, _ = _climb([hashlib.sha256(str(i).encode()).hexdigest() for i in range(400)])
    assert height == 6 and [r.digest.hex() for r in roots.collect()] == [root]
    for bound in (0, 1 << 14):
        got = {r.idx: r for r in merkle.proofs(links, height, bound).collect()}
        assert {i: r.sibs.hex() for i, r in got.items()} == {i: "".join(w) for i, w in enumerate(want)}
        assert {merkle.fold(r.leaf.hex(), r.path, r.sibs) for r in got.values()} == {root}


def test_empty(spark):
    assert _run(spark, [], 1) == []

"""Exact dedup (11): filters against plain counting, groups against brute force, edge rows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsieve.llm import exactdedup, quotient, skew

SCHEMA = "doc_id long, text string, fp string, sha string, n string, keep_id string, body string, uid string"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, *["clash"] * 6) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 20000])
def test_filter_gives_back_what_it_counted(n):
    rng = np.random.default_rng(n)
    fps = np.unique(rng.integers(0, 1 << 58, n, dtype=np.uint64) | np.uint64(5 << 58))
    counts = rng.integers(1, 4, len(fps))
    counts[:4] = [1 << 40, 1 << 16, 257, 2][: len(fps)]
    data = quotient.build(fps, counts, 6)
    got, times = quotient.decode(data, 5, 6)
    assert (got == fps).all() and (times == counts).all()
    for i in range(0, len(fps), 97):
        assert quotient.count(data, int(fps[i]), 6) == counts[i]
        assert quotient.count(data, int(fps[i]) ^ (1 << 20), 6) == (counts[fps == fps[i] ^ np.uint64(1 << 20)].sum())


def test_filter_with_crowded_homes():
    """All fingerprints at a few homes: runs are pushed on beyond the last home slot."""
    fps = np.sort(np.concatenate([np.arange(500, dtype=np.uint64), np.uint64(2**64 - 1) - np.arange(500, dtype=np.uint64)]))
    counts = np.arange(1, 1001)
    got, times = quotient.decode(quotient.build(fps, counts, 0), 0, 0)
    assert (got == fps).all() and (times == counts).all()


def test_filters_merge_as_plain_counting(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.getrandbits(64) - 2**63, 7, -9]) for _ in range(5000)]
    rows = spark.createDataFrame([(v,) for v in values], "fp long").repartition(7)
    merged = exactdedup.filters(rows, 7, task_rows=300)
    assert merged.count() == merged.select("shard").distinct().count()
    want = {v: n for v, n in zip(*np.unique(values, return_counts=True)) if n > 1}
    assert {r.fp: r.n for r in exactdedup.repeated(merged, 7).collect()} == want


def _brute(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    key = lambda i: (i is not None, i)
    out = []
    for text, ids in groups.items():
        keep, left = max(ids, key=key), True
        for i in sorted(ids, key=key, reverse=True):
            out.append((i, keep, len(ids), i == keep and left, hashlib.sha256(text.encode()).hexdigest()))
            left = left and i != keep
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


EDGE = [(1, "Same Text"), (2, "same text"), (3, "same text "), (4, None), (5, ""), (None, "same TEXT"), (None, "alone"),
        (None, "twice"), (None, "Twice"), (6, "É"), (7, "é"), (8, "x" * 3_000_000), (9, "X" * 3_000_000), (10, "row"), (10, "row"),
        (10, "ROW"), (11, "row"), (12, "tie"), (12, "tie"), (13, "İ"), (14, "i̇")]


@pytest.mark.parametrize("bits", [64, 4, 1])
def test_groups_by_brute_force(spark, bits):
    """Also with fingerprints of a few bits, where bytes alone tell texts apart."""
    rng = random.Random(11)
    rows = EDGE + [(100 + i, " ".join(rng.choice("aAbB") for _ in range(rng.randrange(4)))) for i in range(300)]
    assert _rows(exactdedup.exact_groups(_frame(spark, rows).repartition(5), bits)) == _brute(rows)


def test_empty_and_hot(spark):
    assert exactdedup.exact_groups(_frame(spark, [])).collect() == []
    rows = [(i, "hot" if i % 3 else f"text {i}") for i in range(3000)]
    assert _rows(exactdedup.exact_groups(_frame(spark, rows).repartition(6))) == _brute(rows)


def test_spread_join(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left"):
        got = sorted(map(repr, skew.spread_join(left, right, ["k"], how, hot=10).collect()))
        assert got == sorted(map(repr, left.join(right, ["k"], how).select("k", "v", "w").collect()))

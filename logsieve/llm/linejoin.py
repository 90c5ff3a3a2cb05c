"""Line deduplication with a segment-partition edit join.

Lines (split at line feeds, blank ones left out) that are equal are one class, standing for all its copies.
Two classes are linked if their lines are at most `threshold` character edits apart. A line of n characters
is cut into threshold + 1 segments; a line within the threshold must hold one of them unchanged, near its
place. So each line is indexed by (length, segment number, segment), and probes, for each length that is up to
`threshold` shorter than its own, only the substrings that can be aligned with a segment when errors to the
left and to the right are both counted (12 substrings for threshold 2).

Index and probe meet in one equi-join. Its condition also compares a 64-bit parity signature of the lines'
character pairs: an edit changes at most four pairs, so signatures of linked lines differ in at most
4 * threshold bits, which spares the pairs that merely share a segment. What is left is verified by banded
bit-parallel edit distance.

Classes are named by the 64-bit hash of their line (xxhash64).

Defined cases: null and empty texts have no lines; a carriage return before the line feed is part of the line;
lines of at most `threshold` characters are only joined with equal ones (any
two of them are that few edits apart); null doc_ids come first; repeated rows are
copies of each other's lines; an empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import _BASE, _BASE_INV, _powers, mix, written

THRESHOLD = 2
_U = np.uint64
#: characters hashed at a time in a task, at least one line
BLOCK_CHARS = 1 << 20


def cuts(n: np.ndarray, threshold: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Starts and lengths of the threshold + 1 segments of lines of n characters, the last ones longer by one."""
    k = threshold + 1
    short, extra = n // k, n % k
    size = [short + (i >= k - extra) for i in range(k)]
    start = [sum(size[:i], np.zeros_like(n)) for i in range(k)]
    return start, size


def line_keys(lines: list[str], threshold: int):
    """(index rows, probe rows, signatures): rows as (line number, 64-bit key) arrays."""
    n = np.array([len(x) for x in lines], np.int64)
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    off = np.concatenate([[0], np.cumsum(n)])
    value = mix(code + _U(1)) | _U(1)
    total = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(value * _powers(_BASE, len(code)), out=total[1:])
    back = _powers(_BASE_INV, len(code) + 1)

    def key(line, start, size, length, i):
        at = off[line] + start
        h = (total[at + size] - total[at]) * back[at]
        return mix(h + length.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(i + 1) * _U(0xC2B2AE3D27D4EB4F))

    every = np.arange(len(lines))
    index, probe = [], []
    start, size = cuts(n, threshold)
    for i in range(threshold + 1):
        index.append((every, key(every, start[i], size[i], n, i)))
    for less in range(threshold + 1):
        other = n - less
        start, size = cuts(other, threshold)
        for i in range(threshold + 1):
            lo = np.maximum(start[i] - i, start[i] + less - (threshold - i))
            hi = np.minimum(start[i] + i, start[i] + less + (threshold - i))
            for shift in range(2 * threshold + 1):
                s = lo + shift
                ok = np.flatnonzero((s <= hi) & (s >= 0) & (s + size[i] <= n) & (other > threshold))
                if len(ok):
                    probe.append((ok, key(ok, s[ok], size[i][ok], other[ok], i)))
    pair = np.zeros(len(code), np.uint64)
    if len(code) > 1:
        pair[:-1] = _U(1) << (mix(value[:-1] * _U(31) + value[1:]) >> _U(58))
    pair[off[1:] - 1] = 0  # a line's last character begins no pair
    sig = np.bitwise_xor.reduceat(pair, off[:-1])
    flat = lambda rows: tuple(np.concatenate(x) for x in zip(*rows))
    return flat(index), flat(probe), sig


def edit_distance(a: str, b: str, threshold: int) -> int:
    """The edit distance of a and b, or threshold + 1 if it's larger: bit-parallel over a band of
    2 * threshold + 1 diagonals, after the common beginning and end are cut off."""
    head = len(os.path.commonprefix((a, b)))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    m, n, t = len(a), len(b), threshold
    if abs(m - n) > t:
        return t + 1
    if not m or not n:
        return max(m, n)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    width = 2 * t + 1
    full = (1 << width) - 1
    # Column 0 of a band over rows -t .. t: as if t equal characters had come before.
    vn, vp = (1 << (t + 1)) - 1, full ^ ((1 << (t + 1)) - 1)
    score = 0
    for j, c in enumerate(b):
        # the band moves down a row: bit r is row j + 1 - t + r of a, counted from 1
        vp, vn = vp >> 1 | 1 << (width - 1), vn >> 1
        eq = where.get(c, 0)
        low = j - t
        eq = (eq >> low if low >= 0 else eq << -low) & full
        d0 = (((eq & vp) + vp) ^ vp) & full | eq | vn
        hp = (vn | ~(d0 | vp)) & full
        hn = vp & d0
        score += 1 - (d0 >> t & 1)
        hp, hn = (hp << 1 | 1) & full, hn << 1 & full
        vp, vn = (hn | ~(d0 | hp)) & full, hp & d0
        if score > 2 * t:
            return t + 1
    for r in range(t + 1, t + 1 + m - n):
        score += (vp >> r & 1) - (vn >> r & 1)
    for r in range(t + 1 + m - n, t + 1):
        score -= (vp >> r & 1) - (vn >> r & 1)
    return min(score, t + 1)


# ------------------------------------------------------------------ Spark

def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), line of all lines that aren't blank."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .where(F.col("line").rlike(r"[^\s]")))


def line_classes(docs: DataFrame) -> DataFrame:
    """line, lh, n_copies and first (doc_id, line_no) of each distinct line."""
    return (lines_of(docs).groupBy("line").agg(F.count("*").alias("n_copies"), F.min(F.struct("doc_id", "line_no")).alias("first"))
            .withColumn("lh", F.xxhash64("line")))


def _keys(threshold: int, probes: bool):
    def run(batches):
        for batch in batches:
            lines = batch.column("line").to_pylist()
            ids = batch.column("lh").to_numpy(zero_copy_only=False)
            size, first = 0, 0
            for i in range(len(lines)):
                size += len(lines[i])
                if size >= BLOCK_CHARS or i == len(lines) - 1:
                    index, probe, sig = line_keys(lines[first : i + 1], threshold)
                    row, key = probe if probes else index
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[first : i + 1][row]),
                                                      pa.array(sig.view(np.int64)[row])], names=["key", "lh", "sig"])
                    size, first = 0, i + 1
    return run


def _verify(threshold: int):
    def run(batches):
        for batch in batches:
            keep = [edit_distance(x, y, threshold) <= threshold
                    for x, y in zip(batch.column("la").to_pylist(), batch.column("lb").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def linked_lines(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of class names (lh), a < b, whose lines are at most threshold edits apart."""
    long = classes.where(F.char_length("line") > threshold).select("lh", "line")
    schema = "key long, lh long, sig long"
    index = long.mapInArrow(_keys(threshold, False), schema).toDF("key", "a", "sa")
    probe = long.mapInArrow(_keys(threshold, True), schema).toDF("_k", "b", "sb")
    met = index.join(probe, (F.col("key") == F.col("_k")) & (F.col("a") != F.col("b"))
                     & (F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= 4 * threshold))
    pairs = written(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "met")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("_w")).distinct()
    text = written(long.join(wanted, F.col("lh") == F.col("_w"), "left_semi"), "wanted")
    side = lambda x: text.select(F.col("lh").alias(f"_{x}"), F.col("line").alias(f"l{x}"))
    both = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
    return both.select("a", "b", "la", "lb").mapInArrow(_verify(threshold), "a long, b long").distinct()


def deduplicated_lines(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row for each line: doc_id, line_no, its class's first place (first_doc_id, first_line_no), n_copies,
    n_links (classes within the threshold) and kept: it is its class's first, and no linked class comes earlier."""
    classes = written(line_classes(docs), "classes")
    links = written(linked_lines(classes, threshold), "links")
    first = classes.select(F.col("lh").alias("_l"), "first")
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    summed = (ends.join(first, F.col("b") == F.col("_l")).groupBy("a")
              .agg(F.count("*").alias("n_links"), F.min("first").alias("earliest")))
    info = classes.select("lh", "n_copies", "first").join(summed, F.col("lh") == F.col("a"), "left")
    info = info.select(F.col("lh").alias("_l"), "n_copies", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                       F.coalesce(F.col("earliest") < F.col("first"), F.lit(False)).alias("late"))
    rows = lines_of(docs).select("doc_id", "line_no", F.xxhash64("line").alias("lh"))
    return (rows.join(info, F.col("lh") == F.col("_l"))
            .select("doc_id", "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"),
                    "n_copies", "n_links",
                    ((F.struct("doc_id", "line_no") == F.col("first")) & ~F.col("late")).alias("kept")))


def query(spark, sf_dir: str) -> DataFrame:
    return deduplicated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))

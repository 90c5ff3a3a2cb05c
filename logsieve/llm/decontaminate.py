"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over SPAN consecutive words; a window's hash covers the words where the mask
is 1 and ignores the others, so a replaced word leaves the hash alone wherever it falls on a 0.
Hashes of all test windows and all training windows under each mask are joined; around each hit the
document is laid against the test item at the hit's offset and the overlap is verified word by word,
replacements allowed. Where test items end, words beyond the document count as different.

A document is contaminated by an item if, at some offset, at least `percent` of the item's words
stand in the document at their places (items below SPAN words must match whole). With the default
masks, each of which ignores another word of five, no such overlap of 80% or more is missed: however
the replaced words lie, one in five at most, some five consecutive words hold at most one of them
(words of an item that reach out of the document count as replaced).

With `passage` words given (the query and the pipeline give PASSAGE), two more kinds of overlap count for items
of SPAN words and more, whatever the item's length:

* a passage: of some `passage` consecutive words of the item (all, where it is shorter) at least `percent`
  stand in the document in place. No such passage at one offset is missed, for the same reason as above;
* joined stretches: the same for a passage or for the whole item, where words were put in or left out: the
  passage may go on at another of the item's hits whose offset differs by GAP words or less, forward in both.
  A stretch too short for any seed (four words of five) joins nothing.

The benchmark is a stated query set: it is sent to all tasks in blocks of at most BLOCK_HASHES hashes
(16 bytes each), and each block meets all documents in one pass, so its size is bounded whatever the
benchmark's. Items are found once per text: equal item texts share their hashes.

Defined cases: null, empty or blank items match nothing; null or empty documents are clean; a null
doc_id or item_id is carried along; repeated items each count; repeated documents each have rows; an
empty benchmark or document table gives no hits. Other columns are not looked at.
"""

from __future__ import annotations

from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import SMALL_BLOCK, blocks, mix, text_bytes, word_hashes, word_spans, worker_cache, written

#: Fixed masks, 1: the word counts. Each word of a window is ignored by one of them.
MASKS = ("01111", "10111", "11011", "11101", "11110")
SPAN = 5
PERCENT = 80
#: words of an item that make a passage of it
PASSAGE = 13
#: words put in or left out between two stretches that are joined
GAP = 3
BLOCK_HASHES = 1 << 20
#: joined pairs of windows listed at a time in a task
HITS_AT_ONCE = 1 << 21
_U = np.uint64
_SALT = np.random.default_rng(11).integers(1, 2**63, size=64, dtype=np.uint64) * _U(2) + _U(1)

HITS = "doc_id long, item_id long, first_word long, n_words long, n_matched long"


def seed_hashes(words: np.ndarray, mask: str, which: int) -> np.ndarray:
    """Hash of each window of len(mask) words under the mask."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, which + 1, np.uint64) * _SALT[63]
    for j, bit in enumerate(mask):
        if bit == "1":
            acc += words[j : j + n] * _SALT[j]
    return mix(acc)


def _masks(span: int, masks) -> list[tuple[int, str]]:
    return [(i, m) for i, m in enumerate(masks)] if span == SPAN else [(len(masks) + span, "1" * span)]


class Items:
    """A block of test items: their words, and their windows' hashes in order."""

    def __init__(self, rows: list[tuple[int | None, str | None]], masks=MASKS):
        self.ids = [i for i, _ in rows]
        data, off = text_bytes(pa.array([t for _, t in rows], pa.string()))
        start, end, row = word_spans(data, off)
        h = word_hashes(data, start, end)
        bounds = np.searchsorted(row, np.arange(len(rows) + 1))
        self.words = [h[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        self.masks = masks
        # words per window: SPAN, or the whole item where it is shorter
        self.spans = sorted({min(len(w), SPAN) for w in self.words if len(w)})
        keys, item, at = [], [], []
        for i, w in enumerate(self.words):
            if not len(w):
                continue
            for which, mask in _masks(min(len(w), SPAN), masks):
                got = seed_hashes(w, mask, which)
                keys.append(got)
                item.append(np.full(len(got), i))
                at.append(np.arange(len(got)))
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        keys, item, at = cat(keys, np.uint64), cat(item, np.int64), cat(at, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.item, self.at = keys[order], item[order], at[order]
        # a bit per leading 20 bits spares most windows the search
        self.some = np.zeros(1 << 20, bool)
        self.some[(self.keys >> _U(44)).astype(np.int64)] = True

    def hits(self, words: np.ndarray, row: np.ndarray):
        """Arrays of distinct (row, item, place of the item's first word in `words`) of all joined pairs of windows, in
        order, each of some items: as many as have HITS_AT_ONCE pairs, or one item."""
        met, starts = [], np.zeros(len(self.keys) + 1, np.int64)
        for span in self.spans:
            for which, mask in _masks(span, self.masks):
                h = seed_hashes(words, mask, which)
                at = np.flatnonzero(self.some[(h >> _U(44)).astype(np.int64)])
                at = at[row[at] == row[at + span - 1]]
                lo, hi = np.searchsorted(self.keys, h[at], "left"), np.searchsorted(self.keys, h[at], "right")
                at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
                met.append((at, lo, hi))
                starts += np.bincount(lo, minlength=len(starts)) - np.bincount(hi, minlength=len(starts))
        pairs = np.cumsum(np.bincount(self.item, np.cumsum(starts)[:-1], minlength=len(self.words)).astype(np.int64))
        first = 0
        while first < len(pairs) and pairs[-1] > (pairs[first - 1] if first else 0):
            before = pairs[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(pairs, before + HITS_AT_ONCE, "right")))
            kept = np.flatnonzero((self.item >= first) & (self.item < last))
            found = []
            for at, lo, hi in met:
                lo, hi = np.searchsorted(kept, lo), np.searchsorted(kept, hi)
                n = hi - lo
                k = kept[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                at = np.repeat(at, n)
                found.append(np.stack([row[at], self.item[k], at - self.at[k]], axis=1))
            yield np.unique(np.concatenate(found), axis=0)
            first = last


def overlap(item: np.ndarray, doc: np.ndarray, offset: int) -> np.ndarray:
    """Which of the item's words the document has at their places when laid at the offset."""
    same = np.zeros(len(item), bool)
    a, b = max(0, -offset), min(len(item), len(doc) - offset)
    if a < b:
        same[a:b] = item[a:b] == doc[offset + a : offset + b]
    return same


def joined(item: np.ndarray, doc: np.ndarray, offsets: np.ndarray, length: int) -> int:
    """The most of any `length` consecutive item words that the document has in order, each stretch at one of the
    (sorted) offsets, which change by GAP at most from stretch to stretch."""
    k, best = len(offsets), 0
    starts = len(item) - length + 1
    # an offset's neighbours as columns; k: there is none
    near = {d: np.searchsorted(offsets, offsets + d) for d in range(-GAP, GAP + 1) if d}
    near = {d: np.where((i < k) & (offsets[np.minimum(i, k - 1)] == offsets + d), i, k) for d, i in near.items()}
    step = max(1, (1 << 22) // (k + 1))
    for low in range(0, starts, step):
        begin = np.arange(low, min(low + step, starts))
        before: list[np.ndarray] = []  # most matched up to each of the last words; the last column is for no neighbour
        for t in range(length):
            at = (begin + t)[:, None] + offsets[None, :]
            inside = (at >= 0) & (at < len(doc))
            same = inside & (doc[np.where(inside, at, 0)] == item[begin + t][:, None])
            most = np.zeros((len(begin), k + 1), np.int32)
            if before:
                most[:, :k] = before[-1][:, :k]
            for d in range(1, GAP + 1):
                if len(before) > 0:  # d words of the document are put in
                    most[:, :k] = np.maximum(most[:, :k], before[-1][:, near[-d]])
                if len(before) > d:  # d words of the item are left out
                    most[:, :k] = np.maximum(most[:, :k], before[-1 - d][:, near[d]])
            most[:, :k] += same
            before = [*before[-GAP:], most]
        best = max(best, int(before[-1].max()))
    return best


def _passage(same: np.ndarray, length: int) -> int:
    """The most of any `length` consecutive words that are the same."""
    total = np.concatenate([[0], np.cumsum(same)])
    return int((total[length:] - total[:-length]).max())


def _best(items: Items, data: np.ndarray, off: np.ndarray, percent: int, passage: int | None) -> dict:
    """(row, number of the item) -> (words of it that stand in the row, offset) for the items that contaminate rows."""
    start, end, row = word_spans(data, off)
    n_rows = len(off) - 1
    # a word that equals none stands before and after each row: items may reach one word out in a window
    place = np.arange(len(row)) + 2 * row + 1
    words = np.zeros(len(row) + 2 * n_rows, np.uint64)
    words[place] = word_hashes(data, start, end)
    row = np.repeat(np.arange(n_rows), np.bincount(row, minlength=n_rows) + 2)
    first = np.searchsorted(row, np.arange(n_rows + 1)) + 1
    best: dict[tuple[int, int], tuple[int, int]] = {}
    found_pairs = chain.from_iterable(h.tolist() for h in items.hits(words, row))
    for (r, i), group in groupby(found_pairs, key=lambda x: (x[0], x[1])):
        item, doc = items.words[i], words[first[r] : first[r + 1] - 2]
        offsets = [at - int(first[r]) for _, _, at in group]
        length = min(passage or 0, len(item)) if len(item) >= SPAN else 0
        most, where, found = 0, 0, False
        for at in offsets:
            same = overlap(item, doc, at)
            n = int(same.sum())
            enough = n == len(item) if len(item) < SPAN else 100 * n >= percent * len(item)
            if length and not enough:
                enough = 100 * _passage(same, length) >= percent * length
            if (enough, n) > (found, most):
                most, where, found = n, at, enough
        if length and not found and len(offsets) > 1 and (np.diff(offsets) <= GAP).any():
            known = np.array(offsets)
            total = joined(item, doc, known, len(item))
            if 100 * total >= percent * len(item) or 100 * joined(item, doc, known, length) >= percent * length:
                most, found = total, True
        if found:
            best[r, i] = (most, where)
    return best


def _search(items: Items, percent: int, passage: int | None):
    def run(batches):
        worker_cache(None, None)
        for batch, data, off in blocks(batches, size=SMALL_BLOCK):
            best = _best(items, data, off, percent, passage)
            if best:
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[r], items.ids[i], at, len(items.words[i]), n)
                        for (r, i), (n, at) in sorted(best.items())]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "item_id", "first_word", "n_words", "n_matched"])
    return run


def item_blocks(benchmark: DataFrame, block_hashes: int = BLOCK_HASHES, masks=MASKS):
    """Blocks of test items with at most so many window hashes (or one item), streamed to the driver."""
    rows, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        n = len(masks) * (len((r.text or "").encode().split()) + 1)  # windows start at words; bytes split at ASCII white space
        if rows and size + n > block_hashes:
            yield Items(rows, masks)
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += n
    if rows:
        yield Items(rows, masks)


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, masks=MASKS,
                 passage: int | None = None) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_matched: the best overlap of each document with each item in it.

    first_word and n_matched are of the whole item laid at one offset or, where only joined stretches are enough,
    its best stretch's offset and the words of all joined stretches.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for block in item_blocks(benchmark, masks=masks):
        # written, so that one block of items is held at a time
        part = written(d.mapInArrow(_search(block, percent, passage), HITS), "hits")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], HITS)


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, passage: int | None = None) -> DataFrame:
    """The rows of documents, all columns kept, whose doc_id no item contaminates: every row of such an id goes,
    whatever its text. `clean_rows` decides row by row."""
    bad = contaminated(docs, benchmark, percent, passage=passage).select(F.col("doc_id").alias("_bad"))
    return docs.join(bad.distinct(), docs["doc_id"].eqNullSafe(F.col("_bad")), "left_anti")


def _untouched(items: Items, percent: int, passage: int | None):
    def run(batches):
        worker_cache(None, None)
        for batch, data, off in blocks(batches, size=SMALL_BLOCK):
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, _ in _best(items, data, off, percent, passage)]] = False
            if keep.any():
                yield batch if keep.all() else batch.filter(pa.array(keep))
    return run


def clean_rows(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, passage: int | None = None) -> DataFrame:
    """The rows of docs, all columns kept, whose own text no item contaminates, whatever their doc_ids.

    One pass for each block of items, on what the one before it kept; passes are written, so that one is run at a time.
    """
    out = None
    for block in item_blocks(benchmark):
        out = docs if out is None else written(out, "clean")
        out = out.mapInArrow(_untouched(block, percent, passage), docs.schema)
    return docs if out is None else out


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                        passage=PASSAGE)

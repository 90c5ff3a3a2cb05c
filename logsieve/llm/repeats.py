"""Exact repeats of MIN_LENGTH bytes and more, from the common-prefix intervals of suffix arrays.

The suffixes of a whole corpus are split so that each part can be sorted in one task. Every window of
MIN_LENGTH bytes has an anchor, the GRAM-byte string with the smallest hash in it, which depends on the
window's bytes alone: equal windows have equal anchors. A document is cut into segments, maximal runs of
windows with one anchor; segments whose anchor string occurs once in the corpus have no repeats and go no
further. The others meet by anchor, and their suffixes form one enhanced suffix array per part: sorted
suffixes with the lengths of their common prefixes.

Only intervals of MIN_LENGTH common bytes and more matter, so suffixes are first classed by their first
MIN_LENGTH bytes (64-bit rolling hashes) and sorted by what follows. A class whose occurrences all have
the same byte to the left is only the tail of a longer repeat and is left out at once; in the others a
stack scan yields the interval tree, and intervals whose occurrences differ to the left are maximal
repeat groups. A segment's first window counts as different to the left, so repeats that reach over
several segments are found in each of them, and their pieces join.

Of equal texts of MIN_LENGTH bytes and more only the first is looked at: the others repeat it whole, so they are removed
whole, and what repeats one of them repeats the first.

An anchor that more than HOT segments share is not sorted in one task: its windows are matched singly,
by their hashes, with partial aggregation and joins.

Defined cases: a null or empty text has no bytes; texts below MIN_LENGTH bytes have no repeats; rows
with equal doc_id and text are one document; rows with equal doc_id and different texts are told apart, and
ordered, by a 64-bit hash of the text (`tag`, 0 where a doc_id has one text); a null doc_id comes before all others; an empty table gives no rows. Columns other
than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import _BASE, _BASE_INV, _BYTE_HASH, _powers, blocks, mix, text_bytes, written
from .skew import spread_join

MIN_LENGTH = 100
GRAM = 20
HOT = 20_000
#: segment bytes sorted at a time in a task, at least one anchor's
ARRAY_BYTES = 1 << 20
#: bytes of segments taken from their texts at a time
SLICE_BYTES = 1 << 19
_U = np.uint64
_NO_ID = -(1 << 63)
_LEAF = 1 << 62


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` bytes from each place on."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_HASH[data] * _powers(_BASE, n), out=total[1:])
    return mix((total[length:] - total[:-length]) * _powers(_BASE_INV, n)[: n - length + 1])


def segments(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """(row, first window's offset in its row, windows, anchor hash) of each segment of the rows."""
    h = rolling(data, gram)
    spans = np.diff(off)
    if not (spans >= length).any():
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    # the smallest hash of each window, of equal ones the first
    least, have = (h & ~_U(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64), 1
    while have < length - gram + 1:
        step = min(have, length - gram + 1 - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    inside = np.zeros(len(data) + 1, np.int64)
    long = spans >= length
    np.add.at(inside, off[:-1][long], 1)
    np.add.at(inside, (off[1:] - length + 1)[long], -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    anchor = (least[at] & _U(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(off[1:], at, "right")
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    return row[first], at[first] - off[row[first]], count, h[anchor[first]]


def scan(lcp: list[int], left: list[int], visit) -> None:
    """The common-prefix interval tree of one class, by a stack scan, children before their parents.

    lcp[i] is of suffixes i - 1 and i, left their left bytes (-1: differs from all). visit(first, last,
    depth, open) is called for each interval whose left bytes differ; open holds the members that no
    interval below has closed, and what visit returns stays open for the intervals above.
    """
    stack: list[list] = []  # depth, first, lowest and highest left byte, open members
    for i in range(len(left) + 1):
        depth = lcp[i] if 0 < i < len(left) else -1
        node = None
        while stack and stack[-1][0] > depth:
            d, first, low, high, members = stack.pop()
            if d < _LEAF and (low == -1 or low != high):
                members = visit(first, i - 1, d, members)
            if node:
                low, high, members = min(low, node[2]), max(high, node[3]), members + node[4]
            if stack and stack[-1][0] >= depth:  # its parent is on the stack
                up = stack[-1]
                up[2], up[3], up[4] = min(up[2], low), max(up[3], high), up[4] + members
                node = None
            else:
                node = [depth, first, low, high, members]
                break
        if node and depth >= 0:
            stack.append(node)
        if i < len(left):
            stack.append([_LEAF, i, left[i], left[i], [i]])


class Suffixes:
    """The enhanced suffix array of a block of segments: (doc, place, bytes) each, in any order."""

    def __init__(self, doc: np.ndarray, place: np.ndarray, data: np.ndarray, size: np.ndarray, length: int = MIN_LENGTH):
        """data: the segments' bytes, one after another; size: how many each has."""
        self.length = length
        end = np.cumsum(size)
        windows = size - length + 1
        seg = np.repeat(np.arange(len(size)), windows)
        inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (end - size)[seg] + inner
        h = rolling(data, length)[at]
        order = np.argsort(h, kind="stable")
        h, at, seg, inner = h[order], at[order], seg[order], inner[order]
        start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        count = np.diff(np.append(start, len(h)))
        # left bytes; a segment's first window differs from all
        left = np.where(inner > 0, data[np.maximum(at - 1, 0)].astype(np.int64), -1)
        low, high = np.minimum.reduceat(left, start), np.maximum.reduceat(left, start)
        keep = np.repeat((count > 1) & ((low == -1) | (low != high)), count)
        at, seg, left = at[keep], seg[keep], left[keep]
        cls = np.repeat(np.arange(len(start)), count)[keep]
        # what follows the first bytes, up to the segment's end
        more = end[seg] - at - length
        width = int(more.max(initial=0)) + 1
        padded = np.concatenate([data, np.zeros(length + width, np.uint8)])
        tail = np.lib.stride_tricks.sliding_window_view(padded, width)[at + length].astype(">u2") + 1
        tail[np.arange(width) >= more[:, None]] = 0  # the segment's end comes before any byte
        tail = tail.astype(">u2")
        order = np.lexsort((tail.view(f"S{2 * width}").ravel(), cls))
        self.cls, self.left = cls[order], left[order]
        self.doc, self.place = doc[seg[order]], place[seg[order]] + at[order] - (end - size)[seg[order]]
        tail, more = tail[order], more[order]
        self.lcp = np.full(len(order), -1)
        if len(order) > 1:
            same = tail[1:] == tail[:-1]
            common = np.where(same.all(axis=1), width, same.argmin(axis=1))
            self.lcp[1:] = np.where(self.cls[1:] == self.cls[:-1], np.minimum(common, np.minimum(more[1:], more[:-1])), -1)

    def _classes(self):
        edges = np.flatnonzero(np.append(True, self.cls[1:] != self.cls[:-1])) if len(self.cls) else np.zeros(0, np.int64)
        return edges, np.append(edges[1:], len(self.cls))

    def groups(self) -> list[tuple[int, list[int]]]:
        """Maximal repeat groups: (length, all occurrences as indices)."""
        out, (begin, end) = [], self._classes()
        lcp, left = self.lcp.tolist(), self.left.tolist()
        for a, b in zip(begin.tolist(), end.tolist()):
            def visit(first, last, depth, members):
                out.append((self.length + depth, list(range(a + first, a + last + 1))))
                return members
            scan(lcp[a:b], left[a:b], visit)
        return out

    def covered(self) -> np.ndarray:
        """How many bytes each occurrence covers as a repeat of an earlier one: the length of the deepest
        maximal group in which it isn't the first (0: it's the first in all)."""
        out, (begin, end) = np.zeros(len(self.cls), np.int64), self._classes()
        # classes of two are one interval each
        two = begin[end - begin == 2]
        later = (self.doc[two] > self.doc[two + 1]) | ((self.doc[two] == self.doc[two + 1]) & (self.place[two] > self.place[two + 1]))
        same = (self.doc[two] == self.doc[two + 1]) & (self.place[two] == self.place[two + 1])
        out[np.where(later, two, two + 1)[~same]] = self.length + self.lcp[two + 1][~same]
        more = end - begin > 2
        lcp, left, doc, place = (x.tolist() for x in (self.lcp, self.left, self.doc, self.place))
        for a, b in zip(begin[more].tolist(), end[more].tolist()):
            def visit(first, last, depth, members):
                at = [(doc[a + i], place[a + i]) for i in members]
                least = min(at)
                for i, x in zip(members, at):
                    if x > least:
                        out[a + i] = self.length + depth
                return [members[at.index(least)]]
            scan(lcp[a:b], left[a:b], visit)
        return out


# ------------------------------------------------------------------ Spark

def _anchors(batches):
    for batch, data, off in blocks(batches):
        row, first, n, h = segments(data, off, MIN_LENGTH, GRAM)
        if len(row):
            did, tag = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("did", "tag"))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(did), pa.array(tag), pa.array(first),
                                              pa.array(n.astype(np.int32))], names=["h", "did", "tag", "place", "n"])


def _slices(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    """The stretches of `size` bytes from `first` on, as binaries."""
    ends = np.concatenate([[0], np.cumsum(size)])
    out, i = np.empty(ends[-1], np.uint8), 0
    while i < len(size):  # some at a time: a place takes 8 bytes
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + SLICE_BYTES, "right")) - 1)
        at = np.repeat(first[i:j] - ends[i:j], size[i:j]) + np.arange(ends[i], ends[j])
        out[ends[i] : ends[j]] = data[at]
        i = j
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)])


def _segment_bytes(single: bool):
    """Rows of documents with the list `segs` of their shared segments -> the segments' bytes, or, singly, window hashes."""
    def run(batches):
        for batch, data, off in blocks(batches):
            segs = batch.column("segs")
            ends = segs.offsets.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            h, place, n = (segs.flatten().field(c).to_numpy() for c in ("h", "place", "n"))
            if not len(h):
                continue
            if single:
                whole = rolling(data, MIN_LENGTH).view(np.int64)
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row, place = np.repeat(row, n), np.repeat(place, n) + inner
                cols = [whole[off[row] + place]]
            else:
                cols = [h]
            cols += [batch.column(c).to_numpy()[row] for c in ("did", "tag")]
            out = [pa.array(x) for x in [*cols, place.astype(np.int64)]]
            names = ["h", "did", "tag", "place"]
            if not single:
                out.append(_slices(data, off[row] + place, n.astype(np.int64) + MIN_LENGTH - 1).cast(pa.binary()))
                names.append("raw")
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def _array_blocks(batches):
    """Blocks of whole anchors' segments from rows in order of h."""
    held, size = [], 0
    for batch in batches:
        h = batch.column("h").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)]
        lengths = batch.column("raw").cast(pa.large_binary()).buffers()[1]
        lengths = np.frombuffer(lengths, np.int64)[: batch.num_rows + 1] if lengths is not None else np.zeros(1, np.int64)
        for a, b in zip(cuts, cuts[1:]):
            if size >= ARRAY_BYTES and held[-1].column("h")[-1].as_py() != int(h[a]):
                yield held
                held, size = [], 0
            if b > a:
                held.append(batch.slice(a, b - a))
                size += int(lengths[b] - lengths[a])
    if held:
        yield held


def _suffixes(batches):
    for held in _array_blocks(batches):
        col = lambda c: np.concatenate([b.column(c).to_numpy() for b in held])
        # documents (did, tag) by their rank in the block
        did, tag = col("did"), col("tag")
        order = np.lexsort((tag, did))
        d, t = did[order], tag[order]
        new = np.append(True, (d[1:] != d[:-1]) | (t[1:] != t[:-1]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        raw = [text_bytes(b.column("raw").cast(pa.large_binary()).view(pa.large_string())) for b in held]
        data, size = np.concatenate([r[0] for r in raw]), np.concatenate([np.diff(r[1]) for r in raw])
        yield Suffixes(rank, col("place"), data, size), d[new], t[new]


def _cover_rows(batches):
    for s, did, tag in _suffixes(batches):
        n = s.covered()
        keep = n > 0
        doc, place = s.doc[keep], s.place[keep]
        yield pa.RecordBatch.from_arrays([pa.array(did[doc]), pa.array(tag[doc]), pa.array(place), pa.array(place + n[keep])],
                                         names=["did", "tag", "begin", "end"])


def _group_rows(batches):
    for s, did, tag in _suffixes(batches):
        rows = []
        for length, members in s.groups():
            first = min((int(s.doc[i]), int(s.place[i])) for i in members)
            doc, at = first
            rows += [(did[doc], tag[doc], at, length, did[s.doc[i]], tag[s.doc[i]], s.place[i]) for i in members]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                             names=["first_did", "first_tag", "first_place", "length", "did", "tag", "place"])


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, later) of docs. rows: did, tag, text: what names a row's text, the tag being a hash of it where the did
    stands on several texts. later: did, tag, n (bytes) of texts of MIN_LENGTH bytes and more that equal, by 128 bits
    of hashes, one of an earlier (did, tag)."""
    did, tag = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("did"), F.xxhash64("text")
    keys = written(docs.select(did, tag.alias("one"), F.xxhash64(F.lit(7), "text").alias("two"),
                               F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n")), "keys")
    several = written(keys.groupBy("did").agg(F.min("one").alias("lo"), F.max("one").alias("hi"))
                      .where("lo <> hi").select(F.col("did").alias("_d")), "several")
    rows, named = docs.select(did, "text"), keys.withColumn("tag", F.lit(0).cast("long"))
    if several.isEmpty():
        rows = rows.select("did", F.lit(0).cast("long").alias("tag"), "text")
    else:
        rows = (rows.join(several, F.col("did") == F.col("_d"), "left")
                .select("did", F.when(F.col("_d").isNotNull(), tag).otherwise(F.lit(0)).alias("tag"), "text"))
        named = written(keys.join(several, F.col("did") == F.col("_d"), "left")
                        .select("did", "one", "two", "n", F.when(F.col("_d").isNotNull(), F.col("one")).otherwise(F.lit(0)).alias("tag")), "named")
    me = F.struct("did", "tag")
    copied = written(named.where(F.col("n") >= MIN_LENGTH).groupBy("one", "two").agg(F.min(me).alias("first"), F.max(me).alias("last"))
                     .where("first <> last").select("one", "two", "first"), "copied")
    later = spread_join(named, copied, ["one", "two"]).where(me > F.col("first")).select("did", "tag", "n").distinct()
    return rows, written(later, "later")


def _with_segments(rows: DataFrame, shared: DataFrame, later: DataFrame | None = None) -> DataFrame:
    """rows (did, tag, text) with the set of those of their segments in shared; without the texts in later."""
    lists = shared.groupBy("did", "tag").agg(F.collect_set(F.struct("h", "place", "n")).alias("segs"))
    if later is not None:
        lists = lists.join(later.select("did", "tag"), ["did", "tag"], "left_anti")
    lists = lists.withColumnsRenamed({"did": "_d", "tag": "_t"})
    return rows.join(lists, (F.col("did") == F.col("_d")) & (F.col("tag") == F.col("_t"))).select("did", "tag", "text", "segs")


def _shared_segments(rows: DataFrame) -> DataFrame:
    """h, did, tag, place, n, rows of the segments whose anchor another segment has too."""
    found = rows.mapInArrow(_anchors, "h long, did long, tag long, place long, n int")
    often = found.groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1").withColumnRenamed("h", "_h")
    return written(found.join(often, F.col("h") == F.col("_h")).select("h", "did", "tag", "place", "n", "rows"), "shared")


def _sorted_segments(rows: DataFrame, shared: DataFrame, later: DataFrame | None = None) -> DataFrame:
    got = _with_segments(rows, shared, later).mapInArrow(_segment_bytes(False), "h long, did long, tag long, place long, raw binary")
    return got.repartition("h").sortWithinPartitions("h")


def repeat_groups(docs: DataFrame) -> DataFrame:
    """Maximal repeat groups within segments: first_did, first_tag, first_place, length, and each occurrence's did,
    tag, place.

    did and tag name the text, a place is a byte offset in it. Occurrences are listed under each of
    their groups; anchors shared by more than HOT segments are left to `covers`.
    """
    rows, _ = _keyed(docs)
    shared = _shared_segments(rows).where(F.col("rows") <= HOT)
    return _sorted_segments(rows, shared).mapInArrow(
        _group_rows, "first_did long, first_tag long, first_place long, length long, did long, tag long, place long")


def covers(rows: DataFrame, later: DataFrame) -> DataFrame:
    """did, tag, begin, end (byte offsets) of pieces that repeat an earlier string of MIN_LENGTH bytes or more."""
    shared = _shared_segments(rows)
    out = written(_sorted_segments(rows, shared.where(F.col("rows") <= HOT), later)
                  .mapInArrow(_cover_rows, "did long, tag long, begin long, end long"), "covers")
    hot = shared.where(F.col("rows") > HOT)
    if not hot.isEmpty():
        one = written(_with_segments(rows, hot, later).mapInArrow(_segment_bytes(True), "h long, did long, tag long, place long"), "hot")
        first = (one.groupBy("h").agg(F.min(F.struct("did", "tag", "place")).alias("first")).withColumnRenamed("h", "_h"))
        out = out.unionByName(written(one.join(first, F.col("h") == F.col("_h"))
                                      .where(F.struct("did", "tag", "place") > F.col("first"))
                                      .select("did", "tag", F.col("place").alias("begin"), (F.col("place") + MIN_LENGTH).alias("end")),
                                      "hot-covers"))
    return out.unionByName(later.select("did", "tag", F.lit(0).cast("long").alias("begin"), F.col("n").alias("end")))


def _kept(batches):
    for batch, data, off in blocks(batches):
        n_bytes, removed, spans, sha, kept = [], [], [], [], []
        for i, pieces in enumerate(batch.column("pieces").to_pylist()):
            text = data[off[i] : off[i + 1]].tobytes()
            merged = []
            for begin, end in sorted((p["begin"], p["end"]) for p in pieces or ()):
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([begin, end])
            rest, last = [], 0
            for begin, end in merged:
                rest.append(text[last:begin])
                last = end
            rest = b"".join([*rest, text[last:]])
            n_bytes.append(len(text))
            removed.append(len(text) - len(rest))
            spans.append(len(merged))
            sha.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary) of docs (doc_id, text).

    Removed is every byte covered by a MIN_LENGTH-byte string that also starts earlier: in a smaller doc_id,
    or earlier in the same document.
    """
    rows, later = _keyed(docs)
    pieces = (covers(rows, later).groupBy("did", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("pieces"))
              .withColumnsRenamed({"did": "_d", "tag": "_t"}))
    both = rows.join(pieces, (F.col("did") == F.col("_d")) & (F.col("tag") == F.col("_t")), "left")
    return (both.select(F.when(F.col("did") != _NO_ID, F.col("did")).alias("doc_id"), "text", "pieces")
            .mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def query(spark, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")

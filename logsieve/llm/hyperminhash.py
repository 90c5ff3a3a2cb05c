"""Near-duplicate documents by HyperMinHash.

A document's distinct k-word shingles fall by the leading bits of their hashes into BUCKETS
buckets. A bucket's register keeps its smallest hash compressed to a leading-zero count (6 bits)
and the 10 bits after the leading one (the mantissa). Registers serve twice:

* banding: ROWS registers at a time make a band key (empty buckets borrow from others in an order
  fixed per bucket, so that small sets band like large ones). A pair of similarity 0.85 misses
  all 42 bands with a chance of 2e-9; of 0.8, 4e-6.
* estimation: the share of equal registers, less the equal ones that chance alone would give at
  the two set sizes (the collision correction), estimates the Jaccard similarity. Pairs more than
  six standard deviations below the threshold are dropped before verification.

Verification recomputes the full shingle sets from the texts and counts intersection and union.

Groups of copies never become all pairs. Documents with equal sets are one class. The members of a
band bucket are compared inside its task by parity bitmaps: a set's bitmap has a bit for each hash
value, turned over by each shingle that falls there, so two bitmaps never differ in more bits than
the sets differ in shingles, and a pair whose bitmaps differ in too many cannot be a link. What passes
is proposed only as far as it joins parts of the bucket that nothing has joined yet, at most one pair
per member; buckets of more than BUCKET_ROWS members are dealt out as pairs of blocks. Proposed pairs
are estimated, verified, and made components; a second pass over the buckets then proposes every pair
that still lies in different components and passes. So no link is lost, and a bucket whose members
are already connected, however large, costs nothing more.

Sets hold 64-bit shingle hashes (a chance of equality of 2e-13 for a text of 3,000 shingles).

Defined cases: null, empty or blank texts have no shingles and link with nothing; a text with
fewer than k words has its whole word sequence as its one shingle; rows with equal doc_id are one
document in linking; a null doc_id has a null component and is kept; an empty table gives no rows.
Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import SMALL_BLOCK, blocks, mix, shingle_hashes, word_hashes, word_spans, worker_cache, written
from .components import components

BUCKETS = 256
_P = 8
MANTISSA = 10
ROWS = 6
BANDS = BUCKETS // ROWS
#: members of a band bucket that are compared in one task; more are dealt out in blocks
BUCKET_ROWS = 4096
_U = np.uint64
#: for each bucket, the order in which it borrows from others when empty
_BORROW = np.argsort(np.random.default_rng(7).random((BUCKETS, BUCKETS)), axis=1).astype(np.uint8)


def shingle_sets(data, off, k):
    """Per row: its sorted distinct shingle hashes."""
    start, end, row = word_spans(data, off)
    h, ends = shingle_hashes(word_hashes(data, start, end), row, len(off) - 1, k)
    return [np.unique(h[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def registers(u: np.ndarray) -> np.ndarray:
    """BUCKETS registers of a set (sorted distinct hashes); 0 is an empty bucket."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(u):
        return out
    bucket = (u >> _U(64 - _P)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # the smallest of each bucket: u is sorted
    rest = u[first] << _U(_P)
    # leading zeros of the 56 bits that are left, exactly
    top = np.frexp((rest >> _U(_P)).astype(np.float64))[1]
    top -= ((rest >> _U(_P)) < (_U(1) << np.maximum(top - 1, 0).astype(np.uint64))).astype(top.dtype)
    zeros = np.minimum(64 - _P - top, 61)
    after = rest << np.minimum(zeros + 1, 63).astype(np.uint64)
    out[bucket[first]] = ((zeros + 1).astype(np.uint16) << MANTISSA) | (after >> _U(64 - MANTISSA)).astype(np.uint16)
    return out


def band_keys(reg: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys from registers with their empty ones borrowed."""
    full = reg > 0
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _BORROW[empty]
        reg = reg.copy()
        reg[empty] = reg[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    parts = reg[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * _U(0x9E3779B97F4A7C15) + parts[:, j] + _U(1))
    return key


def bitmap(u: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set, 2 to 4 bits for each element or more (64-bit words, a power of two of them)."""
    bits = max(64, 1 << int(3 * len(u)).bit_length())
    odd = np.bincount((u & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps as they would be with fewer words."""
    while maps.shape[1] > words:
        maps = maps[:, : maps.shape[1] // 2] ^ maps[:, maps.shape[1] // 2 :]
    return maps


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers that sets of n and m elements without a common one would share by chance."""
    n, m = np.asarray(n, np.float64)[:, None], np.asarray(m, np.float64)[:, None]
    i = np.arange(1, 64 - _P, dtype=np.float64)
    lo, hi = 2.0 ** -(_P + i), 2.0 ** -(_P + i - 1)
    hit = lambda c: (1 - lo) ** c - (1 - hi) ** c  # noqa: E731  a bucket's smallest is in octave i
    return BUCKETS * (hit(n) * hit(m)).sum(axis=1) / 2.0**MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows a and b, and how many buckets it rests on."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    # chance acts on the buckets that the common elements don't decide
    j = equal / np.maximum(used, 1)
    chance = expected_collisions(n, m) * (1 - j)
    return np.clip((equal - chance) / np.maximum(used, 1), 0, 1), used


# ------------------------------------------------------------------ Spark

_SKETCH = "doc_id long, n_shingles long, digest binary, registers binary, bits binary"


def _sketcher(k: int):
    def run(batches):
        worker_cache(None, None)
        for batch, data, off in blocks(batches, size=SMALL_BLOCK):
            sets = shingle_sets(data, off, k)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array([len(u) for u in sets], pa.int64()),
                pa.array([hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None for u in sets], pa.binary()),
                pa.array([registers(u).tobytes() if len(u) else None for u in sets], pa.binary()),
                pa.array([bitmap(u).tobytes() if len(u) else None for u in sets], pa.binary()),
            ], names=["doc_id", "n_shingles", "digest", "registers", "bits"])
    return run


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set), registers and parity bitmap of docs (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(_sketcher(k), _SKETCH)


def _bands(batches):
    worker_cache(None, None)
    for batch in batches:
        nodes = batch.column("node").to_numpy(zero_copy_only=False)
        keys = [band_keys(np.frombuffer(r, np.uint16)) for r in batch.column("registers").to_pylist()]
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(nodes, BANDS))],
                                             names=["key", "node"])


def _set_rows(k: int):
    def run(batches):
        worker_cache(None, None)
        for batch, data, off in blocks(batches, size=SMALL_BLOCK):
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                pa.array([u.tobytes() for u in shingle_sets(data, off, k)], pa.binary())], names=["id", "items"])
    return run


def _promising(percent: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb")]
            sizes = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb")]
            j, used = estimate(*regs, *sizes)
            t = percent / 100
            keep = j >= t - 6 * np.sqrt(t * (1 - t) / np.maximum(used, 1)) - 1 / np.maximum(used, 1)
            # and by size alone: the smaller set is the largest possible intersection
            keep &= 100 * np.minimum(*sizes) >= percent * np.maximum(*sizes)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))
    return run


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(*(batch.column(c).to_pylist() for c in ("xa", "xb"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose similarity is at least percent / 100: first by estimate, then on full sets."""
    side = lambda x: nodes.select(F.col("node").alias(f"_{x}"), F.col("registers").alias(f"r{x}"),
                                  F.col("n_shingles").alias(f"n{x}"))
    likely = (pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
              .select("a", "b", "ra", "rb", "na", "nb").mapInArrow(_promising(percent), "a long, b long"))
    likely = written(likely, "likely")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("_id")).distinct()
    sets = (docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("_id"), "left_semi")
            .mapInArrow(_set_rows(k), "id long, items binary"))
    sets = written(sets, "sets")
    side = lambda x: sets.select(F.col("id").alias(f"_{x}"), F.col("items").alias(f"x{x}"))
    both = likely.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
    return both.select("a", "b", "xa", "xb").mapInArrow(_verified(percent), "a long, b long").distinct()


class _Bucket:
    """Members of one band bucket, in classes of equal bitmap length."""

    def __init__(self, rows: list[tuple[int, int, int, bytes, int]], percent: int):
        self.node = np.array([r[0] for r in rows])
        self.part = np.unique([r[1] for r in rows], return_inverse=True)[1]
        self.size = np.array([r[2] for r in rows])
        self.side = np.array([r[4] for r in rows])
        self.percent = percent
        self.words = np.array([len(r[3]) // 8 for r in rows])
        self.classes = {}
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            maps = np.frombuffer(b"".join(rows[i][3] for i in at), np.uint64).reshape(len(at), w)
            self.classes[w] = (at, maps, folded(maps, w // 2) if w > 1 else maps)
        self.row = np.zeros(len(rows), np.int64)
        for at, _, _ in self.classes.values():
            self.row[at] = np.arange(len(at))

    def similar(self, i: int, among: np.ndarray) -> np.ndarray:
        """Members of `among` (a mask) that may be links of member i."""
        w, found = int(self.words[i]), []
        # linked sets differ in size by less than a factor of two, and so do their bitmaps
        for v in (w // 2, w, 2 * w):
            if v not in self.classes:
                continue
            at, maps, half = self.classes[v]
            pick = np.flatnonzero(among[at])
            if not len(pick):
                continue
            own = self.classes[w][2 if v < w else 1][self.row[i]]
            other = (half if v > w else maps)[pick]
            apart = np.bitwise_count(other ^ own).sum(axis=1, dtype=np.int64)
            both = self.size[at[pick]] + self.size[i]
            found.append(at[pick][apart * (100 + self.percent) <= both * (100 - self.percent)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def joining(self):
        """Pairs that hold together what may be linked: a spanning forest over the parts."""
        left = np.ones(len(self.node), bool)
        members = [np.flatnonzero(self.part == p) for p in range(self.part.max() + 1)]
        for own in members:
            if not left[own[0]]:
                continue
            left[own] = False
            front = list(own)
            while front and left.any():
                i = front.pop()
                hit = self.similar(i, left)
                for p, first in zip(*np.unique(self.part[hit], return_index=True)):
                    yield i, hit[first]
                    left[members[p]] = False
                    front.extend(members[p])

    def all_apart(self):
        """All pairs in different parts that may be links; across two blocks, or within one."""
        later = np.ones(len(self.node), bool)
        for i in range(len(self.node)):
            later[i] = False
            for j in self.similar(i, later & (self.part != self.part[i])):
                yield i, j


def _propose(percent: int, everything: bool):
    def pairs_of(rows):
        b = _Bucket(rows, percent)
        for i, j in b.all_apart() if everything else b.joining():
            yield min(b.node[i], b.node[j]), max(b.node[i], b.node[j])

    def run(batches):
        worker_cache(None, None)
        key, rows, out = None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "cell", "node", "component", "n", "bits", "block")]
            for k, cell, *row in zip(*cols):
                if (k, cell) != key:
                    out += pairs_of(rows) if len(rows) > 1 else ()
                    key, rows = (k, cell), []
                    if len(out) > 1 << 14:
                        yield _pairs(out)
                        out = []
                rows.append(tuple(row))
        out += pairs_of(rows) if len(rows) > 1 else ()
        if out:
            yield _pairs(out)
    return run


def _pairs(out):
    a, b = zip(*set(out))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def proposals(bands: DataFrame, label: DataFrame, nodes: DataFrame, percent: int, everything: bool) -> DataFrame:
    """Pairs (a, b) of one bucket in different components that may be links (see `_Bucket`)."""
    lab = label.select(F.col("node").alias("_n"), "component")
    placed = (bands.join(lab, F.col("node") == F.col("_n"), "left")
              .select("key", "node", F.coalesce("component", "node").alias("component")))
    placed = written(placed, "placed")
    mixed = (placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows"))
             .where("lo <> hi").select(F.col("key").alias("_k"), F.ceil(F.col("rows") / BUCKET_ROWS).cast("int").alias("blocks")))
    info = nodes.select(F.col("node").alias("_n"), F.col("n_shingles").alias("n"), "bits")
    rows = (placed.join(mixed, F.col("key") == F.col("_k"))
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            # a cell is a pair of blocks (lo, hi); each member goes to the cells of its block
            .withColumn("cell", F.explode(F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda j: F.least(j, F.col("block")).cast("long") * F.col("blocks") + F.greatest(j, F.col("block")))))
            .select("key", "cell", "node", "component", "block")
            .join(info, F.col("node") == F.col("_n")).select("key", "cell", "node", "component", "n", "bits", "block"))
    dealt = rows.repartition("key", "cell").sortWithinPartitions("key", "cell")
    return dealt.mapInArrow(_propose(percent, everything), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for each row of docs (doc_id, text).

    Links are pairs with 100 * |intersection| >= percent * |union|; component_id is the smallest
    doc_id reachable through them.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sk = written(sketches(docs, k), "sketches")
    known = sk.where("digest is not null and doc_id is not null")
    # classes of equal sets: the smallest doc_id stands for each
    classes = written(known.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    member = known.select("doc_id", "digest").join(classes.select(F.col("digest").alias("_dg"), "node"),
                                                   F.col("digest") == F.col("_dg"))
    # a doc_id on several texts holds their classes together
    several = (member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a <> top")
               .select(F.col("doc_id").alias("_id"), "a"))
    same_id = (member.join(several, F.col("doc_id") == F.col("_id")).where("a <> node")
               .select("a", F.col("node").alias("b")).distinct())
    nodes = written(known.join(classes.select(F.col("digest").alias("_dg"), "node"),
                               (F.col("digest") == F.col("_dg")) & (F.col("doc_id") == F.col("node")))
                    .select("node", "n_shingles", "registers", "bits", "digest").dropDuplicates(["node", "digest"]), "nodes")
    banded = nodes.mapInArrow(_bands, "key long, node long")
    crowd = banded.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("top")).where("lead <> top")
    # only keys with several members go on
    bands = written(banded.join(crowd.select(F.col("key").alias("_k")), F.col("key") == F.col("_k"), "left_semi")
                    .distinct(), "bands")
    label = written(components(same_id), "label0")
    first = written(proposals(bands, label, nodes, percent, everything=False), "pairs1")
    linked = written(verify(first, docs, nodes, k, percent).unionByName(same_id), "links1")
    label = written(components(linked), "label1")
    tried = first.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    rest = (proposals(bands, label, nodes, percent, everything=True)
            .join(tried, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti"))
    more = written(verify(rest, docs, nodes, k, percent), "links2")
    label = written(components(linked.unionByName(more)), "label2")
    named = (classes.join(label.select(F.col("node").alias("_n"), "component"), F.col("node") == F.col("_n"), "left")
             .select(F.col("digest").alias("_dg"), F.coalesce("component", "node").alias("component")))
    out = sk.join(named, (F.col("digest") == F.col("_dg")) & F.col("doc_id").isNotNull(), "left")
    comp = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns kept, without near duplicates: of each component the document with the
    smallest doc_id.

    Here the texts of one doc_id are documents of their own, in order of their hash (64 bits of doc_id and text
    name them). Rows with equal doc_id and text stay once; rows without doc_id stay, once per text.
    """
    # All other columns of docs travel in one, so that none meets ours.
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = docs.select("doc_id", "text", *([F.struct(*[docs[c] for c in rest]).alias("_row")] if rest else []))
    ident = F.col("doc_id").cast("long")
    several = written(own.select(ident.alias("_d"), F.xxhash64("text").alias("_h")).where("_d is not null")
                      .groupBy("_d").agg(F.min("_h").alias("lo"), F.max("_h").alias("hi")).where("lo <> hi").select("_d"), "several")
    own = own.withColumn("_uid", ident)
    told_apart = not several.isEmpty()
    if told_apart:
        own = own.join(several, F.col("_uid") == F.col("_d"), "left").withColumn(
            "_uid", F.when(F.col("_d").isNotNull(), F.xxhash64("_d", "text")).otherwise(F.col("_uid"))).drop("_d")
    found = near_duplicates(own.select(F.col("_uid").alias("doc_id"), "text"), k, percent)
    if told_apart:
        # a component's name is no longer its smallest doc_id
        names = own.select(F.col("_uid").alias("_u"), ident.alias("_d")).distinct()
        found = found.join(names, F.col("doc_id").eqNullSafe(F.col("_u")))
        kept = found.groupBy("component_id").agg(F.min(F.struct("_d", "_u")).alias("least")).select(F.col("least._u").alias("_kept"))
    else:
        kept = found.where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    rows = own.join(kept, F.col("_uid").eqNullSafe(F.col("_kept")), "left_semi")
    one = Window.partitionBy("doc_id", "text").orderBy(F.lit(0))
    rows = rows.withColumn("_nth", F.row_number().over(one)).where("_nth = 1")
    return rows.select(*[F.col("_row")[c].alias(c) if c in rest else F.col(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, percent=85)

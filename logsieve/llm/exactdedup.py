"""Exact dedup: counting quotient filters find repeated fingerprints, bytes decide.

Texts are equal when identical after lower-casing A-Z only. Each task counts the 64-bit fingerprints of its rows in
counting quotient filters, one per shard (the fingerprints' leading bits), and the filters of a shard, one from each
task, merge losslessly by sorted remainders. Only fingerprints with a count above one matter further on. Their texts
alone are shuffled and grouped by their bytes, with partial aggregation, so neither a group that holds a third of all
rows nor a fingerprint that different texts share is a problem: the groups are those of equal bytes.

The texts to route are found while the documents are read a second time, by a bitmap over the leading bits of the
repeated fingerprints: `ROUTE` bits a row of the table, 2^MAX_ROUTE_BITS (128 MB) at most at any size. A bit set by
another fingerprint routes a text for nothing, to a group of one; none is missed. Rows are then matched to their
group by fingerprint and SHA-256; two byte-different texts that agree in both would be an error, not a merge.

Defined cases: a null text counts as empty; of equal texts the row with the largest doc_id stays, null being
smallest; of rows with this doc_id and text one stays; an empty table gives no rows. Columns other than doc_id and
text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quotient
from .blocks import _ASCII_LOWER, blocks, written
from .skew import HOT

#: Fingerprints of a shard, about, and the least number of shards.
SHARD_ROWS = 1 << 20
MIN_SHARDS = 64
#: Fingerprints that a task counts before it hands its filters on.
TASK_ROWS = 1 << 22
ROUTE = 16
MAX_ROUTE_BITS = 30
_U = np.uint64


def _lowered(batches):
    """Slices of the batches with their texts' bytes, A-Z lower-cased, and offsets."""
    for batch, data, off in blocks(batches):
        yield batch, memoryview(_ASCII_LOWER[data].tobytes()), off.tolist()


def _fingerprints(body, off, bits: int) -> np.ndarray:
    fps = np.array([xxhash.xxh3_64_intdigest(body[a:b]) for a, b in zip(off, off[1:])], np.uint64)
    return fps >> _U(64 - bits) << _U(64 - bits)


def _rows(bits: int):
    def run(batches):
        for batch, body, off in _lowered(batches):
            sha = [hashlib.sha256(body[a:b]).digest() for a, b in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_fingerprints(body, off, bits).view(np.int64)), pa.array(sha, pa.binary())],
                names=["doc_id", "fp", "sha"])
    return run


def _filter_rows(fps: np.ndarray, counts: np.ndarray, shard_bits: int):
    """One row (shard, filter) for each shard that ascending fingerprints are of."""
    shard = (fps >> _U(64 - shard_bits)).astype(np.int64)
    cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist()
    made = [quotient.build(fps[a:b], counts[a:b], shard_bits) for a, b in zip(cut, [*cut[1:], len(fps)])]
    return pa.RecordBatch.from_arrays([pa.array(shard[cut].astype(np.int32)), pa.array(made, pa.binary())], names=["shard", "filter"])


def _count(shard_bits: int, task_rows: int):
    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch.column("fp").to_numpy().view(np.uint64))
            n += len(held[-1])
            if n >= task_rows:
                yield _filter_rows(*np.unique(np.concatenate(held), return_counts=True), shard_bits)
                held, n = [], 0
        if n:
            yield _filter_rows(*np.unique(np.concatenate(held), return_counts=True), shard_bits)
    return run


def _merge(shard_bits: int):
    """Rows in order of shard -> one filter a shard. Held at a time: what one shard has counted, and a few filters."""
    def run(batches):
        shard, fps, counts, waiting = None, np.zeros(0, np.uint64), np.zeros(0, np.int64), []

        def merged():
            more = [quotient.decode(f, shard, shard_bits) for f in waiting]
            waiting.clear()
            return quotient.summed(np.concatenate([fps, *[m[0] for m in more]]), np.concatenate([counts, *[m[1] for m in more]]))
        for batch in batches:
            for s, f in zip(batch.column("shard").to_pylist(), batch.column("filter").to_pylist()):
                if s != shard:
                    if shard is not None:
                        yield _filter_rows(*merged(), shard_bits)
                    shard, fps, counts = s, fps[:0], counts[:0]
                waiting.append(f)
                if len(waiting) >= 64:
                    fps, counts = merged()
        if shard is not None:
            yield _filter_rows(*merged(), shard_bits)
    return run


def filters(rows: DataFrame, shard_bits: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """shard, filter: the merged counting quotient filters of all fingerprints in rows (fp)."""
    schema = "shard int, filter binary"
    parts = rows.select("fp").mapInArrow(_count(shard_bits, task_rows), schema)
    return written(parts.repartition("shard").sortWithinPartitions("shard").mapInArrow(_merge(shard_bits), schema), "filters")


def _repeated(shard_bits: int):
    def run(batches):
        for batch in batches:
            for s, f in zip(batch.column("shard").to_pylist(), batch.column("filter").to_pylist()):
                fps, counts = quotient.decode(f, s, shard_bits)
                many = counts > 1
                yield pa.RecordBatch.from_arrays([pa.array(fps[many].view(np.int64)), pa.array(counts[many])], names=["fp", "n"])
    return run


def repeated(merged: DataFrame, shard_bits: int) -> DataFrame:
    """fp, n of the fingerprints that merged filters counted more than once."""
    return merged.mapInArrow(_repeated(shard_bits), "fp long, n long")


def _bitmaps(shard_bits: int, route_bits: int):
    def run(batches):
        for batch in batches:
            for s, f in zip(batch.column("shard").to_pylist(), batch.column("filter").to_pylist()):
                fps, counts = quotient.decode(f, s, shard_bits)
                bits = np.zeros(1 << (route_bits - shard_bits), np.uint8)
                bits[((fps[counts > 1] >> _U(64 - route_bits)).astype(np.int64)) & (len(bits) - 1)] = 1
                if bits.any():
                    yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                                     names=["shard", "bits"])
    return run


def _routed(bitmap_bc, route_bits: int, bits: int):
    def run(batches):
        bitmap = bitmap_bc.value
        for batch, body, off in _lowered(batches):
            fps = _fingerprints(body, off, bits)
            at = (fps >> _U(64 - route_bits)).astype(np.int64)
            hit = np.flatnonzero((bitmap[at >> 3] >> (7 - (at & 7))) & 1)
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(hit)), pa.array(fps[hit].view(np.int64)),
                     pa.array([bytes(body[off[i] : off[i + 1]]) for i in hit.tolist()], pa.binary())], names=["doc_id", "fp", "body"])
    return run


def duplicate_groups(docs: DataFrame, rows: DataFrame, n_rows: int, bits: int = 64) -> DataFrame:
    """fp, sha, n, keep_id of each group of two and more rows of docs (doc_id, text) whose lower-cased texts have equal bytes."""
    spark = docs.sparkSession
    shard_bits = max(MIN_SHARDS, -(-n_rows // SHARD_ROWS)).bit_length()
    merged = filters(rows, shard_bits)
    route_bits = min(MAX_ROUTE_BITS, max(shard_bits + 3, (ROUTE * n_rows).bit_length()))
    bitmap = np.zeros(1 << (route_bits - 3), np.uint8)
    size = len(bitmap) >> shard_bits
    # at most 2^route_bits bits in all
    for r in merged.mapInArrow(_bitmaps(shard_bits, route_bits), "shard int, bits binary").collect():
        bitmap[r.shard * size : (r.shard + 1) * size] = np.frombuffer(r.bits, np.uint8)
    routed = docs.mapInArrow(_routed(spark.sparkContext.broadcast(bitmap), route_bits, bits), "doc_id long, fp long, body binary")
    same = (routed.groupBy("fp", "body").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))
            .where("n > 1").select("fp", F.unhex(F.sha2("body", 256)).alias("sha"), "n", "keep_id"))
    one = same.groupBy("fp", "sha").agg(F.max("n").alias("n"), F.max("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("texts"))
    return written(one.select("fp", "sha", F.when(F.col("texts") == 1, F.col("n"))
                              .otherwise(F.raise_error(F.lit("texts of equal fingerprint and SHA-256 differ")).cast("long")).alias("n"),
                              "keep_id"), "groups")


def _with_groups(rows: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """rows with n and keep_id of their group. A group of 1 / HOT of the rows or more, of which there are HOT at most,
    joins by broadcast, and no other key holds more than that share."""
    large = F.col("n") * F.lit(HOT) >= F.lit(n_rows)
    big = F.broadcast(written(groups.where(large), "large-groups"))
    keys = ["fp", "sha"]
    return (rows.join(big, keys).unionByName(
        rows.join(big.select(*keys), keys, "left_anti").join(groups.where(~large), keys, "left")))


def exact_groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each row of docs (doc_id, text).

    `bits`: of the fingerprint that are used; fewer only mean more texts to verify.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(docs.mapInArrow(_rows(bits), "doc_id long, fp long, sha binary")
                   .withColumn("uid", F.monotonically_increasing_id()), "rows")
    n_rows = rows.count()
    groups = duplicate_groups(docs, rows, n_rows, bits)
    out = written(_with_groups(rows, groups, n_rows), "grouped")
    first = F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # repeated rows: several of a group have the doc_id that stays
    several = written(out.where(first & F.col("n").isNotNull()).groupBy("fp", "sha")
                      .agg(F.min("uid").alias("stays"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "several")
    if not several.isEmpty():
        # as many rows as such groups; only rows with the doc_id that stays look them up
        tied = out.where(first & F.col("n").isNotNull()).join(several, ["fp", "sha"]).where("uid <> stays").select("uid", F.lit(False).alias("stay"))
        out = out.join(tied, "uid", "left")
        first = first & F.coalesce("stay", F.lit(True))
    return out.select("doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), first.alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents),
g as (select body, max(doc_id) as keep_id, count(*)::bigint as group_size from d group by body)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.body) as text_sha256
from d join g on d.body = g.body
"""

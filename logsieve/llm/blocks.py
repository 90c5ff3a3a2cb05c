"""Shared helpers: whole-text word and shingle hashing on UTF-8 bytes (numpy),
scratch tables in the shared folder, and distributed running totals.

Words are `[^\\x20\\x09-\\x0D]+`, lower-cased A-Z on request. All of that is
ASCII, so it is exact on UTF-8 bytes and no Python string is made per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsieve.session import ensure_checkpoint_dir

#: Bytes of text handled at a time inside a task; one longer text is a block of its own.
BLOCK_BYTES = 1 << 22
#: The same in the pipeline's operators: workers of all its stages stay beside each other, and what a block took of
#: memory a worker mostly keeps.
SMALL_BLOCK = 1 << 20

_U = np.uint64
_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240229)
_BYTE_HASH = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 2 * BLOCK_BYTES:
            _POWERS[base] = have
    return have[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and their n + 1 offsets (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
           size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of at most `size` text bytes (or one row), with bytes and offsets."""
    for batch in batches:
        data, off = text_bytes(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
            yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_WS[data]
    full = off[:-1] < off[1:]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][full]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[off[1:][full] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(off[1:], start, "right")


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span, equal for equal bytes wherever they stand."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    v = _BYTE_HASH[_ASCII_LOWER[data] if lower else data]
    v *= _powers(_BASE, len(v))
    total = np.zeros(len(v) + 1, np.uint64)
    np.cumsum(v, out=total[1:])
    h = (total[end] - total[start]) * _powers(_BASE_INV, len(v))[start]
    return mix(h + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles in row order and their n_rows + 1 offsets.

    A row with fewer than k words, but at least one, has its whole word sequence as one.
    """
    count = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
    first = np.zeros(n_rows + 1, np.int64)
    np.cumsum(count, out=first[1:])
    n_out = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    out_off = np.zeros(n_rows + 1, np.int64)
    np.cumsum(n_out, out=out_off[1:])
    n = len(words)
    salt = _powers(0xC2B2AE3D27D4EB4F, k + 1)
    # the index of the first word of each shingle
    at = np.arange(out_off[-1]) - np.repeat(out_off[:-1], n_out) + np.repeat(first[:-1], n_out)
    width = np.repeat(np.minimum(count, k), n_out)
    acc = width.astype(np.uint64) * _U(0xA24BAED4963EE407)
    padded = np.concatenate([words, np.zeros(k, np.uint64)]) if n else np.zeros(k, np.uint64)
    for j in range(k):
        acc += np.where(width > j, padded[at + j] * salt[j + 1], _U(0))
    return mix(acc), out_off


_CACHE: list = [None, None]


def worker_cache(key, make):
    """What a worker keeps between tasks (a word table, an encoder): one thing at a time, so that
    the operators that follow each other in it don't add up. A key of None drops it."""
    if key is None or _CACHE[0] != key:
        _CACHE[:] = [None, None]  # first, so that old and new are never held together
        _CACHE[:] = [key, make()] if key is not None else [None, None]
    return _CACHE[1]


# ------------------------------------------------------------------ Spark

def scratch_path(df_or_spark, name: str) -> str:
    """A new folder under the shared folder that the session names in spark.checkpoint.dir."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


#: Spark removes a write's shuffle files as soon as it ends: the table that it leaves is read from then on.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path, conf = scratch_path(df, name), df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that extra columns with clashing names never meet ours."""
    return df.select(*[df[n] for n in names])


def key_hash(*cols: Column | str) -> Column:
    """A 64-bit value that orders rows at random, but the same in each run."""
    return F.xxhash64(*cols)


def with_running(df: DataFrame, group: list[str], order: list[str], value: Column, out: str,
                 chunk_rows: int = 8_192, key_bits: int = 64) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows before this one in its group.

    The group's order is by `order[0]`, a hash column of `key_bits` bits (64: signed), then by the rest. No group meets
    in one task: its rows are cut into chunks by the hash's leading bits, about `chunk_rows` of
    the whole table each, and a chunk starts where the sums of the chunks before it end.
    """
    parts = max(1, -(-df.count() // chunk_rows))
    bits = max(0, (parts - 1).bit_length())
    # the leading bits, kept in the hash's own (signed) order
    chunk = F.shiftright(F.col(order[0]), key_bits - bits) if bits else F.lit(0).cast("long")
    rows = df.withColumn("_chunk", chunk).withColumn("_v", value.cast("long"))
    sums = rows.groupBy(*group, "_chunk").agg(F.sum("_v").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_chunk").alias("_c"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long").alias("_start"))
    inside = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)).cast("long"))
    same = F.col("_chunk") == F.col("_c")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return (rows.join(sums, same).withColumn(out, F.col("_start") + F.col("_in"))
            .drop("_chunk", "_v", "_c", "_start", "_in", *[f"_g_{g}" for g in group]))

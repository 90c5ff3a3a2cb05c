"""Document fingerprints by winnowing, with positions.

Every run of K bytes (UTF-8) is hashed by a rolling hash; of each WINDOW consecutive hashes the
smallest is kept, of equal ones the rightmost, with its position. Two texts that share at least
K + WINDOW - 1 bytes therefore share a fingerprint hash, and runs below K bytes never match.

A fingerprint is written as base64 of its hashes (32 bits, little-endian, in text order)
followed by the gaps between their positions (a byte each: no gap exceeds WINDOW). Likeness is
the Jaccard similarity of the distinct hashes.

Defined cases: an empty or null text has an empty fingerprint, alike only to another empty one;
a text below K bytes has the hash of all its bytes at position 0; fewer than WINDOW hashes are one
window. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import _BASE, _BASE_INV, _BYTE_HASH, BLOCK_BYTES, _powers, blocks, mix, word_hashes

K = 16
WINDOW = 32
_U = np.uint64


def winnow(data: np.ndarray, off: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash uint32, position in its row, offsets of n_rows + 1) of the kept hashes, row by row."""
    n_rows, n = len(off) - 1, len(data)
    grams = np.maximum(np.diff(off) - k + 1, 0)
    key = np.full(n, ~_U(0), np.uint64)
    if n >= k:
        v = _BYTE_HASH[data] * _powers(_BASE, n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(v, out=total[1:])
        h = mix((total[k:] - total[:-k]) * _powers(_BASE_INV, n)[: n - k + 1]) >> _U(32)
        # smaller hash first, of equal ones the later place
        key[: n - k + 1] = h << _U(32) | (_U(0xFFFFFFFF) - np.arange(n - k + 1, dtype=np.uint64))
    least, span = key, 1
    while span < window:
        step = min(span, window - span)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        span += step
    kept, row = [], []
    wide = grams >= window
    starts = np.zeros(n + 1, np.int64)
    np.add.at(starts, off[:-1][wide], 1)
    np.add.at(starts, (off[:-1] + grams - window + 1)[wide], -1)
    at = np.flatnonzero(np.cumsum(starts[:-1]) > 0) if n else np.zeros(0, np.int64)
    best = least[at]
    owner = np.searchsorted(off[1:], at, "right")
    fresh = np.ones(len(best), bool)
    fresh[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])
    kept.append(best[fresh])
    row.append(owner[fresh])
    small = np.flatnonzero((grams > 0) & ~wide)
    if len(small):
        kept.append(np.array([key[off[i] : off[i] + grams[i]].min() for i in small], np.uint64))
        row.append(small)
    tiny = np.flatnonzero((grams == 0) & (np.diff(off) > 0))
    if len(tiny):
        h = word_hashes(data, off[:-1][tiny], off[1:][tiny], lower=False) >> _U(32)
        kept.append(h << _U(32) | (_U(0xFFFFFFFF) - off[:-1][tiny].astype(np.uint64)))
        row.append(tiny)
    kept, row = np.concatenate(kept), np.concatenate(row)
    order = np.argsort(row, kind="stable")
    kept, row = kept[order], row[order]
    place = (_U(0xFFFFFFFF) - (kept & _U(0xFFFFFFFF))).astype(np.int64) - off[row]
    ends = np.zeros(n_rows + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=n_rows), out=ends[1:])
    return (kept >> _U(32)).astype(np.uint32), place, ends


def to_string(hashes: np.ndarray, places: np.ndarray) -> str:
    gaps = np.diff(places, prepend=0).astype(np.uint8)
    return base64.b64encode(hashes.astype("<u4").tobytes() + gaps.tobytes()).decode()


def from_string(s: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(s)
    n = len(raw) // 5
    return np.frombuffer(raw[: 4 * n], "<u4"), np.cumsum(np.frombuffer(raw[4 * n :], np.uint8).astype(np.int64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two arrays of hashes, each sorted and distinct; 1 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _prints(texts: list[bytes]) -> tuple[list[str], list[np.ndarray]]:
    """Fingerprint string and sorted distinct hashes of each text."""
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    h, at, ends = winnow(np.frombuffer(b"".join(texts), np.uint8), off)
    return ([to_string(h[a:b], at[a:b]) for a, b in zip(ends[:-1], ends[1:])],
            [np.unique(h[a:b]) for a, b in zip(ends[:-1], ends[1:])])


def fingerprints(docs: DataFrame) -> DataFrame:
    """All columns of docs (text among them) and `fingerprint`, row by row; a column of that name is replaced."""
    docs = docs.drop("fingerprint")
    schema = T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch, data, off in blocks(batches):
            h, at, ends = winnow(data, off)
            prints = pa.array([to_string(h[a:b], at[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], names=[*batch.schema.names, "fingerprint"])
    return docs.mapInArrow(run, schema)


# ------------------------------------------------- each document beside the next one

_WITH_NEXT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def _compare(rows, last):
    """Rows of (doc_id, text) against their successors in the list; the last row is a successor only."""
    texts = [t for _, t in rows]
    cut = [len(t) // 2 for t in texts[:-1]]
    edited = [(t[: len(t) - c] + nxt[:c]).encode() for t, nxt, c in zip(texts, texts[1:], cut)]
    own, sets = _prints([t.encode() for t in texts])
    changed, changed_sets = _prints(edited)
    cols = [[d for d, _ in rows[:-1]], [len(t) for t in texts[:-1]], [hashlib.sha256(e).hexdigest() for e in edited],
            own[:-1], changed, [likeness(a, b) for a, b in zip(sets, changed_sets)],
            [likeness(a, b) for a, b in zip(sets, sets[1:])]]
    wanted = pa.array(last[:-1])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                       names=[x.split(" ")[0] for x in _WITH_NEXT.split(", ")])
    return batch.filter(wanted)


def _scan(batches):
    rows, own, size = [], [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, 128):
            part = batch.slice(i, 128)
            for doc, turn, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "turn", "text"))):
                rows.append((doc, text or ""))
                own.append(turn == 0)
                size += len(rows[-1][1])
                if size >= BLOCK_BYTES and len(rows) > 1:
                    yield _compare(rows, own)
                    rows, own, size = rows[-1:], own[-1:], len(rows[-1][1])
    if len(rows) > 1:
        yield _compare(rows, own)


def beside_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how like they and the next document's are.

    The next document is the one after it by doc_id (nulls first, equal ids by text), after the
    last one the first. Texts are shuffled once: documents are dealt into `parts` ranges of doc_id
    whose bounds are estimated quantiles, and the first document of each range also goes to the end
    of the range before it. Within a range rows stream past in order.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10 * max(parts, 1000))).first()[0]
    bounds = np.unique(np.array(cuts or [], dtype=np.int64)) if parts > 1 else np.zeros(0, np.int64)

    def range_of(s):
        return np.searchsorted(bounds, s.fillna(0).to_numpy(np.int64), "right") * s.notna().to_numpy()

    @F.pandas_udf("int")
    def pid(s: pd.Series) -> pd.Series:
        return pd.Series(range_of(s.astype("Int64")).astype(np.int32))

    # at most `parts` rows
    heads = sorted((r.p, r.nulls, r.lo) for r in ids.groupBy(pid("doc_id").alias("p")).agg(
        F.min("doc_id").alias("lo"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect())
    before = [heads[i - 1][0] for i in range(len(heads))]
    null_goes = next((b for b, (_, nulls, _) in zip(before, heads) if nulls), -1)
    head_goes = {lo: b for b, (_, nulls, lo) in zip(before, heads) if not nulls}

    @F.pandas_udf("array<int>")
    def places(s: pd.Series) -> pd.Series:
        s = s.astype("Int64")
        extra = [null_goes if x is pd.NA else head_goes.get(int(x), -1) for x in s]
        return pd.Series([[int(p) * 2] if e < 0 else [int(p) * 2, e * 2 + 1] for p, e in zip(range_of(s), extra)])

    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .withColumn("place", F.explode(places("doc_id")))
             .select("doc_id", "text", F.shiftright("place", 1).alias("pid"), (F.col("place") % 2).alias("turn")))
    ordered = (dealt.repartitionById(parts, F.col("pid"))
               .sortWithinPartitions("pid", "turn", F.col("doc_id").asc_nulls_first(), "text"))
    return ordered.mapInArrow(_scan, _WITH_NEXT)


def query(spark, sf_dir: str) -> DataFrame:
    return beside_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Spelling variants: words one edit apart, by blocked Gram matrices of letter counts.

Words are counted over whole texts. Two words that differ by one inserted, deleted or replaced code point have letter
counts that differ by one in one or in two letters, so the squared distance of their count vectors is 1 or 2, and
NumPy gives it for a whole block of words at once: |a|^2 + |b|^2 - 2 a.b, from one matrix product. Pairs at that
distance, of equal or adjacent lengths, are verified as one edit on the words themselves.

Which words share a block: the letters are in GROUPS groups. One edit touches two letters at most, so of 4 groups two
at least have equal counts. A word stands, for every pair of groups, in the bucket of its length and its counts there,
and in the one of words a letter shorter; a pair of words is looked at in each bucket they share and kept in the first
pair of groups in which they agree, so none is missed or found twice. Small buckets are put together into one
product; a bucket of more than TILE words is dealt out as pairs of tiles, each a task's group of its own. Tasks give
on, for each word, only how many near words they found and the best of them.

The word that a word's form, its form and so on end at is found by self-joins that double the distance each time.

Defined cases: a null or empty text has no runs; a null doc_id is an empty one in what is hashed; repeated rows count
as often as they stand; a word without a near word has no form and is its own root; without any word there are no
rows. Columns other than doc_id and text are not looked at. Words are what A-Z lower-casing makes of runs of Latin
letters, U+00C0 to U+00FF included (the signs among these too), so a code point is one or two bytes and one of 256.
"""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import _ASCII_LOWER, blocks, mix, written
from .skew import spread_join

MIN_CHARS = 5
MIN_COUNT = 3
#: One in so many runs, by its hash, loses a code point before it is counted.
DELETE_MOD = 97
RATIO = 2
GROUPS = 4
#: Letters in order of how common they are; dealt to the groups back and forth. Others go by their code point.
COMMON = "etaoinshrdlcumwfgypbvkjxqz"
#: Words of a matrix product: buckets are put together up to BLOCK; a bucket above TILE is cut; STRIP rows at a time.
BLOCK = 256
TILE = 1 << 14
STRIP = 512
_U = np.uint64

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF
_PAIRS = list(combinations(range(GROUPS), 2))
_GROUP_OF = np.arange(256) % GROUPS
for _i, _c in enumerate(COMMON):
    _GROUP_OF[ord(_c)] = _i % GROUPS if _i // GROUPS % 2 == 0 else GROUPS - 1 - _i % GROUPS
_LETTER_HASH = mix(np.arange(1, 257, dtype=np.uint64))
_CRC = np.arange(256, dtype=np.uint32)
for _i in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


# ------------------------------------------------------------------ words

def runs(data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The maximal runs of Latin letters in rows of UTF-8 bytes, A-Z lower-cased, and the row of each."""
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = off[:-1][off[:-1] < off[1:]]  # rows that have bytes begin anew
    begins[cut] = inside[cut]
    start = np.flatnonzero(begins)
    held = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=held[1:])
    ends = np.append(held[start], held[-1])
    texts = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_ASCII_LOWER[data[inside]]))
    return texts, np.searchsorted(off[1:], start, "right")


def run_hashes(prefix: np.ndarray, row: np.ndarray, code: np.ndarray, own: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of a row's prefix followed by a run, for each run.

    prefix: the CRC-32 of each row's prefix; row, code: of each run its row and its distinct run, own and length
    (bytes) being of distinct runs. The CRC-32 of two strings, one after the other, is the first one's, moved on by a
    zero byte for each byte of the second, exclusive or the second one's.
    """
    out = np.zeros(len(row), np.uint32)
    size = length[code]
    order = np.argsort(size, kind="stable")
    found, begin = np.unique(size[order], return_index=True)
    now, at = prefix.astype(np.uint32), 0
    for n, a, b in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(order)]):
        for _ in range(n - at):
            now = (now >> 8) ^ _CRC[now & 255]
        at = n
        i = order[a:b]
        out[i] = now[row[i]] ^ own[code[i]]
    return out


def _count(mod: int, min_chars: int):
    def run(batches):
        for batch, data, off in blocks(batches):
            tokens, row = runs(data, off)
            if not len(tokens):
                continue
            coded = tokens.dictionary_encode()
            code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            raw = words.cast(pa.large_binary()).to_pylist()
            own = np.array([zlib.crc32(w) for w in raw], np.uint32)
            length = np.array([len(w) for w in raw], np.int64)
            chars = length - np.array([w.count(_LEAD) for w in raw], np.int64)
            ids = batch.column("doc_id").to_pylist()
            prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
            h = run_hashes(prefix, row, code, own, length).astype(np.int64)
            hit = h % mod == 0
            whole = np.bincount(code[~hit], minlength=len(raw))
            keep = np.flatnonzero((whole > 0) & (chars >= min_chars))
            out, n = words.take(pa.array(keep)).cast(pa.string()).to_pylist(), whole[keep].tolist()
            cut = code[hit]
            for (c, p), times in zip(*(x.tolist() for x in np.unique(np.stack([cut, h[hit] % chars[cut]], axis=1), axis=0, return_counts=True))):
                if chars[c] > min_chars:
                    text = raw[c].decode()
                    out.append(text[:p] + text[p + 1 :])
                    n.append(times)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])
    return run


def vocabulary(docs: DataFrame, mod: int = DELETE_MOD, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of all words of docs (doc_id, text)."""
    found = docs.select(F.col("doc_id"), "text").mapInArrow(_count(mod, min_chars), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------------ buckets

def _latin(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points (one byte each), one word after another, and n + 1 offsets."""
    off = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=off[1:])
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), off


def _bucket_rows(batches):
    for batch in batches:
        words = batch.column("word").to_pylist()
        code, off = _latin(words)
        chars, sums = np.diff(off), []
        for g in range(GROUPS):
            total = np.zeros(len(code) + 1, np.uint64)
            np.cumsum(np.where(_GROUP_OF[code] == g, _LETTER_HASH[code], _U(0)), out=total[1:])
            sums.append(total[off[1:]] - total[off[:-1]])
        for k, (a, b) in enumerate(_PAIRS):
            key = pa.array(mix(mix(sums[a]) + sums[b]).view(np.int64))
            for shorter in (0, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chars - shorter, pa.int32()), pa.array(np.full(len(words), k, np.int32)), key, batch.column("word"), batch.column("n")],
                    names=["chars", "pair", "key", "word", "n"])


def buckets(words: DataFrame, tile: int = TILE) -> DataFrame:
    """chars, pair, key, i, j, t, word, n: every word in each of its buckets.

    A bucket of more than `tile` words is cut: a word has a tile t there and stands in the cells (i, j) of its tile with
    each other one.
    """
    keys = ["chars", "pair", "key"]
    rows = written(words.mapInArrow(_bucket_rows, "chars int, pair int, key long, word string, n long"), "buckets")
    tiles = written(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > tile)
                    .select(*keys, F.ceil(F.col("c") / tile).cast("int").alias("tiles")), "tiles")
    none = F.lit(0)
    if tiles.isEmpty():
        return rows.select(*keys, none.alias("i"), none.alias("j"), none.alias("t"), "word", "n")
    tiled = spread_join(rows, tiles, keys, "left")
    t = F.when(F.col("tiles").isNull(), none).otherwise(F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(none, F.coalesce("tiles", F.lit(1)) - 1))
    return (tiled.withColumn("t", t).withColumn("o", other)
            .select(*keys, F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "t", "word", "n"))


# ------------------------------------------------------------------ pairs

def close_pairs(vectors: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs a < b of rows whose counts are at squared distance two, lengths equal, or one, lengths adjacent."""
    kind = np.float32 if chars.max(initial=0) < 2000 else np.float64  # exact: products stay below the mantissa
    vectors = vectors[:, vectors.any(axis=0)].astype(kind)
    square = (vectors * vectors).sum(axis=1)
    left, right = [], []
    for a in range(0, len(vectors), STRIP):
        b = min(a + STRIP, len(vectors))
        d = square[a:b, None] + square[None, a:] - 2 * (vectors[a:b] @ vectors[a:].T)
        i, j = np.nonzero(d <= 2)
        keep = i < j
        i, j = i[keep] + a, j[keep] + a
        gap, far = np.abs(chars[i] - chars[j]), d[i - a, j - a]
        ok = ((gap == 0) & (far == 2)) | ((gap == 1) & (far == 1))
        left.append(i[ok])
        right.append(j[ok])
    return np.concatenate(left) if left else np.zeros(0, np.int64), np.concatenate(right) if right else np.zeros(0, np.int64)


def one_edit(code: np.ndarray, off: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[k] and b[k] are one replaced, inserted or deleted code point apart."""
    out, chars = np.zeros(len(a), bool), np.diff(off)
    swap = chars[a] > chars[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    for n in np.unique(chars[a]).tolist():
        for more in (0, 1):
            k = np.flatnonzero((chars[a] == n) & (chars[b] == n + more))
            # as many pairs at a time as keep the arrays small
            for k in np.array_split(k, max(1, len(k) * (n + 1) >> 22)):
                if not len(k):
                    continue
                x = code[off[a[k]][:, None] + np.arange(n)]
                y = code[off[b[k]][:, None] + np.arange(n + more)]
                front = (x == y[:, :n]).cumprod(axis=1).sum(axis=1)
                back = (x[:, ::-1] == y[:, ::-1][:, :n]).cumprod(axis=1).sum(axis=1)
                out[k] = (front + back == n - 1) | ((x == y[:, :n]).sum(axis=1) == n - 1) if not more else front + back >= n
    return out


def _near_of(rows: list[tuple], n: np.ndarray) -> pa.RecordBatch | None:
    """How many near words, and the best, of the words of a block of cells: rows (chars, pair, key, i, j, t, word)."""
    cell = {}
    ids = np.array([cell.setdefault(r[:5], len(cell)) for r in rows])
    base, pair, i, j, t = (np.array([r[k] for r in rows]) for k in (0, 1, 3, 4, 5))
    words = [r[6] for r in rows]
    code, off = _latin(words)
    chars = np.diff(off)
    used = np.unique(code)
    place = np.zeros(256, np.int64)
    place[used] = np.arange(len(used))
    vectors = np.bincount(np.repeat(np.arange(len(words)), chars) * len(used) + place[code],
                          minlength=len(words) * len(used)).reshape(len(words), len(used))
    a, b = close_pairs(vectors, chars)
    # of one cell, one of them of the bucket's own length, and in a cell of two tiles one of each
    ok = (ids[a] == ids[b]) & (np.minimum(chars[a], chars[b]) == base[a]) & ((i[a] == j[a]) | (t[a] != t[b]))
    a, b = a[ok], b[ok]
    # kept in the first pair of groups that both agree in
    differ = vectors[a] != vectors[b]
    agrees = np.stack([~differ[:, _GROUP_OF[used] == g].any(axis=1) for g in range(GROUPS)], axis=1)
    first = np.argmax(np.stack([agrees[:, x] & agrees[:, y] for x, y in _PAIRS], axis=1), axis=1)
    ok = first == pair[a]
    a, b = a[ok], b[ok]
    ok = one_edit(code, off, a, b)
    a, b = np.concatenate([a[ok], b[ok]]), np.concatenate([b[ok], a[ok]])
    if not len(a):
        return None
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    at = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    count = np.diff(np.append(at, len(a)))
    return pa.RecordBatch.from_arrays(
        [pa.array([words[k] for k in a[at].tolist()], pa.string()), pa.array(count, pa.int64()), pa.array(n[b[at]], pa.int64()),
         pa.array([words[k] for k in b[at].tolist()], pa.string())], names=["word", "n_near", "near_n", "near"])


def _near(batches):
    """Sorted cells -> near words, some cells at a time, each whole."""
    held, counts = [], []
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("chars", "pair", "key", "i", "j", "t", "word", "n")]
        for *row, n in zip(*cols):
            row = tuple(row)
            if len(held) >= BLOCK and row[:5] != held[-1][:5]:
                if (out := _near_of(held, np.array(counts))) is not None:
                    yield out
                held, counts = [], []
            held.append(row)
            counts.append(n)
    if held and (out := _near_of(held, np.array(counts))) is not None:
        yield out


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n_near, near_n, near of the words (word, n) that have a near word: how many, and the one of largest n
    (ties: the smallest in code-point order) with its n."""
    cells = ["chars", "pair", "key", "i", "j"]
    found = (buckets(words, tile).repartition(*cells).sortWithinPartitions(*cells)
             .mapInArrow(_near, "word string, n_near long, near_n long, near string"))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("near_n"), F.col("b.near").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of forms (word, form): where following forms ends. Each form has a larger n, so there are no rings;
    each step doubles how far a word sees."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(spread_join(now, on, ["root"], "left"), "roots")
        if step.where("next is not null").isEmpty():
            return now
        now = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, mod: int = DELETE_MOD, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of docs (doc_id, text).

    A word's form is its near word of largest n, if that is at least `ratio` times the word's; its root is where
    following forms ends, or the word itself.
    """
    words = written(vocabulary(docs, mod, min_chars, min_count), "words")
    near = words.join(near_words(words, tile), "word", "left")
    shown = F.col("near_n") >= ratio * F.col("n")
    named = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(shown, F.col("near")).alias("form"), F.when(shown, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(named.where("form is not null"))
    return (named.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def query(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_BYTES = """flatten(list_transform(string_split({0}, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint]
    else [195::bigint, unicode(c)::bigint - 64] end))"""
ORACLE = f"""
with recursive crc_table as (select list_transform(range(256), lambda v: list_reduce(list_prepend(v::bigint, list_transform(range(8), lambda i: 0::bigint)),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) as t),
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) as run from documents),
each as materialized (select doc_id, run, count(*) as times from runs group by all),
hashed as (select run, times, xor(list_reduce(list_prepend(4294967295::bigint, {_BYTES.format("coalesce(doc_id::varchar, '') || ':' || run")}),
    lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1])), 4294967295::bigint) as h from each, crc_table),
cut as (select times, case when h % {DELETE_MOD} = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
    else run end as word from hashed),
words as materialized (select word, sum(times)::bigint as n from cut where length(word) >= {MIN_CHARS} group by word having sum(times) >= {MIN_COUNT}),
gone as materialized (select word, n, unnest(range(1, length(word) + 1)) as i, left(word, i::int - 1) || substr(word, i::int + 1) as rest from words),
pairs as (select a.word, b.word as near, b.n as near_n from gone a join gone b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union select g.word, w.word, w.n from gone g join words w on w.word = g.rest
    union select w.word, g.word, g.n from gone g join words w on w.word = g.rest),
best as (select word, count(*)::bigint as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from pairs group by word),
forms as materialized (select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when near_n >= {RATIO} * w.n then near end as form,
    case when near_n >= {RATIO} * w.n then near_n end as form_n from words w left join best b on w.word = b.word),
up as (select word, word as root, form as next from forms
    union all select up.word, f.word, f.form from up join forms f on f.word = up.next)
select f.word, f.form, up.root, f.n, f.n_near, f.form_n from forms f join up on up.word = f.word and up.next is null
"""

"""Token-ID output: one concatenated id array per segment, with Elias-Fano document boundaries.

`write` encodes whole texts in ascending doc_id order and stores segments of about SEGMENT_IDS
ids; `read_documents` and `read_ids` read them back. The file format is a Parquet table (so that
Spark commits it once and recovers from lost tasks) with one row per segment:

    part, seq          place of the segment in doc_id order
    n_docs, n_ids      documents and ids in it
    width              bytes of an id (2 where the vocabulary allows, else 4), little-endian
    ids                the concatenated ids, each document's followed by the end id
    low_bits, low, high, samples         Elias-Fano code of the n_docs + 1 boundaries (eliasfano)
    n_null, first_id, id_bits, id_low, id_high   documents without doc_id, which come first, and
                       the code of the other doc_ids less the first

A document's global offset is its place in the segment plus the ids of all segments before it;
those sums run over segment headers only.

Encoding is the tokenizers library's own, called for the distinct pieces between spaces that a
worker meets: a byte-level pre-tokenizer always splits before a space that has a non-space on either
side, so the pieces' ids, one after another, are the text's. For the same reason new pieces are
encoded JOINED at a time, as one text, and told apart by the tokens that begin with a space; pieces
that hold other white space, or begin a text, are encoded singly. Texts with a space between white
space on both sides are encoded whole, as are texts that hold the string of an added token (such as
<|endoftext|>), which the library turns into that token's id.

Defined cases: a null or empty text is the end id alone; null doc_ids come first; equal doc_ids
follow each other by text; an empty table writes an empty table; a text longer than a segment is
a segment of its own. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import eliasfano
from .blocks import scratch_path, worker_cache

END_ID = 0
SEGMENT_IDS = 1 << 18
#: Distinct pieces kept by a worker; beyond it the table starts anew with those met again since.
MAX_PIECES = 1 << 19
JOINED = 512
TEXTS_AT_ONCE = 256

#: What a byte-level vocabulary writes for a space.
SPACE = "\u0120"
#: White space, a space, and white space or the end; the space stands first, as it is what a search finds fastest.
_ODD = re.compile(r" (?:(?=\s)|\Z)(?<=\s )")

SEGMENT = ("part int, seq int, n_docs long, n_ids long, width int, ids binary, low_bits int, low binary, high binary, "
           "samples binary, n_null long, first_id long, id_bits int, id_low binary, id_high binary")
_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                    ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()),
                    ("high", pa.binary()), ("samples", pa.binary()), ("n_null", pa.int64()), ("first_id", pa.int64()),
                    ("id_bits", pa.int32()), ("id_low", pa.binary()), ("id_high", pa.binary())])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Codes(dict):
    """piece -> its row in the encoder's table; new pieces are noted and encoded later, together."""

    def __init__(self, owner, lead):
        self.owner, self.lead = owner, lead

    def __missing__(self, piece):
        owner = self.owner
        code = self[piece] = owner.n
        if not self.lead:
            owner.single.append(len(owner.new))
        owner.new.append(self.lead + piece)
        owner.n += 1
        return code


class PieceEncoder:
    def __init__(self, path: str, max_pieces: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.starts = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.starts[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(SPACE)]] = True
        self.max_pieces = max_pieces or MAX_PIECES
        #: batches of texts that met a piece, up to 2
        self.seen = np.zeros(self.max_pieces, np.uint8)
        self.reset()

    def reset(self):
        self.head, self.tail = _Codes(self, ""), _Codes(self, " ")
        self.n, self.new, self.single = 0, [], []
        self.flat, self.offset = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)

    def add(self, text: str) -> int:
        """A text that is encoded whole."""
        self.single.append(len(self.new))
        self.new.append(text)
        self.n += 1
        return self.n - 1

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of pieces that begin with a space, and how many each has."""
        chunks = [pieces[i : i + JOINED] for i in range(0, len(pieces), JOINED)]
        texts = ["".join(c) for c in chunks]
        out, n = [], []
        for chunk, ids in zip(chunks, self._ids(texts)):
            ids = np.array(ids, np.uint32)
            start = np.flatnonzero(self.starts[ids])
            if len(start) == len(chunk) and start[0] == 0:
                out.append(ids)
                n.append(np.diff(np.append(start, len(ids))))
            else:  # a space that isn't a token's first character
                each = self._ids(chunk)
                out.append(np.fromiter(chain.from_iterable(each), np.uint32))
                n.append(np.array([len(x) for x in each]))
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.concatenate(n) if n else np.zeros(0, np.int64)

    def _flush(self):
        if not self.new:
            return
        # with white space besides the space that it begins with: alone
        # (a printable piece has none: of white space only the space is printable)
        alone = np.array([not (len(p) > 1 and p.isprintable()) and len(p.split()) != 1 for p in self.new])
        alone[self.single] = True
        spaced, n_spaced = self._joined([p for p, a in zip(self.new, alone.tolist()) if not a])
        each = self._ids([p for p, a in zip(self.new, alone.tolist()) if a])
        n = np.zeros(len(alone), np.int64)
        n[alone], n[~alone] = [len(x) for x in each], n_spaced
        first = self.n - len(n)
        if self.n + 1 > len(self.offset):
            self.offset = np.concatenate([self.offset, np.zeros(max(len(self.offset), len(n)) + 1, np.int64)])
        ends = self.offset[first] + np.cumsum(n)
        self.offset[first + 1 : self.n + 1] = ends
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), int(ends[-1])), np.uint32)])
        of_alone = np.repeat(alone, n)
        fresh = np.empty(len(of_alone), np.uint32)
        fresh[~of_alone] = spaced
        if each:
            fresh[of_alone] = np.fromiter(chain.from_iterable(each), np.uint32)
        self.flat[self.offset[first] : ends[-1]] = fresh
        self.new, self.single = [], []

    def _renew(self):
        """Starts the table anew with the pieces that were met in more than one batch of texts."""
        head, tail, n, flat, offset, seen = self.head, self.tail, self.n, self.flat, self.offset, self.seen
        self.reset()
        keep = np.flatnonzero(seen[:n] > 1)[: self.max_pieces // 2]
        code = np.full(n, -1)
        code[keep] = np.arange(len(keep))
        for old, new in ((head, self.head), (tail, self.tail)):
            at = code[list(old.values())].tolist() if old else []
            new.update((p, c) for p, c in zip(old, at) if c >= 0)
        size = np.diff(offset[: n + 1])[keep]
        ends = np.concatenate([[0], np.cumsum(size)])
        self.flat = flat[np.repeat(offset[keep] - ends[:-1], size) + np.arange(ends[-1])]
        self.offset, self.n = ends, len(keep)
        self.seen = np.zeros(self.max_pieces, np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has, without the end id."""
        if self.n > self.max_pieces:
            self._renew()
        codes, per_text = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if not text:
                continue
            if any(a in text for a in self.added) or _ODD.search(text):
                c = [self.add(text)]
            else:
                pieces = text.split(" ")
                c = list(map(self.tail.__getitem__, pieces))
                c[0] = self.head[pieces[0]]
            per_text[k] = len(c)
            codes += c
        self._flush()
        c = np.array(codes, dtype=np.int64)
        if self.n > len(self.seen):
            self.seen = np.concatenate([self.seen, np.zeros(max(len(self.seen), self.n), np.uint8)])
        met = np.zeros(self.n, np.uint8)
        met[c] = 1
        self.seen[: self.n] = np.minimum(self.seen[: self.n] + met, 2)
        n = self.offset[c + 1] - self.offset[c]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.offset[c] - ends[:-1], n) + np.arange(ends[-1])
        of_text = np.concatenate([[0], np.cumsum(per_text)])
        return self.flat[at], np.diff(ends[of_text])


def encoder(path: str, max_pieces: int | None = None) -> PieceEncoder:
    return worker_cache(("tokens", path, max_pieces), lambda: PieceEncoder(path, max_pieces))


def _segment(part, seq, width, ids, counts, doc_ids):
    bounds = np.concatenate([[0], np.cumsum(counts)])
    code = eliasfano.encode(bounds)
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    first = int(known[0]) if len(known) else 0
    ident = eliasfano.encode(known.astype(np.uint64) - np.uint64(first % 2**64))
    row = [part, seq, len(counts), int(bounds[-1]), width, np.concatenate(ids).astype(f"<u{width}").tobytes(),
           code["low_bits"], code["low"], code["high"], code["samples"], len(doc_ids) - len(known), first,
           ident["low_bits"], ident["low"], ident["high"]]
    return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _ARROW)], schema=_ARROW)


def _encode_segments(path: str, end_id: int, segment_ids: int, max_pieces: int | None = None):
    def run(batches):
        enc, part, seq = encoder(path, max_pieces), TaskContext.get().partitionId(), 0
        ids, counts, doc_ids, total = [], [], [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                piece = batch.slice(i, TEXTS_AT_ONCE)
                flat, n = enc.encode(piece.column("text").to_pylist())
                ends = np.concatenate([[0], np.cumsum(n)])
                for k, doc in enumerate(piece.column("doc_id").to_pylist()):
                    ids += [flat[ends[k] : ends[k + 1]], np.array([end_id], np.uint32)]
                    counts.append(int(n[k]) + 1)
                    doc_ids.append(doc)
                    total += counts[-1]
                    if total >= segment_ids:
                        yield _segment(part, seq, enc.width, ids, counts, doc_ids)
                        ids, counts, doc_ids, total, seq = [], [], [], 0, seq + 1
        if counts:
            yield _segment(part, seq, enc.width, ids, counts, doc_ids)
    return run


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
          segment_ids: int = SEGMENT_IDS, max_pieces: int | None = None) -> None:
    """Encodes docs (doc_id, text) into segments under path, in ascending doc_id order. The ids are the same for any
    `max_pieces`: a worker that keeps fewer needs less memory and more time."""
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    (ordered.mapInArrow(_encode_segments(tokenizer or default_tokenizer(), end_id, segment_ids, max_pieces), SEGMENT)
     .write.option("compression", "zstd").parquet(path))


def _documents(batches):
    names = ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        for r in (row for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist()):
            n = r["n_docs"]
            bounds = eliasfano.decode(n + 1, r["low_bits"], r["low"], r["high"])
            raw = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:])]
            known = n - r["n_null"]
            doc = (eliasfano.decode(known, r["id_bits"], r["id_low"], r["id_high"]).astype(np.uint64)
                   + np.uint64(r["first_id"] % 2**64)).astype(np.int64)
            ids = pa.concat_arrays([pa.nulls(r["n_null"], pa.int64()), pa.array(doc)])
            cols = [pa.array(np.full(n, r["part"], np.int32)), pa.array(np.full(n, r["seq"], np.int32)), ids,
                    pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(cols, kinds)], names=names)


def segments(spark, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)


def segment_starts(seg: DataFrame) -> DataFrame:
    """part, seq, base: ids before each segment. Sums per part, then over parts: headers only."""
    heads = seg.select("part", "seq", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = (heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select(F.col("part").alias("_p"), F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("_b")))
    inside = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))
    return (heads.withColumn("_in", inside).join(parts, F.col("part") == F.col("_p"))
            .select(F.col("part").alias("_part"), F.col("seq").alias("_seq"), (F.col("_b") + F.col("_in")).alias("base")))


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the files."""
    seg = segments(spark, path)
    rows = seg.mapInArrow(_documents, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    base = segment_starts(seg)
    return (rows.join(base, (F.col("part") == F.col("_part")) & (F.col("seq") == F.col("_seq")))
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def read_ids(segment, i: int) -> np.ndarray:
    """The ids of document i of a segment row, found by select on the coded boundaries."""
    code = (segment["low_bits"], bytes(segment["low"]), bytes(segment["high"]), bytes(segment["samples"]))
    a, b = (eliasfano.get(k, *code) for k in (i, i + 1))
    w = segment["width"]
    return np.frombuffer(bytes(segment["ids"])[a * w : b * w], f"<u{w}").astype(np.int64)


def encode_and_read(docs: DataFrame, max_pieces: int | None = None) -> DataFrame:
    path = scratch_path(docs, "tokens")
    write(docs, path, max_pieces=max_pieces)
    return read_documents(docs.sparkSession, path)


def query(spark, sf_dir: str) -> DataFrame:
    return encode_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet"))

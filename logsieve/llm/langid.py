"""Language identification by spans: script ranges, per-word scores, Viterbi.

Each word has a score for each language: the log-likelihood of its hashed byte 4-grams under the
language's counts. The script of the word's letters (by code point range) first narrows the
languages down to those that were seen to use it. A Viterbi pass over the words, with a penalty for
each switch of language, then labels spans, so that words shared by languages follow their
neighbours. A document's language is the one whose spans hold most letters, its score that share.

A filter needs more than that share, which is large for noise too: `identifiable` also asks that the n-grams be more
likely under the languages of the document's spans than if all n-grams were equally likely (a log-likelihood ratio
below 0 is noise; no threshold is fitted. A text too short for an n-gram stays).

The model is fitted on at most about FIT_DOCS labelled documents (a hash of doc_id picks them; fewer
are all used), counted in Spark tasks; FIT_DOCS is the bound, whatever the input's size. Everything
else covers whole texts of all documents.

Defined cases: a null text or one without a letter is `und` with score 0; words without letters take
any language; a script that no language was seen to use leaves all as candidates; with nothing to
learn from every document is `und`; null doc_ids are never learned from; equal rows get equal
results. Columns other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import blocks, worker_cache
from .wordtable import WordTable, byte_grams, letters, sums

FIT_DOCS = 8192
BUCKETS = 1 << 17
GRAMS = (4,)
SMOOTH = 0.3
#: what a word's log-likelihood counts against the penalty: its n-grams overlap
WEIGHT = 0.5
SWITCH = 12.0
UND = "und"
#: a script belongs to a language that has at least this share of its letters in it
SCRIPT_SHARE = 0.002
#: documents scoring below this have no language that a filter may rely on
MIN_SCORE = 0.3
#: Bytes of text times languages that a task scores at a time.
BLOCK = 1 << 24
#: First code points of script ranges (Unicode blocks) and the script each begins.
SCRIPTS = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
           (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
           (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0x20000, "han"))
NAMES = sorted({s for _, s in SCRIPTS})
_STARTS = np.array([a for a, _ in SCRIPTS])
_SCRIPT = np.array([NAMES.index(s) for _, s in SCRIPTS])


def script_of(word: str) -> int:
    """The script that most of the word's letters are in (of equals the first by name)."""
    if word.isascii():
        return NAMES.index("latin")
    code = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    return int(np.bincount(_SCRIPT[np.searchsorted(_STARTS, code, "right") - 1]).argmax())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


# ------------------------------------------------------------------ model

def _count(batches):
    """(lang, slot, n): n-gram counts, and after them letters per script."""
    worker_cache(None, None)  # what an operator before this one left in the worker
    for batch, _, _ in blocks(batches):
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            words = [letters(w) for k, t in zip(langs, batch.column("text").to_pylist()) if k == lang for w in t.split()]
            words = [w for w in words if w]
            if not words:
                continue
            grams, _ = byte_grams(words, GRAMS, BUCKETS)
            scripts = [script_of(w) for w in words]
            n = np.concatenate([np.bincount(grams, minlength=BUCKETS),
                                np.bincount(scripts, [len(w) for w in words], minlength=len(NAMES)).astype(np.int64)])
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(n[slot])],
                                             names=["lang", "slot", "n"])


class Model:
    def __init__(self, langs: list[str], logp: np.ndarray, allowed: np.ndarray):
        #: languages by name, log-probabilities [bucket, language], and which scripts each may use [script, language]
        self.langs, self.logp, self.allowed = langs, logp, allowed

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Scores per language, then the numbers of letters and of n-grams."""
        clean = [letters(w) for w in words]
        grams, ends = byte_grams(clean, GRAMS, BUCKETS)
        out = np.zeros((len(words), len(self.langs) + 2), np.float32)
        out[:, :-2] = WEIGHT * sums(self.logp[grams], ends)
        out[:, -2] = [len(w) for w in clean]
        out[:, -1] = np.diff(ends)
        ok = self.allowed[[script_of(w) for w in clean]]
        out[:, :-2][~ok & ok.any(axis=1, keepdims=True)] = -1e6
        out[out[:, -2] == 0, :-2] = 0  # no letter: any language
        out[out[:, -2] == 0, -1] = 0
        return out


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """The model from text and lang of docs (doc_id, text, lang), or about fit_docs of them."""
    known = docs.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    n = known.count()
    if n > fit_docs:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * (fit_docs / n)))
    # at most languages * (BUCKETS + scripts) rows
    counts = (known.select("text", "lang").mapInArrow(_count, "lang string, slot long, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(counts.column("lang").to_pylist()))
    at = np.searchsorted(langs, counts.column("lang").to_numpy()) if langs else np.zeros(0, np.int64)
    table = np.zeros((BUCKETS + len(NAMES), len(langs)))
    table[counts.column("slot").to_numpy(), at] = counts.column("n").to_numpy()
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    logp = np.log((grams + SMOOTH) / (grams.sum(axis=0) + SMOOTH * BUCKETS)).astype(np.float32)
    return Model(langs, logp, scripts >= SCRIPT_SHARE * scripts.sum(axis=0))


def viterbi(scores: np.ndarray, off: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of every row of scores, each stretch off[i]:off[i + 1] a sequence of its own.

    All sequences step forward together, the longest first, so a step is one array operation.
    """
    n_seq, (n, k) = len(off) - 1, scores.shape
    label = np.zeros(n, np.int64)
    order = np.argsort(-np.diff(off), kind="stable")
    start, length = off[:-1][order], np.diff(off)[order]
    order_len = -length  # ascending, for searchsorted
    active = int(np.searchsorted(order_len, 0, "left"))
    if not active:
        return label
    value = scores[start[:active]].astype(np.float64)
    # what each place came from: the same label, or, where jump is set, the best one before it
    jump = np.zeros((n, k), bool)
    best = np.zeros(n, np.int8 if k < 128 else np.int32)
    count = np.searchsorted(order_len, -np.arange(int(length[0])), "left")  # sequences longer than t
    for t in range(1, int(length[0])):
        m = count[t]
        v, at = value[:m], start[:m] + t
        b = v.argmax(axis=1)
        floor = v[np.arange(m), b][:, None] - switch
        j = v < floor
        jump[at], best[at] = j, b
        value[:m] = np.where(j, floor, v) + scores[at]
    now = value.argmax(axis=1)
    for t in range(int(length[0]) - 1, -1, -1):
        m = count[t]
        at, cur = start[:m] + t, now[:m]
        label[at] = cur
        now[:m] = np.where(jump[at, cur], best[at], cur)
    return label


def _label(texts, model, table):
    values, off = table.lookup(texts)
    label = viterbi(values[:, :-2], off)
    return label, values, off


# ------------------------------------------------------------------ Spark

def _table(model: Model) -> WordTable:
    """The worker's word table for this model, which the table holds, so that its id stays its own."""
    return worker_cache(("langid", id(model)), lambda: WordTable(model.word_scores, len(model.langs) + 2))


def _block(model: Model) -> int:
    return max(1 << 18, BLOCK // max(1, len(model.langs)))


def _shares(texts, model, table, k):
    """Of each text: the language whose spans hold most letters, all letters, that one's share, and the log-likelihood
    ratio of its n-grams under the spans' languages to equally likely ones."""
    n = len(texts)
    label, values, off = _label(texts, model, table)
    row = np.repeat(np.arange(n), np.diff(off))
    held = np.bincount(row * k + label, values[:, -2], minlength=n * k).reshape(n, k)
    total, top = held.sum(axis=1), held.argmax(axis=1)
    gain = values[np.arange(len(label)), label] / WEIGHT + values[:, -1] * np.log(BUCKETS)
    return (top, total, np.where(total > 0, held[np.arange(n), top] / np.maximum(total, 1), 0.0),
            np.bincount(row, gain, minlength=n))


def _predict(model_bc):
    def run(batches):
        model = model_bc.value
        table, k = _table(model), len(model.langs)
        for batch, _, _ in blocks(batches, size=_block(model)):
            top, total, share, _ = _shares(batch.column("text").to_pylist(), model, table, k)
            names = [model.langs[i] if t > 0 else UND for i, t in zip(top, total)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(share)],
                                             names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of docs (doc_id, text)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not model.langs:
        return d.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    return d.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, lang_pred string, score double")


def _span_rows(model_bc):
    import re
    word = re.compile(r"\S+")

    def run(batches):
        model = model_bc.value
        table = _table(model)
        for batch, _, _ in blocks(batches, size=_block(model)):
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            label, _, off = _label(texts, model, table)
            rows = []
            for i, text in enumerate(texts):
                own = label[off[i] : off[i + 1]]
                if not len(own):
                    continue
                cut = np.flatnonzero(np.diff(own)) + 1
                begins = [m.start() for m in word.finditer(text)]
                firsts = [0, *cut.tolist()]
                for a, b in zip(firsts, [*firsts[1:], len(own)]):
                    rows.append((ids[i], begins[a] if a else 0, begins[b] if b < len(own) else len(text), model.langs[own[a]]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "start", "end", "lang"])
    return run


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, start, end (code points) and lang of each span of docs (doc_id, text); texts without words have none."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not model.langs:
        return d.sparkSession.createDataFrame([], "doc_id long, start long, end long, lang string")
    return d.mapInArrow(_span_rows(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, start long, end long, lang string")


def identified(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of docs (doc_id, text, lang); fitted on rows that aren't held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), fit_docs)
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _keep(model_bc, min_score):
    def run(batches):
        model = model_bc.value
        table, k = _table(model), len(model.langs)
        for batch, _, _ in blocks(batches, size=_block(model)):
            _, total, share, gain = _shares(batch.column("text").to_pylist(), model, table, k)
            yield batch.filter(pa.array((total > 0) & (share >= min_score) & (gain >= 0)))
    return run


def identifiable(docs: DataFrame, fit_docs: int = FIT_DOCS, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs, all columns kept, that have a language: not `und`, a score of at least min_score, and
    n-grams not less likely under its spans' languages than in noise."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), fit_docs)
    if not model.langs:
        return docs.limit(0)
    return docs.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(model), min_score), docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return identified(spark.read.parquet(f"{sf_dir}/documents.parquet"))

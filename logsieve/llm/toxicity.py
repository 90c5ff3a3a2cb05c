"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its hashed byte n-grams (3 to 5 bytes of `<word>`) and the word itself; each
bucket has a DIM-long embedding. A document is the average of all its words' subword embeddings,
and a linear softmax over it gives the two classes' probabilities. Embeddings and softmax are trained
jointly (numpy, Adagrad, class-weighted cross-entropy), so an unseen misspelling scores by the character
n-grams that it shares with words seen in training.

Average and softmax are linear until the last step, so after training each bucket is one number (its
embedding on the difference of the two output vectors), a word the sum of its buckets' numbers, and a
document's logit their sum over its subword count: exact, and worked out once per distinct word.

Training takes at most FIT_DOCS labelled documents (picked by a hash of doc_id; fewer are all used) in
one task, whose memory that bounds: only its distinct subwords per document are kept. Everything else
covers whole texts of all documents.

Defined cases: a text without words, empty or null, has the score of the bias alone; without labels, or
with labels of one class only, the score is that class's share of labels (0 without any); repeated
label rows count once each; null labels and null doc_ids are never learned from; equal texts get equal
scores. Columns other than doc_id, text and toxic are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import blocks, worker_cache
from .wordtable import WordTable, byte_grams, sums

FIT_DOCS = 8192
BUCKETS = 1 << 18
SIZES = (3, 4, 5)
DIM = 8
EPOCHS = 8
#: a subword is learned if at least so many training documents have it; PRIOR_DOCS more say nothing of it
MIN_DOCS = 3
PRIOR_DOCS = 4
#: a log ratio below this starts as 0
DULL = 1.0
BATCH = 64
RATE = 0.5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams and of the word itself, and n + 1 offsets."""
    low = [w.lower() for w in words]
    grams, ends = byte_grams(low, SIZES, BUCKETS)
    whole = np.array([hash_word(w) for w in low], np.int64)
    out = np.insert(grams, ends[1:], whole)
    return out, ends + np.arange(len(ends))


def hash_word(word: str) -> int:
    import zlib
    raw = word.encode()
    return (zlib.crc32(raw) ^ (zlib.adler32(raw) * 0x9E3779B1)) % BUCKETS


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct subword buckets of a text and their shares."""
    words, n = np.unique(np.array(text.split(), dtype=object), return_counts=True)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    grams, ends = subwords(list(words))
    ids, at = np.unique(grams, return_inverse=True)
    share = np.bincount(at, np.repeat(n, np.diff(ends)))
    return ids, (share / share.sum()).astype(np.float32)


def _one_line(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number by damped Newton steps: (slope, intercept)."""
    center, spread = x.mean(), max(float(x.std()), 1e-9)
    z, w = np.stack([(x - center) / spread, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + [0.02 * w[0], 0]
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag([0.02, 1e-6])
        w -= np.clip(np.linalg.solve(hess, grad), -1, 1)
    slope = max(w[0], 0.1) / spread
    return float(slope), float(w[1] - slope * center)


def train(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Jointly trained (bucket scores, bias) for the difference of the two classes' logits."""
    rng = np.random.default_rng(17)
    # A subword of very few documents only tells those apart: it stays at zero, like one never seen.
    in_docs = np.stack([np.bincount(np.concatenate([bags[i][0] for i in np.flatnonzero(y == c)]), minlength=BUCKETS)
                        for c in (0, 1)]).astype(np.float64)
    n_docs = np.bincount(y, minlength=2)
    seen = in_docs.sum(axis=0) >= MIN_DOCS
    bags = [(ids[k], share[k]) for ids, share in bags for k in [seen[ids]]]
    # The first dimension starts as the subword's log ratio between the classes, drawn to 0 where it is rare or small.
    ratio = (in_docs + 0.5) / (n_docs + 1)[:, None]
    ratio = np.log(ratio[1] / ratio[0]) * (in_docs.sum(axis=0) / (in_docs.sum(axis=0) + PRIOR_DOCS)) * seen
    ratio = np.sign(ratio) * np.maximum(np.abs(ratio) - DULL, 0)
    emb = rng.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32) * seen[:, None]
    emb[:, 0] = ratio
    weight = np.sqrt(len(y) / (2.0 * n_docs))  # between the sample's proportions and equal classes
    scale, shift = _one_line(np.array([(ratio[ids] * share).sum() for ids, share in bags]), y, weight[y])
    out, bias = rng.normal(0, 0.01, (DIM, 2)).astype(np.float32), np.array([-shift / 2, shift / 2], np.float32)
    out[0] = -scale / 2, scale / 2
    g_emb, g_out, g_bias = np.full((BUCKETS, DIM), 1e-8, np.float32), np.full((DIM, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    step = np.array([RATE / scale, RATE * scale / 20, RATE], np.float32)  # of embeddings, softmax, bias
    for epoch in range(epochs):
        r_emb, r_out, r_bias = step * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for first in range(0, len(order), BATCH):
            pick = order[first : first + BATCH]
            ends = np.concatenate([[0], np.cumsum([len(bags[i][0]) for i in pick])])
            ids = np.concatenate([bags[i][0] for i in pick])
            share = np.concatenate([bags[i][1] for i in pick])
            hidden = sums(emb[ids] * share[:, None], ends).astype(np.float32)
            logit = hidden @ out + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= weight[y[pick]][:, None] / len(pick)
            d_hidden = p @ out.T
            d_out, d_bias = hidden.T @ p, p.sum(axis=0)
            uniq, at = np.unique(ids, return_inverse=True)
            part = np.repeat(d_hidden, np.diff(ends), axis=0) * share[:, None]
            d_emb = np.stack([np.bincount(at, part[:, j], len(uniq)) for j in range(DIM)], axis=1).astype(np.float32)
            g_emb[uniq] += d_emb**2
            emb[uniq] -= r_emb * d_emb / np.sqrt(g_emb[uniq])
            g_out += d_out**2
            out -= r_out * d_out / np.sqrt(g_out)
            g_bias += d_bias**2
            bias -= r_bias * d_bias / np.sqrt(g_bias)
    return emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


class Model:
    def __init__(self, scores: np.ndarray, bias: float):
        self.scores, self.bias = scores, bias

    def word_values(self, words: list[str]) -> np.ndarray:
        """Sum of the word's bucket scores, and how many subwords it has."""
        grams, ends = subwords(words)
        return np.stack([sums(self.scores[grams], ends), np.diff(ends)], axis=1)

    def probability(self, total: np.ndarray, count: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -30, 30)))


def _train_task(batches):
    bags, y = [], []
    for batch, _, _ in blocks(batches):
        bags += [bag(t) for t in batch.column("text").to_pylist()]
        y += batch.column("toxic").to_pylist()
    y = np.array(y, np.int64)
    full = [i for i, b in enumerate(bags) if len(b[0])]
    if len(set(y[full].tolist())) == 2:
        scores, bias = train([bags[i] for i in full], y[full])
    else:  # nothing to tell apart
        p = float(np.clip(y.mean(), 1e-9, 1 - 1e-9)) if len(y) else 1e-9
        scores, bias = np.zeros(BUCKETS, np.float32), float(np.log(p / (1 - p)))
    yield pa.RecordBatch.from_arrays([pa.array([scores.astype("<f4").tobytes()]), pa.array([bias])], names=["scores", "bias"])


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """The model from labelled (doc_id, text, toxic), or about fit_docs of its rows."""
    known = labelled.where("text is not null and toxic is not null and doc_id is not null").select("doc_id", "text", "toxic")
    n = known.count()
    if n > fit_docs:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * (fit_docs / n)))
    one = known.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id", "text")).coalesce(1)
    got = one.mapInArrow(_train_task, "scores binary, bias double").first()
    return Model(np.frombuffer(got.scores, "<f4"), got.bias) if got else Model(np.zeros(BUCKETS, np.float32), -20.0)


def _table(model: Model) -> WordTable:
    """The worker's word table for this model, which the table holds, so that its id stays its own."""
    return worker_cache(("toxicity", id(model)), lambda: WordTable(model.word_values, 2))


def _score(model_bc):
    def run(batches):
        model = model_bc.value
        table = _table(model)
        for batch, _, _ in blocks(batches):
            values, off = table.lookup(batch.column("text").to_pylist())
            both = sums(values, off)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.probability(both[:, 0], both[:, 1]))],
                                             names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of docs (doc_id, text)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def scored(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of docs (doc_id, text); labels (doc_id, toxic) that aren't held out teach."""
    taught = labels.select(F.col("doc_id").alias("_id"), "toxic").where(~held_out(F.col("_id")))
    model = fit(docs.select("doc_id", "text").join(taught, F.col("doc_id") == F.col("_id")), fit_docs)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def query(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

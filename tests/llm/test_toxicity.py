"""Toxicity (4): held-out recall and precision, unseen misspellings, exactness of the collapsed model, edge rows."""

import random
import zlib

import numpy as np

from logsieve.llm import toxicity as tx

DOCS = "doc_id long, text string, toxic string, score string"


def _corpus(rng, n=600):
    clean = ["".join(rng.choice(["ba", "lo", "mi", "ter", "son", "que", "ra"]) for _ in range(rng.choice([2, 3]))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(clean) for _ in range(rng.choice([10, 40, 150]))]
        y = int(i % 6 == 0)
        if y:
            for _ in range(max(1, len(w) // 30)):
                w[rng.randrange(len(w))] = rng.choice(["jerkface", "dimwit", "scumbag"])
        rows.append((i, " ".join(w), "x", "x"))
        labels.append((i, y, 1))
    return rows, labels


def test_held_out_and_misspellings(spark):
    rows, labels = _corpus(random.Random(4))
    clean = rows[1][1]
    rows += [(2000, clean + " dimwitt scumbagg jerkfaces", "x", "x"), (2001, clean, "x", "x"), (2002, None, "x", "x"),
             (2003, "", "x", "x"), (2004, " \n", "x", "x"), (None, clean + " dimwit dimwit", "x", "x"),
             (2006, (clean + " ") * 400, "x", "x"), (2001, clean, "x", "x")]
    labels += [(None, 1, 1), (2003, 1, 1), (1, None, 1), (5, 0, 1), (5, 0, 1), (99999, 1, 1)]
    d = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    got = tx.scored(d, lab).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    y = {i: t for i, t, _ in labels[:600]}
    test = [r for r in got if r.held_out and r.doc_id in y]
    assert np.mean([by[r.doc_id].predicted == y[r.doc_id] for r in test]) >= 0.97
    assert by[2000].predicted == 1 and by[2001].predicted == 0 and by[None].predicted == 1 and by[2006].predicted == 0
    assert by[2002].score == by[2003].score == by[2004].score


def test_few_labels(spark):
    d = spark.createDataFrame([(i, f"text number {i}", "x", "x") for i in range(12)], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.score < 1e-6 for r in tx.scored(d, none).collect())
    one = spark.createDataFrame([(i, 0) for i in range(12)], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in tx.scored(d, one).collect())
    assert tx.scored(d.limit(0), one).count() == 0


def test_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    # in these tables only the English rows' labels go with words of the texts
    english = spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id")
    y = {r.doc_id: r.toxic for r in labels.join(english, "doc_id").collect()}
    got = [r for r in tx.query(spark, sf).collect() if r.held_out and r.doc_id in y]
    toxic = [r for r in got if y[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in got if not y[r.doc_id]) <= 0.01 * len(got)


def test_collapsed_model_is_the_average():
    rng = np.random.default_rng(0)
    m = tx.Model(rng.normal(size=tx.BUCKETS).astype(np.float32), 0.3)
    text = "some Words, some é words"
    values = m.word_values(text.split()).sum(axis=0)
    ids, share = tx.bag(text)
    assert abs(values[0] / values[1] - (m.scores[ids] * share).sum()) < 1e-5


def test_scores_by_brute_force(spark):
    """A score is the softmax of the average of the vectors of all subwords, of every word as often as it stands."""
    rng = np.random.default_rng(7)
    emb, out, bias = rng.normal(size=(tx.BUCKETS, 3)), rng.normal(size=(3, 2)), rng.normal(size=2)
    model = tx.Model((emb @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))
    texts = ["one two two three", "Wörter und words", "x", "", None, "a b " * 3000, "one\ttwo\n  two"]
    frame = spark.createDataFrame([(i, t, "x", "x") for i, t in enumerate(texts)], DOCS)
    for r in tx.score(frame, model).collect():
        ids = [int(b) for w in (texts[r.doc_id] or "").split() for b in tx.subwords([w])[0]]
        hidden = emb[ids].mean(axis=0) if ids else np.zeros(3)
        logit = hidden @ out + bias
        p = np.exp(logit - logit.max())
        assert abs(r.score - p[1] / p.sum()) < 1e-4

"""The corpus pipeline, stage by stage against brute-force versions on a small copy of documents."""

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from logsieve.llm import hyperminhash, mixing, tokens, winnowing

from .test_decontaminate import brute as leaks
from .test_hyperminhash import brute as components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


#: letters, but of no language: drawn evenly
_RNG = random.Random(8)
NOISE = [" ".join("".join(_RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(40)) for _ in range(6)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    sf = "/root/testdata/sf0.001"
    path = tmp_path_factory.mktemp("small")
    rng = random.Random(1)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").collect()]
    more = [(1000, "123 ... 456", None, "src1", 0), (1001, None, "en", "src1", 0), (1002, "", None, None, 0),
            (None, "a document without an id, of its own", "en", None, 0), (1004, rows[1][1] + " more", "en", "src2", 0),
            (3, rows[3][1], *rows[3][2:])]
    more += [(1200 + i, NOISE[i], "en", "src1", 0) for i in range(len(NOISE))]
    for i in range(10):
        words = rng.choice(items).split()
        words[rng.randrange(len(words))] = "changed"
        more.append((1100 + i, rows[i][1] + "\n" + " ".join(words) + " end", "en", "src3", 0))
    spark.createDataFrame(rows + more, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = corpus_pipeline.written(stage(spark, docs, folder), name)
        after = [(r.doc_id, getattr(r, "text", None)) for r in out.collect()]
        ids = lambda x: sorted((d for d, _ in x), key=str)
        if name != "token_output":
            assert out.columns == docs.columns
        if name == "language_id":
            assert ids(after) == ids([x for x in before if any(c.isalpha() for c in x[1] or "") and x[1] not in NOISE])
        elif name == "near_dedup":
            stay = {d for d, _, c in components(before, 5, 80) if d == c}
            assert sorted(after, key=str) == sorted({x for x in before if x[0] in stay}, key=str)
        elif name == "decontaminate":
            bad = {d for d, _ in leaks(before, items, 80)}
            assert sorted(after, key=str) == sorted((x for x in before if x[0] not in bad), key=str) and len(after) < len(before)
        elif name == "mix":
            taken = {r.doc_id: r.taken for r in mixing.mix(docs)[0].collect()}
            got = {}
            for d, t in after:
                got[d] = got.get(d, 0) + len(t.split())
            assert got == {d: n for d, n in taken.items() if n} and got
        else:
            enc = tokens.encoder(tokens.default_tokenizer()).tokenizer
            want = sorted((str(d), zlib.crc32(np.array(enc.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes())) for d, t in before)
            assert sorted((str(r.doc_id), r.ids_crc32) for r in out.collect()) == want
        docs = out
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, docs.collect()))


def test_empty(spark, folder, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_with_the_names_of_ours(spark):
    """Extra columns named as what the stages work with go through them untouched."""
    names = ["words", "start", "_d", "_s", "_k", "_pk", "_size", "_uid", "_nth", "_kept", "_row", "size", "pass", "fingerprint", "_n", "_p"]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefghijk") * 3 for _ in range(30)), "en", f"s{i % 2}", 0, *[f"{n}{i}" for n in names]) for i in range(30)]
    rows += [(30 + i, *rows[i][1:]) for i in range(5)] + [(3, "another text of an id", "en", "s1", 0, *names)]
    docs = spark.createDataFrame(rows, COLUMNS + "".join(f", `{n}` string" for n in names))
    once = hyperminhash.deduplicated(docs)
    assert once.columns == docs.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, [r for r in docs.collect() if r.doc_id < 30]))
    mixed = mixing.mixed_documents(docs)
    by = {(r.doc_id, r["words"]): r for r in docs.collect()}
    got = mixed.collect()
    assert mixed.columns == docs.columns and got
    for r in got:
        was = by[r.doc_id, r["words"]]
        assert was.text.startswith(r.text) and all(r[n] == was[n] for n in names)
    prints = winnowing.fingerprints(docs)
    assert sorted(prints.columns) == sorted(docs.columns) and prints.where("fingerprint like 'fingerprint%'").isEmpty()

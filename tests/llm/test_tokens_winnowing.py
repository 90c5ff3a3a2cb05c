"""Token files (3) and winnowing (6): round trips and brute force."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from logsieve.llm import eliasfano, tokens, winnowing

DOCS = "doc_id long, text string, n_chars long, part string, place string"
TEXTS = ["", None, " ", "a", "  two  spaces ", "tab\t here \n\n  end  ", "é 漢字   nb   em", "it's we'll 'S x'd 12 345",
         "<|endoftext|> plain", "\x1c \x1f x", "word " * 3000, "x" * 5000, "same", "same", "line\n line", "a　 b 　c", " \n x"]


def _frame(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in zip(ids, texts)], DOCS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab1'\" \t\n  é漢.,s"), max_size=40), max_size=6))
def test_pieces_are_the_librarys_ids(texts):
    enc = tokens.encoder(tokens.default_tokenizer())
    flat, n = enc.encode(texts)
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert flat.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


def test_table_starts_anew_with_what_it_met_twice(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 60)
    enc = tokens.PieceEncoder(tokens.default_tokenizer())
    rng = np.random.default_rng(4)
    kept = 0
    for _ in range(40):
        texts = [" ".join(f"w{k}" + "\n" * int(k % 5 == 0) for k in np.minimum(rng.zipf(1.3, 30), 10**6)) for _ in range(4)]
        flat, n = enc.encode(texts)
        want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert flat.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]
        kept += len(enc.tail) > 0 and enc.n < 60
    assert kept and enc.n < 400


def test_added_tokens_are_the_unchanged_librarys():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    texts = ["a<|endoftext|>b", "<|endoftext|>", "one <|endoftext|> two  three <|endoftext|>\n", "<|endoftext |> <|endoftext", *filter(None, TEXTS)]
    flat, n = tokens.encoder(tokens.default_tokenizer()).encode(texts)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert plain.token_to_id("<|endoftext|>") in want[0]
    assert flat.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano(steps):
    v = np.cumsum([s if s % 3 else 0 for s in steps]) if steps else np.zeros(0, np.int64)
    c = eliasfano.encode(v)
    assert eliasfano.decode(c["n"], c["low_bits"], c["low"], c["high"]).tolist() == v.tolist()
    for i in range(0, len(v), 37):
        assert eliasfano.get(i, c["low_bits"], c["low"], c["high"], c["samples"]) == v[i]


def test_token_files(spark, tmp_path):
    ids = [5, 3, 9, 2, None, 7, 7, 11, -4, 0, 1 << 60, 30, 31, 32, None, 33, 34]
    docs = _frame(spark, TEXTS, ids)
    path = str(tmp_path / "tokens")
    tokens.write(docs, path, segment_ids=500)
    rows = tokens.read_documents(spark, path).orderBy("start").collect()
    enc = tokens.encoder(tokens.default_tokenizer()).tokenizer
    code = lambda t: enc.encode(t or "", add_special_tokens=False).ids + [0]
    order = sorted(zip(ids, TEXTS), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    start = 0
    for r, (doc, text) in zip(rows, order):
        want = np.array(code(text), "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    assert len(rows) == len(TEXTS)
    seen = []
    for seg in tokens.segments(spark, path).orderBy("part", "seq").collect():
        seen += [tokens.read_ids(seg, i).tolist() for i in range(seg.n_docs)]
    assert seen == [code(t) for _, t in order]
    assert tokens.encode_and_read(_frame(spark, [])).count() == 0


def _slow_winnow(b, k, w):
    if not b:
        return []
    grams = [b[i : i + k] for i in range(len(b) - k + 1)] or [b]
    off = np.array([0, len(b)])
    h, at, _ = winnowing.winnow(np.frombuffer(b, np.uint8), off, k, 1)
    assert at.tolist() == list(range(len(grams)))
    w = min(w, len(grams))
    keep = sorted({max(range(i, i + w), key=lambda j: (-int(h[j]), j)) for i in range(len(grams) - w + 1)})
    return [(int(h[j]), j) for j in keep]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abé", max_size=120), min_size=1, max_size=5))
def test_winnow_brute(texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    h, at, ends = winnowing.winnow(np.frombuffer(b"".join(raw), np.uint8), off, 5, 7)
    for i, b in enumerate(raw):
        got = list(zip(h[ends[i] : ends[i + 1]].tolist(), at[ends[i] : ends[i + 1]].tolist()))
        assert got == _slow_winnow(b, 5, 7)


def test_beside_next(spark):
    ids = [5, 3, 9, 2, None, 7, 7, 11, -4, 0, 1 << 60, 30, 31, 32, None, 33, 34]
    order = sorted(zip(ids, TEXTS), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    for parts in (1, 3, 40):
        rows = winnowing.beside_next(_frame(spark, TEXTS, ids), parts).collect()
        got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in rows)
        want = []
        for i, (doc, text) in enumerate(order):
            t, nxt = text or "", order[(i + 1) % len(order)][1] or ""
            h = len(t) // 2
            want.append((str(doc), len(t), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()))
        assert got == sorted(want)
        same = [r for r in rows if r.doc_id in (32, 31)]
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows) and len(same) == 2
    h, at = winnowing.from_string(max((r.fingerprint for r in rows), key=len))
    assert len(h) == len(at) and (np.diff(at) > 0).all() and np.diff(at).max() <= winnowing.WINDOW
    assert winnowing.beside_next(_frame(spark, [])).count() == 0
    one = winnowing.beside_next(_frame(spark, ["only text"])).first()
    assert one.near_next == 1.0
    plain = winnowing.fingerprints(_frame(spark, TEXTS, ids))
    assert plain.count() == len(TEXTS)


def test_likeness_by_brute_force(spark):
    """near_edited and near_next are the shared part of the hashes that plain winnowing selects."""
    rng = np.random.default_rng(6)
    base = "".join(chr(97 + c) for c in rng.integers(0, 9, 400))
    texts = [base, base[:200] + base[:300], base[100:] + "é", "short", "", None, base * 3, base]
    picked = lambda t: {h for h, _ in _slow_winnow((t or "").encode(), winnowing.K, winnowing.WINDOW)}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    rows = {r.doc_id: r for r in winnowing.beside_next(_frame(spark, texts), 3).collect()}
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        assert abs(rows[i].near_edited - like(picked(t), picked(t[: len(t) - half] + nxt[:half]))) < 1e-12
        assert abs(rows[i].near_next - like(picked(t), picked(nxt))) < 1e-12


def test_odd_spaces_and_pieces_with_white_space():
    white = [c for c in map(chr, range(0x110000)) if re.match(r"\s", c)]
    texts = [a + b + " " + c + d for a in ("", "x") for b in ["", "x", *white] for c in ["", "x", *white] for d in ("", "x", "\u4e00")]
    assert [bool(tokens._ODD.search(t)) for t in texts] == [bool(re.search(r"\s (?:\s|\Z)", t)) for t in texts]
    assert [c for c in white if c.isprintable()] == [" "]
    enc = tokens.PieceEncoder(tokens.default_tokenizer())
    ids, n = enc.encode(texts)
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_a_smaller_table_of_pieces_gives_the_same_ids():
    """The pipeline's encoder keeps fewer pieces than op3's: it holds no more than those and a batch, and all ids are the same."""
    texts = [" ".join(f"w{(7 * i + j) % 900} x{i * j % 53}" for j in range(40)) for i in range(120)] + ["", "a  b", "é\n c"]
    whole, small = tokens.PieceEncoder(tokens.default_tokenizer()), tokens.PieceEncoder(tokens.default_tokenizer(), max_pieces=100)
    for i in range(0, len(texts), 10):
        (a, n), (b, m) = whole.encode(texts[i : i + 10]), small.encode(texts[i : i + 10])
        assert a.tolist() == b.tolist() and n.tolist() == m.tolist()
    assert small.n < whole.n and small.n <= 100 + 10 * 80


def test_block_size_changes_no_sketch():
    import pyarrow as pa

    from logsieve.llm import blocks, hyperminhash
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": [None, ""] + [" ".join(f"w{i * j % 97}" for j in range(i)) for i in range(58)]})
    assert blocks.SMALL_BLOCK < blocks.BLOCK_BYTES
    run = lambda: [r for out in hyperminhash._sketcher(5)([batch]) for r in out.to_pylist()]
    want, size = run(), hyperminhash.SMALL_BLOCK
    try:
        hyperminhash.SMALL_BLOCK = 300
        assert run() == want and len(want) == 60
    finally:
        hyperminhash.SMALL_BLOCK = size

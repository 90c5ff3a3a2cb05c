"""The queries that SQL can express, against DuckDB on the smallest tables; all queries' columns."""

import duckdb
import pytest

from logsieve.llm import catalog

SF = "/root/testdata/sf0.001"
FIRST = {
    "op2_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op3_token_output": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op4_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op5_hyperminhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op6_winnowing": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op8_suffix_repeats": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op9_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op10_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op11_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op13_merkle_manifest": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    norm = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    want = sorted((norm(r[names.index(c)] for c in cols) for r in res.fetchall()), key=repr)
    assert sorted((norm(r[c] for c in cols) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(FIRST))
def test_one_row_per_document(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert FIRST[name] <= set(df.columns)
    ids = [r.doc_id for r in df.select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())

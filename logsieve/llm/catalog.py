"""The registered queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (decontaminate, exactdedup, hyperminhash, langid, linejoin, merkle, mixing, repeats, sharding, spelling,
               tokens, toxicity, winnowing)

QUERIES = {
    "op1_decontamination": decontaminate.query,
    "op2_language_id": langid.query,
    "op3_token_output": tokens.query,
    "op4_toxicity": toxicity.query,
    "op5_hyperminhash": hyperminhash.query,
    "op6_winnowing": winnowing.query,
    "op7_line_join": linejoin.query,
    "op8_suffix_repeats": repeats.query,
    "op9_sharding": sharding.query,
    "op10_mixing": mixing.query,
    "op11_exact_dedup": exactdedup.query,
    "op12_spelling_variants": spelling.query,
    "op13_merkle_manifest": merkle.query,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op10_mixing": mixing.ORACLE,
    "op11_exact_dedup": exactdedup.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}

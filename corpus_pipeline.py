"""From raw documents to token files, in five stages, each on what the one before it kept.

language_id      rows whose language cannot be told (no letters, or no language holding MIN_SCORE of them) go
near_dedup       of documents linked by word-5-gram similarity of 0.8 or more, the smallest doc_id stays;
                 texts that share a doc_id are told apart
decontaminate    documents holding four fifths of a benchmark item's words in place, or of 13 in a row, go, row by row
mix              documents as often, and as far, as the mix to source weights takes them
token_output     the mix as token files; a row for each of its documents, read back from them

Each stage's result is written as Parquet in the shared folder and read again for the next; all but the last
have the columns of documents. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsieve.llm import decontaminate, hyperminhash, langid, mixing, tokens
from logsieve.llm.blocks import written

#: Distinct pieces that a worker's encoder keeps: fewer than in op3, as the stages before it left their memory in the workers.
MAX_PIECES = 1 << 17


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identifiable(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hyperminhash.deduplicated(docs, k=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_rows(docs, benchmark, passage=decontaminate.PASSAGE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.encode_and_read(docs, max_pieces=MAX_PIECES)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("mix", mix),
    ("token_output", token_output),
]

#: The stages are statistical or iterative; tests/llm/test_pipeline.py holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

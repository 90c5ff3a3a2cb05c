"""Sharding by longest-processing-time scheduling, groups kept whole.

A group (rows of equal text) goes to one shard. Groups in order of falling size each go to the
least loaded shard, which a heap yields. The heap must not see every group of a large corpus, so
it gets items: each group that holds at least 1 / (shards * LARGE) of all bytes is an item of its
own (at most shards * LARGE of these exist), and all smaller groups are first gathered by their
hash into `bins` items. The number of items is therefore bounded for any input, and with fewer
groups than bins it is the plain algorithm. Shards differ by one item's size at most.

Sizes are summed per group with partial aggregation, so a group that holds a third of the rows
meets no single task; slots come from chunked running totals.

Defined cases: null text counts as the group of null texts, size 1, CRC-32 of no bytes (0); an
empty text is another group; null doc_id is a row like any other; repeated rows are separate
rows of one group; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import with_running, written

SHARDS = 16
LARGE = 512
BINS = 1 << 14


def text_group(text: Column) -> Column:
    """What copies share: 128 bits of the text's SHA-256 (null: a group of its own)."""
    return F.coalesce(F.substring(F.sha2(text, 256), 1, 32), F.lit(""))


def schedule(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Longest processing time first: item name -> shard. Ties go by name, then by shard number."""
    load = [(0, s) for s in range(shards)]
    out = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        total, s = load[0]
        out[name] = s
        heapq.heapreplace(load, (total + size, s))
    return out


def shard(rows: DataFrame, shards: int = SHARDS, large: int = LARGE, bins: int = BINS) -> DataFrame:
    """rows (grp string, size long, ...) with `shard`: all rows of a group in one shard, bytes near equal."""
    spark = rows.sparkSession
    groups = written(rows.groupBy("grp").agg(F.sum("size").alias("group_size")), "groups")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    is_large = F.col("group_size") * F.lit(shards * large) >= F.lit(total)
    bin_of = F.concat(F.lit("bin"), F.pmod(F.xxhash64("grp"), F.lit(bins)).cast("string"))
    # at most shards * large + bins rows
    items = (groups.select(F.when(is_large, F.col("grp")).otherwise(bin_of).alias("item"), "group_size")
             .groupBy("item").agg(F.sum("group_size").alias("item_size")).collect())
    where = schedule([(r.item, r.item_size) for r in items], shards)
    kind = T.StructType([T.StructField("item", T.StringType()), T.StructField("shard", T.IntegerType())])
    # as bounded as the items: broadcast it
    own = F.broadcast(spark.createDataFrame([(k, v) for k, v in where.items() if not k.startswith("bin")], kind))
    binned = F.broadcast(spark.createDataFrame([(k, v) for k, v in where.items() if k.startswith("bin")], kind))
    out = (rows.join(own.select(F.col("item").alias("_own"), F.col("shard").alias("_s1")), F.col("grp") == F.col("_own"), "left")
           .withColumn("_bin", bin_of)
           .join(binned.select(F.col("item").alias("_item"), F.col("shard").alias("_s2")), F.col("_bin") == F.col("_item"), "left"))
    return out.withColumn("shard", F.coalesce("_s1", "_s2")).drop("_own", "_s1", "_bin", "_item", "_s2")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, grp, shard, slot for docs (doc_id, text)."""
    text = F.col("text")
    rows = written(docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), text_group(text).alias("grp")), "rows")
    out = shard(rows, shards).withColumn("okey", F.xxhash64("doc_id", "grp"))
    return (with_running(out, ["shard"], ["okey", "doc_id", "grp"], F.lit(1), "slot")
            .select("doc_id", "size", "text_crc32", "grp", "shard", "slot"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_documents(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                        F.lit(None).cast("int").alias("grown_shard"))

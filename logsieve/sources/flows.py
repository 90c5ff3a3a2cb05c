"""Network-flow scans (SRC7, SRC8, FLT4, FLT5).

A flow table is any DataFrame with the NETFLOW / MONIFLOW columns (parquet,
JDBC, a wide-column store connector). The time range is a plain `where`
on the time column, so Catalyst pushes it into the scan (parquet row-group
or partition pruning) and only the needed columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S

# Columns a flow must have to be kept; proto may be null (FLT4).
# --- fixed values: columns that must not be null ---
NETFLOW_REQUIRED = ["srcip", "dstip", "starttime", "endtime", "packernum", "bytesize"]
MONIFLOW_REQUIRED = ["srcip", "dstip", "appproto", "method"]
# --- end of fixed values ---


def _ts(v: str | Column, like: DataFrame, col: str) -> Column:
    if isinstance(v, Column):
        return v
    kind = like.schema[col].dataType.typeName()
    return F.to_timestamp_ntz(F.lit(v)) if kind == "timestamp_ntz" else F.to_timestamp(F.lit(v))


def scan_netflow(flows: DataFrame, start: str | Column, end: str | Column,
                 time_col: str = "starttime") -> DataFrame:
    """SRC7 + FLT5 + FLT4: flows with `start <= time_col < end` and no null
    in the required columns; typed NETFLOW columns."""
    ranged = flows.where((F.col(time_col) >= _ts(start, flows, time_col))
                         & (F.col(time_col) < _ts(end, flows, time_col)))
    kept = ranged.dropna(subset=NETFLOW_REQUIRED)
    return kept.select(*[F.col(f.name) for f in S.NETFLOW.fields])


def scan_moniflow(flows: DataFrame) -> DataFrame:
    """SRC8 + FLT4: monitored application flows without nulls."""
    return flows.dropna(subset=MONIFLOW_REQUIRED).select(*MONIFLOW_REQUIRED)


def netflow_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Fixture: NETFLOW rows from `lineitem` (FIXTURES §5)."""
    start = F.col("l_shipdate")
    end = F.when(F.col("l_linenumber") != 7,
                 F.timestamp_add("MINUTE", F.col("l_linenumber").cast("bigint"), start))
    return lineitem.select(
        F.concat(F.lit("10.1.0."), (F.col("l_suppkey") % 256).cast("string")).alias("srcip"),
        F.concat(F.lit("10.2.0."), (F.col("l_partkey") % 256).cast("string")).alias("dstip"),
        start.alias("starttime"),
        end.alias("endtime"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("proto"),
        F.col("l_quantity").cast("int").alias("packernum"),
        F.floor(F.col("l_extendedprice")).cast("int").alias("bytesize"),
    )


def moniflow_from_orders(orders: DataFrame) -> DataFrame:
    """Fixture: MONIFLOW rows from `orders` (FIXTURES §5)."""
    def ip(prefix: str, key: str) -> Column:
        k = F.col(key)
        return F.concat(F.lit(prefix), (F.floor(k / 256) % 256).cast("string"), F.lit("."), (k % 256).cast("string"))
    return orders.select(
        ip("10.3.", "o_custkey").alias("srcip"),
        ip("10.4.", "o_orderkey").alias("dstip"),
        F.col("o_orderpriority").alias("appproto"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("method"),
    )

"""A flow store laid out by time (SRC7, FLT5): a scan of a time range opens the files of that range only.

Flows are dealt out by ranges of time, sorted, and written under the period (day or month) they start in. A reader's
range becomes a filter on the period, which prunes folders, and on the time, which the files' statistics answer for
all files and row groups outside. A busy day is split over as many files as its rows ask for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .flows import _ts, scan_netflow

# How a period is named in its folder: a letter for its kind, so that it is read as text, and the date.
_PERIODS = {"day": "'d'yyyy-MM-dd", "month": "'m'yyyy-MM"}


def write_flows(flows: DataFrame, root: str, period: str = "day", time_col: str = "starttime", mode: str = "append",
                max_rows_per_file: int = 5_000_000) -> None:
    """Adds flows to the store. Flows without a start time, which no range holds, are left out."""
    dated = flows.where(F.col(time_col).isNotNull()).withColumn("period", F.date_format(time_col, _PERIODS[period]))
    # flows of one moment are many: their addresses split them further
    ordered = dated.repartitionByRange(F.col(time_col), F.xxhash64("srcip", "dstip")).sortWithinPartitions("period", time_col)
    ordered.write.partitionBy("period").option("maxRecordsPerFile", max_rows_per_file).mode(mode).parquet(root)


def stored_flows(spark: SparkSession, root: str, start: str, end: str, time_col: str = "starttime") -> DataFrame:
    """SRC7 + FLT5 + FLT4 over the store: the rows that `scan_netflow` gives over the same flows."""
    store = spark.read.parquet(root)
    within = F.lit(False)
    for name in _PERIODS.values():
        first, last = (F.date_format(_ts(v, store, time_col), name) for v in (start, end))
        within = within | F.col("period").between(first, last)
    return scan_netflow(store.where(within), start, end, time_col)

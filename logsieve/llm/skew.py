"""A join whose hot keys meet a bounded broadcast instead of one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import written

#: A key is hot from this share (1 / HOT) of the rows on, so that at most HOT keys are.
HOT = 4096


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", hot: int = HOT) -> DataFrame:
    """left joined to right, which holds each key once, on the non-null columns `keys`.

    Keys that hold at least 1 / `hot` of left's rows, of which there are at most `hot`, join by a broadcast of their
    rows in right; all other keys join by a shuffle in which none holds more than that share. left is read twice:
    give a written table. Apart from the keys, no column may stand on both sides.
    """
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = left.count()
    common = F.broadcast(written(counts.where(F.col("_n") * F.lit(hot) >= F.lit(total)).select(*keys), "hot-keys"))
    one = left.join(common, keys, "left_semi").join(F.broadcast(right.join(common, keys, "left_semi")), keys, how)
    rest = left.join(common, keys, "left_anti").join(right.join(common, keys, "left_anti"), keys, how)
    return one.unionByName(rest)

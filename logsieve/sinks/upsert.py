"""A table that keeps one row per id (SNK6-SNK9): writing the same run again replaces its rows.

Rows lie in hash buckets of their id. A write reads the buckets that its ids fall in, drops the rows whose ids it
brings anew, and puts the buckets down as new folders, which one commit of the folder list makes current. Readers see
the table before or after a write, never between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..storage import FolderLog

_BUCKET = "_bucket"


class UpsertTable:
    """`key` is the id column, `buckets` the parts that a write replaces singly: choose it so that one fits a task."""

    def __init__(self, spark: SparkSession, root: str, key: str = "row", buckets: int = 16):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.log = FolderLog(spark, root)

    def upsert(self, rows: DataFrame) -> int:
        """Writes rows (one of each id, if ids repeat) and returns the version. Null ids share one row."""
        new = rows.dropDuplicates([self.key]).withColumn(_BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        have = self.log.current()
        if have:
            touched = {str(r[0]) for r in new.select(_BUCKET).distinct().collect()}  # as many as buckets at most
            old = self.log.read([e for b, e in have.items() if b in touched])
            if old is not None:
                mine = new.select(F.col(self.key).alias("_new"))
                kept = old.join(mine, F.col(self.key).eqNullSafe(F.col("_new")), "left_anti")
                new = new.unionByName(kept.withColumn(_BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")),
                                      allowMissingColumns=True)
        path = self.log.folder("data")
        new.repartition(self.buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(path)
        schema = new.drop(_BUCKET).schema.json()
        parts = [n for n in self.log._names(path) if n.startswith(f"{_BUCKET}=")]
        return self.log.commit({n.split("=")[1]: {"path": f"{path}/{n}", "schema": schema} for n in parts})

    def read(self) -> DataFrame | None:
        """All rows; None before the first write."""
        return self.log.read(list(self.log.current().values()))

"""STR5: periodic rule sync as a stream of ticks.

The original ran an endless loop with a sleep on the driver. Here a `rate`
source ticks once per interval and each micro-batch rebuilds the snapshots
(`sync_rules`); the checkpoint records the ticks, and stopping is
`query.stop()`. A scheduler calling `sync_rules` directly works as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.rules import SnapshotStore, TableSource, sync_rules


def start_rule_sync(spark: SparkSession, src: TableSource, store: SnapshotStore, checkpoint: str,
                    interval_seconds: int = 60, on_sync: Callable[[dict[str, int]], None] | None = None) -> StreamingQuery:
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def on_tick(_batch, _batch_id):
        counts = sync_rules(spark, src, store)
        if on_sync:
            on_sync(counts)

    return (ticks.writeStream.foreachBatch(on_tick).option("checkpointLocation", checkpoint)
            .trigger(processingTime=f"{interval_seconds} seconds").start())

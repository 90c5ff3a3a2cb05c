"""The streaming log job (SRC1, STR1-STR4, STR6, SNK10, J6, AGG3).

readStream -> foreachBatch: each micro-batch is parsed and matched once (persisted) and written to the syslog, genlog,
event and rejects tables, in folders of its own. One commit of the job's folder list (`storage.FolderLog`) then makes
all of them visible, with their row counts: a batch that died halfway shows nothing, and one replayed after a failure
replaces its own folders, also where it now has no rows, so that with the checkpoint results are effectively-once (the
original committed offsets before processing and so lost data on failure). `compact` rewrites the folders of past
batches as few files while readers run. Rules are re-read from their snapshots at the start of a micro-batch once they
are older than `refresh_seconds`.

Event names that no definition covers get one each (J6): the batch that meets a name first writes its definition with
its own tables, in the same commit, and later batches match it. A replay looks only at definitions of batches before
its own, so it writes the same ones again.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import events as ev
from ..plans.normalise import analyze
from ..sinks import documents as docs
from ..sources.rules import SNAPSHOT_EVENT_DEFS_SYSTEM, SnapshotStore
from ..storage import FolderLog

# --- fixed values ---
DEFAULT_REFRESH_SECONDS = 300
# What one task takes of a micro-batch, as lines (Kafka) or bytes of files: matched lines are held beside their fields,
# about 1 kB each, and log lines of that size are a few dozen bytes in a compressed file.
ROWS_PER_TASK = 250_000
BYTES_PER_TASK = 4 << 20
# --- end of fixed values ---

TABLES = ("syslog", "genlog", "event", "rejects", "definitions")
# Definitions made by the job come after all others where a name has several.
_LEARNED_SEQ = 1 << 62


def read_log_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                    options: dict | None = None, max_per_trigger: int | None = None,
                    key_col: str | None = None) -> DataFrame:
    """SRC1: raw log lines as a streaming frame with `value` and a stable `src_key`.

    Kafka (when its connector is present): subscribe options come from the
    caller; startingOffsets defaults to "latest" like the original consumer,
    and the source position (topic, partition, offset) keys the record ids.
    Parquet files with a `value` column serve tests and replays: their column
    `key_col` keys the record ids or, without one, the file's path and the row's
    place in it. Other file formats have no row number, so they need `key_col`.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
        # a topic of few partitions is read by as many tasks as can run
        opts.setdefault("minPartitions", str(spark.sparkContext.defaultParallelism))
        opts.setdefault("maxRecordsPerPartition", str(ROWS_PER_TASK))
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("value").cast("string").alias("value"),
                          F.concat_ws(":", "topic", "partition", "offset").alias("src_key"))
    if max_per_trigger:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger))
    reader = spark.readStream.format(fmt).options(**opts)
    if key_col:
        return reader.schema(f"value string, `{key_col}` string").load(path).select("value", F.col(key_col).alias("src_key"))
    if fmt != "parquet":
        raise ValueError(f"{fmt} lines have no stable position: name a column that has it")
    return reader.schema("value string").load(path).select(
        "value", F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")).alias("src_key"))


class RuleCache:
    """The current rule bundle on the driver; reloaded when older than
    `refresh_seconds` (STR4). `loader` returns {name: DataFrame}."""

    def __init__(self, loader: Callable[[], dict[str, DataFrame]],
                 refresh_seconds: float = DEFAULT_REFRESH_SECONDS, clock: Callable[[], float] = time.time):
        self.loader = loader
        self.refresh_seconds = refresh_seconds
        self.clock = clock
        self.loaded_at: float | None = None
        self.bundle: dict[str, DataFrame] = {}
        self.rows: dict[str, int] = {}
        self.reloads = 0
        self.failed_reloads = 0
        self._lock = threading.Lock()

    def current(self) -> dict[str, DataFrame]:
        with self._lock:
            now = self.clock()
            if self.loaded_at is None or now - self.loaded_at > self.refresh_seconds:
                try:
                    # Rule tables are configuration-sized: keep them cached between batches.
                    fresh = {k: v.cache() for k, v in self.loader().items()}
                    rows = {k: v.count() for k, v in fresh.items()}
                    # Rules that were there are never replaced by none.
                    gone = [k for k, n in self.rows.items() if n and not rows.get(k)]
                    if gone or (rows and not any(rows.values())):
                        for v in fresh.values():
                            v.unpersist()
                        raise ValueError(f"empty rule tables: {gone or list(rows)}")
                except Exception:  # noqa: BLE001
                    # Rules that cannot be read now must not stop the stream:
                    # keep the current ones and try again next batch.
                    if not self.bundle:
                        raise
                    self.failed_reloads += 1
                    return self.bundle
                old, self.bundle, self.rows = self.bundle, fresh, rows
                for v in old.values():
                    v.unpersist()
                self.loaded_at = now
                self.reloads += 1
            return self.bundle


@dataclass
class Outputs:
    """Where the tables go: folders under one root, in any file format Spark writes and reads."""
    root: str
    fmt: str = "parquet"
    forward: str | None = None          # SNK10 target (a directory, or a Kafka topic with fmt kafka)
    forward_fmt: str = "text"
    forward_options: dict = field(default_factory=dict)


def _entries(log: FolderLog, table: str, before: int | None = None) -> list[dict]:
    """A table's committed folders, in order of their batches."""
    found = [e for k, e in log.current().items() if k.split("/")[0] == table and (before is None or e["last"] < before)]
    return sorted(found, key=lambda e: e["first"])


def read_output(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame | None:
    """A table of the job as the latest commit has it: whole batches only. None before the first."""
    log = FolderLog(spark, root)
    return log.read(_entries(log, table), fmt)


def output_counts(spark: SparkSession, root: str) -> DataFrame:
    """AGG3: table, first_batch, last_batch, rows of every committed folder, after any restart."""
    log = FolderLog(spark, root)
    rows = [(t, e["first"], e["last"], e["rows"]) for t in TABLES for e in _entries(log, t)]
    return spark.createDataFrame(rows, "sink string, first_batch bigint, last_batch bigint, rows bigint")


def compact(spark: SparkSession, root: str, keep_batches: int = 100, rows_per_file: int = 5_000_000, fmt: str = "parquet") -> int:
    """STR6: rewrites what each table has of batches but the last `keep_batches` as few files, in one commit; returns
    the folders replaced. Rows and counts stay; readers that hold the old folders keep them until `vacuum`. The job
    may run on only while it isn't committing: call it between micro-batches (`LogJob.compact_every`)."""
    log = FolderLog(spark, root)
    add, drop = {}, []
    last = max((e["last"] for e in log.current().values()), default=-1)
    for table in TABLES:
        old = [e for e in _entries(log, table) if e["last"] <= last - keep_batches]
        if len(old) < 2:
            continue
        n = sum(e["rows"] for e in old)
        path = log.folder(table)
        log.read(old, fmt).repartition(max(1, -(-n // rows_per_file))).write.format(fmt).save(path)
        first, end = old[0]["first"], old[-1]["last"]
        add[f"{table}/{first}-{end}"] = {"path": path, "rows": n, "schema": old[-1]["schema"], "first": first, "last": end}
        drop += [k for k, e in log.current().items() if k.split("/")[0] == table and e["last"] <= last - keep_batches]
    if add:
        log.commit(add, drop)
    return len(drop)


class ProgressLog(StreamingQueryListener):
    """Keeps each micro-batch's progress (rows in, rates, durations) as a file of its own, for after a restart."""

    def __init__(self, spark: SparkSession, root: str):
        self.log = FolderLog(spark, root)
        self.failures = 0

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query": str(p.id), "run": str(p.runId), "batch_id": p.batchId, "at": p.timestamp, "rows_in": p.numInputRows,
               "duration_ms": dict(p.durationMs)}
        try:
            self.log.put(f"{self.log.root}/{p.id}/batch-{p.batchId:012}-{p.runId}.json", json.dumps(row))
        except Exception:  # noqa: BLE001  # a count that can't be kept must not end the stream
            self.failures += 1


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """batch_id, rows_in, at, run of every kept micro-batch."""
    return spark.read.schema("batch_id bigint, rows_in bigint, at string, run string").json(f"{root}/*/batch-*.json")


class LogJob:
    """One running log analysis stream. `learn` makes definitions of new event names (J6); with `rule_store` they are
    also added to the stored definitions, for other readers of the rules. `compact_every`: batches between compactions."""

    def __init__(self, rules: RuleCache, outputs: Outputs, *, log_rule_key: str = "logRule",
                 event_def_key: str = "eventDefRuleBySystem", key_col: str | None = "src_key",
                 tz: str = "UTC", learn: bool = False, rule_store: SnapshotStore | None = None, compact_every: int | None = None):
        self.rules = rules
        self.outputs = outputs
        self.log_rule_key = log_rule_key
        self.event_def_key = event_def_key
        self.key_col = key_col
        self.tz = tz
        self.learn = learn
        self.rule_store = rule_store
        self.compact_every = compact_every
        self.query: StreamingQuery | None = None

    def definitions(self, log: FolderLog, given: DataFrame, batch_id: int) -> DataFrame:
        """The definitions a batch matches against: the rules' and those made by batches before it."""
        learned = log.read(_entries(log, "definitions", before=batch_id), self.outputs.fmt)
        if learned is None:
            return given
        return ev.append_definitions(given, learned.withColumn("rule_seq", F.lit(_LEARNED_SEQ).cast("bigint")) if "rule_seq" in given.columns else learned)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """STR1: one micro-batch -> its tables, in one commit, and the optional forward."""
        if self.key_col and self.key_col not in batch.columns:
            raise ValueError(f"the stream has no column {self.key_col}, which names each line's source position")
        spark, out, bundle = batch.sparkSession, self.outputs, self.rules.current()
        log = FolderLog(spark, out.root)
        known = self.definitions(log, bundle[self.event_def_key], batch_id)
        a = analyze(batch, bundle[self.log_rule_key], known, key_col=self.key_col, tz=self.tz, task_bytes=BYTES_PER_TASK)
        a.matched.persist()
        a.genlog.persist()
        new = None
        try:
            add = {}

            def save(name: str, df: DataFrame) -> int:
                obs, path = Observation(name), log.folder(name)
                df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(out.fmt).save(path)
                add[f"{name}/{batch_id}"] = {"path": path, "rows": obs.get["rows"], "schema": df.schema.json(), "first": batch_id, "last": batch_id}
                return obs.get["rows"]

            if self.learn:
                new = ev.new_definitions(a.genlog, known).persist()
                if save("definitions", new):
                    a.event_defs = ev.append_definitions(known, new.withColumn("rule_seq", F.lit(_LEARNED_SEQ).cast("bigint"))
                                                         if "rule_seq" in known.columns else new)
                else:
                    del add[f"definitions/{batch_id}"]
            save("syslog", a.syslog_docs(self.tz))
            save("genlog", a.genlog_docs())
            save("event", a.event_docs())
            save("rejects", a.rejects(self.tz))
            if out.forward:
                lines = docs.genlog_lines(a.genlog)
                if out.forward_fmt == "kafka":
                    docs.forward_lines(lines, out.forward, "kafka", out.forward_options)
                else:
                    lines.select("value").write.mode("overwrite").format(out.forward_fmt).save(f"{out.forward}/batch_id={batch_id}")
            # a replay that now has no new names drops the ones it wrote before
            log.commit(add, drop=[f"definitions/{batch_id}"])
            if self.rule_store is not None and f"definitions/{batch_id}" in add:
                self.store_definitions(new)
        finally:
            for df in (a.genlog, a.matched, new):
                if df is not None:
                    df.unpersist()
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            compact(spark, out.root, keep_batches=self.compact_every, fmt=out.fmt)
            log.vacuum()

    def store_definitions(self, new: DataFrame) -> None:
        """SET1 in the rule store: a new version of the stored definitions, with those whose names it lacks."""
        stored = self.rule_store.load_bundle({"defs": SNAPSHOT_EVENT_DEFS_SYSTEM})["defs"]
        names = stored.select(ev.name_key(F.col("event_rule_name")).alias("k"))
        missing = new.join(names, ev.name_key(F.col("event_rule_name")) == F.col("k"), "left_anti")
        if not missing.isEmpty():
            self.rule_store.write_bundle({SNAPSHOT_EVENT_DEFS_SYSTEM: ev.append_definitions(stored, missing)})

    def start(self, raw_stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """STR2/STR6: start with a trigger (default: every 10 s) and a checkpoint folder."""
        w = raw_stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
        self.query = w.start()
        return self.query

    def start_limited(self, make_stream: Callable[[int], DataFrame], checkpoint: str, per_trigger: int, first: int,
                      trigger: dict | None = None) -> StreamingQuery:
        """STR3: start with a limit on the first micro-batch of its own, as after a long stop it meets all that has
        piled up. `make_stream(limit)` reads with that limit (`read_log_stream(max_per_trigger=limit)`). With a
        checkpoint that has a batch already, there is no first one, and the stream starts as usual."""
        commits = FolderLog(self.rules_session(), checkpoint)
        if not [n for n in commits._names(f"{checkpoint}/commits") if n.isdigit()]:
            # the first micro-batch starts at once, a second one long after this query is stopped
            q = self.start(make_stream(first), checkpoint, {"processingTime": "1 hour"})
            while q.isActive and not [n for n in commits._names(f"{checkpoint}/commits") if n.isdigit()]:
                q.awaitTermination(0.2)
            if q.exception():
                raise q.exception()
            q.stop()
        return self.start(make_stream(per_trigger), checkpoint, trigger)

    def rules_session(self) -> SparkSession:
        return next(iter(self.rules.current().values())).sparkSession

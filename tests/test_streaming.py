"""Replay, one commit a micro-batch, learned names, compaction, admission and counts."""

import uuid

import pytest
from pyspark.sql import functions as F

from logsieve import fixtures as fx
from logsieve.plans.catalog import system_event_defs, table
from logsieve.session import ensure_checkpoint_dir
from logsieve.sources.rules import SNAPSHOT_EVENT_DEFS_SYSTEM, SNAPSHOT_LOG_RULES, SnapshotStore
from logsieve.storage import FolderLog
from logsieve.streaming import (LogJob, Outputs, ProgressLog, RuleCache, compact, output_counts, read_log_stream,
                                read_output, read_progress)
from conftest import SF_SMALL

SINKS = ("syslog", "genlog", "event", "rejects")


def _base(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _job(spark, base, **options):
    rules = RuleCache(lambda: {"logRule": fx.log_rules_df(spark), "eventDefRuleBySystem": system_event_defs(spark)})
    return LogJob(rules, Outputs(f"{base}/out"), **options)


def _raw(spark, where="true"):
    return fx.raw_lines(table(spark, SF_SMALL, "events").where(where))


def _ids(spark, base, name, column="row"):
    df = read_output(spark, f"{base}/out", name)
    return sorted(r[0] for r in df.select(column).collect()) if df is not None else []


def test_restart_from_checkpoint_no_loss_no_doubles(spark):
    base = _base(spark, "replay")
    ev = table(spark, SF_SMALL, "events")
    progress = ProgressLog(spark, f"{base}/progress")
    spark.streams.addListener(progress)
    try:
        for part in ("event_id < 500", "event_id >= 500"):   # a new driver-side job each, same checkpoint
            _raw(spark, part).write.mode("append").parquet(f"{base}/in")
            _job(spark, base).start(read_log_stream(spark, "parquet", f"{base}/in", key_col="src_key"), f"{base}/ckpt",
                                    {"availableNow": True}).awaitTermination()
        for _ in range(50):   # the listener is told after the query has ended
            if spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty() is None and len(progress.log._names(f"{base}/progress")):
                break
    finally:
        spark.streams.removeListener(progress)
    rows = read_output(spark, f"{base}/out", "syslog").select("row").unionByName(read_output(spark, f"{base}/out", "rejects").select("row"))
    assert rows.count() == ev.count() and rows.distinct().count() == ev.count()
    counts = output_counts(spark, f"{base}/out").where(F.col("sink").isin("syslog", "rejects")).agg(F.sum("rows")).first()[0]
    assert counts == ev.count()
    orphans = read_output(spark, f"{base}/out", "event").join(read_output(spark, f"{base}/out", "genlog"), F.col("logid") == F.col("recordid"), "left_anti")
    assert orphans.count() == 0
    kept = read_progress(spark, f"{base}/progress").where("rows_in > 0").agg(F.sum("rows_in"), F.countDistinct("run")).first()
    assert tuple(kept) == (ev.count(), 2) and progress.failures == 0


def test_replayed_batch_replaces_its_own_output(spark):
    base = _base(spark, "idem")
    job = _job(spark, base)
    job.process(_raw(spark), 7)
    first = {t: _ids(spark, base, t) for t in SINKS}
    job.process(_raw(spark), 7)          # the same micro-batch again, as after a failure
    assert {t: _ids(spark, base, t) for t in SINKS} == first and first["genlog"]
    job.process(_raw(spark, "event_id < 0"), 7)   # and with no rows now
    assert all(_ids(spark, base, t) == [] for t in SINKS)


def test_a_batch_that_dies_between_two_sinks_shows_nothing(spark, monkeypatch):
    base = _base(spark, "half")
    job = _job(spark, base, learn=True)
    job.process(_raw(spark, "event_id % 2 = 0"), 0)
    before = {t: _ids(spark, base, t) for t in SINKS}
    from logsieve.plans.normalise import Analysis
    with monkeypatch.context() as m:
        m.setattr(Analysis, "event_docs", lambda self: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            job.process(_raw(spark, "event_id % 2 = 1"), 1)
    assert {t: _ids(spark, base, t) for t in SINKS} == before
    job.process(_raw(spark, "event_id % 2 = 1"), 1)
    whole = _base(spark, "whole")
    _job(spark, whole, learn=True).process(_raw(spark), 0)
    assert {t: _ids(spark, base, t) for t in SINKS} == {t: _ids(spark, whole, t) for t in SINKS}


def test_compaction_keeps_rows_and_readers(spark):
    base = _base(spark, "compact")
    job = _job(spark, base, learn=True)
    for i in range(5):
        job.process(_raw(spark, f"event_id % 5 = {i}"), i)
    before = {t: _ids(spark, base, t) for t in SINKS}
    counts = {r.sink: r.n for r in output_counts(spark, f"{base}/out").groupBy("sink").agg(F.sum("rows").alias("n")).collect()}
    held = read_output(spark, f"{base}/out", "syslog")
    folders = len(FolderLog(spark, f"{base}/out").current())
    assert compact(spark, f"{base}/out", keep_batches=2) >= 8
    assert len(FolderLog(spark, f"{base}/out").current()) < folders
    assert {t: _ids(spark, base, t) for t in SINKS} == before and held.count() == len(before["syslog"])
    assert {r.sink: r.n for r in output_counts(spark, f"{base}/out").groupBy("sink").agg(F.sum("rows").alias("n")).collect()} == counts
    gone = FolderLog(spark, f"{base}/out").vacuum(keep=1)
    assert len(gone) >= 8 and {t: _ids(spark, base, t) for t in SINKS} == before
    # a batch after the compaction, replayed, still replaces itself alone
    job.process(_raw(spark, "event_id % 5 = 4"), 4)
    assert {t: _ids(spark, base, t) for t in SINKS} == before


def test_each_new_name_gets_one_definition_once(spark):
    """Three batches with one new name in all: defined in the first, matched in each, also after a replay."""
    base = _base(spark, "names")
    store = SnapshotStore(spark, f"{base}/rules")
    store.write_bundle({SNAPSHOT_LOG_RULES: fx.log_rules_df(spark), SNAPSHOT_EVENT_DEFS_SYSTEM: system_event_defs(spark)})
    job = LogJob(RuleCache(store.load_bundle), Outputs(f"{base}/out"), learn=True, rule_store=store)
    lines = _raw(spark, "event_type = 'signup' AND event_id % 50 > 1")
    for i in (0, 1, 1, 2, 0):
        job.process(lines.where(F.col("src_key").cast("long") % 3 == i), i)
    defs = read_output(spark, f"{base}/out", "definitions").collect()
    assert len(defs) == 1 and defs[0].event_rule_name.lower() == "signup"
    events = read_output(spark, f"{base}/out", "event").collect()
    assert {e.event_rule_id for e in events} == {defs[0].event_rule_id} and len(events) == len(_ids(spark, base, "genlog")) > 3
    stored = store.load_bundle()["eventDefRuleBySystem"].where("lower(trim(event_rule_name)) = 'signup'").collect()
    assert [r.event_rule_id for r in stored] == [defs[0].event_rule_id]
    # a job without memory of this one, with the stored rules, has nothing to learn
    again = LogJob(RuleCache(store.load_bundle), Outputs(f"{base}/other"), learn=True)
    again.process(lines, 0)
    assert read_output(spark, f"{base}/other", "definitions") is None


def test_refresh_between_two_table_writes_sees_the_old_bundle(spark):
    store = SnapshotStore(spark, _base(spark, "bundle"))
    old, new = ([{"rule_seq": 0, "log_rule_id": v, "log_regex": "(a)"}] for v in ("old", "new"))
    store.write_bundle({SNAPSHOT_LOG_RULES: fx.log_rules_df(spark, old), SNAPSHOT_EVENT_DEFS_SYSTEM: system_event_defs(spark)})
    names = lambda: [r.log_rule_id for r in store.load_bundle()["logRule"].collect()]
    store.write(fx.log_rules_df(spark, new), SNAPSHOT_LOG_RULES)     # one table of the next sync is there, the other isn't
    assert names() == ["old"]
    held = store.load_bundle()["logRule"]
    store.write_bundle({SNAPSHOT_LOG_RULES: fx.log_rules_df(spark, new), SNAPSHOT_EVENT_DEFS_SYSTEM: system_event_defs(spark).limit(1)})
    assert names() == ["new"] and store.load_bundle()["eventDefRuleBySystem"].count() == 1
    assert [r.log_rule_id for r in held.collect()] == ["old"]


def test_folder_log(spark):
    log = FolderLog(spark, _base(spark, "log"))
    assert log.current() == {} and log.read([]) is None
    assert log.commit({"a": {"path": "x"}, "b": {"path": "y"}}) == 1
    assert log.commit({"a": {"path": "z"}}, drop=["b"]) == 2
    assert log.current() == {"a": {"path": "z"}} and log.current(1)["b"] == {"path": "y"}
    with pytest.raises(FileExistsError):
        log.put(f"{log.root}/_log/v{2:012}.json", "{}")


def test_file_positions_tell_equal_lines_apart(spark):
    base = _base(spark, "equal")
    line = fx.HEARTBEAT
    spark.createDataFrame([(line,)] * 30, "value string").repartition(2).write.parquet(f"{base}/in")
    found = []
    for attempt in ("a", "b"):
        job = _job(spark, f"{base}/{attempt}")
        job.start(read_log_stream(spark, "parquet", f"{base}/in"), f"{base}/{attempt}/ckpt", {"availableNow": True}).awaitTermination()
        found.append(set(_ids(spark, f"{base}/{attempt}", "syslog")))
    assert len(found[0]) == 30 and found[0] == found[1]
    with pytest.raises(ValueError):
        read_log_stream(spark, "text", f"{base}/in")


def test_empty_rules_never_replace_rules(spark):
    full = fx.log_rules_df(spark)
    sets = [full, full.limit(0), full]
    cache = RuleCache(lambda: {"logRule": sets.pop(0)}, refresh_seconds=-1)
    assert [cache.current()["logRule"].count() for _ in range(3)] == [len(fx.LOG_RULES)] * 3
    assert (cache.reloads, cache.failed_reloads) == (2, 1)
    with pytest.raises(ValueError):
        RuleCache(lambda: {"logRule": full.limit(0)}).current()


def test_rule_cache_refresh_interval():
    calls = []
    now = [0.0]
    cache = RuleCache(lambda: calls.append(1) or {}, refresh_seconds=300, clock=lambda: now[0])
    cache.current()
    now[0] = 200
    cache.current()
    now[0] = 301
    cache.current()
    assert len(calls) == 2


def test_a_large_micro_batch_is_matched_in_small_parts(spark, tmp_path, monkeypatch):
    """Tasks of a micro-batch take so many bytes of its files each, also where these are fewer than the cores' splits."""
    from logsieve.streaming import job
    _raw(spark).coalesce(1).write.parquet(str(tmp_path / "in"))
    monkeypatch.setattr(job, "BYTES_PER_TASK", 500)
    seen = []
    monkeypatch.setattr(job, "analyze", lambda *a, _of=job.analyze, **k: (lambda got: (seen.append(
        [r["count"] for r in got.matched.groupBy(F.spark_partition_id()).count().collect()]), got)[1])(_of(*a, **k)))
    base = _base(spark, "parts")
    _job(spark, base).start(read_log_stream(spark, "parquet", str(tmp_path / "in"), key_col="src_key"), f"{base}/ckpt",
                            {"availableNow": True}).awaitTermination()
    assert len(seen) == 1 and sum(seen[0]) == 1000 and len(seen[0]) > 8 and max(seen[0]) < 100


def test_input_steps_are_as_many_files_as_their_lines_need(spark, monkeypatch):
    from logsieve.plans import catalog
    from logsieve.streaming import job
    monkeypatch.setattr(job, "ROWS_PER_TASK", 100)
    base = _base(spark, "steps")
    assert catalog._in_files(spark, SF_SMALL, base, 3) == 4
    sizes = [r["count"] for r in spark.read.parquet(f"{base}/in").groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == 12 and sum(sizes) == 1000 and max(sizes) < 110

"""Rule sync and snapshots, cluster shapes, index reads, id modes."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from logsieve import fixtures as fx
from logsieve import schema as S
from logsieve.operators import parse as ps
from logsieve.plans.catalog import table
from logsieve.session import ensure_checkpoint_dir
from logsieve.sinks import clusters as cl
from logsieve.sources.index import read_index
from logsieve.sources.rules import (SNAPSHOT_EVENT_DEFS_SYSTEM, SNAPSHOT_EVENT_FIELDS, SNAPSHOT_LOG_RULES,
                                    SnapshotStore, TableSource, read_json_array_snapshot, sync_rules)
from logsieve.streaming.rulesync import start_rule_sync
from conftest import SF_SMALL


def _base_tables(spark, root):
    sup = table(spark, SF_SMALL, "supplier")
    tables = {
        "t_siem_log_regex": fx.log_regexes(table(spark, SF_SMALL, "part")),
        "t_siem_log_regex_lib": fx.log_regex_libs(sup),
        "t_siem_moni_ne": fx.moni_ne(sup),
        "t_moni_device_ip": fx.device_ips(sup),
        "t_siem_event_rule_def": fx.event_defs_df(spark),
        "t_siem_event_rule_field": fx.event_fields_df(spark),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    return TableSource(fmt="parquet", path_template=root + "/{name}")


def test_sync_rules_writes_every_snapshot(spark):
    root = f"{ensure_checkpoint_dir(spark)}/sync-{uuid.uuid4().hex}"
    src = _base_tables(spark, f"{root}/base")
    store = SnapshotStore(spark, f"{root}/snap")
    counts = sync_rules(spark, src, store)
    assert counts[SNAPSHOT_EVENT_DEFS_SYSTEM] == 6
    assert counts[SNAPSHOT_EVENT_FIELDS] == len(fx.EVENT_FIELDS)
    rules = store.read(SNAPSHOT_LOG_RULES)
    assert counts[SNAPSHOT_LOG_RULES] == rules.count() > 0
    # all text, no nulls, and rule_seq follows (log_rule_id, device_ip)
    assert all(t == "string" for c, t in rules.dtypes if c != "rule_seq")
    assert rules.where(F.col("eventid").isNull()).count() == 0
    ordered = [(r["log_rule_id"], r["device_ip"]) for r in rules.orderBy("rule_seq").collect()]
    assert ordered == sorted(ordered)
    bundle = store.load_bundle()
    assert bundle["logUserRule"].count() == 0 and "log_regex" in bundle["logUserRule"].columns


def test_rule_sync_stream_ticks(spark):
    root = f"{ensure_checkpoint_dir(spark)}/syncs-{uuid.uuid4().hex}"
    src = _base_tables(spark, f"{root}/base")
    store = SnapshotStore(spark, f"{root}/snap")
    def rows_now():
        try:   # the sync may be rewriting the snapshot at this very moment
            return store.read(SNAPSHOT_LOG_RULES).count()
        except Exception:  # noqa: BLE001
            return 0

    q = start_rule_sync(spark, src, store, f"{root}/ckpt", interval_seconds=5)
    try:
        deadline = time.time() + 120
        while time.time() < deadline and rows_now() == 0:
            time.sleep(2)
    finally:
        q.stop()
    assert store.read(SNAPSHOT_LOG_RULES).count() > 0


def test_rule_cache_keeps_rules_when_reload_fails():
    state = {"fail": False}

    class Frame:
        def cache(self):
            if state["fail"]:
                raise OSError("snapshot being rewritten")
            return self

        def count(self):
            return 1

        def unpersist(self):
            pass

    from logsieve.streaming import RuleCache
    now = [0.0]
    cache = RuleCache(lambda: {"logRule": Frame()}, refresh_seconds=0, clock=lambda: now[0])
    first = cache.current()
    state["fail"] = True
    now[0] = 1
    assert cache.current() is first and cache.failed_reloads == 1
    state["fail"] = False
    now[0] = 2
    assert cache.current() is not first and cache.reloads == 2


def test_json_array_snapshot_text(spark):
    text = spark.createDataFrame([('[{"a": "x", "b": null}, {"a": "y"}]',)], "value string")
    rows = read_json_array_snapshot(spark, text, ["a", "b"]).orderBy("rule_seq").collect()
    assert [(r["a"], r["b"], r["rule_seq"]) for r in rows] == [("x", "", 0), ("y", "", 1)]


def test_nested_and_flat_cluster_rows_agree(spark):
    pts = fx.points_from_embeddings(table(spark, SF_SMALL, "embeddings"))
    cen = cl.centres_of(pts)
    flat = cl.point_rows(pts, cen, "C", "2024-01-01 00:00:00", "d")
    # nested form built from a few known points (the shape a trainer returns)
    nested = spark.createDataFrame(
        [(0, [("10.0.0.1", [0.0, 0.0]), ("10.0.0.2", [3.0, 4.0])], [0.0, 5.0])], S.CLUSTER_RESULT)
    rows = cl.point_rows_nested(nested, "C", "2024-01-01 00:00:00", "d").orderBy("name").collect()
    assert [(r["name"], r["distance"], r["center_info"]) for r in rows] == [
        ("10.0.0.1", 0.0, "0.0#0.0"), ("10.0.0.2", 5.0, "3.0#4.0")]
    assert flat.count() == pts.count()
    assert flat.where(F.col("distance") < 0).count() == 0
    batch = cl.centre_rows_batch(spark.createDataFrame(
        [("r", "n", "0", "1.0", "C", "x", "bad time", "d", "0", "P")], ", ".join(f"{c} string" for c in cl.BATCH_COLUMNS)))
    b = batch.first()
    assert b["type"] is None and b["cltime"] is None


def test_read_index_needs_name_and_predicate(spark):
    with pytest.raises(ValueError):
        read_index(spark, "", "a = 1")
    with pytest.raises(ValueError):
        read_index(spark, "x", "")


def test_random_id_mode(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00~r~-~-~S~c",)], "value string")
    a = ps.parse(df, id_mode="random").first()["recordid"]
    b = ps.parse(df, id_mode="hash").first()["recordid"]
    assert len(a) == 32 and a != b and b == ps.parse(df).first()["recordid"]


def test_snapshot_versions(spark):
    store = SnapshotStore(spark, f"{ensure_checkpoint_dir(spark)}/versions-{uuid.uuid4().hex}")
    with pytest.raises(FileNotFoundError):
        store.read(SNAPSHOT_LOG_RULES, required=True)
    one = spark.createDataFrame([("a",)], "log_rule_id string")
    assert store.write(one, SNAPSHOT_LOG_RULES) == 1
    held = store.read(SNAPSHOT_LOG_RULES)
    two = spark.createDataFrame([("a",), ("b",)], "log_rule_id string")
    assert store.write(two, SNAPSHOT_LOG_RULES) == 2
    assert held.count() == 1 and store.read(SNAPSHOT_LOG_RULES).count() == 2   # the older version's files are still there
    # a version without its commit marker is still being written
    two.withColumn("rule_seq", F.lit(0)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .parquet(store.path(SNAPSHOT_LOG_RULES, 3))
    assert store.versions(SNAPSHOT_LOG_RULES) == [1, 2] and store.write(one, SNAPSHOT_LOG_RULES) == 4
    store.prune(SNAPSHOT_LOG_RULES, keep=1)
    assert store.versions(SNAPSHOT_LOG_RULES) == [4]


def test_upsert_keeps_one_row_of_each_id(spark):
    import uuid

    from logsieve.session import ensure_checkpoint_dir
    from logsieve.sinks.upsert import UpsertTable
    t = UpsertTable(spark, f"{ensure_checkpoint_dir(spark)}/upsert-{uuid.uuid4().hex}", buckets=4)
    assert t.read() is None
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").cast("string").alias("row"), F.lit(v).alias("v"))
    pick = lambda df: {r.row: r.v for r in df.collect()}
    t.upsert(rows(0, 50, "a"))
    held = t.read()
    t.upsert(rows(0, 50, "a"))            # the same run again
    assert t.read().count() == 50
    t.upsert(rows(40, 60, "b").unionByName(rows(40, 45, "b")))
    assert pick(t.read()) == {str(i): "a" if i < 40 else "b" for i in range(60)} and t.read().count() == 60
    t.upsert(rows(0, 0, "c"))
    assert t.read().count() == 60 and pick(held) == {str(i): "a" for i in range(50)}
    one = rows(3, 4, "d").withColumn("more", F.lit(1))
    t.upsert(one)
    assert pick(t.read())["3"] == "d" and t.read().count() == 60


def test_flow_store_opens_the_files_of_the_range_only(spark):
    import uuid

    from logsieve.session import ensure_checkpoint_dir
    from logsieve.sources.flows import scan_netflow
    from logsieve.sources.flowstore import stored_flows, write_flows
    flows = spark.range(4000).select(
        F.concat(F.lit("10.0.0."), (F.col("id") % 9).cast("string")).alias("srcip"), F.lit("10.1.1.1").alias("dstip"),
        F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 900)).alias("starttime"),
        F.timestamp_seconds(F.lit(1704070000) + F.col("id") * 900).alias("endtime"), F.lit(None).cast("string").alias("proto"),
        F.col("id").cast("int").alias("packernum"), F.when(F.col("id") % 7 > 0, F.lit(3)).alias("bytesize"))
    for period in ("day", "month"):
        root = f"{ensure_checkpoint_dir(spark)}/flows-{uuid.uuid4().hex}"
        write_flows(flows, root, period)
        got = stored_flows(spark, root, "2024-01-10 06:00:00", "2024-01-10 18:00:00")
        want = scan_netflow(flows, "2024-01-10 06:00:00", "2024-01-10 18:00:00")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 30
        files = spark.read.parquet(root).inputFiles()
        mine = [f for f in files if f"period={dict(day='d2024-01-10', month='m2024-01')[period]}/" in f]
        got = stored_flows(spark, root, "2024-01-10 06:00:00", "2024-01-10 18:00:00")
        got.collect()
        scan = got._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numFiles").value() == len(mine) < len(files)
        assert "GreaterThanOrEqual(starttime" in scan.toString()   # and the statistics skip what is in them

"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed from the driver tables (configuration tables are literals)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixtures as fx
from .. import schema as S
from ..operators import assembly as asm
from ..operators import events as ev
from ..operators import match as mt
from ..operators import parse as ps
from ..sinks import documents as docs
from .normalise import analyze

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.raw_lines(table(spark, sf_dir, "events"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ps.parse(raw_from_events(spark, sf_dir), key_col="src_key")


def system_event_defs(spark: SparkSession) -> DataFrame:
    return asm.event_defs_system(fx.event_defs_df(spark), fx.event_fields_df(spark))


def _analysis(spark: SparkSession, sf_dir: str, user: bool = False):
    users = fx.user_rules_df(spark) if user else None
    return analyze(raw_from_events(spark, sf_dir), fx.log_rules_df(spark), system_event_defs(spark),
                   key_col="src_key", user_rules=users)


# --- log path -----------------------------------------------------------------

def q_raw_parse(spark, sf_dir):
    """FLT1, FLT2, PRJ1, PRJ2: raw lines -> fields and payload parts."""
    p = _parsed(spark, sf_dir)
    return p.select("line", "n_fields", "recordid", "recvtime", "reportip", "reportapp",
                    "device_ip", "msg", "shifted")


def q_genlog_match(spark, sf_dir):
    """J3, PRJ3, AGG4: the 24-field genlog of every matched line."""
    return _analysis(spark, sf_dir).genlog.select(*S.GENLOG_FIELDS)


def q_syslog_docs(spark, sf_dir):
    """J3, PRJ5, SNK2, F1: raw-log documents with the match flag."""
    return _analysis(spark, sf_dir).syslog_docs()


def q_genlog_docs(spark, sf_dir):
    """SNK3, F7, F8: stored genlog documents."""
    return _analysis(spark, sf_dir).genlog_docs()


def q_user_rule_match(spark, sf_dir):
    """J4, PRJ4: genlog by user rules (named groups, whole content, no device filter)."""
    return _analysis(spark, sf_dir, user=True).genlog.select(*S.GENLOG_FIELDS)


def q_event_match_name(spark, sf_dir):
    """J5, PRJ6, SNK4: event documents for genlog names with a definition."""
    return _analysis(spark, sf_dir).event_docs()


def q_event_match_id(spark, sf_dir):
    """PRJ7: events straight from the genlog's rule id, name and level."""
    g = _analysis(spark, sf_dir).genlog
    return docs.event_docs(ev.match_by_id(g))


def q_new_event_rules(spark, sf_dir):
    """J6, SET1: one new definition per event name without one."""
    g = _analysis(spark, sf_dir).genlog
    return ev.new_definitions(g, system_event_defs(spark))


def q_new_rule_events(spark, sf_dir):
    """The events of lines whose name got a new definition."""
    g = _analysis(spark, sf_dir).genlog
    return docs.event_docs(ev.events_for_new_names(g, system_event_defs(spark)))


def q_match_counts(spark, sf_dir):
    """AGG1, AGG3: lines per match status."""
    m = _analysis(spark, sf_dir).matched
    return m.groupBy("match_status").agg(F.count(F.lit(1)).alias("n"))


def q_rule_counts(spark, sf_dir):
    """AGG1: genlog rows per rule, and event rows per definition, from one pass over the logs:
    counted per rule and event name first, then once more per rule and per definition."""
    a = _analysis(spark, sf_dir)
    counted = a.genlog.groupBy("logruleid", ev.name_key(F.col("eventname")).alias("name_key")).agg(F.count(F.lit(1)).alias("n"))
    index = ev.definition_index(a.event_defs).select("def_key", "def_id")
    named = counted.join(index, F.col("name_key") == F.col("def_key"), "left")
    both = F.array(F.struct(F.lit("log_rule").alias("kind"), F.col("logruleid").alias("rule")),
                   F.struct(F.lit("event_def").alias("kind"), F.col("def_id").alias("rule")))
    return (named.select("n", F.inline(both)).where(F.col("rule").isNotNull())
            .groupBy("rule", "kind").agg(F.sum("n").alias("n")))


def q_log_rejects(spark, sf_dir):
    """SURVEY 2.9: the lines that have no raw-log document, with the reason and the shifted mark."""
    return _analysis(spark, sf_dir).rejects()


def q_record_ids(spark, sf_dir):
    """records and distinct ids of each table, with equal lines in the input; the lines are matched once."""
    from .normalise import Analysis
    path = _scratch(spark, "matched")
    a = _analysis(spark, sf_dir)
    a.matched.write.parquet(path)
    stored = spark.read.schema(a.matched.schema).parquet(path)
    a = Analysis(stored, mt.to_genlog(stored), a.event_defs)
    ids = (a.syslog_docs().select(F.lit("syslog").alias("kind"), "row")
           .unionByName(a.genlog_docs().select(F.lit("genlog").alias("kind"), "row"))
           .unionByName(a.rejects().select(F.lit("rejects").alias("kind"), "row")))
    return ids.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row").alias("n_ids"))


def q_rule_rejects(spark, sf_dir):
    """Rule validation: rules refused on load and why (with the log volume they would have seen)."""
    rej = mt.rule_rejects(fx.log_rules_df(spark))
    p = _parsed(spark, sf_dir)
    dev = mt.prepare_rules(fx.log_rules_df(spark)).select("rule_id", "device_key")
    lines = p.groupBy(F.col("device_ip")).agg(F.count(F.lit(1)).alias("lines"))
    # Null-safe equality: the rule keys are never null, and a plain equality
    # would make Catalyst infer `device_ip IS NOT NULL` and push it, with the
    # whole payload extraction inlined, below the aggregate.
    return (rej.join(dev, "rule_id").join(lines, F.col("device_key").eqNullSafe(F.col("device_ip")), "left")
            .select("rule_id", "reject_reason", F.coalesce("lines", F.lit(0)).alias("lines")))


QUERIES: dict[str, Query] = {
    "raw_parse": q_raw_parse,
    "genlog_match": q_genlog_match,
    "syslog_docs": q_syslog_docs,
    "genlog_docs": q_genlog_docs,
    "user_rule_match": q_user_rule_match,
    "event_match_name": q_event_match_name,
    "event_match_id": q_event_match_id,
    "new_event_rules": q_new_event_rules,
    "new_rule_events": q_new_rule_events,
    "match_counts": q_match_counts,
    "rule_counts": q_rule_counts,
    "rule_rejects": q_rule_rejects,
    "log_rejects": q_log_rejects,
    "record_ids": q_record_ids,
}


def q_event_summary(spark, sf_dir):
    """Flagship: security events per definition and inner/outer flag, with the
    number of distinct reporting devices."""
    e = _analysis(spark, sf_dir).events
    return e.groupBy("event_rule_id", "event_rule_name", "is_inner").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct("reportneip").alias("n_devices"))


QUERIES["event_summary"] = q_event_summary


# --- rule tables --------------------------------------------------------------

def _rule_base(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier")
    return (fx.log_regexes(table(spark, sf_dir, "part")), fx.log_regex_libs(sup),
            fx.moni_ne(sup), fx.device_ips(sup))


def q_log_rule_assembly(spark, sf_dir):
    """J1, FLT6: log rules per (rule, device IP) from four base tables."""
    return asm.assemble_log_rules(*_rule_base(spark, sf_dir))


def _event_base(spark, sf_dir):
    return (fx.event_rule_defs(table(spark, sf_dir, "customer")),
            fx.event_rule_fields_table(table(spark, sf_dir, "orders")))


def q_event_defs_system(spark, sf_dir):
    """J2, SRC4: built-in definitions, one row per rule field."""
    return asm.event_defs_system(*_event_base(spark, sf_dir))


def q_event_defs_user(spark, sf_dir):
    """SRC3: user definitions."""
    return asm.event_defs_user(_event_base(spark, sf_dir)[0])


def q_event_rule_fields(spark, sf_dir):
    """SRC5: the rule-field table."""
    return asm.event_rule_fields(_event_base(spark, sf_dir)[1])


def q_rule_snapshot_roundtrip(spark, sf_dir):
    """SNK1, SRC6, PRJ9: assembled rules published as a snapshot and read back."""
    from ..sources.rules import SNAPSHOT_LOG_RULES, SnapshotStore
    store = SnapshotStore(spark, _scratch(spark, "snapshots"))
    store.write(q_log_rule_assembly(spark, sf_dir), SNAPSHOT_LOG_RULES)
    return store.read(SNAPSHOT_LOG_RULES).select(*S.LOG_RULE_COLUMNS)


def _rule_set(spark, sf_dir, rules: DataFrame, name: str) -> DataFrame:
    from ..sources.rules import SnapshotStore
    store = SnapshotStore(spark, _scratch(spark, "rules"))
    store.write(rules, name, ["log_rule_id"])
    return store.read(name)


_RULE_SET_COLUMNS = ["line_key", "logruleid", "sourceip", "eventname", "destport"]


def q_device_rule_match(spark, sf_dir):
    """J3 at size: a rule for each part, hundreds and more to a device, read from a snapshot; a line tests only the
    rules whose literal it holds."""
    from ..sources.rules import SNAPSHOT_LOG_RULES
    rules = _rule_set(spark, sf_dir, fx.device_rules(table(spark, sf_dir, "part")), SNAPSHOT_LOG_RULES)
    return mt.to_genlog(mt.match_system(_parsed(spark, sf_dir), rules)).select(*_RULE_SET_COLUMNS)


def q_user_rule_set_match(spark, sf_dir):
    """J4 at size: a user rule for each part, read from a snapshot; every rule applies to every line."""
    from ..sources.rules import SNAPSHOT_USER_LOG_RULES
    rules = _rule_set(spark, sf_dir, fx.user_part_rules(table(spark, sf_dir, "part")), SNAPSHOT_USER_LOG_RULES)
    return mt.to_genlog(mt.match_user(_parsed(spark, sf_dir), rules), user_rules=True).select(*_RULE_SET_COLUMNS)


QUERIES.update({
    "device_rule_match": q_device_rule_match,
    "user_rule_set_match": q_user_rule_set_match,
})


# --- flows and clusters ---------------------------------------------------------

def q_netflow_scan(spark, sf_dir):
    """SRC7, FLT4, FLT5: flows in [start, end) without nulls (proto may be null)."""
    from ..sources.flows import netflow_from_lineitem, scan_netflow
    return scan_netflow(netflow_from_lineitem(table(spark, sf_dir, "lineitem")), *fx.FLOW_RANGE)


def q_netflow_store_scan(spark, sf_dir):
    """SRC7, FLT5: the same scan over a store laid out by time, which opens the range's files only."""
    from ..sources.flows import netflow_from_lineitem
    from ..sources.flowstore import stored_flows, write_flows
    root = _scratch(spark, "flows")
    write_flows(netflow_from_lineitem(table(spark, sf_dir, "lineitem")), root, period="month")
    return stored_flows(spark, root, *fx.FLOW_RANGE)


def q_moniflow_scan(spark, sf_dir):
    """SRC8, FLT4: monitored flows without nulls."""
    from ..sources.flows import moniflow_from_orders, scan_moniflow
    return scan_moniflow(moniflow_from_orders(table(spark, sf_dir, "orders")))


CLUSTER_TIME = "2024-01-01 00:00:00"


def _points(spark, sf_dir):
    """Points, and their centres as a table of their own: worked out once, then read."""
    from ..sinks.clusters import centres_of
    pts = fx.points_from_embeddings(table(spark, sf_dir, "embeddings"))
    path = _scratch(spark, "centres")
    centres_of(pts).write.parquet(path)
    return pts, spark.read.parquet(path)


def _stored(spark, df: DataFrame, tag: str, times: int = 1) -> DataFrame:
    """SNK6-SNK9: rows written to their result table, which keeps one of each id, and the table read back."""
    from ..sinks.upsert import UpsertTable
    result = UpsertTable(spark, _scratch(spark, tag), buckets=8)
    for _ in range(times):
        result.upsert(df)
    return result.read()


def q_cluster_points(spark, sf_dir):
    """SNK6: one row per clustered point with its distance to the centre."""
    from ..sinks.clusters import point_rows
    pts, cen = _points(spark, sf_dir)
    return _stored(spark, point_rows(pts, cen, "CL-1", CLUSTER_TIME, "level one"), "cluster-points")


def q_cluster_centers(spark, sf_dir):
    """SNK7: level-one centres; the same run is written twice and leaves one row of each."""
    from ..sinks.clusters import centre_rows
    return _stored(spark, centre_rows(_points(spark, sf_dir)[1], "CL-1", CLUSTER_TIME, 1), "centres-1", times=2)


def q_cluster_centers_sub(spark, sf_dir):
    """SNK8: level-two centres with parent run and parent centre."""
    from ..sinks.clusters import centre_rows_level2
    return _stored(spark, centre_rows_level2(_points(spark, sf_dir)[1], "CL-1", 0, "CL-2", CLUSTER_TIME, 2), "centres-2")


def q_cluster_centers_batch(spark, sf_dir):
    """SNK9: ten text columns cast to typed centre rows."""
    from ..sinks.clusters import centre_rows_batch, coords_text
    cen = _points(spark, sf_dir)[1]
    text = cen.select(
        F.concat(F.lit("B-"), F.col("label").cast("string")).alias("row"),
        F.concat(F.lit("centre-"), F.col("label").cast("string")).alias("name"),
        F.col("label").cast("string").alias("center_index"),
        coords_text(F.col("coords")).alias("center_info"),
        F.lit("CL-2").alias("clno"), F.lit("2").alias("type"), F.lit(CLUSTER_TIME).alias("cltime"),
        F.lit(S.CENTER_DEMO_LEVEL2).alias("demo"), F.lit("0").alias("center_index_p"),
        F.lit("CL-1").alias("clno_p"))
    return _stored(spark, centre_rows_batch(text), "centres-batch")


# --- addresses -----------------------------------------------------------------

def q_ip_range_join(spark, sf_dir):
    """Each log line joined to every named IP section holding its reporting IP."""
    from ..operators.iprange import range_join
    p = _parsed(spark, sf_dir).select("line_key", "reportip")
    return range_join(p, F.col("reportip"), fx.ip_sections_df(spark)).select("line_key", "reportip", "section_name")


def q_ip_to_long(spark, sf_dir):
    """addresses as numbers, and the inclusive section test."""
    from ..functions import ip_in_section, ip_to_long
    p = _parsed(spark, sf_dir)
    return p.select("line_key", "reportip", ip_to_long(F.col("reportip")).alias("reportip_num"),
                    "device_ip", ip_to_long(F.col("device_ip")).alias("device_num"),
                    ip_in_section(F.col("reportip"), F.lit("10.0.0.0-10.0.0.99")).alias("in_office"))


def q_device_semi(spark, sf_dir):
    """Lines whose payload device has a usable rule."""
    from ..operators.iprange import with_device_rule
    p = _parsed(spark, sf_dir)
    devices = mt.prepare_rules(fx.log_rules_df(spark)).where(F.col("reject_reason").isNull()) \
        .select(F.col("device_key").alias("device_ip"))
    return with_device_rule(p, "device_ip", devices).select("line_key", "device_ip")


# --- scalar functions ------------------------------------------------------------

def q_date_functions(spark, sf_dir):
    """Receive-time text <-> epoch, lenient tail, unreadable text."""
    from ..functions import date_to_millis, date_to_seconds, millis_to_date, millis_to_date_compact
    e = table(spark, sf_dir, "events")
    txt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ms = date_to_millis(txt)
    bad = F.concat(F.lit("2024-13-0"), (F.col("event_id") % 9 + 1).cast("string"), F.lit(" 00:00:00"))
    return e.select("event_id", txt.alias("recv"), ms.alias("ms"), date_to_seconds(txt).alias("sec"),
                    millis_to_date(ms).alias("back"), millis_to_date_compact(ms).alias("compact"),
                    date_to_millis(F.concat(txt, F.lit(" trailing"))).alias("ms_tail"),
                    date_to_millis(bad).alias("ms_bad"))


def _mixed_case_json():
    return F.concat(F.lit('{"K": '), (F.col("event_id") % 3).cast("string"),
                    F.lit(', "k": '), F.get_json_object("props", "$.k"),
                    F.lit(', "Type": "'), F.col("event_type"), F.lit('"}'))


def q_json_map(spark, sf_dir):
    """JSON props -> map."""
    from ..functions import json_to_map
    m = json_to_map(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", m["k"].alias("k"), F.size(m).alias("n_keys"))


def q_json_nested_map(spark, sf_dir):
    """F6, second level: a nested object's own map."""
    from ..functions import json_to_nested_map
    text = F.concat(F.lit('{"type": "'), F.col("event_type"), F.lit('", "user": {"id": '), F.col("user_id").cast("string"),
                    F.lit(', "name": "u'), F.col("user_id").cast("string"), F.lit('"}}'))
    m = json_to_nested_map(text)
    return table(spark, sf_dir, "events").select(
        "event_id", m["type"]["text"].alias("type"), m["type"]["fields"].isNull().alias("type_is_plain"),
        m["user"]["fields"]["id"].alias("user_id"), m["user"]["fields"]["name"].alias("user_name"))


def q_json_lower_keys(spark, sf_dir):
    """keys lowered; keys equal but for case accumulate into an array."""
    from ..functions import json_lower_keys
    m = json_lower_keys(_mixed_case_json())
    return table(spark, sf_dir, "events").select("event_id", m["k"].alias("k"), m["type"].alias("type"),
                                                 F.size(m).alias("n_keys"))


def q_unicode_codec(spark, sf_dir):
    """F8, F9 over whole document texts: escape, digest, decode back."""
    from ..functions import escapes_to_string, string_to_escapes
    d = ps.spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    d = ps.once(d, [F.col("doc_id"), F.col("text")], [string_to_escapes(F.col("text")).alias("esc"),
                                                      string_to_escapes(F.col("text"), pad=True).alias("padded")])
    units = F.length(F.hex(F.encode(F.col("text"), "UTF-16BE"))) / 4
    return d.select("doc_id", units.cast("bigint").alias("n_units"), F.md5("esc").alias("escaped_md5"),
                    (escapes_to_string(F.col("padded")) == F.col("text")).alias("roundtrip_ok"))


# --- index documents ------------------------------------------------------------

def q_index_read(spark, sf_dir):
    """SNK5, SRC9, PRJ8: documents written with upper-case keys, read back
    through a pushed-down predicate and lowered."""
    from ..sources.index import read_index
    target = _scratch(spark, "index")
    docs_df = _analysis(spark, sf_dir).syslog_docs()
    upper = docs_df.toDF(*[c.upper() for c in docs_df.columns])
    docs.write_documents(upper, target, fmt="parquet", mode="overwrite")
    return read_index(spark, target, "ISMATCH = 0", fmt="parquet")


QUERIES.update({
    "log_rule_assembly": q_log_rule_assembly,
    "event_defs_system": q_event_defs_system,
    "event_defs_user": q_event_defs_user,
    "event_rule_fields": q_event_rule_fields,
    "rule_snapshot_roundtrip": q_rule_snapshot_roundtrip,
    "netflow_scan": q_netflow_scan,
    "netflow_store_scan": q_netflow_store_scan,
    "moniflow_scan": q_moniflow_scan,
    "cluster_points": q_cluster_points,
    "cluster_centers": q_cluster_centers,
    "cluster_centers_sub": q_cluster_centers_sub,
    "cluster_centers_batch": q_cluster_centers_batch,
    "ip_range_join": q_ip_range_join,
    "ip_to_long": q_ip_to_long,
    "device_semi": q_device_semi,
    "date_functions": q_date_functions,
    "json_map": q_json_map,
    "json_lower_keys": q_json_lower_keys,
    "json_nested_map": q_json_nested_map,
    "unicode_codec": q_unicode_codec,
    "index_read": q_index_read,
})


# --- streaming --------------------------------------------------------------------

def _scratch(spark, tag: str) -> str:
    import uuid

    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def _stream_job(spark, base: str, loader, refresh_seconds: float = 300, forward: bool = False, **options):
    from ..streaming import LogJob, Outputs, RuleCache
    outs = Outputs(f"{base}/out", forward=f"{base}/forward" if forward else None)
    return LogJob(RuleCache(loader, refresh_seconds), outs, **options)


def _output(spark, base: str, name: str) -> DataFrame:
    from ..streaming import read_output
    return read_output(spark, f"{base}/out", name)


def _static_rules(spark):
    return lambda: {"logRule": fx.log_rules_df(spark), "eventDefRuleBySystem": system_event_defs(spark)}


def _run_available(spark, base: str, job, max_per_trigger: int | None = None):
    from ..streaming import read_log_stream
    stream = read_log_stream(spark, "parquet", f"{base}/in", key_col="src_key", max_per_trigger=max_per_trigger)
    q = job.start(stream, f"{base}/checkpoint", {"availableNow": True})
    q.awaitTermination()
    return q


def _in_files(spark, sf_dir: str, base: str, n: int) -> int:
    """The raw lines in n steps, one after another: event ids by their remainder. Each step is as many files, of about
    ROWS_PER_TASK lines; returns how many."""
    from ..streaming.job import ROWS_PER_TASK
    events = table(spark, sf_dir, "events")
    files = max(1, -(-events.count() // (n * ROWS_PER_TASK)))
    for i in range(n):
        fx.raw_lines(events.where(F.col("event_id") % n == i).repartition(files)).write.mode("append").parquet(f"{base}/in")
    return files


def q_stream_normalise(spark, sf_dir):
    """SRC1, STR1, STR2, STR6: the log job over a file stream (all files that are there);
    the stored genlog documents equal the batch result."""
    base = _scratch(spark, "stream")
    raw_from_events(spark, sf_dir).write.parquet(f"{base}/in")
    _run_available(spark, base, _stream_job(spark, base, _static_rules(spark)))
    return _output(spark, base, "genlog").select(*S.GENLOG_DOC_COLUMNS)


def q_stream_rule_refresh(spark, sf_dir):
    """STR4: rules change between micro-batches of one running query; lines of
    even events see rule set v1 (no rule LR-2), lines of odd events v2. An empty
    rule set published in between is not taken over."""
    from ..sources.rules import SNAPSHOT_EVENT_DEFS_SYSTEM, SNAPSHOT_LOG_RULES, SnapshotStore
    from ..streaming import read_log_stream
    base = _scratch(spark, "refresh")
    store = SnapshotStore(spark, f"{base}/rules")
    store.write_bundle({SNAPSHOT_LOG_RULES: fx.log_rules_df(spark, [r for r in fx.LOG_RULES if r["rule_seq"] != 2]),
                        SNAPSHOT_EVENT_DEFS_SYSTEM: system_event_defs(spark)})
    job = _stream_job(spark, base, store.load_bundle, refresh_seconds=0)
    events = table(spark, sf_dir, "events")
    fx.raw_lines(events.where(F.col("event_id") % 4 == 0)).write.mode("append").parquet(f"{base}/in")
    q = job.start(read_log_stream(spark, "parquet", f"{base}/in", key_col="src_key"), f"{base}/checkpoint",
                  {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        store.write_bundle({SNAPSHOT_LOG_RULES: fx.log_rules_df(spark).limit(0)})
        fx.raw_lines(events.where(F.col("event_id") % 4 == 2)).write.mode("append").parquet(f"{base}/in")
        q.processAllAvailable()
        store.write_bundle({SNAPSHOT_LOG_RULES: fx.log_rules_df(spark)})
        fx.raw_lines(events.where(F.col("event_id") % 2 == 1)).write.mode("append").parquet(f"{base}/in")
        q.processAllAvailable()
    finally:
        q.stop()
    return _output(spark, base, "genlog").select(*S.GENLOG_DOC_COLUMNS)


def q_kafka_forward(spark, sf_dir):
    """SNK10: genlog records forwarded as `~`-joined lines (to files here; to
    Kafka when its connector is on the classpath)."""
    base = _scratch(spark, "forward")
    raw_from_events(spark, sf_dir).write.parquet(f"{base}/in")
    _run_available(spark, base, _stream_job(spark, base, _static_rules(spark), forward=True))
    return spark.read.text(f"{base}/forward").select("value")


QUERIES.update({
    "stream_normalise": q_stream_normalise,
    "stream_rule_refresh": q_stream_rule_refresh,
    "kafka_forward": q_kafka_forward,
})


def q_event_defs_appended(spark, sf_dir):
    """SET1: the built-in definitions with the new ones (J6) appended, by name."""
    g = _analysis(spark, sf_dir).genlog
    defs = system_event_defs(spark)
    return ev.append_definitions(defs, ev.new_definitions(g, defs))


QUERIES["event_defs_appended"] = q_event_defs_appended


def q_sink_counts(spark, sf_dir):
    """AGG3: rows that each sink of the log job took, counted while they were written and kept with each batch's
    commit: read after the stream was stopped and started again by another job."""
    from ..streaming import output_counts
    base = _scratch(spark, "counts")
    events = table(spark, sf_dir, "events")
    for i in range(2):
        fx.raw_lines(events.where(F.col("event_id") % 2 == i)).write.mode("append").parquet(f"{base}/in")
        _run_available(spark, base, _stream_job(spark, base, _static_rules(spark)))
    return output_counts(spark, f"{base}/out").groupBy("sink").agg(F.sum("rows").alias("n"))


def q_stream_new_names(spark, sf_dir):
    """J6 in the stream: three micro-batches; the first gives each event name without a definition one, and all
    batches' lines of that name are its events."""
    base = _scratch(spark, "names")
    files = _in_files(spark, sf_dir, base, 3)
    _run_available(spark, base, _stream_job(spark, base, _static_rules(spark), learn=True), max_per_trigger=files)
    made = (_output(spark, base, "definitions").groupBy(F.col("event_rule_id").alias("made_id"))
            .agg(F.count(F.lit(1)).alias("c")))
    events = _output(spark, base, "event").groupBy("event_rule_id", "event_rule_name", "event_rule_level").agg(
        F.count(F.lit(1)).alias("n_events"))
    return (events.join(made, F.col("event_rule_id") == F.col("made_id"), "left")
            .select("event_rule_id", "event_rule_name", "event_rule_level", "n_events", F.coalesce("c", F.lit(0)).alias("n_definitions")))


def q_stream_admission(spark, sf_dir):
    """STR3: a backlog of files taken in bounded micro-batches, the first of one step's files and the others of two; the
    sizes are checked, and the documents are those of the batch query."""
    from ..streaming import output_counts, read_log_stream
    base = _scratch(spark, "admission")
    steps = 6
    n = _in_files(spark, sf_dir, base, steps)
    job = _stream_job(spark, base, _static_rules(spark))
    job.start_limited(lambda limit: read_log_stream(spark, "parquet", f"{base}/in", key_col="src_key", max_per_trigger=limit),
                      f"{base}/checkpoint", per_trigger=2 * n, first=n, trigger={"availableNow": True}).awaitTermination()
    # every line is in one of these two
    sizes = (output_counts(spark, f"{base}/out").where(F.col("sink").isin("syslog", "rejects")).groupBy("first_batch")
             .agg(F.sum("rows").alias("n")).orderBy("first_batch").collect())
    files = [r.n for r in spark.read.parquet(f"{base}/in").groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n")).collect()]
    if sizes[0].n > n * max(files) or any(s.n > 2 * n * max(files) for s in sizes) or len(sizes) < 1 + (steps - 1) // 2:
        raise AssertionError(f"micro-batches of {[s.n for s in sizes]} lines from files of {files}")
    return _output(spark, base, "genlog").select(*S.GENLOG_DOC_COLUMNS)


def _base_tables(spark, sf_dir):
    """The rule base tables under the names that a rule source reads."""
    from ..sources.rules import TableSource
    root = _scratch(spark, "base")
    regexes, libs, ne, ips = _rule_base(spark, sf_dir)
    defs, fields = _event_base(spark, sf_dir)
    for name, df in (("t_siem_log_regex", regexes), ("t_siem_log_regex_lib", libs), ("t_siem_moni_ne", ne),
                     ("t_moni_device_ip", ips), ("t_siem_event_rule_def", defs), ("t_siem_event_rule_field", fields)):
        df.write.parquet(f"{root}/{name}")
    return TableSource("parquet", path_template=root + "/{name}")


def q_rule_sync(spark, sf_dir):
    """STR5: the sync stream rebuilds the snapshots from the base tables at its first tick; the
    log-rule snapshot as a reader then finds it."""
    import threading

    from ..sources.rules import SNAPSHOT_LOG_RULES, SnapshotStore
    from ..streaming.rulesync import start_rule_sync
    store = SnapshotStore(spark, _scratch(spark, "sync"))
    done = threading.Event()
    q = start_rule_sync(spark, _base_tables(spark, sf_dir), store, _scratch(spark, "ticks"), interval_seconds=3600,
                        on_sync=lambda _: done.set())
    try:
        while not done.wait(1):
            if q.exception():
                raise q.exception()
    finally:
        q.stop()
    return store.read(SNAPSHOT_LOG_RULES, required=True).select(*S.LOG_RULE_COLUMNS)


def q_rule_set_counts(spark, sf_dir):
    """AGG2: rows of each table of the rule bundle, after a sync from the base tables."""
    from ..sources.rules import SnapshotStore, rule_set_counts, sync_rules
    store = SnapshotStore(spark, _scratch(spark, "bundle"))
    sync_rules(spark, _base_tables(spark, sf_dir), store)
    return rule_set_counts(store.load_bundle())


def q_section_rejects(spark, sf_dir):
    """IP sections that are no ranges of addresses, and the lines they would have been tested on."""
    from ..operators.iprange import section_rejects
    lines = _parsed(spark, sf_dir).groupBy().agg(F.count("reportip").alias("lines"))
    bad = section_rejects(fx.ip_sections_df(spark)).select("section_name", "reject_reason")
    return bad.select("*", lines.scalar().alias("lines"))


QUERIES.update({
    "sink_counts": q_sink_counts,
    "stream_new_names": q_stream_new_names,
    "stream_admission": q_stream_admission,
    "rule_sync": q_rule_sync,
    "rule_set_counts": q_rule_set_counts,
    "section_rejects": q_section_rejects,
})

"""Security-log shaped inputs derived from the driver tables, plus the small
configuration tables (rules, event definitions) the test queries use.

The raw log lines are a pure DataFrame projection of `events`, so their work
grows with that table; the rule tables are configuration, stated as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import schema as S

# --- fixed values: system log rules (FIXTURES §2) ---------------------------
# Columns not listed are "". Capture columns hold group numbers as text.
# Rule 3 has no group (must never match), rule 4 does not compile, rule 5
# names a group the regex lacks, and so do rules 6 (its first parentheses are
# quoted), 7 (they stand in a comment) and 8 to 10 (they are members of a bracket
# class: after a first `]`, of a nested class, of an intersection); all eight are
# rejected when rules load.
LOG_RULES = [
    {"rule_seq": 0, "log_rule_id": "LR-0", "log_rule_lib_id": "LIB-1", "device_ip": "192.168.0.1",
     "log_regex": r"user=(\d+) type=(error)", "sourceip": "1", "destport": "", "eventname": "2",
     "eventlevel": "3", "eventdefid": "a-b-c", "reportnetype": "firewall", "eventid": "EID-0"},
    {"rule_seq": 1, "log_rule_id": "LR-1", "log_rule_lib_id": "LIB-1", "device_ip": "192.168.0.1",
     "log_regex": r"user=(\d+) type=(\w+) value=([\d.]+)", "sourceip": "1", "destport": "3",
     "eventname": "2", "eventlevel": "", "eventdefid": "", "reportnetype": "firewall", "eventid": "EID-1"},
    {"rule_seq": 2, "log_rule_id": "LR-2", "log_rule_lib_id": "LIB-2", "device_ip": "192.168.0.2",
     "log_regex": r"type=(\w+)( none)?", "sourceip": "2", "destport": "", "eventname": "1",
     "eventlevel": "2", "eventdefid": "d-e", "reportnetype": "ids", "eventid": "EID-2"},
    {"rule_seq": 3, "log_rule_id": "LR-3", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.3",
     "log_regex": r"type=\w+", "sourceip": "", "destport": "", "eventname": "",
     "eventlevel": "", "eventdefid": "", "reportnetype": "", "eventid": ""},
    {"rule_seq": 4, "log_rule_id": "LR-4", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.4",
     "log_regex": r"(", "sourceip": "", "destport": "", "eventname": "",
     "eventlevel": "", "eventdefid": "", "reportnetype": "", "eventid": ""},
    {"rule_seq": 5, "log_rule_id": "LR-5", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.5",
     "log_regex": r"type=(\w+)", "sourceip": "9", "destport": "", "eventname": "1",
     "eventlevel": "", "eventdefid": "", "reportnetype": "", "eventid": ""},
    {"rule_seq": 6, "log_rule_id": "LR-6", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.6",
     "log_regex": r"\Qf(x)\E user=(\d+)", "sourceip": "2", "destport": "", "eventname": "1",
     "eventlevel": "", "eventdefid": "", "reportnetype": "", "eventid": ""},
    {"rule_seq": 7, "log_rule_id": "LR-7", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.7",
     "log_regex": "(?x) type=(\\w+)  # the (kind)", "sourceip": "", "destport": "", "eventname": "2",
     "eventlevel": "", "eventdefid": "", "reportnetype": "", "eventid": ""},
    {"rule_seq": 8, "log_rule_id": "LR-8", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.0",
     "log_regex": r"[](]?user=(\d+)", "sourceip": "1", "eventname": "2"},
    {"rule_seq": 9, "log_rule_id": "LR-9", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.0",
     "log_regex": r"[[a](]?user=(\d+)", "sourceip": "1", "eventname": "2"},
    {"rule_seq": 10, "log_rule_id": "LR-10", "log_rule_lib_id": "LIB-3", "device_ip": "192.168.0.0",
     "log_regex": r"[\w&&[^(]]*type=(\w+)", "sourceip": "2", "eventname": "1"},
]

# --- fixed values: user log rules (named groups, no device filter) ---------
USER_RULES = [
    {"rule_seq": 0, "log_rule_id": "UR-0", "log_regex": r"user=(?<sourceIp>\d+) type=(?<eventName>error)",
     "eventlevel": "4", "eventdefid": "u-1", "reportnetype": "user", "eventid": "UEID-0"},
    {"rule_seq": 1, "log_rule_id": "UR-1", "log_regex": r"user=(?<sourceIp>\d+) type=(?<eventName>purchase) value=(?<amount>[\d.]+)",
     "eventlevel": "", "eventdefid": "", "reportnetype": "user", "eventid": "UEID-1"},
    {"rule_seq": 2, "log_rule_id": "UR-2", "log_regex": r"type=click",
     "eventlevel": "", "eventdefid": "", "reportnetype": "", "eventid": ""},
]

# --- fixed values: event definitions and their fields (FIXTURES §3) --------
# (event_rule_id, event_rule_lib_id, event_rule_code, event_rule_name, event_rule_level,
#  event_basic_type, event_sub_type, event_rule_desc, event_rule, is_inner, is_use)
EVENT_DEFS = [
    ("EV1", "L1", "C1", "Error", "3", "attack", "scan", "error event", "", 1, 1),
    ("EV2", "L1", "C2", " click ", "1", "audit", "web", "click event", "", 1, 1),
    ("EV3", "L1", "C3", "PURCHASE", "2", "audit", "trade", "purchase event", "", 1, 1),
    ("EV4", "L2", "C4", "error", "5", "attack", "dup", "second error definition", "", 1, 1),
    ("EV5", "L2", "C5", "signup", "2", "audit", "user", "user definition", "", 0, 1),
    ("EV6", "L2", "C6", "view", "1", "audit", "web", "not in use", "", 1, 0),
    ("EV7", "L3", "C7", "", "4", "misc", "blank", "blank name", "", 1, 1),
]
# (event_rule_field_id, event_rule_id, event_rule_field, match_method, filed_begin_value, filed_end_value)
EVENT_FIELDS = [
    ("F1", "EV1", "eventname", "equals", "Error", ""),
    ("F2", "EV1", "eventlevel", "range", "1", "5"),
    ("F3", "EV2", "eventname", "equals", "click", ""),
    ("F4", "EV3", "eventname", "equals", "PURCHASE", ""),
    ("F5", "EV4", "eventname", "equals", "error", ""),
    ("F6", "EV9", "eventname", "equals", "missing", ""),
    ("F7", "EV7", "eventname", "equals", "", ""),
    ("F8", "EV6", "eventname", "equals", "view", ""),
    ("F9", "EV5", "eventname", "equals", "signup", ""),
]

# --- fixed values: named IP sections for the range join --------------------
IP_SECTIONS = [
    ("office", "10.0.0.0-10.0.0.99"),
    ("lab", "10.0.0.100-10.0.0.255"),
    ("overlap", "10.0.0.50-10.0.0.149"),
    ("wide", "10.12.3.0-10.20.250.255"),
    ("broad", "9.0.0.0-11.255.255.255"),
    ("backwards", "10.0.0.9-10.0.0.1"),
    ("malformed", "1.1.1.1-2000000000.0.0.0"),
    ("single", "10.0.0.7-10.0.0.7"),
]

# Time range of the flow scan, half-open.
FLOW_RANGE = ("1997-01-01 00:00:00", "1998-01-01 00:00:00")
# --- end of fixed values ---


# Configuration frames are built once per session and reused, so every query
# plans over the same relation (and its size check is counted once).
_FRAMES: dict = {}


def literal_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small literal table built on the JVM (one `range` row and an
    `inline` of literal structs): no Python-backed RDD, so using it in a
    plan never starts Python workers."""
    fields = [f.strip().rsplit(" ", 1) for f in ddl.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n.strip("`")) for (n, t), v in zip(fields, row)]) for row in rows]
    if not structs:
        return spark.createDataFrame([], ddl)
    return spark.range(1).select(F.inline(F.array(*structs)))


def _per_session(spark: SparkSession, name: str, build) -> DataFrame:
    key = (spark._jsparkSession.sessionUUID(), name)
    if key not in _FRAMES:
        _FRAMES[key] = build()
    return _FRAMES[key]


def log_rules_df(spark: SparkSession, rules: list[dict] | None = None) -> DataFrame:
    """The system log rule table: 32 string columns + rule_seq."""
    if rules is None:
        return _per_session(spark, "log_rules", lambda: _rules_frame(spark, LOG_RULES))
    return _rules_frame(spark, rules)


def _rules_frame(spark: SparkSession, rules: list[dict]) -> DataFrame:
    rows = []
    for r in rules:
        rows.append(tuple([r.get(c, "") for c in S.LOG_RULE_COLUMNS] + [int(r["rule_seq"])]))
    ddl = ", ".join(f"`{c}` string" for c in S.LOG_RULE_COLUMNS) + ", rule_seq bigint"
    return literal_frame(spark, rows, ddl)


def user_rules_df(spark: SparkSession, rules: list[dict] | None = None) -> DataFrame:
    """User log rules: same columns, groups named in the regex instead of numbered."""
    if rules is None:
        return _per_session(spark, "user_rules", lambda: _rules_frame(spark, USER_RULES))
    return _rules_frame(spark, rules)


EVENT_DEF_DDL = ("event_rule_id string, event_rule_lib_id string, event_rule_code string, "
                 "event_rule_name string, event_rule_level string, event_basic_type string, "
                 "event_sub_type string, event_rule_desc string, event_rule string, "
                 "is_inner int, is_use int")
EVENT_FIELD_DDL = ", ".join(f"{c} string" for c in S.EVENT_FIELD_COLUMNS)


def event_defs_df(spark: SparkSession) -> DataFrame:
    return _per_session(spark, "event_defs", lambda: literal_frame(spark, EVENT_DEFS, EVENT_DEF_DDL))


def event_fields_df(spark: SparkSession) -> DataFrame:
    return _per_session(spark, "event_fields", lambda: literal_frame(spark, EVENT_FIELDS, EVENT_FIELD_DDL))


def ip_sections_df(spark: SparkSession) -> DataFrame:
    return _per_session(spark, "ip_sections",
                        lambda: literal_frame(spark, IP_SECTIONS, "section_name string, ip_section string"))


# ---------------------------------------------------------------------------
# Raw log lines from `events` (FIXTURES §1)
# ---------------------------------------------------------------------------

def _s(c: Column) -> Column:
    return c.cast("string")


HEARTBEAT = "2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~heartbeat"


def raw_lines(events: DataFrame) -> DataFrame:
    """One `~`-delimited raw log line per event.

    Odd event ids carry their own record id (md5 of the id); even ones leave
    it out, so the id-adding path runs. Every 50th event has a 20-part
    payload and the one after it a 40-part payload (short payloads). Some
    lines are faulty or awkward: a null value (id mod 97 = 5), an unreadable
    time (mod 89 = 7), a `~` in the content (mod 83 = 11), and heartbeats,
    which all have the same text (mod 71 = 13). `src_key` is the line's
    position in its source: the event id.
    """
    uid = F.col("user_id")
    reportip = F.concat(F.lit("10.0."), _s(F.expr("user_id div 256")), F.lit("."), _s(uid % 256))
    device = F.concat(F.lit("192.168.0."), _s(uid % 8))
    message = F.concat(F.lit("user="), _s(uid), F.lit(" type="), F.col("event_type"),
                       F.lit(" value="), _s(F.col("value").cast("decimal(18,2)")))
    content = (
        F.when(F.col("event_id") % 50 == 0, F.concat(F.repeat(F.lit("x|!"), 19), F.lit("x")))
        .when(F.col("event_id") % 50 == 1,
              F.concat(F.repeat(F.lit("x|!"), 29), device, F.lit("|!"), F.repeat(F.lit("x|!"), 9), F.lit("x")))
        .otherwise(F.concat(F.repeat(F.lit("x|!"), 29), device, F.lit("|!"), F.repeat(F.lit("x|!"), 36), message))
    )
    eid = F.col("event_id")
    content = F.when(eid % 83 == 11, F.concat(content, F.lit("~tail"))).otherwise(content)
    app = F.when(F.col("event_type") == "view", F.lit("NE_FLOW")).otherwise(F.lit("SYSLOG"))
    time = F.when(eid % 89 == 7, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    body = F.concat_ws("~", time, reportip, F.lit("-"), F.lit("-"), app, content)
    line = F.when(F.col("event_id") % 2 == 0, body) \
        .otherwise(F.concat(F.md5(_s(F.col("event_id"))), F.lit("~"), body))
    line = F.when(eid % 97 == 5, F.lit(None).cast("string")).when(eid % 71 == 13, F.lit(HEARTBEAT)).otherwise(line)
    return events.select(line.alias("value"), _s(eid).alias("src_key"))


# Hand-made edge-case lines (unit tests only).
EDGE_LINES = [
    None,
    "   ",
    "a~b~c~d~e",
    "2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~plain content",
    "00000000000000000000000000000001~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~plain content",
    "00000000000000000000000000000002~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~c~extra",
    "2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~content~~",
    "not-a-date~10.0.0.1~-~-~SYSLOG~content",
]


# ---------------------------------------------------------------------------
# Rule base tables from the TPC-H tables (sizes grow with the scale factor)
# ---------------------------------------------------------------------------
# Devices are suppliers; a device type is (nation, key mod 5, key div 50).
# Each supplier also defines a rule library of its own device type; rules are
# parts, 25 per library, so libraries of the top fifth of suppliers have no
# rule. Every 97th part has a null rule id; every 7th points at an unknown
# library. Suppliers with key mod 10 = 7 have no IP, mod 10 = 9 a null IP,
# mod 3 = 0 a second IP.

def moni_ne(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        k.cast("string").alias("ne_id"),
        F.col("s_nationkey").cast("string").alias("htypeid"),
        F.concat(F.lit("V"), _s(k % 5)).alias("vendorid"),
        F.concat(F.lit("M"), _s(F.expr("s_suppkey div 50"))).alias("model"))


def device_ips(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    ip1 = F.when(k % 10 != 9, F.concat(F.lit("172.16."), _s(F.expr("s_suppkey div 256")), F.lit("."), _s(k % 256)))
    ip2 = F.concat(F.lit("172.17."), _s(F.expr("s_suppkey div 256")), F.lit("."), _s(k % 256))
    ips = F.when(k % 3 == 0, F.array(ip1, ip2)).otherwise(F.array(ip1))
    return supplier.where(k % 10 != 7).select(k.cast("string").alias("ne_id"), F.explode(ips).alias("device_ip"))


def log_regex_libs(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit("LIB"), _s(k)).alias("log_rule_lib_id"),
        F.col("s_nationkey").cast("string").alias("htyeid"),
        F.concat(F.lit("V"), _s(k % 5)).alias("vendorid"),
        F.concat(F.lit("M"), _s(F.expr("s_suppkey div 50"))).alias("model"))


def log_regexes(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    lib = F.when(k % 7 == 3, F.concat(F.lit("NOLIB"), _s(k))).otherwise(F.concat(F.lit("LIB"), _s(F.expr("p_partkey div 25"))))
    values = {
        "log_rule_id": F.when(k % 97 != 0, F.concat(F.lit("R"), _s(k))),
        "log_rule_lib_id": lib,
        "log_rule_code": F.concat(F.lit("C"), _s(k)),
        "log_regex": F.concat(F.lit("user=(\\d+) type=("), F.lower(F.col("p_type")), F.lit(")")),
        "eventdefid": F.col("p_brand"),
        "eventlevel": _s(F.col("p_size") % 5),
        "sourceip": F.lit("1"),
        "eventname": F.lit("2"),
        "reportnetype": F.col("p_name"),
    }
    return part.select(*[values.get(c, F.lit("")).alias(c) for c in S.LOG_REGEX_COLUMNS])


def device_rules(part: DataFrame) -> DataFrame:
    """Log rules for the devices of `raw_lines`, one for each part; where there are
    more than 8,000, several are for the same user, and the first one wins."""
    k = F.col("p_partkey")
    values = {
        "log_rule_id": F.concat(F.lit("PR-"), F.lpad(_s(k), 9, "0")),
        "device_ip": F.concat(F.lit("192.168.0."), _s(k % 8)),
        "log_regex": F.concat(F.lit("user=("), _s(F.expr("p_partkey div 8") % 1000 * 8 + k % 8), F.lit(") type=(\\w+) value=([\\d.]+)")),
        "sourceip": F.lit("1"), "eventname": F.lit("2"), "destport": F.lit("3"),
        "eventdefid": F.col("p_brand"), "eventlevel": _s(F.col("p_size") % 5),
    }
    return part.select(*[values.get(c, F.lit("")).alias(c) for c in S.LOG_RULE_COLUMNS])


def user_part_rules(part: DataFrame) -> DataFrame:
    """User rules (named groups, all devices), one for each part."""
    k = F.col("p_partkey")
    values = {
        "log_rule_id": F.concat(F.lit("PU-"), F.lpad(_s(k), 9, "0")),
        "log_regex": F.concat(F.lit("user=(?<sourceIp>"), _s(k % 1000), F.lit(") type=(?<eventName>\\w+) value=(?<destPort>[\\d.]+)")),
        "eventdefid": F.col("p_brand"), "eventlevel": _s(F.col("p_size") % 5),
    }
    return part.select(*[values.get(c, F.lit("")).alias(c) for c in S.LOG_RULE_COLUMNS])


# Event definitions are customers (name = market segment, so names repeat);
# rule fields are orders (several per definition; every 11th points at a
# missing definition).

def event_rule_defs(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        F.concat(F.lit("E"), _s(k)).alias("event_rule_id"),
        F.concat(F.lit("EL"), _s(k % 10)).alias("event_rule_lib_id"),
        F.concat(F.lit("C"), _s(k)).alias("event_rule_code"),
        F.col("c_mktsegment").alias("event_rule_name"),
        _s(F.col("c_nationkey") % 5).alias("event_rule_level"),
        F.concat(F.lit("B"), _s(F.col("c_nationkey") % 3)).alias("event_basic_type"),
        F.concat(F.lit("S"), _s(k % 4)).alias("event_sub_type"),
        F.col("c_name").alias("event_rule_desc"),
        F.lit("").alias("event_rule"),
        F.when(k % 4 == 0, 0).otherwise(1).alias("is_inner"),
        F.when(k % 5 == 0, 0).otherwise(1).alias("is_use"))


def event_rule_fields_table(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    rid = F.when(k % 11 == 0, F.concat(F.lit("EMISSING"), _s(k))).otherwise(F.concat(F.lit("E"), _s(F.col("o_custkey"))))
    return orders.select(
        F.concat(F.lit("F"), _s(k)).alias("event_rule_field_id"),
        rid.alias("event_rule_id"),
        F.col("o_orderpriority").alias("event_rule_field"),
        F.col("o_orderstatus").alias("match_method"),
        _s(F.col("o_totalprice").cast("decimal(18,2)")).alias("filed_begin_value"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("filed_end_value"))


def points_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """Cluster points: label -> cluster, vec_id -> address, the embedding -> coordinates."""
    k = F.col("vec_id")
    ip = F.concat(F.lit("10.9."), _s(F.expr("vec_id div 256")), F.lit("."), _s(k % 256))
    coords = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    return embeddings.select(F.col("label").cast("int").alias("label"), ip.alias("ip"), coords.alias("coords"))

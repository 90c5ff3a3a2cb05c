"""Record layouts of the security-log engine.

Every layout is kept as an ordered list of column names (the positional
formats of the original application become named, typed columns here).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field orders that must equal the original record layouts ---

# Raw log line, positions after the record id has been put in front.
RAW_FIELDS = ["recordid", "recvtime", "reportip", "raw3", "raw4", "reportapp", "logcontent"]

# Normalised log ("genlog"), 24 positions.
GENLOG_FIELDS = [
    "row", "recordid", "firstrecvtime", "reportapp", "reportip",
    "sourceip", "sourceport", "destip", "destport", "eventaction",
    "actionresult", "reportnetype", "eventdefid", "eventname", "eventlevel",
    "orgid", "appproto", "url", "getparameter", "proto",
    "opentime", "eventid", "orglog", "logruleid",
]

# Genlog fields filled from a capture group of the rule regex, in genlog order.
# The value of each is the rule column of the same name, holding a group number.
CAPTURE_FIELDS = [
    "sourceip", "sourceport", "destip", "destport", "eventaction", "actionresult",
    "eventname", "appproto", "url", "getparameter", "proto", "opentime",
]

# User rules name their groups instead; genlog field -> group name.
USER_GROUP_NAMES = {
    "sourceip": "sourceIp", "sourceport": "sourcePort", "destip": "destIp",
    "destport": "destPort", "eventaction": "actionOpt", "actionresult": "actionResult",
    "eventname": "eventName", "appproto": "appProto", "url": "url",
    "getparameter": "getParameter", "proto": "proto", "opentime": "openTime",
}

# Event result, 15 positions (followed by the whole genlog record).
EVENT_FIELDS = [
    "event_rule_result_id", "event_rule_result_id2", "event_rule_id", "logid",
    "event_rule_name", "event_rule_level", "reportneip", "sourceip", "sourceport",
    "destip", "destport", "opentime", "actionopt", "is_inner", "proto",
]

# Log rule table (32 columns), in the order the rule loader selects them.
LOG_RULE_COLUMNS = [
    "log_rule_id", "log_rule_lib_id", "log_rule_code", "original_log", "log_regex",
    "eventdefid", "eventlevel", "eventsubtype", "storagetime", "orilevel", "proto",
    "reportnetype", "reportvendor", "reportneip", "reportip", "reportapp", "sourceip",
    "sourceport", "destip", "destport", "destneid", "eventname", "eventdetail",
    "appproto", "url", "getparameter", "eventaction", "opentime", "actionopt",
    "actionresult", "device_ip", "eventid",
]

# Base tables the log rule is assembled from.
LOG_REGEX_COLUMNS = [c for c in LOG_RULE_COLUMNS if c != "device_ip"]
LOG_REGEX_LIB_COLUMNS = ["log_rule_lib_id", "htyeid", "vendorid", "model"]
MONI_NE_COLUMNS = ["ne_id", "htypeid", "vendorid", "model"]
DEVICE_IP_COLUMNS = ["ne_id", "device_ip"]

# Event definitions.
EVENT_DEF_COLUMNS = [
    "event_rule_id", "event_rule_lib_id", "event_rule_code", "event_rule_name",
    "event_rule_level", "event_basic_type", "event_sub_type", "event_rule_desc",
    "event_rule", "is_inner", "is_use",
]
EVENT_DEF_USER_COLUMNS = list(EVENT_DEF_COLUMNS)
EVENT_DEF_SYSTEM_COLUMNS = [
    "event_rule_id", "event_rule_name", "event_rule_level", "event_basic_type",
    "event_sub_type", "filed_begin_value", "event_rule_field", "match_method",
]
EVENT_FIELD_COLUMNS = [
    "event_rule_field_id", "event_rule_id", "event_rule_field", "match_method",
    "filed_begin_value", "filed_end_value",
]

# Stored documents (lower-case keys, as written to the index).
SYSLOG_DOC_COLUMNS = [
    "row", "recordid", "recvtime", "storagetime", "reportip", "reportapp",
    "logcontent", "ismatch",
]
GENLOG_DOC_COLUMNS = [
    "row", "recordid", "firstrecvtime", "reportapp", "reportip", "sourceip",
    "sourceport", "destip", "destport", "eventaction", "actionresult",
    "reportnetype", "eventdefid", "eventname", "eventname2", "eventname3",
    "eventlevel", "orgid", "appproto", "url", "getparameter", "orglog", "logruleid",
]
EVENT_DOC_COLUMNS = [
    "row", "event_rule_result_id", "event_rule_id", "logid", "event_rule_name",
    "event_rule_level", "reportneip", "sourceip", "sourceport", "destip", "destport",
    "opentime", "actionopt", "is_inner", "proto",
]

# Feature names stored with cluster centres.
CENTER_DEMO_LEVEL1 = "TCP#ICMP#GRE#UDP#time#packernum#bytesize"
CENTER_DEMO_LEVEL2 = "QQ#FTP#HTTP#TELNET#DBAudit#bd_local_trojan#GET#POST"


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


NETFLOW = T.StructType([
    T.StructField("srcip", T.StringType()),
    T.StructField("dstip", T.StringType()),
    T.StructField("starttime", T.TimestampType()),
    T.StructField("endtime", T.TimestampType()),
    T.StructField("proto", T.StringType()),
    T.StructField("packernum", T.IntegerType()),
    T.StructField("bytesize", T.IntegerType()),
])

MONIFLOW = string_schema(["srcip", "dstip", "appproto", "method"])

CLUSTER_POINT = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("coords", T.ArrayType(T.DoubleType())),
])

CLUSTER_RESULT = T.StructType([
    T.StructField("label", T.IntegerType()),
    T.StructField("points", T.ArrayType(CLUSTER_POINT)),
    T.StructField("distances", T.ArrayType(T.DoubleType())),
])

# --- end of fixed values ---

"""DuckDB SQL for each registered query: the independent check of its result.

The rule tables are literal configuration; the oracle states the matching
the rules define as one CASE per rule with literal patterns (DuckDB takes a
capture-group number only as a constant). Rules 3-10 of the fixture are
refused on load (no group, bad pattern, group number too large), so only
rules 0-2 appear here.
"""

from __future__ import annotations

from .. import fixtures as fx
from .. import schema as S

VALID_RULE_SEQS = [0, 1, 2]
VALID_USER_RULE_SEQS = [0, 1]   # user rule 2 has no group


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


RAW_CTE = """
raw AS (
  SELECT event_id, CASE WHEN event_id % 97 = 5 THEN NULL
              WHEN event_id % 71 = 13 THEN '2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~heartbeat'
              WHEN event_id % 2 = 0 THEN body
              ELSE md5(CAST(event_id AS VARCHAR)) || '~' || body END AS value
  FROM (
    SELECT event_id, concat_ws('~',
        CASE WHEN event_id % 89 = 7 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END,
        '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR),
        '-', '-',
        CASE WHEN event_type = 'view' THEN 'NE_FLOW' ELSE 'SYSLOG' END,
        (CASE WHEN event_id % 50 = 0 THEN repeat('x|!', 19) || 'x'
             WHEN event_id % 50 = 1 THEN repeat('x|!', 29) || '192.168.0.' || CAST(user_id % 8 AS VARCHAR)
                                         || '|!' || repeat('x|!', 9) || 'x'
             ELSE repeat('x|!', 29) || '192.168.0.' || CAST(user_id % 8 AS VARCHAR) || '|!'
                  || repeat('x|!', 36) || 'user=' || CAST(user_id AS VARCHAR) || ' type=' || event_type
                  || ' value=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END) || CASE WHEN event_id % 83 = 11 THEN '~tail' ELSE '' END) AS body
    FROM events) b
),
lines AS (
  SELECT event_id, value, CASE WHEN value IS NOT NULL AND trim(value) <> ''
                      AND len(string_split(regexp_replace(trim(value), '~+$', ''), '~')) <= 6
                     THEN md5(CAST(event_id AS VARCHAR)) || '~' || value ELSE value END AS line
  FROM raw
),
parsed AS (
  SELECT event_id, value, line, md5(CAST(event_id AS VARCHAR) || '~' || coalesce(line, '')) AS line_key, len(f) AS n_fields,
         coalesce(len(f) > 7 OR (len(f) = 7 AND regexp_matches(f[1], '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} ')
                  AND NOT regexp_matches(f[2], '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} ')), false) AS shifted,
         f[1] AS recordid, f[2] AS recvtime, f[3] AS reportip, f[6] AS reportapp, f[7] AS logcontent,
         CASE WHEN len(f) > 6 THEN len(p) END AS payload_size,
         CASE WHEN len(f) > 6 THEN trim(p[30]) END AS device_ip,
         CASE WHEN len(f) > 6 THEN trim(p[67]) END AS msg
  FROM (SELECT event_id, value, line, f,
               string_split(regexp_replace(f[7], '(\\|!)+$', ''), '|!') AS p
        FROM (SELECT event_id, value, line, string_split(regexp_replace(line, '~+$', ''), '~') AS f FROM lines) s) t
)"""


def _rules(user: bool = False) -> list[dict]:
    if user:
        return [r for r in fx.USER_RULES if r["rule_seq"] in VALID_USER_RULE_SEQS]
    return [r for r in fx.LOG_RULES if r["rule_seq"] in VALID_RULE_SEQS]


def _user_numbered(regex: str) -> tuple[str, dict[str, int]]:
    """Named groups -> numbered ones (DuckDB refuses `(?<n>...)`), with the numbers."""
    import re
    names = re.findall(r"\(\?<([A-Za-z][A-Za-z0-9]*)>", regex)
    return re.sub(r"\(\?<[A-Za-z][A-Za-z0-9]*>", "(", regex), {n: i + 1 for i, n in enumerate(names)}


def _cap(text: str, pattern: str, group: int | None, port: bool) -> str:
    if group is None:
        return "' '"
    raw = f"regexp_extract({text}, {_q(pattern)}, {group})"
    kept = f"replace({raw}, ':', '')" if port else raw
    return f"CASE WHEN coalesce({raw}, '') = '' THEN ' ' ELSE {kept} END"


def _group_of(rule: dict, field: str, user: bool) -> int | None:
    if user:
        _, idx = _user_numbered(rule["log_regex"])
        return idx.get(S.USER_GROUP_NAMES[field])
    g = rule.get(field, "").strip()
    return int(g) if g else None


def _matched_cte(user: bool = False, extra: dict[int, str] | None = None) -> str:
    text = "logcontent" if user else "msg"
    whens = []
    for r in _rules(user):
        pat = _user_numbered(r["log_regex"])[0] if user else r["log_regex"]
        dev = "" if user else f"device_ip = {_q(r['device_ip'])} AND "
        dev += (extra or {}).get(r["rule_seq"], "")
        whens.append(f"WHEN n_fields > 6 AND {dev}regexp_matches({text}, {_q(pat)}) THEN {r['rule_seq']}")
    return f"matched AS (SELECT *, CASE {' '.join(whens)} END AS seq FROM parsed)"


def _per_rule(expr_of, user: bool) -> str:
    parts = [f"WHEN {r['rule_seq']} THEN {expr_of(r)}" for r in _rules(user)]
    return f"CASE seq {' '.join(parts)} END"


def _genlog_cte(user: bool = False) -> str:
    text = "logcontent" if user else "msg"
    cols = {
        "row": "md5('genlog~' || line_key)",
        "recordid": "md5('genlog~' || line_key)",
        "firstrecvtime": "epoch_ms(try_strptime(left(trim(recvtime), 19), '%Y-%m-%d %H:%M:%S'))",
        "reportapp": "reportapp",
        "reportip": "reportip",
        "orgid": "recordid",
        "orglog": text,
    }
    for f in S.CAPTURE_FIELDS:
        cols[f] = _per_rule(lambda r, f=f: _cap(
            text, _user_numbered(r["log_regex"])[0] if user else r["log_regex"],
            _group_of(r, f, user), f in ("sourceport", "destport")), user)
    cols["reportnetype"] = _per_rule(lambda r: _q(r.get("reportnetype", "")), user)
    cols["eventdefid"] = _per_rule(lambda r: _q(r.get("eventdefid", "").replace("-", "")), user)
    cols["eventlevel"] = _per_rule(lambda r: _q(r.get("eventlevel", "") or "1"), user)
    cols["eventid"] = _per_rule(lambda r: _q(r.get("eventid", "")), user)
    cols["logruleid"] = _per_rule(lambda r: _q(r["log_rule_id"].strip()), user)
    select = ",\n  ".join(f"{cols[f]} AS {f}" for f in S.GENLOG_FIELDS)
    return (f"genlog AS (SELECT * FROM (SELECT\n  {select},\n  line_key, recvtime\nFROM matched WHERE seq IS NOT NULL) g "
            "WHERE firstrecvtime IS NOT NULL)")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _defs_cte() -> str:
    defs = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in row) + ")"
                     for row in fx.EVENT_DEFS)
    fields = ", ".join("(" + ", ".join(_q(v) for v in row) + ")" for row in fx.EVENT_FIELDS)
    return f"""
defs_raw(event_rule_id, event_rule_lib_id, event_rule_code, event_rule_name, event_rule_level,
         event_basic_type, event_sub_type, event_rule_desc, event_rule, is_inner, is_use) AS (VALUES {defs}),
fields_raw(event_rule_field_id, event_rule_id, event_rule_field, match_method, filed_begin_value,
           filed_end_value) AS (VALUES {fields}),
sysdefs AS (
  SELECT d.event_rule_id, d.event_rule_name, d.event_rule_level, d.event_basic_type, d.event_sub_type,
         f.filed_begin_value, f.event_rule_field, f.match_method
  FROM defs_raw d RIGHT JOIN fields_raw f ON d.event_rule_id = f.event_rule_id
  WHERE CAST(d.is_inner AS VARCHAR) = '1' AND CAST(d.is_use AS VARCHAR) = '1'
),
defidx AS (
  SELECT lower(trim(event_rule_name)) AS def_key,
         arg_min(event_rule_id, (event_rule_id, event_rule_field)) AS def_id,
         arg_min(event_rule_name, (event_rule_id, event_rule_field)) AS def_name,
         arg_min(event_rule_level, (event_rule_id, event_rule_field)) AS def_level
  FROM sysdefs GROUP BY 1
)"""


def _event_select(id_expr: str, name_expr: str, level_expr: str, src: str) -> str:
    return f"""SELECT md5('event_doc~' || line_key) AS row,
  md5('event~' || line_key) AS event_rule_result_id,
  {id_expr} AS event_rule_id, g.row AS logid, {name_expr} AS event_rule_name,
  {level_expr} AS event_rule_level, reportip AS reportneip, sourceip, sourceport, destip, destport,
  CAST(firstrecvtime AS VARCHAR) AS opentime, actionresult AS actionopt,
  CASE WHEN reportapp = 'NE_FLOW' THEN '0' ELSE '1' END AS is_inner, reportapp AS proto
FROM {src}"""


def _escapes(name: str) -> str:
    return (f"array_to_string(list_transform(string_split({name}, ''), "
            f"lambda c: 'socos' || lower(to_hex(unicode(c)))), '')")


def _status_cte() -> str:
    devs = sorted({r["device_ip"] for r in _rules()})
    dev_list = ", ".join(_q(d) for d in devs)
    return f"""status AS (
  SELECT *, CASE WHEN value IS NULL THEN 'null_value'
                 WHEN n_fields <= 6 THEN 'too_few_fields'
                 WHEN seq IS NOT NULL THEN 'matched'
                 WHEN device_ip IS NULL THEN 'short_payload'
                 WHEN device_ip IN ({dev_list}) AND msg IS NULL THEN 'short_payload'
                 ELSE 'no_rule' END AS match_status
  FROM matched)"""


def build() -> dict[str, str]:
    sys = [RAW_CTE, _matched_cte(), _genlog_cte()]
    usr = [RAW_CTE, _matched_cte(True), _genlog_cte(True)]
    genlog_cols = ", ".join(S.GENLOG_FIELDS)
    sql: dict[str, str] = {}
    sql["raw_parse"] = _with(RAW_CTE) + (
        "SELECT line, n_fields, recordid, recvtime, reportip, reportapp, device_ip, msg, shifted FROM parsed")
    sql["genlog_match"] = _with(*sys) + f"SELECT {genlog_cols} FROM genlog"
    sql["user_rule_match"] = _with(*usr) + f"SELECT {genlog_cols} FROM genlog"
    flag = "CASE WHEN seq IS NOT NULL THEN '0' ELSE '1' END"
    sql["syslog_docs"] = _with(RAW_CTE, _matched_cte()) + f"""
SELECT md5('syslog~' || line_key) AS row, ff[1] AS recordid, ms AS recvtime, ms AS storagetime,
       ff[3] AS reportip, ff[6] AS reportapp, ff[7] AS logcontent,
       CAST(CASE WHEN trim(ff[8]) = '' THEN 1
                 WHEN regexp_matches(trim(ff[8]), '^[+-]?[0-9]{{1,10}}$') AND TRY_CAST(trim(ff[8]) AS INTEGER) IS NOT NULL
                   THEN TRY_CAST(trim(ff[8]) AS INTEGER)
                 ELSE 0 END AS INTEGER) AS ismatch
FROM (SELECT *, epoch_ms(try_strptime(left(trim(ff[2]), 19), '%Y-%m-%d %H:%M:%S')) AS ms
      FROM (SELECT *, string_split(line || '~' || {flag}, '~') AS ff FROM matched) a) b
WHERE line IS NOT NULL AND len(ff) >= 8 AND ms IS NOT NULL"""
    doc_cols = []
    for c in S.GENLOG_DOC_COLUMNS:
        if c == "row":
            doc_cols.append("md5('genlog_doc~' || line_key) AS row")
        elif c == "eventname2":
            doc_cols.append(f"CASE WHEN trim(eventname) = '' THEN '' ELSE {_escapes('trim(eventname)')} END AS eventname2")
        elif c == "eventname3":
            doc_cols.append("CASE WHEN trim(eventname) = '' THEN '' ELSE upper(md5(trim(eventname))) END AS eventname3")
        else:
            doc_cols.append(c)
    sql["genlog_docs"] = _with(*sys) + f"SELECT {', '.join(doc_cols)} FROM genlog WHERE firstrecvtime IS NOT NULL"
    sql["event_match_name"] = _with(*sys, _defs_cte()) + _event_select(
        "def_id", "def_name", "def_level", "genlog g JOIN defidx ON lower(trim(g.eventname)) = defidx.def_key")
    sql["event_match_id"] = _with(*sys) + _event_select("eventid", "eventname", "eventlevel", "genlog g")
    new_defs = """newdefs AS (
  SELECT md5('eventdef~' || k) AS event_rule_id, '' AS event_rule_lib_id, '' AS event_rule_code,
         arg_min(trim(eventname), row) AS event_rule_name, arg_min(trim(eventlevel), row) AS event_rule_level,
         '' AS event_basic_type, '' AS event_sub_type, '' AS event_rule_desc, '' AS event_rule,
         '1' AS is_inner, '1' AS is_use
  FROM (SELECT *, lower(trim(eventname)) AS k FROM genlog) g
  WHERE NOT EXISTS (SELECT 1 FROM defidx WHERE defidx.def_key = g.k)
  GROUP BY k)"""
    sql["new_event_rules"] = _with(*sys, _defs_cte(), new_defs) + f"SELECT {', '.join(S.EVENT_DEF_COLUMNS)} FROM newdefs"
    sql["new_rule_events"] = _with(*sys, _defs_cte(), new_defs) + _event_select(
        "n.event_rule_id", "g.eventname", "g.eventlevel",
        "genlog g JOIN newdefs n ON lower(trim(g.eventname)) = lower(trim(n.event_rule_name))")
    # each new name's definition comes from the first of the three batches that has it
    first_defs = new_defs.replace(
        "FROM (SELECT *, lower(trim(eventname)) AS k FROM genlog) g",
        "FROM (SELECT *, min(b) OVER (PARTITION BY k) AS b0 FROM (SELECT g.*, lower(trim(eventname)) AS k, p.event_id % 3 AS b "
        "FROM genlog g JOIN parsed p ON p.line_key = g.line_key) x) g").replace("WHERE NOT EXISTS", "WHERE b = b0 AND NOT EXISTS")
    sql["stream_new_names"] = _with(*sys, _defs_cte(), first_defs) + """
SELECT event_rule_id, event_rule_name, event_rule_level, count(*) AS n_events, max(made) AS n_definitions FROM (
  SELECT d.def_id AS event_rule_id, d.def_name AS event_rule_name, d.def_level AS event_rule_level, 0 AS made
  FROM genlog g JOIN defidx d ON lower(trim(g.eventname)) = d.def_key
  UNION ALL SELECT n.event_rule_id, n.event_rule_name, n.event_rule_level, 1
  FROM genlog g JOIN newdefs n ON lower(trim(g.eventname)) = lower(trim(n.event_rule_name))) e
GROUP BY event_rule_id, event_rule_name, event_rule_level"""
    split = f"(SELECT *, string_split(line || '~' || {flag}, '~') AS ff FROM matched) a"
    rejects = f"""rejects AS (
  SELECT md5('reject~' || line_key) AS row, value, reason, shifted FROM (
    SELECT *, CASE WHEN value IS NULL THEN 'null_value' WHEN len(ff) < 8 THEN 'too_few_fields'
      WHEN try_strptime(left(trim(ff[2]), 19), '%Y-%m-%d %H:%M:%S') IS NULL THEN 'bad_time' END AS reason FROM {split}) b
  WHERE reason IS NOT NULL)"""
    sql["log_rejects"] = _with(RAW_CTE, _matched_cte(), rejects) + "SELECT * FROM rejects"
    # each input line is in exactly one of syslog and rejects, and no two records share an id
    sql["record_ids"] = _with(*sys, rejects) + """
SELECT 'genlog' AS kind, count(*) AS n, count(*) AS n_ids FROM genlog
UNION ALL SELECT 'rejects', count(*), count(*) FROM rejects
UNION ALL SELECT 'syslog', (SELECT count(*) FROM events) - count(*), (SELECT count(*) FROM events) - count(*) FROM rejects"""
    sql["sink_counts"] = _with(*sys, _defs_cte(), rejects) + """
SELECT 'genlog' AS sink, count(*) AS n FROM genlog
UNION ALL SELECT 'rejects', count(*) FROM rejects
UNION ALL SELECT 'syslog', (SELECT count(*) FROM events) - count(*) FROM rejects
UNION ALL SELECT 'event', count(*) FROM genlog g JOIN defidx ON lower(trim(g.eventname)) = defidx.def_key"""
    sql["match_counts"] = _with(RAW_CTE, _matched_cte(), _status_cte()) + \
        "SELECT match_status, count(*) AS n FROM status GROUP BY match_status"
    sql["rule_counts"] = _with(*sys, _defs_cte()) + """
SELECT logruleid AS rule, count(*) AS n, 'log_rule' AS kind FROM genlog GROUP BY logruleid
UNION ALL
SELECT def_id AS rule, count(*) AS n, 'event_def' AS kind
FROM genlog g JOIN defidx ON lower(trim(g.eventname)) = defidx.def_key GROUP BY def_id"""
    rejected = {3: "no_group", 4: "bad_regex", 5: "bad_group", 6: "bad_group", 7: "bad_group",
                8: "bad_group", 9: "bad_group", 10: "bad_group"}
    rej_rows = ", ".join(f"({_q(r['log_rule_id'])}, {_q(rejected[r['rule_seq']])}, {_q(r['device_ip'])})"
                         for r in fx.LOG_RULES if r["rule_seq"] in rejected)
    sql["rule_rejects"] = _with(RAW_CTE, f"rej(rule_id, reject_reason, dev) AS (VALUES {rej_rows})") + """
SELECT rule_id, reject_reason, coalesce(lines, 0) AS lines
FROM rej LEFT JOIN (SELECT device_ip, count(*) AS lines FROM parsed GROUP BY device_ip) c ON c.device_ip = rej.dev"""
    for name, text, key, device, prefix in (
            ("device_rule_match", "msg", "p_partkey // 8 % 1000 * 8 + p_partkey % 8", "'192.168.0.' || CAST(p_partkey % 8 AS VARCHAR)", "PR-"),
            ("user_rule_set_match", "logcontent", "p_partkey % 1000", "NULL", "PU-")):
        # the rules differ in the user they name alone: the first part of a device and user is the first rule that matches
        sql[name] = _with(RAW_CTE, f"""
rules AS (SELECT CAST({key} AS VARCHAR) AS who, {device} AS dev, min('{prefix}' || lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS logruleid
          FROM part GROUP BY ALL),
found AS (SELECT *, regexp_extract({text}, 'user=(\\d+) type=(\\w+) value=([\\d.]+)', ['a', 'b', 'c']) AS m FROM parsed WHERE n_fields > 6)""") + """
SELECT line_key, logruleid, m.a AS sourceip, m.b AS eventname, m.c AS destport
FROM found JOIN rules ON rules.who = m.a AND (rules.dev IS NULL OR rules.dev = found.device_ip)
WHERE try_strptime(left(trim(recvtime), 19), '%Y-%m-%d %H:%M:%S') IS NOT NULL"""
    sql["event_defs_appended"] = _with(*sys, _defs_cte(), new_defs) + (
        "SELECT * FROM sysdefs UNION ALL BY NAME SELECT * FROM newdefs")
    sql["event_summary"] = (
        "SELECT event_rule_id, event_rule_name, is_inner, count(*) AS n_events, "
        "count(DISTINCT reportneip) AS n_devices FROM (\n" + sql["event_match_name"] + "\n) e GROUP BY 1, 2, 3")
    return sql



# --- rule tables, flows, clusters, addresses, functions -----------------------

def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def java_double(x: str) -> str:
    """DuckDB text of a double as the JVM prints it (E notation below 1e-3)."""
    a = f"abs({x})"
    s = f"CAST({a} AS VARCHAR)"
    frac = f"split_part({s}, '.', 2)"
    digits = f"ltrim({frac}, '0')"
    small = (f"{digits}[1] || '.' || CASE WHEN length({digits}) > 1 THEN {digits}[2:] ELSE '0' END"
             f" || 'E' || CAST(-(length({frac}) - length({digits}) + 1) AS VARCHAR)")
    mant = f"split_part({s}, 'e', 1)"
    sci = (f"CASE WHEN contains({mant}, '.') THEN {mant} ELSE {mant} || '.0' END"
           f" || 'E' || CAST(CAST(split_part({s}, 'e', 2) AS INTEGER) AS VARCHAR)")
    return (f"CASE WHEN {x} = 0 OR ({a} >= 0.001 AND {a} < 10000000) THEN CAST({x} AS VARCHAR) "
            f"ELSE CASE WHEN {x} < 0 THEN '-' ELSE '' END || "
            f"CASE WHEN contains({s}, 'e') THEN {sci} ELSE {small} END END")


def _ipn(x: str) -> str:
    parts = f"string_split(regexp_replace(trim({x}), '\\.+$', ''), '.')"
    o = [f"TRY_CAST({parts}[{i}] AS BIGINT)" for i in range(1, 5)]
    return f"CASE WHEN len({parts}) >= 4 THEN ((({o[0]} * 256 + {o[1]}) * 256 + {o[2]}) * 256 + {o[3]}) END"


RULE_BASE_CTE = """
ne AS (SELECT CAST(s_suppkey AS VARCHAR) AS ne_id, CAST(s_nationkey AS VARCHAR) AS htypeid,
              'V' || CAST(s_suppkey % 5 AS VARCHAR) AS vendorid, 'M' || CAST(s_suppkey // 50 AS VARCHAR) AS model
       FROM supplier),
ip AS (SELECT CAST(s_suppkey AS VARCHAR) AS ne_id,
              CASE WHEN s_suppkey % 10 <> 9 THEN '172.16.' || CAST(s_suppkey // 256 AS VARCHAR) || '.'
                   || CAST(s_suppkey % 256 AS VARCHAR) END AS device_ip
       FROM supplier WHERE s_suppkey % 10 <> 7
       UNION ALL
       SELECT CAST(s_suppkey AS VARCHAR), '172.17.' || CAST(s_suppkey // 256 AS VARCHAR) || '.' || CAST(s_suppkey % 256 AS VARCHAR)
       FROM supplier WHERE s_suppkey % 10 <> 7 AND s_suppkey % 3 = 0),
lib AS (SELECT 'LIB' || CAST(s_suppkey AS VARCHAR) AS log_rule_lib_id, CAST(s_nationkey AS VARCHAR) AS htyeid,
               'V' || CAST(s_suppkey % 5 AS VARCHAR) AS vendorid, 'M' || CAST(s_suppkey // 50 AS VARCHAR) AS model
        FROM supplier)"""


def _rx_cte() -> str:
    values = {
        "log_rule_id": "CASE WHEN p_partkey % 97 <> 0 THEN 'R' || CAST(p_partkey AS VARCHAR) END",
        "log_rule_lib_id": ("CASE WHEN p_partkey % 7 = 3 THEN 'NOLIB' || CAST(p_partkey AS VARCHAR) "
                            "ELSE 'LIB' || CAST(p_partkey // 25 AS VARCHAR) END"),
        "log_rule_code": "'C' || CAST(p_partkey AS VARCHAR)",
        "log_regex": "'user=(\\d+) type=(' || lower(p_type) || ')'",
        "eventdefid": "p_brand",
        "eventlevel": "CAST(p_size % 5 AS VARCHAR)",
        "sourceip": "'1'",
        "eventname": "'2'",
        "reportnetype": "p_name",
    }
    cols = ", ".join(f"{values.get(c, chr(39) * 2)} AS {c}" for c in S.LOG_REGEX_COLUMNS)
    return f"rx AS (SELECT {cols} FROM part)"


def _assembly_sql(stringified: bool = False) -> str:
    def col(c: str) -> str:
        e = "lib2.device_ip" if c == "device_ip" else f"rx.{c}"
        return f"CASE WHEN {e} IS NULL OR {e} = 'null' THEN '' ELSE {e} END AS {c}" if stringified else f"{e} AS {c}"
    return _with(RULE_BASE_CTE, _rx_cte()) + f"""
SELECT {', '.join(col(c) for c in S.LOG_RULE_COLUMNS)}
FROM rx RIGHT JOIN (
  SELECT lib.log_rule_lib_id, m.device_ip
  FROM lib JOIN (SELECT ne.htypeid, ne.vendorid, ne.model, ip.device_ip
                 FROM ne LEFT JOIN ip ON ip.ne_id = ne.ne_id) m
    ON lib.htyeid = m.htypeid AND lib.vendorid = m.vendorid AND lib.model = m.model) lib2
  ON lib2.log_rule_lib_id = rx.log_rule_lib_id
WHERE lib2.device_ip IS NOT NULL AND rx.log_rule_id IS NOT NULL"""


EVENT_BASE_CTE = """
edefs AS (SELECT 'E' || CAST(c_custkey AS VARCHAR) AS event_rule_id, 'EL' || CAST(c_custkey % 10 AS VARCHAR) AS event_rule_lib_id,
                 'C' || CAST(c_custkey AS VARCHAR) AS event_rule_code, c_mktsegment AS event_rule_name,
                 CAST(c_nationkey % 5 AS VARCHAR) AS event_rule_level, 'B' || CAST(c_nationkey % 3 AS VARCHAR) AS event_basic_type,
                 'S' || CAST(c_custkey % 4 AS VARCHAR) AS event_sub_type, c_name AS event_rule_desc, '' AS event_rule,
                 CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS is_inner,
                 CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS is_use
          FROM customer),
eflds AS (SELECT 'F' || CAST(o_orderkey AS VARCHAR) AS event_rule_field_id,
                 CASE WHEN o_orderkey % 11 = 0 THEN 'EMISSING' || CAST(o_orderkey AS VARCHAR)
                      ELSE 'E' || CAST(o_custkey AS VARCHAR) END AS event_rule_id,
                 o_orderpriority AS event_rule_field, o_orderstatus AS match_method,
                 CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS filed_begin_value,
                 strftime(o_orderdate, '%Y-%m-%d') AS filed_end_value
          FROM orders)"""


_POINTS_CTE = """
pts AS (SELECT CAST(label AS INTEGER) AS label,
               '10.9.' || CAST(vec_id // 256 AS VARCHAR) || '.' || CAST(vec_id % 256 AS VARCHAR) AS ip,
               list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS coords
        FROM embeddings),
cen AS (SELECT label, list(m ORDER BY i) AS centre
        FROM (SELECT label, i, round(avg(x), 6) AS m
              FROM (SELECT label, unnest(coords) AS x, unnest(range(len(coords))) AS i FROM pts) f GROUP BY label, i) a
        GROUP BY label)"""


def _coords_text(lst: str) -> str:
    return f"array_to_string(list_transform({lst}, lambda x: {java_double('x')}), '#')"


CLUSTER_TIME_SQL = "TIMESTAMP '2024-01-01 00:00:00'"


def _escape_unit(c: str) -> str:
    u = f"unicode({c})"
    return (f"CASE WHEN {u} > 65535 THEN '\\u' || lower(to_hex(55296 + (({u} - 65536) >> 10))) || "
            f"'\\u' || lower(to_hex(56320 + (({u} - 65536) & 1023))) ELSE '\\u' || lower(to_hex({u})) END")


def build_more(sql: dict[str, str]) -> None:
    sql["log_rule_assembly"] = _assembly_sql()
    sql["rule_snapshot_roundtrip"] = _assembly_sql(stringified=True)
    sql["event_defs_system"] = _with(EVENT_BASE_CTE) + f"""
SELECT {', '.join(('f.' if c in ('filed_begin_value', 'event_rule_field', 'match_method') else 'd.') + c for c in S.EVENT_DEF_SYSTEM_COLUMNS)}
FROM edefs d RIGHT JOIN eflds f ON d.event_rule_id = f.event_rule_id
WHERE CAST(d.is_inner AS VARCHAR) = '1' AND CAST(d.is_use AS VARCHAR) = '1'"""
    sql["event_defs_user"] = _with(EVENT_BASE_CTE) + (
        f"SELECT {', '.join(S.EVENT_DEF_USER_COLUMNS)} FROM edefs WHERE is_inner = 0 AND is_use = 1")
    sql["event_rule_fields"] = _with(EVENT_BASE_CTE) + f"SELECT {', '.join(S.EVENT_FIELD_COLUMNS)} FROM eflds"
    lo, hi = (f"TIMESTAMP '{t}'" for t in fx.FLOW_RANGE)
    sql["netflow_scan"] = f"""
SELECT * FROM (
  SELECT '10.1.0.' || CAST(l_suppkey % 256 AS VARCHAR) AS srcip, '10.2.0.' || CAST(l_partkey % 256 AS VARCHAR) AS dstip,
         l_shipdate AS starttime,
         CASE WHEN l_linenumber <> 7 THEN l_shipdate + to_minutes(CAST(l_linenumber AS BIGINT)) END AS endtime,
         nullif(l_returnflag, 'N') AS proto, CAST(trunc(l_quantity) AS INTEGER) AS packernum,
         CAST(floor(l_extendedprice) AS INTEGER) AS bytesize
  FROM lineitem) f
WHERE starttime >= {lo} AND starttime < {hi} AND srcip IS NOT NULL AND dstip IS NOT NULL
  AND starttime IS NOT NULL AND endtime IS NOT NULL AND packernum IS NOT NULL AND bytesize IS NOT NULL"""
    sql["moniflow_scan"] = """
SELECT * FROM (
  SELECT '10.3.' || CAST((o_custkey // 256) % 256 AS VARCHAR) || '.' || CAST(o_custkey % 256 AS VARCHAR) AS srcip,
         '10.4.' || CAST((o_orderkey // 256) % 256 AS VARCHAR) || '.' || CAST(o_orderkey % 256 AS VARCHAR) AS dstip,
         o_orderpriority AS appproto, nullif(o_orderstatus, 'P') AS method
  FROM orders) m
WHERE srcip IS NOT NULL AND dstip IS NOT NULL AND appproto IS NOT NULL AND method IS NOT NULL"""
    dist = ("round(sqrt(list_sum(list_transform(range(1, len(coords) + 1), "
            "lambda i: (coords[i] - centre[i]) * (coords[i] - centre[i])))), 6)")
    sql["cluster_points"] = _with(_POINTS_CTE) + f"""
SELECT md5('cluster~CL-1~' || ip || '~' || CAST(label AS VARCHAR)) AS row, 'CL-1' AS clno, ip AS name,
       CAST(label AS VARCHAR) AS center_index, {dist} AS distance, {_coords_text('coords')} AS center_info,
       {CLUSTER_TIME_SQL} AS cltime, 'level one' AS demo
FROM pts JOIN cen USING (label)"""
    sql["cluster_centers"] = _with(_POINTS_CTE) + f"""
SELECT md5('centre~CL-1~' || CAST(label AS VARCHAR)) AS row, CAST(label AS VARCHAR) AS center_index,
       {_coords_text('centre')} AS center_info, 'CL-1' AS clno, 1 AS type, {CLUSTER_TIME_SQL} AS cltime,
       {_q(S.CENTER_DEMO_LEVEL1)} AS demo
FROM cen"""
    sql["cluster_centers_sub"] = _with(_POINTS_CTE) + f"""
SELECT md5('centre2~CL-2~' || CAST(label AS VARCHAR)) AS row, CAST(label AS VARCHAR) AS center_index,
       '0' AS center_index_p, {_coords_text('centre')} AS cluster_info, 'CL-2' AS clno, 'CL-1' AS clno_p,
       2 AS type, {CLUSTER_TIME_SQL} AS cltime, {_q(S.CENTER_DEMO_LEVEL2)} AS demo
FROM cen"""
    sql["cluster_centers_batch"] = _with(_POINTS_CTE) + f"""
SELECT 'B-' || CAST(label AS VARCHAR) AS row, 'centre-' || CAST(label AS VARCHAR) AS name,
       CAST(label AS VARCHAR) AS center_index, {_coords_text('centre')} AS center_info, 'CL-2' AS clno,
       2 AS type, {CLUSTER_TIME_SQL} AS cltime, {_q(S.CENTER_DEMO_LEVEL2)} AS demo,
       '0' AS center_index_p, 'CL-1' AS clno_p
FROM cen"""
    secs = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in fx.IP_SECTIONS)
    sql["ip_range_join"] = _with(RAW_CTE, f"sec(section_name, ip_section) AS (VALUES {secs})") + f"""
SELECT p.line_key, p.reportip, r.section_name
FROM parsed p JOIN (SELECT section_name, {_ipn("split_part(trim(ip_section), '-', 1)")} AS lo,
                           {_ipn("substr(trim(ip_section), strpos(trim(ip_section), '-') + 1)")} AS hi FROM sec) r
  ON r.lo BETWEEN 0 AND 4294967295 AND r.hi BETWEEN 0 AND 4294967295 AND {_ipn('p.reportip')} BETWEEN r.lo AND r.hi"""
    sql["ip_to_long"] = _with(RAW_CTE) + f"""
SELECT line_key, reportip, {_ipn('reportip')} AS reportip_num, device_ip, {_ipn('device_ip')} AS device_num,
       ({_ipn('reportip')} >= {_ipn("'10.0.0.0'")} AND {_ipn('reportip')} <= {_ipn("'10.0.0.99'")}) AS in_office
FROM parsed"""
    devs = ", ".join(sorted({_q(r["device_ip"]) for r in _rules()}))
    sql["device_semi"] = _with(RAW_CTE) + f"SELECT line_key, device_ip FROM parsed WHERE device_ip IN ({devs})"
    sec_ts = "date_trunc('second', ts)"
    sql["date_functions"] = f"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS recv, epoch_ms({sec_ts}) AS ms,
       CAST(epoch({sec_ts}) AS BIGINT) AS sec, strftime({sec_ts}, '%Y-%m-%d %H:%M:%S') AS back,
       strftime({sec_ts}, '%Y-%m-%d%H:%M:%S') AS compact, epoch_ms({sec_ts}) AS ms_tail,
       epoch_ms(make_timestamp(2025, 1, event_id % 9 + 1, 0, 0, 0.0)) AS ms_bad
FROM events"""
    sql["json_map"] = ("SELECT event_id, json_extract_string(props, '$.k') AS k, "
                       "CAST(len(json_keys(props)) AS INTEGER) AS n_keys FROM events")
    sql["json_lower_keys"] = ("SELECT event_id, '[' || CAST(event_id % 3 AS VARCHAR) || ',' || "
                              "json_extract_string(props, '$.k') || ']' AS k, event_type AS type, "
                              "2 AS n_keys FROM events")
    sql["json_nested_map"] = ("SELECT event_id, event_type AS type, true AS type_is_plain, CAST(user_id AS VARCHAR) AS user_id, "
                              "'u' || CAST(user_id AS VARCHAR) AS user_name FROM events")
    sql["rule_sync"] = sql["rule_snapshot_roundtrip"]
    sql["rule_set_counts"] = f"""
SELECT 'logRule' AS rule_set, count(*) AS n FROM ({sql["log_rule_assembly"]}) a
UNION ALL SELECT 'logUserRule', 0
UNION ALL SELECT 'eventDefRuleByUser', 0
UNION ALL SELECT 'eventDefRuleBySystem', count(*) FROM ({sql["event_defs_system"]}) b
UNION ALL SELECT 'eventFieldRule', count(*) FROM ({sql["event_rule_fields"]}) c"""
    sql["section_rejects"] = _with(RAW_CTE) + """
SELECT name AS section_name, reason AS reject_reason, (SELECT count(reportip) FROM parsed) AS lines
FROM (VALUES ('backwards', 'backwards'), ('malformed', 'out_of_range')) x(name, reason)"""
    sql["unicode_codec"] = f"""
SELECT doc_id,
       CAST(list_sum(list_transform(string_split(text, ''), lambda c: CASE WHEN unicode(c) > 65535 THEN 2 ELSE 1 END)) AS BIGINT) AS n_units,
       CASE WHEN trim(text) = '' THEN NULL
            ELSE md5(array_to_string(list_transform(string_split(text, ''), lambda c: {_escape_unit('c')}), '')) END AS escaped_md5,
       CASE WHEN trim(text) = '' THEN NULL ELSE true END AS roundtrip_ok
FROM documents"""
    sql["index_read"] = "SELECT * FROM (" + sql["syslog_docs"] + ") s WHERE ismatch = 0"
    sql["stream_normalise"] = sql["genlog_docs"]
    sql["stream_admission"] = sql["genlog_docs"]
    sql["netflow_store_scan"] = sql["netflow_scan"]
    refresh = [RAW_CTE, _matched_cte(extra={2: "event_id % 2 = 1 AND "}), _genlog_cte()]
    sql["stream_rule_refresh"] = sql["genlog_docs"].replace(
        _with(RAW_CTE, _matched_cte(), _genlog_cte()), _with(*refresh))
    fields = ", ".join("recvtime" if c == "firstrecvtime" else c for c in S.GENLOG_FIELDS)
    sql["kafka_forward"] = _with(RAW_CTE, _matched_cte(), _genlog_cte()) + f"SELECT concat_ws('~', {fields}) AS value FROM genlog"


_build_log = build


def build() -> dict[str, str]:  # noqa: F811 - extends the log-path queries
    sql = _build_log()
    build_more(sql)
    return sql

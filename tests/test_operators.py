"""Operators on hand-made raw lines and rule rows."""

from pyspark.sql import functions as F

from logsieve import fixtures as fx
from logsieve import schema as S
from logsieve.functions import date_to_millis
from logsieve.operators import assembly as asm
from logsieve.operators import events as ev
from logsieve.operators import match as mt
from logsieve.operators import parse as ps
from logsieve.plans.normalise import analyze
from logsieve.sinks import documents as docs

DEV = "192.168.0.1"


def payload(n_parts, device=DEV, message="user=7 type=error value=1.00"):
    parts = ["x"] * n_parts
    if n_parts > 29:
        parts[29] = device
    if n_parts > 66:
        parts[66] = message
    return "|!".join(parts)


def lines_df(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_admission_and_split(spark):
    rows = {r["value"]: r for r in ps.parse(lines_df(spark, fx.EDGE_LINES)).collect()}
    assert rows[None]["line"] is None
    assert rows["   "]["line"] == "   "                       # blank: no id
    assert rows["a~b~c~d~e"]["n_fields"] == 6                  # 5 fields + id
    six = "2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~plain content"
    assert rows[six]["n_fields"] == 7 and rows[six]["line"].endswith("~" + six)
    seven = "00000000000000000000000000000001~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~plain content"
    assert rows[seven]["line"] == seven and rows[seven]["recordid"].endswith("1")
    trailing = "2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~content~~"
    assert rows[trailing]["n_fields"] == 7                     # trailing empties dropped, id added


def test_match_edge_cases(spark):
    content67 = payload(67)
    lines = [
        f"id1~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~{content67}",                 # matches rule 0
        f"id2~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~{payload(20)}",               # short: no device
        f"id3~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~{payload(40)}",               # short: device, no message
        f"id4~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~{payload(67, device='192.168.0.9')}",  # no rule
        f"id5~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~plain",                        # content without |!
        f"id6~2024-01-01 00:00:00~10.0.0.1~-~-~SYSLOG~{payload(67, device='192.168.0.3')}",  # only a rejected rule
    ]
    m = mt.match_system(ps.parse(lines_df(spark, lines)), fx.log_rules_df(spark))
    got = {r["recordid"]: (r["match_status"], r["hit"]["rule_id"] if r["hit"] else None) for r in m.collect()}
    assert got["id1"] == ("matched", "LR-0")
    assert got["id2"] == ("short_payload", None)
    assert got["id3"] == ("short_payload", None)
    assert got["id4"] == ("no_rule", None)
    assert got["id5"] == ("short_payload", None)
    assert got["id6"] == ("no_rule", None)


def test_first_match_and_captures(spark):
    line = f"id~2024-01-01 00:00:00~10.0.0.9~-~-~NE_FLOW~{payload(67, message='user=5 type=click value=2.50')}"
    g = mt.to_genlog(mt.match_system(ps.parse(lines_df(spark, [line])), fx.log_rules_df(spark))).first()
    assert g["logruleid"] == "LR-1"                 # rule 0 needs type=error
    assert g["sourceip"] == "5" and g["eventname"] == "click" and g["destport"] == "2.50"
    assert g["sourceport"] == " " and g["eventlevel"] == "1" and g["eventdefid"] == ""
    assert g["reportip"] == "10.0.0.9" and g["orgid"] == "id" and g["orglog"] == "user=5 type=click value=2.50"
    assert g["firstrecvtime"] == 1704067200000


def test_non_participating_group_and_port_colon(spark):
    rules = [{"rule_seq": 0, "log_rule_id": " R ", "device_ip": f" {DEV} ",
              "log_regex": r"p=(:?)(\d*)( none)?", "sourceport": "1", "destport": "2", "sourceip": "3",
              "eventname": "", "eventlevel": " ", "eventdefid": "a-b"}]
    line = f"id~2024-01-01 00:00:00~r~-~-~S~{payload(67, message='p=:')}"
    g = mt.to_genlog(mt.match_system(ps.parse(lines_df(spark, [line])), fx.log_rules_df(spark, rules))).first()
    assert g["sourceport"] == ""      # ":" with the colon removed is stored empty
    assert g["destport"] == " "       # empty group
    assert g["sourceip"] == " "       # group took no part
    assert g["eventname"] == " "      # blank group number
    assert g["eventlevel"] == " "     # not empty, kept as is
    assert g["eventdefid"] == "ab" and g["logruleid"] == "R"


def test_rule_validation(spark):
    rej = {r["rule_id"]: r["reject_reason"] for r in mt.rule_rejects(fx.log_rules_df(spark)).collect()}
    assert rej == {"LR-3": "no_group", "LR-4": "bad_regex", "LR-5": "bad_group", "LR-6": "bad_group", "LR-7": "bad_group",
                   "LR-8": "bad_group", "LR-9": "bad_group", "LR-10": "bad_group"}


def test_user_rules_named_groups(spark):
    line = f"id~2024-01-01 00:00:00~r~-~-~S~user=3 type=purchase value=9.99"
    m = mt.match_user(ps.parse(lines_df(spark, [line])), fx.user_rules_df(spark))
    g = mt.to_genlog(m, user_rules=True).first()
    assert g["logruleid"] == "UR-1" and g["sourceip"] == "3" and g["eventname"] == "purchase"
    assert g["url"] == " " and g["orglog"] == "user=3 type=purchase value=9.99"


def test_event_match_and_new_definitions(spark):
    defs = asm.event_defs_system(fx.event_defs_df(spark), fx.event_fields_df(spark))
    assert defs.count() == 6   # F1, F2 (fan-out), F3, F4, F5, F7
    names = ["Error", "error ", "click", "view", "signup", "PURCHASE"]
    lines = [f"id{i}~2024-01-01 00:00:00~r~-~-~{'NE_FLOW' if n == 'view' else 'S'}~"
             f"{payload(67, message=f'user={i} type={n.strip()} value=1.00')}" for i, n in enumerate(names)]
    a = analyze(lines_df(spark, lines), fx.log_rules_df(spark), defs)
    evs = {r["logid"]: r for r in a.events.collect()}
    by_name = {r["event_rule_name"] for r in evs.values()}
    assert by_name == {"Error", " click ", "PURCHASE"}              # first of EV1/EV4 wins
    assert all(r["event_rule_id"] != "EV4" for r in evs.values())
    new = ev.new_definitions(a.genlog, defs).collect()
    assert sorted(r["event_rule_name"] for r in new) == ["signup", "view"]
    assert all(r["is_inner"] == "1" and r["is_use"] == "1" for r in new)
    e = a.events.where(F.col("proto") == "S").first()
    assert e["is_inner"] == "1" and e["opentime"] == 1704067200000


def test_documents_and_rejects(spark):
    lines = fx.EDGE_LINES + [f"id~2024-01-01 00:00:00~r~-~-~S~{payload(67)}"]
    a = analyze(lines_df(spark, lines), fx.log_rules_df(spark),
                asm.event_defs_system(fx.event_defs_df(spark), fx.event_fields_df(spark)))
    sys_docs = {d["recordid"]: d["ismatch"] for d in a.syslog_docs().collect()}
    # flag 0 for the match; a "~" inside the content shifts field 7 to content
    # text, which reads back as 0 ("matched") as stored by the original
    assert sys_docs["id"] == 0
    assert sys_docs["00000000000000000000000000000002"] == 0
    assert sys_docs["00000000000000000000000000000001"] == 1
    rej = {r["reason"] for r in a.rejects().collect()}
    assert rej == {"null_value", "bad_time", "too_few_fields"}
    assert a.rejects().count() + a.syslog_docs().count() == len(lines)
    gd = a.genlog_docs().first()
    assert gd["eventname2"] == "socos65socos72socos72socos6fsocos72"
    assert gd["eventname3"] == "CB5E100E5A9A3E7F6D1FD97512215282"
    assert set(a.genlog_docs().columns) == set(S.GENLOG_DOC_COLUMNS)


def test_matched_plus_unmatched_is_input(spark):
    from logsieve.plans.catalog import raw_from_events
    raw = raw_from_events(spark, "/root/testdata/sf0.001")
    m = mt.match_system(ps.parse(raw, key_col="src_key"), fx.log_rules_df(spark))
    n = raw.count()
    assert m.count() == n
    g = mt.to_genlog(m)
    timed = date_to_millis(F.col("recvtime")).isNotNull()
    assert 0 < g.count() == m.where(F.col("hit").isNotNull() & timed).count() < m.where(F.col("hit").isNotNull()).count()
    assert g.select("line_key").distinct().count() == g.count()   # at most one genlog per line


def test_rule_assembly_handmade(spark):
    regex = spark.createDataFrame([("R1", "L1", "a(b)"), ("R2", "L9", "c(d)"), (None, "L1", "e(f)")],
                                  "log_rule_id string, log_rule_lib_id string, log_regex string")
    for c in S.LOG_REGEX_COLUMNS:
        if c not in regex.columns:
            regex = regex.withColumn(c, F.lit(""))
    lib = spark.createDataFrame([("L1", "t", "v", "m"), ("L2", "t", "v", "x")], "log_rule_lib_id string, htyeid string, vendorid string, model string")
    ne = spark.createDataFrame([("N1", "t", "v", "m"), ("N2", "t", "v", "m")], "ne_id string, htypeid string, vendorid string, model string")
    ips = spark.createDataFrame([("N1", "1.1.1.1"), ("N1", "1.1.1.2"), ("N2", None)], "ne_id string, device_ip string")
    out = asm.assemble_log_rules(regex, lib, ne, ips)
    got = sorted((r["log_rule_id"], r["device_ip"]) for r in out.collect())
    assert got == [("R1", "1.1.1.1"), ("R1", "1.1.1.2")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RightOuter" not in plan and "LeftOuter" not in plan


def test_captures_one_pass_and_singly_agree(spark):
    """Rules whose regex cannot be wrapped (an open comment) and texts that hold the separator."""
    rules = [{"rule_seq": 0, "log_rule_id": "A", "device_ip": DEV, "log_regex": "(?x) user=(\\d+) \\s type=(\\w+)  # kind",
              "sourceip": "1", "eventname": "2"},
             {"rule_seq": 1, "log_rule_id": "B", "device_ip": DEV, "log_regex": r"^id=(\w+)(?:;|$)(x)?.*?to=(.)", "sourceip": "1", "destip": "2", "eventname": "3"}]
    msgs = ["user=5 type=click", "id=7;x to=\u0001!", "id=8;y to=z", "a\nid=9; to=q"]
    lines = [f"id{i}~2024-01-01 00:00:00~r~-~-~S~{payload(67, message=m)}" for i, m in enumerate(msgs)]
    m = mt.match_system(ps.parse(lines_df(spark, lines)), fx.log_rules_df(spark, rules))
    got = {r["orgid"]: (r["sourceip"], r["destip"], r["eventname"]) for r in mt.to_genlog(m).collect()}
    assert got == {"id0": ("5", " ", "click"), "id1": ("7", "x", "\u0001"), "id2": ("8", " ", "z")}


def test_user_rules_in_chunks(spark):
    lines = [f"id{i}~2024-01-01 00:00:00~r~-~-~S~user={i} type={t} value=1.5" for i, t in enumerate(["error", "purchase", "view"])]
    one, many = (mt.match_user(ps.parse(lines_df(spark, lines)), fx.user_rules_df(spark), chunk_bytes=b, index_max_bytes=0) for b in (1 << 20, 200))
    pick = lambda df: sorted((r["recordid"], r["hit"]["rule_id"] if r["hit"] else None) for r in df.collect())
    assert pick(one) == pick(many) == [("id0", "UR-0"), ("id1", "UR-1"), ("id2", None)]
    assert len(mt.pack_chunks(mt.usable_rules(fx.user_rules_df(spark), named_groups=True), 200)) > 1


def test_range_join_widths(spark):
    from logsieve.functions import ip_to_long
    from logsieve.operators.iprange import explode_ranges, range_join, section_rejects
    secs = [("a", "0.0.0.0-255.255.255.255"), ("b", "10.0.0.5-10.0.0.5"), ("c", "10.0.0.0-10.3.7.1"), ("d", "9.255.0.0-10.0.0.4"),
            ("bad", "x-1.1.1.1"), ("far", "1.1.1.1-2000000000.0.0.0"), ("back", "2.0.0.0-1.0.0.0")]
    s = spark.createDataFrame(secs, "section_name string, ip_section string")
    ips = ["10.0.0.4", "10.0.0.5", "10.3.7.1", "10.3.7.2", "255.255.255.255", "0.0.0.0", "junk", None]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(ips)], "id int, ip string")
    num = lambda x: sum(int(p) << 8 * (3 - i) for i, p in enumerate(x.split(".")))
    want = {(i, n) for i, x in enumerate(ips[:6]) for n, sec in secs[:4] if num(sec.split("-")[0]) <= num(x) <= num(sec.split("-")[1])}
    got = range_join(d, F.col("ip"), s).collect()
    assert {(r.id, r.section_name) for r in got} == want and len(got) == len(want)
    left = range_join(d, F.col("ip"), s, how="left").collect()
    assert {r.id for r in left if r.section_name is None} == {6, 7} and len(left) == len(want) + 2
    assert {r.section_name: r.reject_reason for r in section_rejects(s).collect()} == {
        "bad": "unreadable", "far": "out_of_range", "back": "backwards"}
    assert explode_ranges(s).groupBy("section_name").count().agg({"count": "max"}).first()[0] <= 513

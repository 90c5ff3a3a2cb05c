"""Scalar functions (F1-F14) on hand-made values."""

from pyspark.sql import functions as F

from logsieve.functions import (date_to_millis, date_to_seconds, escapes_to_string, ip_in_section,
                                ip_to_long, jsplit, jtrim, json_lower_keys, json_to_map, md5_upper,
                                millis_to_date, millis_to_date_compact,
                                regex_is_valid, regexscan, string_to_escapes)


def one(spark, expr, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_jtrim_and_split(spark):
    assert one(spark, jtrim(F.col("s")), "\t a b \n") == "a b"
    assert one(spark, F.size(jsplit(F.col("s"), "~")), "a~b~~") == 2
    assert one(spark, F.size(jsplit(F.col("s"), "~")), "~a~b") == 3
    assert one(spark, F.size(jsplit(F.col("s"), r"\|!")), "x|!y|!|!") == 2


def test_dates(spark):
    assert one(spark, date_to_millis(F.col("s")), "2024-01-01 00:00:07") == 1704067207000
    assert one(spark, date_to_millis(F.col("s")), "2024-01-01 00:00:07 trailing") == 1704067207000
    # fields out of range are carried over, as the original's lenient parser did
    for text, same in (("2024-13-01 00:00:00", "2025-01-01 00:00:00"), ("2024-02-30 00:00:00", "2024-03-01 00:00:00"),
                       ("2023-12-31 25:61:61", "2024-01-01 02:02:01"), ("2024-00-10 00:00:00", "2023-12-10 00:00:00")):
        assert one(spark, date_to_millis(F.col("s")), text) == one(spark, date_to_millis(F.col("s")), same) is not None
    assert one(spark, date_to_millis(F.col("s")), "not a time") is None
    assert one(spark, date_to_millis(F.col("s")), "   ") is None
    assert one(spark, date_to_millis(F.col("s")), None) is None
    assert one(spark, date_to_seconds(F.col("s")), "2024-01-01 00:00:07") == 1704067207
    assert one(spark, millis_to_date(F.col("s").cast("bigint")), "1704067207000") == "2024-01-01 00:00:07"
    assert one(spark, millis_to_date_compact(F.col("s").cast("bigint")), "1704067207000") == "2024-01-0100:00:07"
    # F2(F1(x)) = x
    assert one(spark, millis_to_date(date_to_millis(F.col("s"))), "1999-12-31 23:59:59") == "1999-12-31 23:59:59"


def test_md5_and_escapes(spark):
    assert one(spark, md5_upper(F.col("s")), "abc") == "900150983CD24FB0D6963F7D28E17F72"
    assert one(spark, string_to_escapes(F.col("s"), "socos"), "Ab") == "socos41socos62"
    assert one(spark, string_to_escapes(F.col("s")), "中") == "\\u4e2d"
    # outside the BMP: two UTF-16 units, as the JVM's chars
    assert one(spark, string_to_escapes(F.col("s")), "😀") == "\\ud83d\\ude00"
    assert one(spark, string_to_escapes(F.col("s")), "  ") is None
    assert one(spark, escapes_to_string(F.col("s")), "a\\u0041b\\u0042tail") == "aAbB"
    assert one(spark, escapes_to_string(F.col("s")), "\\ud83d\\ude00") == "😀"
    assert one(spark, escapes_to_string(F.col("s")), "no escape") == ""
    assert one(spark, escapes_to_string(F.col("s")), "cut\\u12") is None


def test_ip(spark):
    assert one(spark, ip_to_long(F.col("s")), "172.20.7.33") == 2886993697
    assert one(spark, ip_to_long(F.col("s")), " 1.2.3.4 ") == 16909060
    assert one(spark, ip_to_long(F.col("s")), "1.2.3") is None
    assert one(spark, ip_to_long(F.col("s")), "1.2.x.4") is None
    assert one(spark, ip_in_section(F.col("s"), F.lit("172.20.4.0-172.20.90.255")), "172.20.7.33") is True
    assert one(spark, ip_in_section(F.col("s"), F.lit("172.20.4.0-172.20.90.255")), "172.20.4.0") is True
    assert one(spark, ip_in_section(F.col("s"), F.lit("172.20.4.0-172.20.90.255")), "172.21.0.0") is False
    assert one(spark, ip_in_section(F.col("s"), F.lit("172.20.4.0")), "172.20.4.0") is None


def test_ip_monotone(spark):
    ips = [f"{a}.{b}.{c}.{d}" for a, b, c, d in [(1, 2, 3, 4), (1, 2, 3, 5), (1, 2, 4, 0), (1, 3, 0, 0), (2, 0, 0, 0)]]
    vals = [r["n"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(ips)], "i int, s string")
            .orderBy("i").select(ip_to_long(F.col("s")).alias("n")).collect()]
    assert vals == sorted(vals) and len(set(vals)) == len(vals)


def test_json(spark):
    m = one(spark, json_to_map(F.col("s")), '{"k": 69, "o": {"a": 1}, "n": null}')
    assert m["k"] == "69" and m["o"] == '{"a":1}' and m["n"] is None
    low = one(spark, json_lower_keys(F.col("s")), '{"K": 1, "k": 2, "Type": "x"}')
    assert low["k"] == '[1,2]' and low["type"] == "x"


def test_regex_helpers(spark):
    assert one(spark, regexscan.group_count(regexscan.scan("s")), r"a(b)(?:c)(?<n>d)\(e[(]") == 2
    assert one(spark, regexscan.group_count(regexscan.scan("s")), r"(?<=x)y") == 0
    assert one(spark, regex_is_valid(F.col("s")), "(") is False
    assert one(spark, regex_is_valid(F.col("s")), "a(b)") is True
    assert one(spark, regexscan.group_index(regexscan.scan("s"), "eventName"), r"(\d+) (?<sourceIp>x)(?<eventName>y)") == 3
    assert one(spark, regexscan.group_index(regexscan.scan("s"), "url"), r"(?<sourceIp>x)") is None


def test_nested_map_goes_by_type(spark):
    from logsieve.functions import json_to_nested_map
    row = spark.createDataFrame([(r'{"a":"{\"x\":1}","b":{"x":1,"y":"z"},"c":[1,{"d":2}],"e":null,"f":1.5}',)], "s string") \
        .select(json_to_nested_map(F.col("s")).alias("m")).first().m
    assert row["a"].text == '{"x":1}' and row["a"].fields is None
    assert row["b"].fields == {"x": "1", "y": "z"} and row["b"].text == '{"x":1,"y":"z"}'
    assert row["c"].text == '[1,{"d":2}]' and row["c"].fields is None
    assert row["e"].text is None and row["e"].fields is None and row["f"].text == "1.5"


def test_escapes_of_any_number_of_units(spark):
    """Units with any number of leading zeros, and texts that don't fill the last group of units."""
    from logsieve.functions import string_to_escapes
    chars = "a\u0000\u0007\u0100\u0fff\u1000\uffff\u00ff\U0001f600 \\$0"
    texts = [(chars * 4)[i : i + n] for n in range(1, 20) for i in range(12)]
    units = lambda t: [int.from_bytes(t.encode("utf-16-be")[i : i + 2], "big") for i in range(0, len(t.encode("utf-16-be")), 2)]
    texts = [t for t in texts if t.strip("".join(map(chr, range(33))))]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in d.select("t", string_to_escapes(F.col("t")).alias("a"), string_to_escapes(F.col("t"), prefix="socos").alias("b"),
                      string_to_escapes(F.col("t"), pad=True).alias("c")).collect():
        assert (r.a, r.b, r.c) == tuple("".join(f % u for u in units(r.t)) for f in ("\\u%x", "socos%x", "\\u%04x")), r.t


def test_escapes_are_evaluated_once(spark):
    from logsieve.plans.catalog import q_unicode_codec
    plan = q_unicode_codec(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 2

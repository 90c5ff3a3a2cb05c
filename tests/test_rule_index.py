"""The regex scanner against the JVM's own reading, and the rule index against testing every rule."""

import random

from pyspark.sql import functions as F

from logsieve import schema as S
from logsieve.functions import regexscan
from logsieve.operators import match as mt
from logsieve.operators import parse as ps

# Patterns whose parentheses are easily miscounted.
PATTERNS = [
    r"[](]user=(\d+)", r"[^](]u(x)", r"[[a](]x(\d+)", r"[a&&[^(]](b)", r"[a[b[(]]c](d)", r"[\](](a)", r"[\Q]\E(](a)", r"\Qf(x)\E (a)", r"\Qopen (",
    r"\\Q(a)\E", "(?x) a # (no)\n (b)", "(?x) [ ](] (c)", "(?x)[#(]\n(](a)", "(?x:#(\n(a))#(b)", "((?x) a#(b)\n)#(c)", "(?x)(?-x)#(a)", "(?x-i) # (a\n(b)",
    r"(?<n>a)(?<=b)(?<!c)(?:d)(?>e)(?=f)(?!g)(h)", r"\c((a)", r"\p{L}(a)\P{Lu}\pL(b)", r"(a)\1(?<b>c)\k<b>", r"\x{28}(a)\x28(b)(\050)", r"a{2}(b){0,3}(c)?",
    "(?s-x:(a))", "\\#(a)", "(?x)\\#(a)", "a|(b)|c", "( ?a)", "(?x)( ?:a)(b)", "\ue003(a)", "\U0001f600(b)[\U0001f600(]", "", "a]b(c)", "[a-]](b)", "[-(](b)",
]


def _random(rng, depth=0):
    """A pattern that compiles."""
    atoms = ["a", "b", "cd", " ", r"\d", ".", "[ab]", r"\(", r"[)(]", "[]x(]", r"\Q(x\E", "=", "-", "é", r"\.", r"\n"]
    out = ""
    for _ in range(rng.randrange(1, 5)):
        kind = rng.random()
        if kind < 0.6 or depth > 3:
            out += rng.choice(atoms) if rng.random() < 0.5 else rng.choice(["user=", " type=", "ab", "x"])
        else:
            out += rng.choice(["(", "(?:", "(?=", "(?!", "(?>", "(?<=a)(", "(?s:"]) + _random(rng, depth + 1)
            if rng.random() < 0.3:
                out += "|" + _random(rng, depth + 1)
            out += ")"
        if rng.random() < 0.25 and not out.endswith("|"):
            out += rng.choice(["?", "*", "+", "+?", "*+", "{2}", "{0,1}"])
    return out


def _scanned(spark, patterns):
    s = F.col("s")
    df = spark.createDataFrame([(p,) for p in patterns], "r string").select("r", regexscan.scan("r").alias("s"))
    return df.select("r", regexscan.group_count(s).alias("n"), regexscan.literals(s).alias("l"), regexscan.closing(s).alias("c")).collect()


def test_groups_and_literals_as_the_jvm_reads_them(spark):
    rng = random.Random(17)
    java = spark._jvm.java.util.regex.Pattern
    patterns = {}
    for p in PATTERNS + [_random(rng) for _ in range(400)]:
        try:
            patterns[p] = java.compile(p)
        except Exception:  # noqa: BLE001
            continue
    assert len(patterns) > 300
    texts = ["".join(rng.choice(["user=", " type=", "a", "b", "cd", "x", " ", "(", ")", "1", ".", "é", "]"]) for _ in range(rng.randrange(8))) for _ in range(60)]
    held = 0
    for r in _scanned(spark, list(patterns)):
        assert r.n == patterns[r.r].matcher("").groupCount(), r.r
        java.compile("(?:" + r.r + r.c + ")()")   # more can be put behind it
        if r.l:
            for t in texts:
                if patterns[r.r].matcher(t).find():
                    held += 1
                    assert all(x in t for x in r.l), (r.r, t, r.l)
    assert held > 500


def test_literals(spark):
    want = {r"user=(\d+) type=(\w+)": ["user=", " type="], r"user=(12) type": ["user=12 type"], r"abc?d": ["ab", "d"], r"ab+c": ["ab", "c"],
            r"a|b": [], r"x(?:a|b)y": ["x", "y"], r"x(ab)?y": ["x", "y"], r"x(?=zz)y(?!q)": ["x", "y"], r"(?i)abc": [], r"\Qa.b\E\.c": ["a.b.c"],
            r"a\x41b": [], r"(?x) ab c # d": ["abc"], r"(ab(cd(ef)))": ["abcdef"], r"(ab)+c": ["ab", "c"],
            r"x(?:=(?:a|b)ab)?": ["x"], r"x(=(a)+ab)?y": ["x", "y"], r"x((ab)?)+y": ["x", "y"]}
    assert {r.r: r.l for r in _scanned(spark, want)} == want


def _table(spark, rules):
    ddl = ", ".join(f"`{c}` string" for c in S.LOG_RULE_COLUMNS) + ", rule_seq bigint"
    return spark.createDataFrame([(*[r.get(c, "") for c in S.LOG_RULE_COLUMNS], r["rule_seq"]) for r in rules], ddl)


def _lines(rng, n):
    vocab = ["user=1", "user=12", "type=a", "(x)", "err", "disk full", "é", "99", "-"]
    for i in range(n):
        message = " ".join(rng.choice(vocab) for _ in range(rng.randrange(6)))
        parts = ["x"] * 66 + [message]
        parts[29] = f"10.0.0.{rng.randrange(4)}"
        yield f"id{i}~2024-01-01 00:00:00~r~-~-~S~{'|!'.join(parts)}"


def test_index_finds_what_testing_every_rule_finds(spark):
    rng = random.Random(23)
    bodies = [r"user=(\d+)", r"(disk) full", r"type=(\w)", r"(.)", r"(99|err)", r"user=(1) type", r"\((x)\)", r"[](](x)", r"(é) ", "(?x) err (\\ ) #c", "(?i)DISK (f)"]
    rules = [{"rule_seq": i, "log_rule_id": f"R{i}", "device_ip": f"10.0.0.{rng.randrange(3)}", "log_regex": rng.choice(bodies) + rng.choice(["", "", " ?", r"\b"]),
              "sourceip": "1", "eventname": rng.choice(["", "1"])} for i in range(60)]
    rules.sort(key=lambda r: -r["rule_seq"])
    table = _table(spark, rules)
    parsed = ps.parse(spark.createDataFrame([(v,) for v in _lines(rng, 300)], "value string")).persist()
    pick = lambda m: sorted((r["recordid"], r["match_status"], r["hit"]["rule_id"] if r["hit"] else None) for r in m.collect())
    by_index, by_table = mt.match_system(parsed, table), mt.match_system(parsed, table, index_max_bytes=0)
    found = pick(by_index)
    assert found == pick(by_table) and len({r for _, _, r in found}) > 5
    named = [{**r, "log_regex": r["log_regex"].replace("(", "(?<eventName>", 1) if r["log_regex"].startswith(("user", "type", "(d")) else r["log_regex"]} for r in rules]
    table = _table(spark, named)
    by_index, by_table = mt.match_user(parsed, table), mt.match_user(parsed, table, index_max_bytes=0)
    assert pick(by_index) == pick(by_table)
    rows = lambda m: sorted(map(tuple, mt.to_genlog(m, user_rules=True).collect()))
    assert rows(by_index) == rows(by_table)


def test_a_miscounted_group_fails_no_query(spark):
    """Were the scanner wrong, a group number beyond the regex's groups would still be read as no capture."""
    rules = mt.prepare_rules(_table(spark, [{"rule_seq": 0, "log_rule_id": "R", "device_ip": "10.0.0.1", "log_regex": r"user=(\d+)", "sourceip": "1"}]))
    hit = rules.select(F.struct("regex", F.lit(")()()").alias("tail"), F.lit("$1\u0001$3").alias("template")).alias("hit"))
    assert hit.select(F.regexp_replace(F.lit("a user=7 b"), mt._wrapped(), F.col("hit.template")).alias("x")).first().x == "7\u0001"


def test_no_line_meets_a_rule_without_its_gram(spark):
    rules = [{"rule_seq": i, "log_rule_id": f"R{i}", "device_ip": "10.0.0.1", "log_regex": f"user=(\\d+) code=({i:05})", "sourceip": "1"} for i in range(500)]
    from logsieve.operators.ruleindex import rule_index
    index = rule_index(mt.usable_rules(_table(spark, rules)), mt._rule_struct_fields())
    texts = spark.createDataFrame([("user=1 code=00017",), ("user=1 code=99999",), ("nothing",)], "t string")
    sizes = [r.n for r in texts.select(F.size(index.candidates(F.lit("10.0.0.1"), F.col("t"))).alias("n")).collect()]
    assert 1 <= sizes[0] <= 30 and sizes[1] <= 30 and sizes[2] <= 3  # of 500


def test_later_rules_of_the_same_regex_take_no_room(spark):
    """3,000 rules of 30 regexes are as large as 30 rules, and each line's rule is the first of its regex."""
    from logsieve.operators.ruleindex import first_of_regex, rule_index
    rules = [{"rule_seq": 5000 - i, "log_rule_id": f"R{i}", "device_ip": "10.0.0.1", "log_regex": f"user=({i % 30});", "sourceip": "1"} for i in range(3000)]
    ok = first_of_regex(mt.usable_rules(_table(spark, rules)), mt._rule_struct_fields())
    index = rule_index(ok, mt._rule_struct_fields(), 30_000)
    assert index is not None and ok.count() == 30
    texts = spark.createDataFrame([("user=7;",), ("user=77;",)], "t string")
    assert [r[0] for r in texts.select(index.first_hit(F.lit("10.0.0.1"), F.col("t"))["rule_id"]).collect()] == ["R2977", None]


def test_rules_joined_by_gram_find_what_testing_every_rule_finds(spark):
    rng = random.Random(29)
    bodies = [r"user=(?<eventName>\d+)", r"(?<eventName>disk) full", r"type=(?<eventName>\w)", r"(?<eventName>99|err)", r"(?<eventName>é) ", r"(?i)DISK (?<eventName>f)"]
    rules = [{"rule_seq": i, "log_rule_id": f"R{i}", "log_regex": rng.choice(bodies) + rng.choice(["", " ?", r"\b", " user=1 type=a", " disk full"])} for i in range(80)]
    rules.sort(key=lambda r: -r["rule_seq"])
    table = _table(spark, rules)
    lines = list(_lines(rng, 300)) + ["id1~2024-01-01 00:00:00~r~-~-~S~heartbeat"] * 5 + [None, "a~b"]
    parsed = ps.parse(spark.createDataFrame([(v,) for v in lines], "value string")).persist()
    pick = lambda m: sorted((str(r["recordid"]), r["match_status"], r["hit"]["rule_id"] if r["hit"] else None) for r in m.collect())
    every = pick(mt.match_user(parsed, table, index_max_bytes=0))
    joined = mt.match_user(parsed, table, index_max_bytes=0, chunk_bytes=1)
    # the rules are one side of a join, not values beside each line
    assert "Subquery" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert pick(joined) == every and len({r for _, _, r in every}) > 4


def test_a_line_looks_up_few_of_its_grams(spark):
    """Those that begin as a listed one does; every gram that is listed is found, beyond Latin-1 too."""
    from logsieve.operators import ruleindex as ri
    rng = random.Random(31)
    for n in (4, 8):
        for alphabet in ("ab=-1", "user=0129 |!x.é", "ab€漢\U0001f600^]\\-["):
            grams = {"".join(rng.choice(alphabet) for _ in range(n)) for _ in range(30)}
            follow = ri._follow(grams)
            texts = ["".join(rng.choice([*alphabet, *grams]) for _ in range(20)) for _ in range(20)]
            df = spark.createDataFrame([(t,) for t in texts], "t string")
            found = df.select("t", F.regexp_extract_all("t", F.lit(ri.beginning(follow)), F.lit(1)).alias("g")).collect()
            assert all({g for g in grams if g in r.t} <= set(r.g) and all(len(g) == n for g in r.g) for r in found)
            assert ri._follow_of(spark.createDataFrame([(g,) for g in grams], "g string")) == follow
    rules = [{"rule_seq": i, "log_rule_id": f"R{i}", "device_ip": "10.0.0.1", "log_regex": f"user=({i:04}) type"} for i in range(500)]
    index = ri.rule_index(mt.usable_rules(_table(spark, rules)), mt._rule_struct_fields())
    line = "x|!" * 29 + "10.0.0.1" + "x|!" * 37 + "user=0123 type=a"
    looked_up = spark.range(1).select(F.regexp_extract_all(F.lit(line), F.lit(index.grams), F.lit(1))).first()[0]
    assert 1 <= len(looked_up) < 20 and len(line) > 200


def test_rules_are_scanned_once_and_in_several_tasks(spark):
    """Of 400 rules of 40 regexes 40 are scanned, though they come as one partition; refused rules stay refused."""
    rules = [{"rule_seq": 900 - i, "log_rule_id": f"R{i}", "device_ip": " 10.0.0.1", "log_regex": f"user=({i % 40}) " + "(" * (i % 40 == 3), "sourceip": "19"[i % 80 == 7]}
             for i in range(400)]
    table = _table(spark, rules).coalesce(1)
    alike = mt._first_alike(table, named_groups=True)
    assert alike.count() == 40 and alike.rdd.getNumPartitions() > 1
    ids = lambda t, named: {r.rule_id for r in mt.usable_rules(t, named).collect()}
    assert ids(alike, True) == {f"R{i}" for i in range(360, 400) if i % 40 != 3}
    # a rule that is refused for its group number leaves the next one of its regex
    alike = mt._first_alike(table)
    assert alike.count() == 41 and ids(alike, False) == {f"R{i}" for i in range(360, 400) if i % 40 != 3}

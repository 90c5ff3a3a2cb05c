"""First-match regex join of raw logs against log rules (J3, J4, J8, PRJ3, PRJ4, AGG4).

Plan shape: the usable rules are listed by a required gram of their regex (`ruleindex`), as constants of the plan. A
line looks its own grams up and meets only the rules that it can match, which an `aggregate` tests in rule order,
stopping at the first hit: there is no join, the logs stay where they are, and the work per line doesn't grow with the
rules. Of the rules of a device with the same regex only the first is kept: no line gets to the others. Rule sets too
large for a constant are joined by gram (`ruleindex.join_by_gram`): a rule stands in the table once, and a line meets
those whose gram it holds.
All captures come from one pass of the chosen regex: a `regexp_replace` whose template lists the rule's groups. No
Python runs per row; the logs are never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schema as S
from ..functions import date_to_millis, is_blank, jtrim, regex_is_valid, regexscan
from .joins import MAX_BROADCAST_BYTES, config_bytes
from .parse import derived_id, once
from .ruleindex import MAX_INDEX_BYTES, first_of_regex, join_by_gram, rule_index

# Bytes of user rules (as JSON text) that go into one array, all of which a line tests; more are joined by gram.
MAX_RULE_CHUNK_BYTES = 8 << 20
# Stands between captures while they are one text.
_CAPTURE_SEP = "\u0001"
# The device of user rules, which apply to all lines, and what stands for a line's when it has none.
_ALL_DEVICES, _NO_DEVICE = "", "\u0001"

# Rule constants carried into the genlog record.
_CONSTANTS = ["reportnetype", "eventdefid", "eventlevel", "eventid"]
_PORT_FIELDS = {"sourceport", "destport"}


def _group_number(c: Column) -> Column:
    return F.when(is_blank(c), F.lit(None).cast("int")).otherwise(jtrim(c).try_cast("int"))


def prepare_rules(rules: DataFrame, named_groups: bool = False) -> DataFrame:
    """Validate log rules and resolve their capture groups to numbers.

    Adds `reject_reason` (null for a usable rule): bad_regex (does not
    compile), no_group (a regex without a group never matches), bad_group
    (a group number that is not a number or exceeds the group count).
    With `named_groups`, group numbers come from the names in the regex
    (PRJ4); an unknown name gives no capture.
    """
    # The pattern is scanned once: behind `once`, the many uses of the scan below (and a filter on the
    # reason, pushed down with them inlined) don't repeat it.
    base = rules.select("*", jtrim(F.col("log_regex")).alias("_regex"))
    base = once(base, [F.col(c) for c in base.columns], [regexscan.scan("_regex").alias("_scan"), regex_is_valid(F.col("_regex")).alias("_valid")])
    base = once(base, [F.col(c) for c in base.columns], [regexscan.literals(F.col("_scan")).alias("_runs")])
    regex, scanned = F.col("_regex"), F.col("_scan")
    n_groups = F.coalesce(regexscan.group_count(scanned), F.lit(0))
    if named_groups:
        groups = {f: regexscan.group_index(scanned, S.USER_GROUP_NAMES[f]) for f in S.CAPTURE_FIELDS}
        bad = F.lit(False)
    else:
        groups = {f: _group_number(F.col(f)) for f in S.CAPTURE_FIELDS}
        # One comparison with the group count for all twelve numbers.
        not_number = F.lit(False)
        for f in S.CAPTURE_FIELDS:
            not_number = not_number | (~is_blank(F.col(f)) & groups[f].isNull())
        numbers = list(groups.values())
        bad = not_number | (F.greatest(*numbers) > n_groups) | (F.least(*numbers) < 0)
    reason = (F.when(F.col("log_regex").isNull() | ~F.col("_valid"), F.lit("bad_regex"))
              .when(n_groups == 0, F.lit("no_group"))
              .when(bad, F.lit("bad_group")))
    template = F.concat_ws(_CAPTURE_SEP, *[F.when(groups[f].isNull(), F.lit(""))
                                           .otherwise(F.concat(F.lit("$"), groups[f].cast("string"))) for f in S.CAPTURE_FIELDS])
    runs = F.col("_runs")
    longest = F.aggregate(runs, F.lit(""), lambda a, r: F.when(F.length(r) > F.length(a), r).otherwise(a))
    cols = [
        F.col("rule_seq").cast("bigint").alias("rule_seq"),
        jtrim(F.col("log_rule_id")).alias("rule_id"),
        regex.alias("regex"),
        # what ends a quote or comment left open, then a group for every number that the rule may name
        F.concat(regexscan.closing(scanned), F.lit(")"), F.repeat(F.lit("()"), n_groups)).alias("tail"),
        template.alias("template"),
        F.coalesce(longest, F.lit("")).alias("literal"),
        F.coalesce(runs, F.array().cast("array<string>")).alias("runs"),
        *[g.alias("g_" + f) for f, g in groups.items()],
        *[F.col(c).alias("c_" + c) for c in _CONSTANTS],
    ]
    cols.append((F.lit(_ALL_DEVICES) if named_groups else jtrim(F.col("device_ip"))).alias("device_key"))
    return base.select(*cols, reason.alias("reject_reason"))


def rule_rejects(rules: DataFrame, named_groups: bool = False) -> DataFrame:
    """Rules that were refused on load, with the reason."""
    return prepare_rules(rules, named_groups).where(F.col("reject_reason").isNotNull()) \
        .select("rule_seq", "rule_id", "regex", "reject_reason")


def _rule_struct_fields() -> list[str]:
    return ["rule_seq", "rule_id", "regex", "tail", "template", "literal", "device_key", *["g_" + f for f in S.CAPTURE_FIELDS],
            *["c_" + c for c in _CONSTANTS]]


def usable_rules(rules: DataFrame, named_groups: bool = False) -> DataFrame:
    return prepare_rules(rules, named_groups).where(F.col("reject_reason").isNull() & F.col("device_key").isNotNull())


def _first_alike(rules: DataFrame, named_groups: bool = False) -> DataFrame:
    """Of the rules that differ in their number, id and constants only the first in rule order: the others match the same
    texts later, or are refused with it. The rules are spread over the tasks that then scan them."""
    order = [F.col("rule_seq").cast("bigint").alias("rule_seq"), jtrim(F.col("log_rule_id")).alias("log_rule_id")]
    same = {"log_regex": jtrim(F.col("log_regex"))}
    if not named_groups:
        same |= {"device_ip": jtrim(F.col("device_ip"))} | {f: F.col(f) for f in S.CAPTURE_FIELDS}
    alike = rules.select(*[c.alias(f) for f, c in same.items()], F.struct(*order, *_CONSTANTS).alias("r"))
    return (alike.repartition(rules.sparkSession.sparkContext.defaultParallelism, *same)
            .groupBy(*same).agg(F.min("r").alias("r")).select(*same, "r.*"))


def pack_chunks(ok: DataFrame, chunk_bytes: int = MAX_RULE_CHUNK_BYTES) -> list[DataFrame]:
    """User rules: every usable rule applies to every log. One-row tables, each with a sorted
    array of about chunk_bytes of rules at most, in rule order."""
    n = max(1, -(-config_bytes(ok) // chunk_bytes))
    if n > 1:
        ok = ok.withColumn("_chunk", F.ntile(n).over(Window.orderBy("rule_seq", "rule_id")))
    else:
        ok = ok.withColumn("_chunk", F.lit(1))
    return [ok.where(F.col("_chunk") == i + 1)
            .agg(F.sort_array(F.collect_list(F.struct(*_rule_struct_fields()))).alias("rules")) for i in range(n)]


def _first_hit(packed: DataFrame, text: Column, rules: str = "rules") -> Column:
    """AGG4: the first rule (array order) whose regex finds a match; later rules are not tested."""
    rule_type = packed.schema["rules"].dataType.elementType

    def step(acc, r):
        return F.when(acc.isNotNull(), acc).when(F.contains(text, r["literal"]) & F.rlike(text, r["regex"]), r)
    return F.aggregate(F.col(rules), F.lit(None).cast(rule_type), step)


def _indexed(parsed: DataFrame, index, device: Column, text: Column) -> DataFrame:
    """parsed with `hit`, the first of the index's rules that matches, or null."""
    hit = index.first_hit(device, text)
    return once(parsed, [F.col(c) for c in parsed.columns], [F.when(F.col("n_fields") > 6, hit).alias("hit")])


def match_system(parsed: DataFrame, rules: DataFrame, broadcast_max_bytes: int = MAX_BROADCAST_BYTES,
                 index_max_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """J3 + J8: attach `hit` (the first matching system rule, or null) to each parsed line.

    Lines with six or fewer fields, no device IP in the payload or no rule
    for their device get a null hit. `match_status` tells which.
    """
    ok = first_of_regex(usable_rules(_first_alike(rules)), _rule_struct_fields())
    index = rule_index(ok, _rule_struct_fields(), index_max_bytes)
    device = F.coalesce(F.col("device_ip"), F.lit(_NO_DEVICE))
    if index is not None:
        joined = _indexed(parsed, index, device, F.col("msg"))
        known = index.has_rules(device)
    else:
        joined = join_by_gram(parsed, ok, _rule_struct_fields(), device, F.col("msg"), F.col("n_fields") > 6, broadcast_max_bytes)
        known = F.col("_known")
    status = (F.when(F.col("value").isNull(), F.lit("null_value"))
              .when(F.col("n_fields") <= 6, F.lit("too_few_fields"))
              .when(F.col("hit").isNotNull(), F.lit("matched"))
              .when(F.col("device_ip").isNull(), F.lit("short_payload"))
              .when(F.col("msg").isNull() & known, F.lit("short_payload"))
              .otherwise(F.lit("no_rule")))
    return joined.withColumn("match_status", status).drop("_known")


def match_user(parsed: DataFrame, user_rules: DataFrame, chunk_bytes: int = MAX_RULE_CHUNK_BYTES,
               index_max_bytes: int = MAX_INDEX_BYTES, broadcast_max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The first matching user rule, tested against the whole raw content
    (field 6, untrimmed), with no device filter."""
    ok = first_of_regex(usable_rules(_first_alike(user_rules, named_groups=True), named_groups=True), _rule_struct_fields())
    index = rule_index(ok, _rule_struct_fields(), index_max_bytes)
    if index is not None:
        joined = _indexed(parsed, index, F.lit(_ALL_DEVICES), F.col("logcontent"))
    elif chunk_bytes > index_max_bytes and config_bytes(ok) <= chunk_bytes:
        # One value: no join, and the logs stay in place.
        rules = pack_chunks(ok, chunk_bytes)[0]
        with_rules = parsed.select("*", rules.scalar().alias("_rules"))
        hit = F.when(F.col("n_fields") > 6, _first_hit(rules, F.col("logcontent"), "_rules"))
        joined = once(with_rules, [F.col(c) for c in parsed.columns], [hit.alias("hit")])
    else:
        joined = join_by_gram(parsed, ok, _rule_struct_fields(), F.lit(_ALL_DEVICES), F.col("logcontent"),
                              F.col("n_fields") > 6, broadcast_max_bytes).drop("_known")
    status = (F.when(F.col("value").isNull(), F.lit("null_value"))
              .when(F.col("n_fields") <= 6, F.lit("too_few_fields"))
              .when(F.col("hit").isNotNull(), F.lit("matched"))
              .otherwise(F.lit("no_rule")))
    return joined.withColumn("match_status", status)


def _wrapped() -> Column:
    """The hit rule's regex with the whole text around its first match. A group number is never out of range in it."""
    h = F.col("hit")
    return F.concat(F.lit(r"^[\s\S]*?(?:"), h["regex"], h["tail"], F.lit(r"[\s\S]*$"))


def _captures(text: Column) -> Column:
    """All captures of the hit rule in one pass, in the order of CAPTURE_FIELDS (null: take them singly)."""
    one_pass = F.split(F.regexp_replace(text, F.col("_wrapped"), F.col("hit")["template"]), _CAPTURE_SEP)
    return F.when(~F.contains(text, F.lit(_CAPTURE_SEP)), one_pass)


def _capture(text: Column, field: str) -> Column:
    g = F.col("hit")["g_" + field]
    raw = (F.when(F.col("_captures").isNotNull(), F.get(F.col("_captures"), S.CAPTURE_FIELDS.index(field)))
           .otherwise(F.call_function("regexp_extract", text, F.col("_wrapped"), g)))
    kept = F.replace(raw, F.lit(":"), F.lit("")) if field in _PORT_FIELDS else raw
    # A blank group number, or a group that took no part or is empty, gives " ".
    return F.when(g.isNull() | raw.isNull() | (raw == ""), F.lit(" ")).otherwise(kept)


def to_genlog(matched: DataFrame, user_rules: bool = False, tz: str = "UTC") -> DataFrame:
    """PRJ3: one GENLOG record per matched line (24 fields + the receive-time text).

    `firstrecvtime` is typed epoch milliseconds in both paths (system rules
    stored the text, user rules the number; both read back as milliseconds).
    A line whose receive time cannot be read has no record, and so no event
    either: it is one of the rejects.
    """
    h = F.col("hit")
    text = F.col("logcontent") if user_rules else F.col("msg")
    gid = derived_id("genlog")
    level = h["c_eventlevel"]
    cols = {
        "row": gid,
        "recordid": gid,
        "firstrecvtime": date_to_millis(F.col("recvtime"), tz),
        "reportapp": F.col("reportapp"),
        "reportip": F.col("reportip"),
        **{f: _capture(text, f) for f in S.CAPTURE_FIELDS},
        "reportnetype": F.coalesce(h["c_reportnetype"], F.lit(" ")),
        "eventdefid": F.coalesce(F.replace(h["c_eventdefid"], F.lit("-"), F.lit("")), F.lit(" ")),
        "eventlevel": F.when(level.isNull() | (level == ""), F.lit("1")).otherwise(level),
        "orgid": F.col("recordid"),
        "eventid": F.coalesce(h["c_eventid"], F.lit(" ")),
        "orglog": text,
        "logruleid": h["rule_id"],
    }
    hits = matched.where(h.isNotNull())
    hits = once(hits, [F.col(c) for c in hits.columns], [_wrapped().alias("_wrapped")])
    hits = once(hits, [F.col(c) for c in hits.columns], [_captures(text).alias("_captures")])
    records = once(hits, [F.col("recvtime"), F.col("line_key")], [cols[f].alias(f) for f in S.GENLOG_FIELDS])
    return records.where(F.col("firstrecvtime").isNotNull())

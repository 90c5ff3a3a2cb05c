"""A gram index over rule regexes: which rules a text can match at all.

From each regex the literal stretches that every match must hold are taken (`regexscan.literals`), and of their
GRAM-character substrings the one that fewest rules of the same device have. Rules are listed under a hash of device
and gram in an array of slots, so a text looks up its own grams and meets only rules whose gram it holds; a rule
without a literal is listed under its device alone and met by all its texts. Of a text's grams only those are looked up
that have, after the first character of some listed gram, characters such as listed grams have there: one regex finds
them (`beginning`), where hashing every gram took most of a line's time. The few candidates are then tested in
rule order, so the first match is the one that testing every rule would give, and the work per text does not grow
with the rules. A device with FEW rules at most has them all tested: that costs less than a text's grams.

Slots and rules are configuration: at most MAX_INDEX_BYTES, checked, become constants of the plan. A constant stands
in it once and is read in place, where an array column would be copied beside every line. Larger rule sets are tables,
which texts join by device and gram (`join_by_gram`).
"""

from __future__ import annotations

import json
import time
import zlib
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .joins import CHECK_TTL_SECONDS, MAX_BROADCAST_BYTES, checked_broadcast
from .parse import once

GRAM = 4
FEW = 16
# Bytes of rules (as JSON text) that may become a constant; more are matched from a joined table.
MAX_INDEX_BYTES = 8 << 20
_SEP = "\u0002"
# Joined rules go by a longer gram where they have one: of many rules, too many share one of GRAM characters.
LONG_GRAM = 8
# Buckets in which the grams of joined rules are counted.
_GRAM_BUCKETS = 1 << 16
# Stands for the characters beyond Latin-1, which aren't told apart in looking for grams.
_OTHER = 256
# Kinds of grams looked for one by one; more are looked for as one.
_MAX_KINDS = 16


def _class(codes) -> str:
    return "[" + "".join("\\x{100}-\\x{10FFFF}" if c == _OTHER else "\\x{%x}" % c for c in sorted(codes)) + "]"


def beginning(follow: dict[int, tuple[frozenset, ...]]) -> str:
    """A regex that finds, as group 1 at every place, all texts that `follow` allows: by first character, the characters
    that may stand in each place after it (as codes; _OTHER: any beyond Latin-1)."""
    kinds: dict = {}
    for first, rest in follow.items():
        kinds.setdefault(rest, set()).add(first)
    if len(kinds) > _MAX_KINDS:
        kinds = {tuple(frozenset().union(*at) for at in zip(*kinds)): set(follow)}
    each = "|".join(_class(firsts) + "".join(map(_class, rest)) for rest, firsts in kinds.items())
    return f"(?={_class(follow)})(?=({each}))" if follow else "(?!)()"


def _follow(grams) -> dict[int, tuple[frozenset, ...]]:
    seen: dict = {}
    for g in grams:
        first, *rest = [min(ord(c), _OTHER) for c in g]
        for at, c in zip(seen.setdefault(first, [set() for _ in rest]), rest):
            at.add(c)
    return {first: tuple(map(frozenset, rest)) for first, rest in seen.items()}


@dataclass
class RuleIndex:
    """Rules in rule order, the slots that list them, and the devices that have some."""
    rules: str          # JSON array of rule structs
    schema: StructType  # of one rule
    slots: str          # JSON array of arrays of positions
    n_slots: int
    devices: str        # JSON array of arrays of device keys, by hash
    n_devices: int
    grams: str          # regex of the grams that may be listed; "": none is (no device has more than FEW rules)

    def _slot(self, device: Column, gram: Column, n: int) -> Column:
        key = F.concat(device, F.lit(_SEP), gram).cast("binary")
        return (F.crc32(key) % F.lit(n)).cast("int")

    def candidates(self, device: Column, text: Column) -> Column:
        """The rules to test, in rule order."""
        slots = F.from_json(F.lit(self.slots), "array<array<int>>")
        rules = F.from_json(F.lit(self.rules), f"array<{self.schema.simpleString()}>")
        grams = F.array(F.lit(""))
        if self.grams:
            grams = F.concat(grams, F.regexp_extract_all(text, F.lit(self.grams), F.lit(1)))
        found = F.transform(grams, lambda g: F.get(slots, self._slot(device, g, self.n_slots)))
        at = F.array_sort(F.array_distinct(F.flatten(F.filter(found, lambda x: F.size(x) > 0))))
        return F.transform(at, lambda p: F.get(rules, p))

    def first_hit(self, device: Column, text: Column) -> Column:
        """AGG4: the first rule, in rule order, that is the device's and finds a match; later ones are not tested."""
        def step(acc, r):
            return F.when(acc.isNotNull(), acc).when(
                (r["device_key"] == device) & F.contains(text, r["literal"]) & F.rlike(text, r["regex"]), r)
        return F.aggregate(self.candidates(device, text), F.lit(None).cast(self.schema), step)

    def has_rules(self, device: Column) -> Column:
        names = F.get(F.from_json(F.lit(self.devices), "array<array<string>>"), self._slot(device, F.lit(""), self.n_devices))
        return F.coalesce(F.array_contains(names, device), F.lit(False))


def _hash(device: str, gram: str) -> int:
    return zlib.crc32(f"{device}{_SEP}{gram}".encode())


def _rarest(rules: list) -> list[str]:
    """Of each rule's grams the one that fewest rules of its device have ("": it has none, or the device FEW rules)."""
    many = {d for d, n in Counter(rule.device_key for rule in rules).items() if n > FEW}
    grams = [{r[i : i + GRAM] for r in rule.runs for i in range(len(r) - GRAM + 1)} if rule.device_key in many else set() for rule in rules]
    often = Counter((rule.device_key, g) for rule, own in zip(rules, grams) for g in own)
    return [min(own, key=lambda g: (often[rule.device_key, g], g), default="") for rule, own in zip(rules, grams)]


_BUILT: dict = {}


def rule_index(rules: DataFrame, fields: list[str], max_bytes: int = MAX_INDEX_BYTES) -> RuleIndex | None:
    """The index of usable rules (`prepare_rules`), or None where they are too large for a constant; they stay persisted
    then, until they are listed (`join_by_gram`).

    Built on the driver, which a constant of the plan passes anyway, and remembered for the rule refresh interval, as sizes are (`config_bytes`).
    """
    key = (rules.sparkSession._jsparkSession.sessionUUID(), rules.semanticHash(), max_bytes)
    hit = _BUILT.get(key)
    # the key is a 32-bit hash: the plans themselves are compared too
    if hit is None or time.monotonic() - hit[1] > CHECK_TTL_SECONDS or not hit[2].sameSemantics(rules):
        if len(_BUILT) > 100:
            _BUILT.clear()
        hit = _BUILT[key] = (_build(rules, fields, max_bytes), time.monotonic(), rules)
    return hit[0]


def _slots(hashes: list[int], values: list, n: int) -> str:
    out: list[list] = [[] for _ in range(n)]
    for h, v in zip(hashes, values):
        out[h % n].append(v)
    return json.dumps(out)


def _build(rules: DataFrame, fields: list[str], max_bytes: int) -> RuleIndex | None:
    found = rules.persist().select(F.to_json(F.struct(*fields)).alias("j"), "rule_seq", "rule_id", "regex", "device_key", "runs")
    if (found.agg(F.sum(F.octet_length("j"))).first()[0] or 0) > max_bytes:
        return None
    order = ["rule_seq", "rule_id", "regex"]
    rows = sorted(found.collect(), key=lambda r: [(r[c] is not None, r[c]) for c in order])
    rules.unpersist()
    n = 1
    while n < 2 * len(rows):
        n *= 2
    devices = sorted({r.device_key for r in rows})
    grams = _rarest(rows)
    return RuleIndex("[" + ",".join(r.j for r in rows) + "]", rules.select(*fields).schema,
                     _slots([_hash(r.device_key, g) for r, g in zip(rows, grams)], range(len(rows)), n), n,
                     _slots([_hash(d, "") for d in devices], devices, n), n, beginning(_follow(filter(None, grams))) if any(grams) else "")


def first_of_regex(rules: DataFrame, fields: list[str]) -> DataFrame:
    """Of the usable rules of a device that have the same regex the first in rule order (in which `fields` begin): the
    others match the same texts later, so none of them is ever a first match."""
    return (rules.groupBy("device_key", "regex").agg(F.min(F.struct(*fields, "runs")).alias("r"))
            .select("r.*"))


def _grams(text: Column, n: int) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))" % n), F.lit(1))


def _follow_of(grams: DataFrame) -> dict[int, tuple[frozenset, ...]]:
    """`_follow` of a column g of grams of the same length; at most 257 rows for each first character and place come back."""
    code = lambda at: F.least(F.ascii(F.substring("g", at, 1)), F.lit(_OTHER))
    places = F.posexplode(F.transform(F.sequence(F.lit(2), F.length("g")), lambda at: F.least(F.ascii(F.substr("g", at, F.lit(1))), F.lit(_OTHER))))
    seen: dict = {}
    for r in grams.select(code(1).alias("first"), places.alias("at", "code")).distinct().collect():
        seen.setdefault(r.first, {}).setdefault(r.at, set()).add(r.code)
    return {first: tuple(frozenset(at[i]) for i in sorted(at)) for first, at in seen.items()}


def _by_gram(rules: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """_k, rule, what is persisted of them, and regexes that find all grams listed: each rule under a hash of its device and that of its grams which is rarest among the rules ("": it has
    none). How often a gram occurs is counted in buckets of hashes, so that it is a constant; any choice is right."""
    of_length = lambda n: F.array_distinct(F.flatten(F.transform("runs", lambda r: _grams(r, n))))
    found = rules.select("device_key", F.struct(*fields).alias("rule"), of_length(LONG_GRAM).alias("_long"), of_length(GRAM).alias("_short"))
    found = found.select("device_key", "rule", F.when(F.size("_long") > 0, F.col("_long")).otherwise(F.col("_short")).alias("_grams"))
    bucket = lambda g: F.pmod(_key(F.col("device_key"), g), F.lit(_GRAM_BUCKETS)).cast("int")
    counts = [0] * _GRAM_BUCKETS
    for r in found.select(F.explode(F.transform("_grams", bucket)).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.b] = r.n
    often = F.from_json(F.lit(json.dumps(counts)), "array<bigint>")
    rarest = F.array_min(F.transform("_grams", lambda g: F.struct(F.get(often, bucket(g)).alias("n"), g.alias("g"))))["g"]
    listed = found.select("device_key", F.coalesce(rarest, F.lit("")).alias("g"), "rule").persist()
    of_length = [_follow_of(listed.where(F.length("g") == n)) for n in (GRAM, LONG_GRAM)]
    rules.unpersist()
    return listed.select(_key(F.col("device_key"), F.col("g")).alias("_k"), "rule"), listed, [beginning(f) for f in of_length]


def _key(device: Column, gram: Column) -> Column:
    return F.xxhash64(device, gram)


_LISTED: dict = {}


def _listed(rules: DataFrame, fields: list[str]) -> tuple[DataFrame, list[str]]:
    """`_by_gram`, persisted for the rule refresh interval."""
    key, now = (rules.sparkSession._jsparkSession.sessionUUID(), rules.semanticHash()), time.monotonic()
    for k, (old, since, plan) in list(_LISTED.items()):
        if now - since > CHECK_TTL_SECONDS or k == key and not plan.sameSemantics(rules):
            del _LISTED[k]
            if k[0] == key[0]:
                old[1].unpersist()
    if key not in _LISTED:
        _LISTED[key] = (_by_gram(rules, fields), now, rules)
    listed, _, regexes = _LISTED[key][0]
    return listed, regexes


def join_by_gram(parsed: DataFrame, rules: DataFrame, fields: list[str], device: Column, text: Column, applies: Column,
                 broadcast_max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """parsed with `hit`, the first rule in rule order (in which `fields` begin) that is the device's and finds a match,
    or null, and `_known`, whether the device has rules: for rules too large for a constant.

    Each different text goes once, with those of its grams that some rule is listed under, to the rules of that gram;
    lines then take their text's first rule. No rule and no text is gathered with all others.
    """
    listed, regexes = _listed(rules, fields)
    keys = checked_broadcast(listed.select("_k").distinct(), broadcast_max_bytes)
    lines = once(parsed, [F.col(c) for c in parsed.columns], [device.alias("_dev"), F.when(applies, text).alias("_text")])
    texts = lines.where(F.col("_text").isNotNull()).select("_dev", "_text").distinct()
    grams = F.concat(F.array(F.lit("")), *[F.regexp_extract_all("_text", F.lit(r), F.lit(1)) for r in regexes])
    met = texts.select("_dev", "_text", F.explode(F.array_distinct(F.transform(grams, lambda g: _key(F.col("_dev"), g)))).alias("_k"))
    met = met.join(keys, "_k", "left_semi").join(listed, "_k")
    rule = F.col("rule")
    found = met.where((rule["device_key"] == F.col("_dev")) & F.contains("_text", rule["literal"]) & F.rlike("_text", rule["regex"]))
    first = found.groupBy("_dev", "_text").agg(F.min("rule").alias("hit"))
    devices = checked_broadcast(listed.select(F.col("rule")["device_key"].alias("_dev")).distinct().withColumn("_has", F.lit(True)), broadcast_max_bytes)
    # lines of the same text may be many: the key of those that can't match is their own
    out = lines.withColumn("_text", F.coalesce("_text", F.concat(F.lit(_SEP), F.col("line_key")))) \
        .join(first, ["_dev", "_text"], "left").join(devices, "_dev", "left")
    return out.select(*parsed.columns, "hit", F.coalesce("_has", F.lit(False)).alias("_known"))

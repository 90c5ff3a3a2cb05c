"""Genlog -> security event (J5, J6, PRJ6, PRJ7, SET1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions import jtrim
from .joins import checked_broadcast, never_null_key
from .parse import derived_id

# --- fixed values ---
INNER_FLOW_APP = "NE_FLOW"
# --- end of fixed values ---


def name_key(c: Column) -> Column:
    """Event names compare trimmed and case-insensitively."""
    return F.lower(jtrim(c))


def _rule_order(defs: DataFrame) -> Column:
    if "rule_seq" in defs.columns:
        return F.col("rule_seq")
    return F.struct(*[F.col(c) for c in ("event_rule_id", "event_rule_field") if c in defs.columns])


def definition_index(defs: DataFrame) -> DataFrame:
    """One definition per name key: the first in rule order wins.

    `min_by` aggregates partially on the map side, so a name repeated on
    many rows (one row per rule field) never gathers on one reducer.
    """
    first = F.min_by(F.struct("event_rule_id", "event_rule_name", "event_rule_level"), _rule_order(defs))
    return (defs.groupBy(name_key(F.col("event_rule_name")).alias("def_key"))
            .agg(first.alias("d"))
            .select("def_key", F.col("d.event_rule_id").alias("def_id"),
                    F.col("d.event_rule_name").alias("def_name"),
                    F.col("d.event_rule_level").alias("def_level")))


def event_record(rule_id: Column, rule_name: Column, rule_level: Column) -> list[Column]:
    """PRJ6: the 15 EVENT fields, from a genlog row and the chosen definition.

    Kept as stored: opentime is the receive time (genlog 2, not genlog 20),
    actionopt is the action *result* (genlog 10) and proto is the reporting
    app (genlog 3, not genlog 19).
    """
    eid = derived_id("event")
    return [
        eid.alias("event_rule_result_id"),
        eid.alias("event_rule_result_id2"),
        rule_id.alias("event_rule_id"),
        F.col("row").alias("logid"),
        rule_name.alias("event_rule_name"),
        rule_level.alias("event_rule_level"),
        F.col("reportip").alias("reportneip"),
        F.col("sourceip"), F.col("sourceport"), F.col("destip"), F.col("destport"),
        F.col("firstrecvtime").alias("opentime"),
        F.col("actionresult").alias("actionopt"),
        F.when(F.col("reportapp") == INNER_FLOW_APP, F.lit("0")).otherwise(F.lit("1")).alias("is_inner"),
        F.col("reportapp").alias("proto"),
        F.col("line_key"),
    ]


def _event_key() -> Column:
    return never_null_key(name_key(F.col("eventname")), F.col("row"))


def unknown_names(genlog: DataFrame, defs: DataFrame) -> DataFrame:
    """The genlog rows whose event name no definition covers."""
    index = checked_broadcast(definition_index(defs).select("def_key"))
    return genlog.join(index, _event_key() == index["def_key"], "left_anti")


def match_by_name(genlog: DataFrame, defs: DataFrame) -> DataFrame:
    """Genlog joined to the event definition of the same (trimmed,
    case-ignoring) name; the first definition wins; no definition, no event."""
    index = checked_broadcast(definition_index(defs))
    joined = genlog.join(index, _event_key() == index["def_key"], "inner")
    return joined.select(*event_record(F.col("def_id"), F.col("def_name"), F.col("def_level")))


def match_by_id(genlog: DataFrame) -> DataFrame:
    """PRJ7: EVENT straight from the genlog: id = eventid, name, level from the rule."""
    return genlog.select(*event_record(F.col("eventid"), F.col("eventname"), F.col("eventlevel")))


def default_definition_id(key: Column) -> Column:
    """Id of a definition made for a new event name: stable per name key."""
    return F.md5(F.concat(F.lit("eventdef~"), key))


def new_definitions(genlog: DataFrame, defs: DataFrame, id_fn=default_definition_id) -> DataFrame:
    """One new definition per event name no definition covers.

    Name and level come from the genlog row with the least `row` id (trimmed,
    as stored); the id from `id_fn(name_key)`; is_inner = is_use = "1",
    everything else "". Each name is added once, however many lines carry it.
    """
    unknown = unknown_names(genlog, defs)
    pick = F.min_by(F.struct(jtrim(F.col("eventname")).alias("n"), jtrim(F.col("eventlevel")).alias("l")), F.col("row"))
    grouped = unknown.groupBy(name_key(F.col("eventname")).alias("name_key")).agg(pick.alias("p"))
    blank = F.lit("")
    values = {
        "event_rule_id": id_fn(F.col("name_key")),
        "event_rule_lib_id": blank, "event_rule_code": blank,
        "event_rule_name": F.col("p.n"), "event_rule_level": F.col("p.l"),
        "event_basic_type": blank, "event_sub_type": blank, "event_rule_desc": blank,
        "event_rule": blank, "is_inner": F.lit("1"), "is_use": F.lit("1"),
    }
    return grouped.select(*[values[c].alias(c) for c in S.EVENT_DEF_COLUMNS])


def events_for_new_names(genlog: DataFrame, defs: DataFrame, id_fn=default_definition_id) -> DataFrame:
    """The EVENT of each genlog whose name gets a new definition: the
    definition's id, which is a function of the name, and the genlog's own
    (untrimmed) name and level. One pass over the logs, no join with them.
    A null name has no definition, so no event."""
    named = unknown_names(genlog, defs).where(F.col("eventname").isNotNull())
    return named.select(*event_record(id_fn(name_key(F.col("eventname"))), F.col("eventname"), F.col("eventlevel")))


def append_definitions(defs: DataFrame, new_defs: DataFrame) -> DataFrame:
    """SET1: the rule set with the new definitions added (columns aligned by name)."""
    return defs.unionByName(new_defs, allowMissingColumns=True)

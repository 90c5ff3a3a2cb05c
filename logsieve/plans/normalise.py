"""Composition of the log analysis: raw lines -> syslog, genlog and event tables.

The same pure DataFrame -> DataFrame functions serve a batch read and a
streaming micro-batch (see `logsieve.streaming`).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import events as ev
from ..operators import match as mt
from ..operators import parse as ps
from ..sinks import documents as docs


@dataclass
class Analysis:
    matched: DataFrame     # every parsed line with its `hit` rule (or null) and `match_status`
    genlog: DataFrame      # one normalised record per matched line
    event_defs: DataFrame  # definitions the events are matched against

    @cached_property
    def events(self) -> DataFrame:
        """One security event per genlog whose name has a definition (built on first use)."""
        return ev.match_by_name(self.genlog, self.event_defs)

    def syslog_docs(self, tz: str = "UTC") -> DataFrame:
        return docs.syslog_docs(self.matched, tz)

    def genlog_docs(self) -> DataFrame:
        return docs.genlog_docs(self.genlog)

    def event_docs(self) -> DataFrame:
        return docs.event_docs(self.events)

    def rejects(self, tz: str = "UTC") -> DataFrame:
        return docs.rejects(self.matched, tz)


def analyze(raw: DataFrame, log_rules: DataFrame, event_defs: DataFrame, *,
            value_col: str = "value", key_col: str | None = None, id_mode: str = "hash",
            tz: str = "UTC", user_rules: DataFrame | None = None, task_bytes: int | None = None) -> Analysis:
    """Parse, match system rules (or user rules when given), normalise, map to events.

    `key_col` names each line's position in its source (see `parse.admit`); `task_bytes`
    bounds what one task takes (see `parse.spread`)."""
    parsed = ps.parse(raw, value_col, key_col, id_mode, task_bytes)
    if user_rules is not None:
        matched = mt.match_user(parsed, user_rules)
        genlog = mt.to_genlog(matched, user_rules=True, tz=tz)
    else:
        matched = mt.match_system(parsed, log_rules)
        genlog = mt.to_genlog(matched, tz=tz)
    return Analysis(matched, genlog, event_defs)

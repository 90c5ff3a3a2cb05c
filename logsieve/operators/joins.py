"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, functions as F

# Bytes a rule table may hold, as JSON text, and still be broadcast. Far below
# the default 8 GB broadcast limit, also once unpacked into rows.
MAX_BROADCAST_BYTES = 64 << 20


def config_bytes(df: DataFrame) -> int:
    """Size of a configuration table, as JSON text: one job over it, remembered
    for the rule refresh interval. Not for tables derived from logs or points."""
    key = (df.sparkSession._jsparkSession.sessionUUID(), df.semanticHash())
    now = time.monotonic()
    hit = _CHECKED.get(key)
    if hit is None or now - hit[1] > CHECK_TTL_SECONDS:
        if len(_CHECKED) > 10_000:
            _CHECKED.clear()
        size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
        hit = (size or 0, now)
        _CHECKED[key] = hit
    return hit[0]


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark a configuration table for broadcast when it holds at most `max_bytes`.

    Beyond the bound the frame is returned unmarked and the join shuffles,
    where AQE may still pick a broadcast from runtime statistics or split
    skewed keys. The rows of the result are the same either way.
    """
    return F.broadcast(df) if config_bytes(df) <= max_bytes else df


# Sizes already checked in this process, by (session, semantic plan hash):
# the same rule table feeding several queries is measured once. A plan over
# files hashes its paths, not their contents, so a size is trusted only for
# the rule refresh interval.
CHECK_TTL_SECONDS = 300.0
_CHECKED: dict = {}


# A key value no real key takes: text keys are trimmed (so never start with
# U+0001) and addresses are non-negative blocks.
_NO_TEXT_KEY = "\u0001"
_NO_LONG_KEY = -(1 << 62)
_SPREAD = 1 << 20


def never_null_key(key: Column, row: Column) -> Column:
    """`key` with null replaced by a value that matches nothing, another for each `row`.

    A nullable, computed join key makes Catalyst infer `key IS NOT NULL` and
    push it, with the whole computation inlined, down to the scan: below any
    repartition and evaluated twice. A key that cannot be null infers no such
    filter; rows that had a null key still match nothing, and should the join
    shuffle they do not meet in one task.
    """
    return F.coalesce(key, F.concat(F.lit(_NO_TEXT_KEY), row.cast("string")), F.lit(_NO_TEXT_KEY))


def never_null_long(key: Column, row: Column) -> Column:
    return F.coalesce(key, F.lit(_NO_LONG_KEY) + F.pmod(F.xxhash64(row), F.lit(_SPREAD)))

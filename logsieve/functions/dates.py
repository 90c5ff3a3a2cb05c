"""Date text <-> epoch conversions (F1-F5), independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# --- fixed values: text formats of the log records ---
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATETIME_FORMAT_NO_BLANK = "yyyy-MM-ddHH:mm:ss"
# --- end of fixed values ---

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


# Leading "date time" of the text; fields of one or two digits, as the
# lenient JVM parser accepted them; anything after the seconds is ignored.
_LEADING_DATETIME = r"^[\x00-\x20]*([0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})"


def _carried_over(head: Column) -> Column:
    """`y-m-d h:m:s` with fields of any size: what is too much is carried over."""
    n = F.transform(F.split(head, "[- :]"), lambda x: x.cast("int"))
    month = F.add_months(F.make_date(F.get(n, 0), F.lit(1), F.lit(1)), F.get(n, 1) - 1)
    days = F.unix_date(month).cast("bigint") + F.get(n, 2) - 1
    seconds = days * 86400 + F.get(n, 3) * 3600 + F.get(n, 4) * 60 + F.get(n, 5)
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def _parse_wall(text: Column, tz: str) -> Column:
    """Wall-clock text -> UTC wall clock as TIMESTAMP_NTZ (null when unreadable).

    A cast, not a formatter: no per-row pattern or zone lookup, and the
    session time zone never enters. Only fields out of range (month 13, day
    32, hour 25) take the second way, which carries them over."""
    head = F.regexp_extract(text, _LEADING_DATETIME, 1)
    wall = F.coalesce(F.when(head != "", head).try_cast("timestamp_ntz"), F.when(head != "", _carried_over(head)))
    return wall if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)


def date_to_millis(text: Column, tz: str = "UTC") -> Column:
    """F1 (and F5): `yyyy-MM-dd HH:mm:ss` text -> epoch milliseconds, null when unreadable."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), _parse_wall(text, tz))


def date_to_seconds(text: Column, tz: str = "UTC") -> Column:
    """as F1, in seconds."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), _parse_wall(text, tz))


def _millis_to_local(millis: Column, tz: str) -> Column:
    utc_wall = F.timestamp_add("MILLISECOND", millis.cast("bigint"), F.expr(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall) if tz != "UTC" else utc_wall


def millis_to_date(millis: Column, tz: str = "UTC") -> Column:
    """epoch milliseconds -> `yyyy-MM-dd HH:mm:ss`."""
    return F.date_format(_millis_to_local(millis, tz), DATETIME_FORMAT)


def millis_to_date_compact(millis: Column, tz: str = "UTC") -> Column:
    """epoch milliseconds -> `yyyy-MM-ddHH:mm:ss` (no blank)."""
    return F.date_format(_millis_to_local(millis, tz), DATETIME_FORMAT_NO_BLANK)

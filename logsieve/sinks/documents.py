"""Stored documents and their writers (SNK2-SNK5, SNK10, PRJ8).

The documents are projections; the writers are plain DataFrameWriter calls,
so any format with a Spark connector (parquet, json, an index or Kafka when
its jar is present) can be the target. Errors rise to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..functions import date_to_millis, is_blank, jtrim, md5_upper, string_to_escapes
from ..operators.parse import FIELD_SEP, derived_id, match_flag_text, once, stored_ismatch

# --- fixed values ---
ESCAPE_PREFIX = "socos"
# --- end of fixed values ---


def lower_columns(df: DataFrame) -> DataFrame:
    """PRJ8: lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def _flagged_fields(matched: DataFrame):
    flagged = F.concat(F.col("line"), F.lit(FIELD_SEP), match_flag_text(F.col("hit").isNotNull()))
    return F.split(flagged, FIELD_SEP)


def syslog_docs(matched: DataFrame, tz: str = "UTC") -> DataFrame:
    """SNK2: one raw-log document per flagged line of at least 8 fields.

    Fields are read back from the flagged line, as stored. A line whose
    receive time does not parse is left out here (it is in `rejects`).
    """
    with_f = once(matched, [F.col(c) for c in matched.columns], [_flagged_fields(matched).alias("_ff")])
    f = F.col("_ff")
    timed = once(with_f, [F.col(c) for c in with_f.columns], [date_to_millis(F.get(f, 1), tz).alias("_ms")])
    ms = F.col("_ms")
    return (timed.where(F.col("line").isNotNull() & (F.size(f) >= 8) & ms.isNotNull())
            .select(derived_id("syslog").alias("row"),
                    F.get(f, 0).alias("recordid"),
                    ms.alias("recvtime"),
                    ms.alias("storagetime"),
                    F.get(f, 2).alias("reportip"),
                    F.get(f, 5).alias("reportapp"),
                    F.get(f, 6).alias("logcontent"),
                    stored_ismatch(F.col("line"), F.col("hit").isNotNull()).alias("ismatch")))


def rejects(matched: DataFrame, tz: str = "UTC") -> DataFrame:
    """Every line that has no raw-log document, with the reason: a null value, too few
    fields, or an unreadable receive time (`shifted`: read one place off, see `parse`)."""
    f = _flagged_fields(matched)
    reason = (F.when(F.col("value").isNull(), F.lit("null_value"))
              .when(F.size(f) < 8, F.lit("too_few_fields"))
              .when(date_to_millis(F.get(f, 1), tz).isNull(), F.lit("bad_time")))
    judged = once(matched, [F.col("value"), F.col("line_key"), F.col("shifted")], [reason.alias("reason")])
    return judged.where(F.col("reason").isNotNull()).select(
        derived_id("reject").alias("row"), "value", "reason", "shifted")


def genlog_docs(genlog: DataFrame) -> DataFrame:
    """SNK3: 23 stored genlog columns; genlog 19-21 are not stored.

    eventname2 is the name's UTF-16 units as `socos`+hex, eventname3 its
    upper-case MD5; both "" for a blank name.
    """
    name = jtrim(F.col("eventname"))
    blank = is_blank(F.col("eventname"))
    cols = {
        "row": derived_id("genlog_doc"),
        "eventname2": F.when(blank, F.lit("")).otherwise(string_to_escapes(name, ESCAPE_PREFIX)),
        "eventname3": F.when(blank, F.lit("")).otherwise(md5_upper(name)),
    }
    return (genlog.where(F.col("firstrecvtime").isNotNull())
            .select(*[cols.get(c, F.col(c)).alias(c) for c in S.GENLOG_DOC_COLUMNS]))


def event_docs(events: DataFrame) -> DataFrame:
    """SNK4: 15 stored event columns (`opentime` as the text of epoch milliseconds)."""
    cols = {"row": derived_id("event_doc"), "event_rule_result_id": F.col("event_rule_result_id2"),
            "opentime": F.col("opentime").cast("string")}
    return events.select(*[cols.get(c, F.col(c)).alias(c) for c in S.EVENT_DOC_COLUMNS])


def write_documents(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "append",
                    options: dict | None = None, partition_by: list[str] | None = None) -> None:
    """SNK5: write a document frame to `target` with any Spark data source."""
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target)


def genlog_lines(genlog: DataFrame) -> DataFrame:
    """SNK10: genlog records as `~`-joined text in a `value` column (null key),
    the shape forwarded to a downstream topic. The receive time is the text."""
    fields = [F.col("recvtime") if c == "firstrecvtime" else F.col(c) for c in S.GENLOG_FIELDS]
    return genlog.select(F.lit(None).cast("string").alias("key"), F.concat_ws(FIELD_SEP, *fields).alias("value"))


def forward_lines(lines: DataFrame, target: str, fmt: str = "kafka", options: dict | None = None) -> None:
    """SNK10 writer: Kafka when its connector is present (`target` is the topic, the
    options carry the servers), else any file format for tests."""
    if fmt == "kafka":
        lines.write.format("kafka").options(**(options or {})).option("topic", target).save()
    else:
        lines.select("value").write.mode("append").format(fmt).options(**(options or {})).save(target)

"""Raw line admission, field split and payload extraction (FLT1-FLT3, PRJ1, PRJ2, PRJ5).

All steps are narrow projections: no shuffle, one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import count_sep, is_blank, jpart, jsplit_char, jtrim, random_uuid

# --- fixed values: record delimiters and positions ---
FIELD_SEP = "~"
PAYLOAD_SEP = "|!"
PAYLOAD_DEVICE_IP = 29
PAYLOAD_MESSAGE = 66
# --- end of fixed values ---

# The optimizer's size of a source that tells none is Long.MaxValue, or more after a projection.
_UNKNOWN_SIZE = 1 << 55

_TIME_START = r"^[\x00-\x20]*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} "


def spread(df: DataFrame, min_partitions: int | None = None, task_bytes: int | None = None) -> DataFrame:
    """Round-robin the input over the cluster only when its scan is estimated
    to give fewer splits than the session can run at once (one small file).
    The estimate is the optimizer's, from file sizes: nothing is run for it. A
    large scan is already split and is left as it is, so this adds no shuffle
    at scale; the regex work that follows is CPU-bound and otherwise runs on a
    single core. Streams are left alone (Kafka: see `minPartitions` in
    `read_log_stream`). With `task_bytes`, tasks take about as many bytes of
    the files each, whatever the size of the input: for rows that are kept in
    memory, of which one split of a well compressed file holds too many."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.isStreaming:
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if task_bytes and size < _UNKNOWN_SIZE:
        n = max(want, -(-size // task_bytes))
        return df.repartition(n) if n > want or size < want * split else df
    return df.repartition(want) if size < want * split else df


def admit(df: DataFrame, value_col: str = "value", key_col: str | None = None,
          id_mode: str = "hash") -> DataFrame:
    """FLT1: put a record id in front of non-blank lines of at most six fields.

    id_mode="hash" derives the id from `key_col`, the line's position in its
    source (a Kafka topic/partition/offset, a file and row number), so that
    equal lines get different ids and a replayed batch the same ones again.
    Without a position the id comes from the line itself, and equal lines
    share it; id_mode="random" uses a fresh UUID.
    """
    v = F.col(value_col)
    n_fields = count_sep(F.rtrim(jtrim(v), F.lit(FIELD_SEP)), FIELD_SEP) + 1
    short = v.isNotNull() & ~is_blank(v) & (n_fields <= 6)
    key = F.col(key_col).cast("string") if key_col else v
    rid = F.md5(key) if id_mode == "hash" else random_uuid()
    line = F.when(short, F.concat(rid, F.lit(FIELD_SEP), v)).otherwise(v)
    return once(df, [F.col(c) for c in df.columns if c != "line"], [line.alias("line")])


def parse(df: DataFrame, value_col: str = "value", key_col: str | None = None,
          id_mode: str = "hash", task_bytes: int | None = None) -> DataFrame:
    """FLT1 + PRJ1 + PRJ2: raw lines -> named raw fields and the payload parts.

    Adds: line, line_key, n_fields, recordid, recvtime, reportip, reportapp,
    logcontent, device_ip (payload part 29), msg (payload part 66); a part the
    JVM split would not have is null. line_key names the record: it comes from
    the source position (`key_col`) and the line. `shifted` marks a line whose
    content holds the separator, so that its fields are read one place off (it
    got no id and the time stands first) or its content ends early.
    """
    d = admit(spread(df, task_bytes=task_bytes), value_col, key_col, id_mode)
    fields = jsplit_char(F.col("line"), FIELD_SEP)
    content = F.get(F.col("_f"), 6)
    # Only payload parts 29 and 66 are read, so the payload is never split
    # into an array: literal substring scans find the two parts.
    key = F.concat(F.col(key_col).cast("string"), F.lit(FIELD_SEP), F.coalesce("line", F.lit(""))) if key_col else F.col("line")
    looks_timed = lambda i: F.coalesce(F.get(F.col("_f"), i).rlike(_TIME_START), F.lit(False))
    parsed = [
        F.md5(key).alias("line_key"),
        F.size("_f").alias("n_fields"),
        F.coalesce((F.size("_f") > 7) | ((F.size("_f") == 7) & looks_timed(0) & ~looks_timed(1)), F.lit(False)).alias("shifted"),
        F.get("_f", 0).alias("recordid"),
        F.get("_f", 1).alias("recvtime"),
        F.get("_f", 2).alias("reportip"),
        F.get("_f", 5).alias("reportapp"),
        content.alias("logcontent"),
        F.when(F.size("_f") > 6, jtrim(jpart(content, PAYLOAD_SEP, PAYLOAD_DEVICE_IP))).alias("device_ip"),
        F.when(F.size("_f") > 6, jtrim(jpart(content, PAYLOAD_SEP, PAYLOAD_MESSAGE))).alias("msg"),
    ]
    keep = [F.col(c) for c in d.columns]
    return once(d.select(*keep, fields.alias("_f")), keep, parsed)


def once(df: DataFrame, keep: list[Column], computed: list[Column]) -> DataFrame:
    """Project `computed` next to `keep`, evaluating each expression exactly once.

    The computed columns come out of a one-row `inline` (a Generate node).
    A later filter on them therefore stays above it, instead of being pushed
    down with the whole expression inlined - which would evaluate it twice
    and, on a small input, before the spread.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*computed))))


def derived_id(tag: str, key: Column | str = "line_key") -> Column:
    """Stable per-record id of one output table (F10, hash mode)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(tag + FIELD_SEP), k))


def match_flag_text(matched: Column) -> Column:
    """PRJ5: the flag appended to the raw line, "0" matched / "1" not."""
    return F.when(matched, F.lit("0")).otherwise(F.lit("1"))


def stored_ismatch(line: Column, matched: Column) -> Column:
    """PRJ5 as the syslog document reads it back: field 7 of line + flag.

    Normally that is the flag; when the content held a `~`, field 7 is a
    piece of content: blank -> 1, an integer -> its value, other text -> 0.
    """
    f7 = jtrim(F.get(F.split(F.concat(line, F.lit(FIELD_SEP), match_flag_text(matched)), FIELD_SEP), 7))
    return (F.when(f7 == "", F.lit(1))
            .when(f7.rlike(r"^[+-]?[0-9]{1,10}$") & f7.try_cast("int").isNotNull(), f7.try_cast("int"))
            .otherwise(F.lit(0))).cast("int")

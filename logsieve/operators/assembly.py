"""Rule table assembly by joins (J1, J2, FLT6, SRC3-SRC5, PRJ9, rule order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S


def _is(c: str, v: str) -> Column:
    # Flags may arrive as numbers or text; compare as text so no cast can fail.
    return F.col(c).cast("string") == F.lit(v)


def assemble_log_rules(log_regex: DataFrame, lib: DataFrame, moni_ne: DataFrame,
                       device_ip: DataFrame) -> DataFrame:
    """J1 + FLT6: one log rule per (rule, device IP) of the devices its library covers.

    device LEFT JOIN device_ip on ne_id; INNER JOIN library on the three
    device-type keys; rule RIGHT JOIN that on log_rule_lib_id; then
    device_ip and log_rule_id not null. The null-rejecting filter lets
    Catalyst plan all three as inner joins.
    """
    ne = moni_ne.alias("ne")
    ip = device_ip.alias("ip")
    moni = ne.join(ip, F.col("ip.ne_id") == F.col("ne.ne_id"), "left") \
        .select(F.col("ne.htypeid"), F.col("ne.vendorid"), F.col("ne.model"), F.col("ip.device_ip"))
    lb = lib.alias("lb")
    mo = moni.alias("mo")
    libdev = lb.join(mo, (F.col("lb.htyeid") == F.col("mo.htypeid"))
                     & (F.col("lb.vendorid") == F.col("mo.vendorid"))
                     & (F.col("lb.model") == F.col("mo.model")), "inner") \
        .select(F.col("lb.log_rule_lib_id").alias("lib_id"), F.col("mo.device_ip").alias("device_ip"))
    rx = log_regex.alias("rx")
    joined = rx.join(libdev.alias("ld"), F.col("ld.lib_id") == F.col("rx.log_rule_lib_id"), "right") \
        .where(F.col("ld.device_ip").isNotNull() & F.col("rx.log_rule_id").isNotNull())
    return joined.select(*[F.col("ld.device_ip" if c == "device_ip" else f"rx.{c}").alias(c)
                           for c in S.LOG_RULE_COLUMNS])


def event_defs_system(defs: DataFrame, fields: DataFrame) -> DataFrame:
    """J2 + SRC4: built-in definitions, one row per rule field (RIGHT JOIN on
    event_rule_id, kept only where the definition is inner and in use)."""
    d = defs.alias("d")
    f = fields.alias("f")
    joined = d.join(f, F.col("d.event_rule_id") == F.col("f.event_rule_id"), "right") \
        .where(_is("d.is_inner", "1") & _is("d.is_use", "1"))
    src = {"filed_begin_value": "f", "event_rule_field": "f", "match_method": "f"}
    return joined.select(*[F.col(f"{src.get(c, 'd')}.{c}").alias(c) for c in S.EVENT_DEF_SYSTEM_COLUMNS])


def event_defs_user(defs: DataFrame) -> DataFrame:
    """SRC3: user definitions (not inner, in use), 11 columns."""
    return defs.where(_is("is_inner", "0") & _is("is_use", "1")).select(*S.EVENT_DEF_USER_COLUMNS)


def event_rule_fields(fields: DataFrame) -> DataFrame:
    """SRC5: the rule-field table, 6 columns."""
    return fields.select(*S.EVENT_FIELD_COLUMNS)


def stringify(df: DataFrame, keep: tuple[str, ...] = ("rule_seq",)) -> DataFrame:
    """PRJ9: every value as text; null, "" and the text "null" become ""."""
    def one(c: str) -> Column:
        s = F.col(c).cast("string")
        return F.when(s.isNull() | (s == "null"), F.lit("")).otherwise(s).alias(c)
    return df.select(*[F.col(c) if c in keep else one(c) for c in df.columns])


def with_rule_seq(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """Give each rule its position in a fixed order as `rule_seq` (BIGINT).

    A distributed sort followed by monotonically increasing ids: the ids grow
    with the sort order (they may have gaps), which is all "first rule wins"
    needs. Done once, when a snapshot is written.
    """
    return df.orderBy(*order_cols).withColumn("rule_seq", F.monotonically_increasing_id())

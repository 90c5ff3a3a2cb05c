"""IP range join (J7) and the device-IP semi join (J8 on its own).

A range join as an equi-join: every range is listed under the address blocks
it touches, every address under its own blocks, and the join runs on the block
with the exact `lo <= ip <= hi` test as a post-filter. Blocks come in three
widths; a range uses the narrowest of which it touches at most MAX_BLOCKS, so
no range has more rows than that however wide it is. No pair of rows is formed
that does not share a block, and no candidate is dropped. Sections that are no
ranges of addresses are refused with a reason (`section_rejects`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ip_to_long, jtrim, section_bounds
from .joins import checked_broadcast, never_null_key, never_null_long

# Block widths in bits, and the blocks a range may touch (the widest has 256 blocks in all).
BLOCK_BITS = (8, 16, 24)
MAX_BLOCKS = 513
MAX_ADDRESS = (1 << 32) - 1


def _bounded(sections: DataFrame, section_col: str) -> DataFrame:
    lo, hi = section_bounds(F.col(section_col))
    reason = (F.when(F.col("ip_lo").isNull() | F.col("ip_hi").isNull(), F.lit("unreadable"))
              .when((F.col("ip_lo") < 0) | (F.col("ip_lo") > MAX_ADDRESS) | (F.col("ip_hi") < 0) | (F.col("ip_hi") > MAX_ADDRESS),
                    F.lit("out_of_range"))
              .when(F.col("ip_lo") > F.col("ip_hi"), F.lit("backwards")))
    return sections.select("*", lo.alias("ip_lo"), hi.alias("ip_hi")).withColumn("reject_reason", reason)


def section_rejects(sections: DataFrame, section_col: str = "ip_section") -> DataFrame:
    """Sections that take no part in the join, with `reject_reason`."""
    return _bounded(sections, section_col).where(F.col("reject_reason").isNotNull()).drop("ip_lo", "ip_hi")


def explode_ranges(sections: DataFrame, section_col: str = "ip_section") -> DataFrame:
    """Ranges with numeric bounds, one row per touched block (_bits, _block)."""
    ranges = _bounded(sections, section_col).where(F.col("reject_reason").isNull()).drop("reject_reason")
    touched = lambda b: F.shiftright("ip_hi", b) - F.shiftright("ip_lo", b) + 1
    bits = F.lit(BLOCK_BITS[-1])
    for b in reversed(BLOCK_BITS[:-1]):
        bits = F.when(touched(b) <= MAX_BLOCKS, F.lit(b)).otherwise(bits)
    ranges = ranges.withColumn("_bits", bits)
    span = lambda c: F.call_function("shiftright", F.col(c), F.col("_bits"))
    return ranges.withColumn("_block", F.explode(F.sequence(span("ip_lo"), span("ip_hi"))))


def range_join(df: DataFrame, ip: Column, sections: DataFrame, section_col: str = "ip_section",
               how: str = "inner") -> DataFrame:
    """Rows of `df` joined to every section containing `ip` (inclusive ends).

    how="left" keeps rows in no section (section columns null).
    """
    rb = checked_broadcast(explode_ranges(sections, section_col))
    # Neither the address nor its block may be null in the join condition (see
    # never_null_key); an unreadable address gets a sentinel below every range.
    left = df.withColumn("_ipn", never_null_long(ip_to_long(ip), F.struct(*df.columns)))

    def inside(block, bits):
        return (block == rb["_block"]) & (bits == rb["_bits"]) & F.col("_ipn").between(rb["ip_lo"], rb["ip_hi"])

    # An address has a block of each width; a range is listed under one width only.
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("bits"), F.shiftright("_ipn", b).alias("block")) for b in BLOCK_BITS]))
    rows = left.withColumn("_at", each)
    found = rows.join(rb, inside(F.col("_at.block"), F.col("_at.bits")), "inner").drop("_at", "_ipn", "_bits", "_block")
    if how == "inner":
        return found
    if how != "left":
        raise ValueError(f"how must be inner or left, not {how}")
    rest = left
    for b in BLOCK_BITS:
        rest = rest.join(rb, inside(F.shiftright("_ipn", b), F.lit(b)), "left_anti")
    return found.unionByName(rest.drop("_ipn"), allowMissingColumns=True)


def with_device_rule(df: DataFrame, device_col: str, rule_devices: DataFrame) -> DataFrame:
    """Rows whose device IP (trimmed) equals a rule's device IP; a null on
    either side is no match."""
    keys = checked_broadcast(rule_devices.select(jtrim(F.col("device_ip")).alias("_dk")).distinct())
    key = never_null_key(jtrim(F.col(device_col)), F.xxhash64(*df.columns))
    return df.join(keys, key == keys["_dk"], "left_semi")

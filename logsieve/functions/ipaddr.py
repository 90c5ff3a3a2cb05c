"""IPv4 text -> number and range tests (F11, J7's predicate)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import jsplit, jtrim

_INT_TEXT = r"^[+-]?[0-9]{1,10}$"


def ip_to_long(ip: Column) -> Column:
    """dotted quad -> long by shifting in the first four parts.

    Parts are read as integers without bounds, like the original; fewer than
    four parts or a part that is not an integer gives null.
    """
    parts = F.slice(jsplit(jtrim(ip), r"\."), 1, 4)
    # A part that is not an integer turns the accumulator null, and it stays null.
    value = F.aggregate(parts, F.lit(0).cast("bigint"),
                        lambda acc, o: F.when(o.rlike(_INT_TEXT),
                                              F.shiftleft(acc, 8).bitwiseOR(o.try_cast("int").cast("bigint"))))
    return F.when(F.size(parts) == 4, value)


def section_bounds(section: Column) -> tuple[Column, Column]:
    """`begin-end` text -> (begin, end) as longs; null when there is no '-'."""
    s = jtrim(section)
    has_dash = F.instr(s, "-") > 0
    begin = F.when(has_dash, ip_to_long(F.substring_index(s, "-", 1)))
    end = F.when(has_dash, ip_to_long(F.substr(s, F.instr(s, "-") + 1)))
    return begin, end


def ip_in_section(ip: Column, section: Column) -> Column:
    """J7 predicate: begin <= ip <= end, both ends inclusive."""
    lo, hi = section_bounds(section)
    n = ip_to_long(ip)
    return (lo <= n) & (n <= hi)

"""Digest, escape codec and id functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import is_blank


def md5_upper(c: Column) -> Column:
    """MD5 of the UTF-8 bytes, upper-case hex."""
    return F.upper(F.md5(c))


def _java_replacement_quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


# One unit of hex text as groups of a regex: whole, or without leading zeros.
_PADDED = "(....)"
_UNPADDED = "(?:00([1-9a-f].)|000(.)|0([1-9a-f]..)|(....))"
_AT_ONCE = 8


def string_to_escapes(c: Column, prefix: str = "\\u", pad: bool = False) -> Column:
    """F8: every UTF-16 unit as `prefix` + hex without zero padding; blank -> null.

    With prefix="socos" this is the `eventname2` form of the genlog document.
    `pad=True` writes four hex digits per unit, the form F9 reads back.
    One linear regex pass over the UTF-16BE hex text (a character outside
    the BMP is two units, as in the JVM's char sequence), _AT_ONCE units a
    match, as a match costs more than a unit; no per-unit array.
    """
    units = F.lower(F.hex(F.encode(c, "UTF-16BE")))
    unit = _PADDED if pad else _UNPADDED
    to = _java_replacement_quote(prefix)
    n = unit.count("(") - unit.count("(?:")
    by = "".join(to + "".join(f"${i * n + g + 1}" for g in range(n)) for i in range(_AT_ONCE))
    out = F.regexp_replace(units, unit + (unit + "?") * (_AT_ONCE - 1), by)
    # The last match may have fewer units: the prefixes of those it lacks are cut off.
    lacking = F.pmod(-F.length(units) / 4, F.lit(_AT_ONCE)).cast("int")
    # (the one-element array: the text is worked out once, then measured and cut)
    out = F.get(F.transform(F.array(out), lambda t: F.left(t, F.length(t) - lacking * len(prefix))), 0)
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(out)


def escapes_to_string(c: Column) -> Column:
    """decode `\\uXXXX` escapes.

    Text before and between escapes is kept, text after the last escape is
    dropped and a line without any escape gives "", as the original decoder
    does; blank -> null. An escape without four hex digits after it (where the
    original loops or fails) gives null.
    """
    parts = F.split(c, r"\\u", -1)
    n = F.size(parts)
    tail = F.slice(parts, 2, F.greatest(n - 1, F.lit(1)))
    bad = F.exists(tail, lambda p: ~p.rlike("^[0-9A-Fa-f]{4}"))
    # Each piece: the escaped unit, then the text up to the next escape, all
    # as UTF-16BE hex so that surrogate pairs join when decoded. The lambdas
    # touch only their element (no per-element look at the whole text).
    pieces = F.transform(tail, lambda p: F.concat(
        F.upper(F.substring(p, 1, 4)), F.hex(F.encode(F.substring(p, 5, 1 << 30), "UTF-16BE"))))
    decoded = F.decode(F.unhex(F.concat(F.hex(F.encode(F.element_at(parts, 1), "UTF-16BE")),
                                        F.array_join(pieces, ""))), "UTF-16BE")
    # Text after the last escape is dropped, as the original decoder does.
    rest = F.substring(F.element_at(parts, -1), 5, 1 << 30)
    kept = F.left(decoded, F.length(decoded) - F.length(rest))
    # Fast path: text made only of escapes decodes in one pass.
    only_escapes = c.rlike(r"^(?:\\u[0-9A-Fa-f]{4})+$")
    direct = F.decode(F.unhex(F.replace(c, F.lit("\\u"), F.lit(""))), "UTF-16BE")
    return (F.when(is_blank(c), F.lit(None).cast("string"))
            .when(only_escapes, direct)
            .when(n == 1, F.lit(""))
            .when(bad, F.lit(None).cast("string"))
            .otherwise(kept))


def random_uuid() -> Column:
    """F10, id_mode="random": a UUID without dashes."""
    return F.replace(F.expr("uuid()"), F.lit("-"), F.lit(""))

"""String helpers with the JVM semantics the log formats were written against."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# String.trim() strips every character up to U+0020, not only the blank.
_JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))


def jtrim(c: Column) -> Column:
    """String.trim(): strip all characters <= U+0020 at both ends."""
    return F.btrim(c, F.lit(_JAVA_TRIM_CHARS))


def is_blank(c: Column) -> Column:
    """Null, empty or only characters <= U+0020."""
    return c.isNull() | (jtrim(c) == F.lit(""))


def jsplit(c: Column, sep_regex: str) -> Column:
    """String.split(regex): like Spark's split, but trailing empty pieces are dropped.

    A line made only of separators gives one empty piece here where the JVM
    gives none; both are below every length guard in use.
    """
    return F.split(F.regexp_replace(c, f"(?:{sep_regex})+$", ""), sep_regex)


def count_sep(c: Column, sep: str) -> Column:
    """Occurrences of the literal separator `sep` (no regex, no array)."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(sep), F.lit("")))) / len(sep)).cast("int")


def jsplit_char(c: Column, sep: str) -> Column:
    """String.split for a one-character literal separator: trailing empty
    pieces dropped by an `rtrim` of that character instead of a regex."""
    return F.split(F.rtrim(c, F.lit(sep)), "\\" + sep if sep in ".|!^$*+?()[]{}\\" else sep)


def jpart(c: Column, sep: str, i: int) -> Column:
    """Piece `i` (0-based) of String.split(sep) for a literal separator,
    without building the array: null when the JVM split has no piece `i`
    (fewer separators, or only empty pieces from `i` on, which it drops)."""
    before = F.substring_index(c, sep, i)
    rest = F.substr(c, F.length(before) + F.lit(len(sep) + 1))
    exists = (count_sep(c, sep) >= i) & (F.replace(rest, F.lit(sep), F.lit("")) != F.lit(""))
    return F.when(exists, F.substring_index(rest, sep, 1))


def regex_is_valid(regex: Column) -> Column:
    """True when the JVM compiles the pattern (evaluated on executors, never raises)."""
    return _try_compile(regex).isNotNull()


def _try_compile(regex: Column) -> Column:
    return F.call_function("try_reflect", F.lit("java.util.regex.Pattern"), F.lit("compile"), regex)

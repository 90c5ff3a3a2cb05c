"""A character-level scanner of Java regular expressions, as a SQL fold with state.

`scan` reads a pattern once, with the rules by which the JVM reads it: quotes (backslash-Q to backslash-E), escapes, nested
bracket classes with a first `]` that is a letter, inline flags with their scope, and comments and white space in
comment mode. It gives the pattern's items as a text of literal characters and markers, from which the number and names
of its groups and the literal stretches that every match holds are read off. Nothing here runs per log line: the
patterns are rule tables.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Markers in the scanned text (private-use characters; a pattern that holds one itself is marked UNSURE).
CAPTURE, NAMED, NAME_END, GROUP, LOOK, CLOSE, OR, MAYBE, MORE, ANY, BREAK, UNSURE = (chr(0xE000 + i) for i in range(12))
_MARKERS = f"{CAPTURE}-{UNSURE}"
_OPENS = CAPTURE + GROUP + LOOK

(_TEXT, _ESCAPE, _CONTROL, _QUOTE, _QUOTE_ESCAPE, _COMMENT, _COMMENT_ESCAPE, _OPEN, _QUESTION, _FLAGS, _LESS, _NAME, _BRACE,
 _PROPERTY, _REFERENCE) = range(15)
_SPACE = "[ \\t\\n\\x0B\\f\\r]"
_LINE_END = "[\\n\\r\\u0085\\u2028\\u2029]"

# Nested groups that `literals` unwraps; a pattern with deeper ones has no literal.
_DEPTH = 6

#: mode; class depth; how fresh the class is (2: just opened, 1: no member yet, 0); comment mode, now and as flags being
#: read will leave it; whether these are switched off; comment modes of the enclosing groups; a name being read; items.
_STATE = {"mode": "0", "depth": "0", "fresh": "0", "x": "false", "x_next": "false", "off": "false", "outer": "''", "name": "''", "out": "''"}


def _q(text: str) -> str:
    """A SQL string literal."""
    return "'" + "".join("\\" + ch if ch in "\\'" else ch for ch in text) + "'"


def _to(mode: int | None = None, add: str | None = None, state: dict | None = None, **changes: str) -> dict:
    """The state with some columns changed (SQL texts); `add` goes behind the items."""
    cols = dict(state or {f: f"s.{f}" for f in _STATE})
    if mode is not None:
        cols["mode"] = str(mode)
    if add is not None:
        cols["out"] = f"concat({cols['out']}, {add})"
    return cols | changes


def _entered(marker: str, **changes: str) -> dict:
    """Inside a group: the comment mode outside is kept for its end."""
    return _to(_TEXT, marker, outer="concat(if(s.x, 'x', '-'), s.outer)", **changes)


def _sql(then: dict | str) -> str:
    return then if isinstance(then, str) else "named_struct(" + ", ".join(f"'{f}', {v}" for f, v in then.items()) + ")"


def _choose(*cases: tuple[str, dict | str], otherwise: dict | str) -> str:
    whens = " ".join(f"WHEN {when} THEN {_sql(then)}" for when, then in cases)
    return f"CASE {whens} ELSE {_sql(otherwise)} END"


def _is(*chars: str) -> str:
    return "c IN (" + ", ".join(map(_q, chars)) + ")"


def _matches(pattern: str) -> str:
    return f"c RLIKE {_q(pattern)}"


_LITERAL = f"CASE WHEN {_matches(f'[{_MARKERS}]')} THEN {_q(UNSURE)} ELSE c END"


def _text(state: dict) -> str:
    """A character outside quotes, escapes and comments, met in `state`."""
    to = lambda *a, **k: _to(*a, state=state, **k)
    space, comment, still = f"s.x AND {_matches(_SPACE)}", f"s.x AND {_is('#')}", "least(s.fresh, 1)"
    in_class = _choose(
        (_is("\\"), to(_ESCAPE)),
        (space, to(fresh=still)),
        (comment, to(_COMMENT, fresh=still)),
        (_is("["), to(depth="s.depth + 1", fresh="2")),
        (_is("]") + " AND s.fresh = 0 AND s.depth = 1", to(None, _q(ANY), depth="0")),
        (_is("]") + " AND s.fresh = 0", to(depth="s.depth - 1")),
        (_is("^") + " AND s.fresh = 2", to(fresh="1")), otherwise=to(fresh="0"))
    return _choose(
        ("s.depth > 0", in_class),
        (_is("\\"), to(_ESCAPE)),
        (space, to()),
        (comment, to(_COMMENT)),
        (_is("["), to(depth="1", fresh="2")),
        (_is("("), to(_OPEN)),
        (_is(")"), to(None, _q(CLOSE), x=f"if({state['outer']} = '', s.x, startswith({state['outer']}, 'x'))", outer=f"substr({state['outer']}, 2)")),
        (_is("|"), to(None, _q(OR))),
        (_is("?", "*"), to(None, _q(MAYBE))),
        (_is("+"), to(None, _q(MORE))),
        (_is("{"), to(_BRACE, _q(MAYBE))),
        (_is("."), to(None, _q(ANY))),
        (_is("^", "$"), to(None, _q(BREAK))), otherwise=to(None, _LITERAL))


def _escape() -> str:
    """The character after a backslash."""
    add = lambda a: f"if(s.depth > 0, '', {a})"
    done = lambda a, mode=_TEXT: _to(mode, add(a), fresh="0")
    return _choose(
        (_is("Q"), _to(_QUOTE)),
        (_is("E"), _to(_TEXT)),
        (_is("c"), done(_q(ANY), _CONTROL)),
        (_is("p", "P", "N"), done(_q(ANY), _PROPERTY)),
        (_is("k"), done(_q(ANY), _REFERENCE)),
        (_matches("[xu0-9]"), done(_q(ANY + UNSURE))),  # digits that follow may belong to it
        (_matches("[bBAGzZ]"), done(_q(BREAK))),
        (_matches("[A-Za-z]"), done(_q(ANY))), otherwise=done(_LITERAL))


def _flags(**changes: str) -> str:
    state = _to(**changes)
    to = lambda *a, **k: _to(*a, state=state, **k)
    return _choose(
        (_is("-"), to(_FLAGS, off="true")),
        (_is("x"), to(_FLAGS, x_next=f"NOT {state['off']}")),
        (_is(")"), to(_TEXT, _q(BREAK), x=state["x_next"])),
        (_is(":"), _entered(_q(GROUP), x=state["x_next"])),
        # a letter may then stand for another one
        (_is("i", "u", "U", "c") + f" AND NOT {state['off']}", to(_FLAGS, _q(UNSURE))), otherwise=to(_FLAGS))


def _step() -> str:
    modes = {
        _TEXT: _text(_to()),
        _ESCAPE: _escape(),
        _CONTROL: _to(_TEXT),
        _QUOTE: _choose((_is("\\"), _to(_QUOTE_ESCAPE)), ("s.depth > 0", _to(fresh="0")), otherwise=_to(None, _LITERAL)),
        _QUOTE_ESCAPE: _choose(
            (_is("E"), _to(_TEXT)),
            (_is("\\") + " AND s.depth > 0", _to(fresh="0")), (_is("\\"), _to(None, _q("\\"))),
            ("s.depth > 0", _to(_QUOTE, fresh="0")), otherwise=_to(_QUOTE, f"concat({_q(chr(92))}, {_LITERAL})")),
        _COMMENT: _choose((_matches(_LINE_END), _to(_TEXT)), (_is("\\"), _to(_COMMENT_ESCAPE)), otherwise=_to()),
        _COMMENT_ESCAPE: _choose((_is("Q"), _to(_QUOTE, _q(UNSURE))), (_matches(_LINE_END), _to(_TEXT)), otherwise=_to(_COMMENT)),
        _OPEN: _choose((_is("?"), _to(_QUESTION)), (f"s.x AND {_matches(_SPACE)}", _to()), otherwise=_text(_entered(_q(CAPTURE)))),
        _QUESTION: _choose(
            (_is(":", ">"), _entered(_q(GROUP))), (_is("=", "!"), _entered(_q(LOOK))), (_is("<"), _to(_LESS)),
            otherwise=_flags(x_next="s.x", off="false")),
        _FLAGS: _flags(),
        _LESS: _choose((_is("=", "!"), _entered(_q(LOOK))), otherwise=_to(_NAME, name="c")),
        _NAME: _choose((_is(">"), _entered(f"concat({_q(NAMED)}, s.name, {_q(NAME_END)})")), otherwise=_to(name="concat(s.name, c)")),
        _BRACE: _choose((_is("}"), _to(_TEXT)), otherwise=_to()),
        _PROPERTY: _choose((_is("{"), _to(_BRACE)), otherwise=_to(_TEXT)),
        _REFERENCE: _choose((_is(">"), _to(_TEXT)), otherwise=_to()),
    }
    return _choose(*[(f"s.mode = {mode}", then) for mode, then in modes.items()], otherwise=_to())


# One element per code point; {0} is the pattern's column.
_FOLD = f"aggregate(regexp_extract_all({{0}}, '(?s).', 0), {_sql(_STATE)}, (s, c) -> {_step().replace('{', '{{').replace('}', '}}')})"


def scan(column: str) -> Column:
    """struct(mode, ..., out): the state after the last character of the pattern in a column; `out` holds its items."""
    return F.expr(_FOLD.format(f"`{column}`"))


def group_count(scanned: Column) -> Column:
    return F.regexp_count(scanned["out"], F.lit(f"[{CAPTURE}{NAMED}]"))


def group_index(scanned: Column, name: str) -> Column:
    """Number of the group `name`, or null."""
    marker = NAMED + name + NAME_END
    before = F.substring_index(scanned["out"], marker, 1)
    return F.when(F.instr(scanned["out"], marker) > 0, (F.regexp_count(before, F.lit(f"[{CAPTURE}{NAMED}]")) + 1).cast("int"))


def closing(scanned: Column) -> Column:
    """What ends a quote or comment that the pattern leaves open, so that more can be put behind it."""
    return (F.when(scanned["mode"].isin(_QUOTE, _QUOTE_ESCAPE), F.lit("\\E"))
            .when(scanned["mode"].isin(_COMMENT, _COMMENT_ESCAPE), F.lit("\n")).otherwise(F.lit("")))


def literals(scanned: Column) -> Column:
    """The literal stretches that the text of every match holds, as an array (empty where that isn't sure).

    Optional items, lookarounds and groups with alternatives hold none; what stays of the pattern is what every match
    goes through, cut at all that isn't a literal character.
    """
    def sub(t, pattern, by):
        return F.regexp_replace(t, f"(?s){pattern}", by)
    inner = f"[^{_OPENS}{CLOSE}]*"
    t = sub(scanned["out"], f"{NAMED}[^{NAME_END}]*{NAME_END}", CAPTURE)
    t = sub(t, f"([{MAYBE}{MORE}])[{MAYBE}{MORE}]", "$1")
    for _ in range(_DEPTH):
        t = sub(t, f"{LOOK}{inner}{CLOSE}[{MAYBE}{MORE}]?", BREAK)
        t = sub(t, f"[{CAPTURE}{GROUP}]{inner}{CLOSE}{MAYBE}", BREAK)
        t = sub(t, f"[{CAPTURE}{GROUP}][^{_OPENS}{CLOSE}{OR}]*{OR}{inner}{CLOSE}{MORE}?", BREAK)
        t = sub(t, f"[{CAPTURE}{GROUP}]({inner}){CLOSE}{MORE}", f"{BREAK}$1{BREAK}")
        t = sub(t, f"[{CAPTURE}{GROUP}]({inner}){CLOSE}(?![{MAYBE}{MORE}])", "$1")
    sure = ~t.rlike(f"[{_OPENS}{CLOSE}{OR}{UNSURE}]")
    t = sub(sub(t, f".{MAYBE}", BREAK), f"(.){MORE}", f"$1{BREAK}")
    runs = F.filter(F.split(t, f"[{_MARKERS}]+"), lambda r: r != "")
    return F.when(sure, runs).otherwise(F.array().cast("array<string>"))

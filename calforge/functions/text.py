"""String helpers with Python ``str`` semantics, as native Spark expressions.

Spark's ``trim`` only removes U+0020 and Java's ``\\s`` misses most Unicode blanks,
so the whitespace and line-break sets are spelled out. The patterns use only the
syntax shared by Java regex and RE2 (``\\A``, ``\\z``, ``\\x{..}``, no backreferences),
so the same pattern text drives the DuckDB oracle (``*_sql`` helpers).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip()/str.isspace() treat as whitespace.
WS_CHARS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

WS = f"[{WS_CHARS}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# The same set as plain characters, and the line boundaries of str.splitlines()
# other than '\n' (for trim/translate, which need no regex).
WS_STRING = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
             + "\u2028\u2029\u202f\u205f\u3000")
BREAKS_NOT_LF = "\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"


def _sql_str(chars: str) -> str:
    return " || ".join(f"chr({ord(ch)})" for ch in chars)


def ustrip(col) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace. ``trim`` with an
    explicit character set only looks at the two ends (no regex scan)."""
    return F.trim(_c(col), F.lit(WS_STRING))


def ustrip_sql(expr: str) -> str:
    return f"trim({expr}, {_sql_str(WS_STRING)})"


def normalise_lines(col, split_double_space: bool = True) -> Column:
    """splitlines -> strip -> (split on two blanks -> strip) -> drop empty -> join '\n'.

    Every line boundary becomes '\n' with ``translate`` (a CRLF becomes two breaks,
    i.e. one extra empty line, which is dropped anyway), two blanks become '\n' with
    a literal ``replace`` (same left-to-right pieces as ``split('  ')``), then one
    literal split, a ``trim`` per piece and a filter of empties. Equal to the
    piecewise form because pieces only lose blanks at their ends. No regex runs.
    """
    t = F.translate(_c(col), BREAKS_NOT_LF, "\n" * len(BREAKS_NOT_LF))
    if split_double_space:
        t = F.replace(t, F.lit("  "), F.lit("\n"))
    pieces = F.transform(F.split(t, "\n"), lambda x: F.trim(x, F.lit(WS_STRING)))
    return F.array_join(F.filter(pieces, lambda x: x != ""), "\n")


def normalise_lines_sql(expr: str, split_double_space: bool = True) -> str:
    t = f"translate({expr}, {_sql_str(BREAKS_NOT_LF)}, {_sql_str(chr(10) * len(BREAKS_NOT_LF))})"
    if split_double_space:
        t = f"replace({t}, '  ', chr(10))"
    return (f"array_to_string(list_filter(list_transform(string_split({t}, chr(10)), "
            f"lambda x: trim(x, {_sql_str(WS_STRING)})), lambda x: x <> ''), chr(10))")


def ics_escape(col, newlines: bool = False) -> Column:
    """Calendar text escape: ',' -> '\\,' and ';' -> '\\;' (literal, backslash kept as is);
    with ``newlines`` a line feed first becomes the two characters '\\n'."""
    c = _c(col)
    if newlines:
        c = F.replace(c, F.lit("\n"), F.lit("\\n"))
    c = F.replace(c, F.lit(","), F.lit("\\,"))
    return F.replace(c, F.lit(";"), F.lit("\\;"))


def ics_escape_sql(expr: str, newlines: bool = False) -> str:
    if newlines:
        expr = f"replace({expr}, chr(10), '\\n')"
    return f"replace(replace({expr}, ',', '\\,'), ';', '\\;')"


def capitalize(col) -> Column:
    """``str.capitalize()`` for one word: first letter upper, the rest lower."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def contains_ci(column: Column, text: str | None) -> Column:
    """Case-insensitive substring; ``%`` and ``_`` inside the text act as wildcards, and a
    backslash takes that from them. Before any other character a backslash means nothing."""
    if not text:
        return F.lit(True)
    pattern = re.sub(r"\\(.)", lambda m: m[0] if m[1] in "%_\\" else m[1], f"%{text}%", flags=re.DOTALL)
    return column.ilike(pattern)


# White space by Unicode (U+0085 and the separators, general category Z), and the
# control characters that count as such.
_BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
           "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
           "\u2028\u2029\u202f\u205f\u3000")


def stripped(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.trim(text, F.lit(_BLANKS))


def normal_code(code: Column) -> Column:
    """Upper-case, stripped code used for comparison only; a missing code reads as NAN."""
    return F.coalesce(F.upper(stripped(code)), F.lit("NAN"))


def percent(share: Column, digits: int) -> Column:
    """Percentage text; a tie goes to the even digit."""
    return F.format_string(f"%.{digits}f%%", F.bround(share * 100, digits))


def won(amount: Column) -> Column:
    return F.concat(F.lit("₩"), F.format_number(amount, 0))


def container_name(raw: Column) -> Column:
    """Name without the leading slash; empty where there is no slash in front."""
    return F.regexp_extract(raw, "^/(.*)$", 1)


def matches_fully(column: Column, pattern: str) -> Column:
    return column.rlike(f"^(?:{pattern})$")


# In a coded text a backslash is always followed by one of these letters, never by another
# backslash, so each code can be undone on its own, that of the backslash last.
_CODES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))

_EMPTY = "\\e"


def escaped(text: Column) -> Column:
    """Line breaks and backslashes as two plain characters, so that a row stays on one line, and
    two for the empty text, which some formats take for none."""
    for plain, code in _CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return F.when(text == "", F.lit(_EMPTY)).otherwise(text)


def unescaped(text: Column) -> Column:
    """The opposite of ``escaped``, whatever characters the text has."""
    out = text
    for plain, code in reversed(_CODES):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return F.when(text == _EMPTY, "").otherwise(out)

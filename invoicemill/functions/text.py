"""Text helpers: one regex dialect, one notion of white space, one notion of missing."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

# All code points that count as white space when a value is stripped, and all decimal digits.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
_DIGITS = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_DIGITS_FROM = "".join(_DIGITS)
_DIGITS_TO = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def rx(pattern: str, *, ignore_case: bool = False, dot_all: bool = False, by_line: bool = False) -> str:
    """JVM form of a pattern: Unicode classes, and only ``\\n`` ends a line.

    Letters of a word are L*, N* and the underscore; white space includes U+001C-U+001F.
    With ``by_line`` the pattern is applied to each line of the text: ``^`` and ``$`` are line
    ends and white space never reaches into the next line.
    """
    space = r"[[\s\x1c-\x1f]&&[^\n]]" if by_line else r"[\s\x1c-\x1f]"
    body = pattern.replace(r"\w", r"[\p{L}\p{N}_]").replace(r"\s", space)
    return f"(?dU{'i' if ignore_case else ''}{'s' if dot_all else ''}{'m' if by_line else ''}){body}"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """NULL for empty text. Unlike ``nullif`` this evaluates ``c`` once inside conditions, too."""
    return F.get(F.array_remove(F.array(c), F.lit("")), F.lit(0))


def find(c: Column, pattern: str, group: int = 1, **flags) -> Column:
    """Stripped group of the first match; NULL where nothing (or only blanks) matched."""
    return blank_to_null(strip(F.regexp_extract(c, rx(pattern, **flags), group)))


def find_first(c: Column, patterns: list[str], **flags) -> Column:
    return F.coalesce(*[find(c, p, **flags) for p in patterns])


_NOT_SPACE = r"[^\s\x1c-\x1f]"


def filled_lines(c: Column, unless: str = "", until: str = "") -> Column:
    """Stripped lines of a text that are not blank, in order.

    ``unless``: pattern that must not match at the first character of a line;
    ``until``: pattern that the line must end with.
    """
    guard = f"(?!{unless})" if unless else ""
    body = f"({guard}{_NOT_SPACE}.*{until})\\s*$" if until else f"({guard}{_NOT_SPACE}(?:.*{_NOT_SPACE})?)"
    # _NOT_SPACE is in the dialect of the JVM already, so only the rest is translated.
    pattern = rx(r"^\s*" + body.replace(_NOT_SPACE, "\0"), by_line=True).replace("\0", _NOT_SPACE)
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(1))


def short_runs(c: Column) -> Column:
    """A text with long runs of blanks and of rule signs cut short, and box-drawing rules as ``=``, which leaves most invoices in ASCII and at half their length.

    A run of eight or more blanks keeps two at least, one of rule signs at least one. For patterns that neither return such signs nor count them beyond one blank.
    """
    for sign in "─═":
        c = F.replace(F.replace(c, F.lit(sign * 20), F.lit("=")), F.lit(sign), F.lit("="))
    return F.replace(c, F.lit(" " * 8), F.lit("  "))


def ascii_digits(c: Column) -> Column:
    """Decimal digits of any script as 0-9, so that they can be cast."""
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, _DIGITS_FROM, _DIGITS_TO))


def truthy(c: Column, kind: str = "text") -> Column:
    """Neither NULL nor empty (text) nor zero (number)."""
    if kind == "number":
        return F.coalesce(c != 0, F.lit(False))
    return F.coalesce(c != "", F.lit(False))


def present(c: Column) -> Column:
    return c.isNotNull()

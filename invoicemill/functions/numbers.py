"""Money and number helpers. Money is DECIMAL from the moment it leaves the text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.text import ascii_digits

MONEY = "decimal(12,2)"
QUANTITY = "decimal(10,2)"
PARSED_QUANTITY = "decimal(18,6)"
TAX_RATE = "decimal(10,8)"


def parse_number(c: Column, as_type: str) -> Column:
    """Digits with thousands commas to a number; NULL for NULL, junk and overflow."""
    return F.replace(ascii_digits(c), F.lit(","), F.lit("")).try_cast(as_type)


def parse_currency(c: Column) -> Column:
    """``$1,234.5`` and the like to DECIMAL(12,2); junk, empty text and overflow are NULL."""
    bare = F.regexp_replace(c, fv.CURRENCY_SYMBOLS_PATTERN, "")
    return F.regexp_replace(bare, fv.OUTER_SPACE_PATTERN, "").try_cast(MONEY)


def float_text(c: Column) -> Column:
    """A two-decimal amount the way a float prints: 226.80 as ``226.8``, 200.00 as ``200.0``."""
    return F.regexp_replace(c.cast(MONEY).cast("string"), "0$", "")


def money_text(c: Column) -> Column:
    """``1,234.56``"""
    return F.format_number(c, 2)


def general_text(c: Column) -> Column:
    """Six significant digits without trailing zeros; powers of ten from a million up."""
    def plain(decimals: int) -> Column:
        shown = F.round(c, decimals).cast(f"decimal(30,{decimals})").cast("string")
        return F.regexp_replace(shown, r"\.?0+$", "") if decimals else shown

    text = F.when(c >= F.lit("999999.5").cast("decimal(18,6)"),
                  F.regexp_replace(F.format_string("%.5e", c.cast("double")), r"\.?0+e", "e"))
    for digits, floor in ((6, "99999.95"), (5, "9999.995"), (4, "999.9995"), (3, "99.99995"), (2, "9.999995")):
        text = text.when(c >= F.lit(floor).cast("decimal(18,6)"), plain(6 - digits))
    return text.when(c >= 1, plain(5)).otherwise(plain(6))


def sum_of(items: Column, field: str) -> Column:
    """Exact sum of one field over an array of structs; NULL counts as nothing."""
    return F.aggregate(items, F.lit(0).cast("decimal(24,2)"),
                       lambda acc, x: (acc + F.coalesce(x[field], F.lit(0).cast(MONEY))).cast("decimal(24,2)"))



"""The JVM form of every pattern finds what the pattern means, also in awkward text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.text import WHITESPACE, filled_lines, rx, strip
from invoicemill.operators import extract as ex

PIECES = ["Invoice", "invoıce", "INVOİCE", "Number", "No", "No.", "#", ":", " ", "  ", " ", "\t", "\n", "\r", " ",
          "\x1c", "\x85", "INV", "2026", "-", "1", "12", "٣", "é", "½", "Ⅷ", "á", "_", "PO", "P.O.", "MDOT", "Tax", "(", ")",
          "%", "$", ",", ".", ".00", "12.50", "1,000.25", "Subtotal", "ſubtotal", "TOTAL", "Amount Due", "DUE", "Bill To", "bill\nto",
          "K", "Date", "Due Date", "2026-01-15", "January 5, 2026", "x@y.co", "@", "a.b", "Rome", ", NY ", "13440", "(217) 555-0142",
          "2175550142", "=", "─", "══════════", "Description", "Qty", "Thank", "𝟙", "🙂"]

PATTERNS = [(p, 1, dict(ignore_case=True)) for p in (
    *fv.INVOICE_NUMBER_PATTERNS, *fv.PO_NUMBER_PATTERNS, fv.SUBTOTAL_PATTERN, fv.TAX_PATTERN, fv.TAX_WITH_RATE_PATTERN,
    fv.INVOICE_DATE_LABEL + fv.DATE_LABEL_GAP + fv.DATE_MONTH_NAME_FORM)]
PATTERNS += [(fv.TAX_WITH_RATE_PATTERN, 2, dict(ignore_case=True)), (fv.PHONE_PATTERN, 0, {}), (fv.EMAIL_PATTERN, 0, {}),
             (fv.CITY_STATE_ZIP_PATTERN, 1, {}), (fv.CITY_STATE_ZIP_PATTERN, 3, {}),
             (fv.BILL_TO_SPLIT_PATTERN, 0, dict(ignore_case=True)),
             (fv.BILL_TO_SECTION_PATTERN, 1, dict(ignore_case=True, dot_all=True)),
             (fv.ITEM_WIDE_PATTERN, 1, {}), (fv.ITEM_WIDE_PATTERN, 2, {}), (fv.ITEM_NARROW_PATTERN, 4, {}),
             ("^" + fv.TOTAL_PATTERN, 1, dict(ignore_case=True)), (fv.INVOICE_NUMBER_FORMAT, 0, {}),
             (fv.RULE_LINE_PATTERN, 0, {}), (fv.ITEM_SKIP_PATTERN, 0, dict(ignore_case=True))]


@pytest.fixture(scope="module")
def texts(spark):
    pick = random.Random(7)
    rows = ["".join(pick.choices(PIECES, k=pick.randint(1, 14))) for _ in range(4000)]
    # near misses of every shape are rare in random text, so some is built around the labels
    rows += [pick.choice(["Invoice No", "PO #", "Subtotal", "Tax (", "Total", "Bill To:\n", "Invoice Date", "Thing  2", ""])
             + "".join(pick.choices(PIECES, k=pick.randint(1, 6))) for _ in range(4000)]
    return spark.createDataFrame(list(enumerate(rows)), "id int, t string").repartition(8).cache()


def flags(options):
    return (re.IGNORECASE if options.get("ignore_case") else 0) | (re.DOTALL if options.get("dot_all") else 0)


def test_patterns(texts):
    columns = [F.regexp_extract("t", rx(p, **options), group).alias(f"c{n}") for n, (p, group, options) in enumerate(PATTERNS)]
    wrong, hits = [], 0
    for row in texts.select("t", *columns).collect():
        for n, (pattern, group, options) in enumerate(PATTERNS):
            match = re.search(pattern, row.t, flags(options))
            want = (match.group(group) or "") if match else ""
            hits += bool(match)
            if row[f"c{n}"] != want:
                wrong.append((pattern, row.t, want, row[f"c{n}"]))
    assert hits > 1000 and wrong == []


def test_guarded_patterns_find_the_same(texts):
    rows = texts.select("t", F.regexp_extract("t", rx(ex._EMAIL), 0).alias("email"),
                        F.regexp_extract("t", rx(ex._CITY), 1).alias("city")).collect()
    for row in rows:
        for name, pattern, group in (("email", fv.EMAIL_PATTERN, 0), ("city", fv.CITY_STATE_ZIP_PATTERN, 1)):
            match = re.search(pattern, row.t)
            assert row[name] == (match.group(group) if match else ""), (name, row.t)


def test_lines_and_strip(texts):
    for row in texts.select("t", filled_lines(F.col("t")).alias("lines"), strip(F.col("t")).alias("s")).collect():
        assert row.lines == [line.strip() for line in row.t.split("\n") if line.strip()]
        assert row.s == row.t.strip()


def test_whitespace_is_complete():
    assert set(WHITESPACE) == {c for c in map(chr, range(0x110000)) if re.fullmatch(r"\s", c)}

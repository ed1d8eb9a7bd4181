from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from invoicemill.functions.numbers import float_text, general_text, parse_currency
from invoicemill.operators import digest, extract as ex, validate as va
from invoicemill.operators.render import render
from tests.samples import EXPECTED, LARGE, PLAIN, invoice_text

WANTED = """DOCUMENT SUMMARY
========================================
Invoice Number:  INV-2026-041
Invoice Date:    January 20, 2026
Due Date:        February 19, 2026
Payment Terms:   Net 30
PO Reference:    PO-2026-0091

VENDOR
----------------------------------------
Name:    Harbor Paper Works
Address: 12 Quay Road, Portland, ME 04101
Phone:   (207) 555-0111
Email:   office@harborpaper.example.com

FINANCIAL SUMMARY
----------------------------------------
Subtotal:    $       93.00
Tax:         $        7.44  (8.00%)
==============================
TOTAL:       $      100.44  USD

LINE ITEMS (3 items)
----------------------------------------
  1. Envelopes C5 (box) — Qty: 4 x $11.25 = $45.00
  2. Letter Tray — Qty: 3 x $9.90 = $29.70
  3. Stapler — Qty: 1 x $18.30 = $18.30

  Highest value item: Envelopes C5 (box) ($45.00)

DATA QUALITY
----------------------------------------
Status: REVIEW NEEDED - Warnings present
Rules checked: 13
Passed: 12

Warnings (1):
  - Invoice date 2026-01-20 is outside expected range (2026-02-20 to 2027-03-22)

EXTRACTION QUALITY
----------------------------------------
Confidence: 100% (High)
Key fields extracted: 100%"""

EMPTY = """DOCUMENT SUMMARY
========================================

FINANCIAL SUMMARY
----------------------------------------

EXTRACTION QUALITY
----------------------------------------
Confidence: 0% (Low)
Key fields extracted: 0%"""


@pytest.fixture(scope="module")
def records(spark):
    texts = spark.createDataFrame([("plain", PLAIN), ("large", LARGE), ("empty", "")], "document_id string, raw_text string")
    return va.validate(ex.flatten(ex.extract(texts)), as_of="2027-02-20").cache()


def test_full_digest(records):
    got = {r.document_id: r.digest for r in records.select("document_id", digest.full()).collect()}
    assert got["plain"] == WANTED


def test_digest_of_nothing(records):
    got = records.where("document_id = 'empty'").select(digest.full(with_validation=False), digest.brief()).first()
    assert got.digest == EMPTY and got.digest_brief == "Invoice details not available"


def test_brief(records):
    got = {r.document_id: r.digest_brief for r in records.select("document_id", digest.brief()).collect()}
    assert got["large"] == "Invoice INV-2026-777 from Northwind Compute LLC for $32,578.92 dated Feb 10, 2026"


def test_insights(records):
    got = [(r.document_id, r.insight_number, r.kind, r.text) for r in digest.insights(records, ["document_id"]).orderBy("document_id", "insight_number").collect()]
    assert got == [
        ("large", 1, "top_spend", "Top spend: Rack Server 2U drives 79% of this invoice ($25,800.00 of $32,578.92)."),
        ("large", 2, "bulk_orders", "Bulk orders: 1500x Patch Cable 3m."),
        ("large", 3, "range", "Line items range from $1,146.00 to $25,800.00 (avg $10,032.00)."),
        ("plain", 1, "range", "Line items range from $18.30 to $45.00 (avg $31.00)."),
        ("plain", 2, "largest_item", "Largest item: Envelopes C5 (box) at $45.00.")]


def test_first_of_equal_items_wins(spark):
    items = "array(named_struct('description', 'a', 'amount', cast(5 as decimal(12,2))), named_struct('description', 'b', 'amount', cast(5 as decimal(12,2))))"
    row = spark.sql(f"select {items} as i").select(digest.largest_item(F.col("i"))["description"].alias("hi"),
                                                  digest.smallest_item(F.col("i"))["description"].alias("lo")).first()
    assert (row.hi, row.lo) == ("a", "a")


def test_bands(spark):
    rows = spark.createDataFrame([(0.9,), (0.89,), (0.7,), (0.69,)], "c double").select(digest.quality_band(F.col("c")).alias("b")).collect()
    assert [r.b for r in rows] == ["High", "Medium", "Medium", "Low"]


def test_render_gives_the_layout_back(spark):
    want = EXPECTED["plain"]
    row = {"document_id": "d", "invoice_number": want["invoice_number"], "invoice_date": want["invoice_date"],
           "due_date": want["due_date"], "po_number": want["po_number"], "subtotal": want["subtotal"], "tax_rate": want["tax_rate"],
           "tax_amount": want["tax_amount"], "total_amount": want["total_amount"], "line_item_count": 3}
    row |= {f"vendor_{n}": v for n, v in zip(("name", "address", "city", "state", "zip", "phone", "email"), want["vendor"])}
    row |= {f"bill_to_{n}": v for n, v in zip(("name", "address", "city", "state", "zip"), want["bill_to"])}
    headers = spark.createDataFrame([row]).withColumns(
        {c: F.col(c).cast("decimal(12,2)") for c in ("subtotal", "tax_amount", "total_amount")})
    lines = spark.createDataFrame([("d", n, i[0], i[1], i[2], i[3]) for n, i in enumerate(want["items"], 1)],
                                  "document_id string, line_number int, description string, quantity decimal(10,2), "
                                  "unit_price decimal(12,2), line_amount decimal(12,2)")
    assert render(headers, lines).first().raw_text == PLAIN


@pytest.mark.parametrize("text, amount", [
    ("$1,234.56", D("1234.56")), (" €12 ", D("12.00")), ("1.005", D("1.01")), ("", None), ("n/a", None),
    ("99999999999", None), ("¥-5.5", D("-5.50")), (None, None)])
def test_parse_currency(spark, text, amount):
    row = spark.createDataFrame([(text,)], "t string").select(parse_currency(F.col("t")).alias("a")).first()
    assert row.a == amount


def test_number_texts(spark):
    values = [1, 15, D("1000.5"), D("12345.67"), D("123456.78"), D("999999.4"), 1000000, 1234567, D("0.5"), D("0.05"), 0, 100]
    rows = spark.createDataFrame([(D(v),) for v in values], "v decimal(18,6)").select(general_text(F.col("v")).alias("g")).collect()
    assert [r.g for r in rows] == [f"{float(v):g}" for v in values]
    money = [D("226.80"), D("200.00"), D("0.05"), D("-1.10"), D("9999999999.99")]
    rows = spark.createDataFrame([(m,) for m in money], "v decimal(12,2)").select(float_text(F.col("v")).alias("g")).collect()
    assert [r.g for r in rows] == [str(float(m)) for m in money]

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from invoicemill.functions.text import short_runs
from invoicemill.operators import extract as x
from tests.samples import EXPECTED, LARGE, PLAIN


@pytest.fixture(scope="module")
def records(spark):
    texts = spark.createDataFrame(
        [("plain", PLAIN), ("large", LARGE), ("empty", ""), ("none", None)], "document_id string, raw_text string")
    return {r.document_id: r for r in x.extract(texts).collect()}


@pytest.mark.parametrize("name", ["plain", "large"])
def test_whole_record(records, name):
    got, want = records[name], EXPECTED[name]
    for field in ("invoice_number", "invoice_date", "due_date", "po_number", "subtotal", "tax_rate", "tax_amount",
                  "total_amount"):
        assert got[field] == want[field], field
    assert tuple(got.vendor) == want["vendor"]
    assert tuple(got.bill_to) == want["bill_to"]
    assert [tuple(i)[1:] for i in got.line_items] == want["items"]
    assert [i.line_number for i in got.line_items] == list(range(1, len(want["items"]) + 1))
    assert got.currency == "USD" and got.parse_confidence == 1.0 and got.key_field_rate == 1.0
    assert got.reject_reasons == []


@pytest.mark.parametrize("name", ["empty", "none"])
def test_empty_text(records, name):
    got = records[name]
    assert got.parse_confidence == 0.0 and got.key_field_rate == 0.0 and got.line_items == []
    assert got.invoice_number is None and got.vendor.name is None and got.bill_to.name is None


def one(spark, text, build):
    return spark.createDataFrame([(text,)], "t string").select(build(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize("text, want", [
    ("Invoice Notes apply", "tes"), ("invoice #ab_9-é", "ab_9-é"), ("INV 2026 12", "INV 2026 12"),
    ("Invoice : A77", "A77"), ("Invoice No. 456", "456"), ("Statement No. 9", None), ("ınvoıce no: X1", "X1"),
])
def test_invoice_number(spark, text, want):
    assert one(spark, text, x.invoice_number) == want


@pytest.mark.parametrize("text, want", [
    ("P.O. #ABC-123", "ABC-123"), ("support123 line", "port123"), ("MDOT 77-a", "MDOT 77-a"), ("nothing", None),
])
def test_po_number(spark, text, want):
    assert one(spark, text, x.po_number) == want


@pytest.mark.parametrize("text, want", [
    ("Invoice Date: 2026-01-15", date(2026, 1, 15)), ("INVOICE DATE 01/15/2026", date(2026, 1, 15)),
    ("Invoice Date: 01-15-2026", date(2026, 1, 15)), ("Invoice Date: January 15, 2026", date(2026, 1, 15)),
    ("Invoice Date: jan 5 2026", date(2026, 1, 5)), ("Invoice Date: May 5,\n 2026", date(2026, 5, 5)),
    ("Invoice Date: January 15,2026", None), ("Invoice Date: 2026-02-30", None),
    ("Invoice Date: 2026-02-30 Invoice Date: 03/01/2026", date(2026, 3, 1)),
    ("Invoice Date: 2026-02-30 Invoice Date: 2026-03-01", None), ("Invoice Date: 0000-01-01", None),
    ("Date: 2026-01-15", None), ("Invoice Date: ٢٠٢٦-٠١-١٥", date(2026, 1, 15)),
    ("Invoice Date: Smarch 5, 2026", None),
])
def test_invoice_date(spark, text, want):
    assert one(spark, text, x.invoice_date) == want


@pytest.mark.parametrize("text, want", [
    ("call (217) 555-0142 now", "(217) 555-0142"), ("217.555.0142", "217.555.0142"), ("2175550142", "2175550142"),
    ("217 555 0142", "217 555 0142"), ("217\n5550142", "217\n5550142"), ("555-0142", None),
])
def test_phone(spark, text, want):
    assert one(spark, text, x.phone) == want


@pytest.mark.parametrize("text, want", [
    ("to a.b+c@d-e.co.uk.", "a.b+c@d-e.co.uk"), ("x@y", None), ("bad@ then ok@z.io", "ok@z.io"),
    ("a@b@c.de", "b@c.de"), ("éa@b.cd", "a@b.cd"),
])
def test_email(spark, text, want):
    assert one(spark, text, x.email) == want


@pytest.mark.parametrize("text, want", [
    ("Springfield, IL 62704", ("Springfield", "IL", "62704")),
    ("12 Main St. Big Town , TX  78759-1234", ("Big Town", "TX", "78759-1234")),
    ("springfield, il 62704", (None, None, None)),
])
def test_city_state_zip(spark, text, want):
    assert tuple(one(spark, text, lambda c: F.struct(*x.city_state_zip(c)))) == want


@pytest.mark.parametrize("text, want", [
    ("Order Subtotal: 5.00", "5.00"), ("Subtotal: 5.00\nTotal: 6.00", "6.00"),
    ("Total 1.00 Amount Due: 2.00", "2.00"), ("  subtotal 4.00", None), ("Total 1.00", "1.00"),
    ("a Total: 3.00", "3.00"), ("Grand Total $1,234.50", "1,234.50"),
])
def test_total(spark, text, want):
    assert one(spark, text, x.total_text) == want


@pytest.mark.parametrize("text, want", [
    ("Tax (8.0%): 22.74", ("8.0", "22.74")), ("Sales Tax (7%) $1.00", ("7", "1.00")), ("Tax: 3.10", (None, "3.10")),
    ("Tax (8%) : 1.00", ("8", "1.00")), ("none", (None, None)),
])
def test_tax(spark, text, want):
    assert tuple(one(spark, text, lambda c: F.struct(*[v.alias(n) for v, n in zip(x.tax_texts(c), "ra")]))) == want


@pytest.mark.parametrize("line, want", [
    ("Widget  2  1.00  2.00", ("Widget", D(2), D("1.00"), D("2.00"))),
    ("Widget 2 $1.00 $2.00", ("Widget", D(2), D("1.00"), D("2.00"))),
    ("Cable, 3 m  1,000.5  0.10  100.05", ("Cable, 3 m", D("1000.5"), D("0.10"), D("100.05"))),
    ("A  2 1.00 2.00", ("A", D(2), D("1.00"), D("2.00"))),
    ("Odd\rname  1  1.00  1.00", ("Odd\rname", D(1), D("1.00"), D("1.00"))),
    ("Billing services  2  1.00  2.00", None), ("Item  2  1.00  2.00", None),
    ("PO box  1  1.00  1.00", None), ("Pot  1  1.00  1.00", ("Pot", D(1), D("1.00"), D("1.00"))),
    ("\t Widget\u00a0 2  1.00  2.00 \r", ("Widget", D(2), D("1.00"), D("2.00"))), ("Widget  2  1.00\n2.00", None),
    ("Widget 2.5 1.00 2.50", ("Widget 2.5", None, None, None)),
])
def test_line_item(spark, line, want):
    items = one(spark, line, lambda c: x.line_items(x.item_cells(c)))
    if want and want[1] is None:
        assert items == []
    else:
        assert [tuple(i)[1:] for i in items] == ([want] if want else [])


def test_vendor_lines(spark):
    text = "\n ==== \n\tInvoice \n ınvoıce\nINVOICE 7\n=-= x\n \u00a0\n─═\x1c\nAcme \x1d Ltd\u2003\n\r\nA\nInvoices"
    assert one(spark, text, x.vendor_lines) == ["INVOICE 7", "=-= x", "Acme \x1d Ltd", "A", "Invoices"]


def test_bill_to_needs_its_own_line_and_an_end(spark):
    text = spark.createDataFrame([(1, "Bill To: Acme"), (2, "Bill To:\nAcme\n1 St, Rome, NY 13440\n" + "-" * 10),
                                  (3, "Bill To:\nAcme\nInvoice Date: x"), (4, "Bill To:\nAcme\n")],
                                 "document_id int, raw_text string")
    got = {r.document_id: r.bill_to for r in x.extract(text).collect()}
    assert got[1].name is None and got[4].name is None
    assert tuple(got[2]) == ("Acme", "1 St, Rome, NY 13440", "Rome", "NY", "13440")
    assert got[3].name == "Acme"


def test_values_that_do_not_fit_are_rejected_not_lost(spark):
    text = spark.createDataFrame([("a", "Tax (150%): 1.00\nSubtotal: 99,999,999,999.00")],
                                 "document_id string, raw_text string")
    got = x.extract(text).first()
    assert got.tax_rate is None and got.tax_amount == D("1.00")
    assert got.reject_reasons == ["subtotal_out_of_range", "tax_rate_out_of_range"]


def test_confidence_of_a_partial_record(spark):
    text = spark.createDataFrame([("a", "Acme\nInvoice No: 77\nTotal: 5.00\nWidget  2  1.00  2.00\nSubtotal: 2.02")],
                                 "document_id string, raw_text string")
    got = x.extract(text).first()
    # 3 + 3 + 3 + 2 (items) + 1 (subtotal) of 21: a two-cent gap earns no bonus
    assert got.parse_confidence == round(12 / 21, 2)


def test_extraction_stays_narrow(spark):
    plan = x.extract(spark.createDataFrame([("a", "b")], "document_id string, raw_text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text


def test_default_amount(spark):
    row = spark.sql("select cast(5 as decimal(18,6)) q, cast(10 as decimal(12,2)) p, "
                    "cast(null as decimal(12,2)) a, cast(7 as decimal(12,2)) b").select(
        x.default_amount(F.col("q"), F.col("p"), F.col("a")).alias("x"),
        x.default_amount(F.col("q"), F.col("p"), F.col("b")).alias("y")).first()
    assert row.x == D("50.00") and row.y == D("7.00")


@pytest.mark.parametrize("gap", ["    ", " "])
def test_item_line_that_holds_the_cell_mark(spark, gap):
    line = f"Cable\x00 tie{gap}2{gap}3.50{gap}7.00"
    items = one(spark, line, lambda c: x.line_items(x.item_cells(c)))
    assert [tuple(i) for i in items] == [(1, "Cable\x00 tie", D(2), D("3.50"), D("7.00"))]
    assert one(spark, "no\x00thing costs 7.00", lambda c: x.line_items(x.item_cells(c))) == []


def test_items_are_worked_out_once(spark):
    """Spark must not push a filter that works the items out a second time below the projections."""
    texts = spark.createDataFrame([("a", "Widget  2  1.00  2.00\nGadget  1  3.00  3.00"), ("b", "no items"), ("c", None)], "document_id string, raw_text string")
    items = x.explode_items(x.extract(texts))
    assert [(r.document_id, r.line_number, r.description) for r in items.collect()] == [("a", 1, "Widget"), ("a", 2, "Gadget")]
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    once = x.extract(texts).select("line_items")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == once.count("regexp_extract_all") == 1


def test_fields_are_the_same_in_short_runs(spark):
    """Runs of blanks and rules are cut short for labelled fields; what they give, and where one blank counts, stays."""
    rule = "─" * 61 + "═" * 23
    texts = [PLAIN, f"Invoice Number:{' ' * 17}A-17\n{rule}TOTAL DUE:{' ' * 40}1,234.50{rule}\nPO{' ' * 8}1234\n{rule}",
             f"Subtotal:{' ' * 31}99.10 {rule}\n{' ' * 9}Subtotal TOTAL 5.00\nx{rule} Total{' ' * 8}:{' ' * 9}$7.25 ── 8.00\nTax (7.5%):{' ' * 16}1.00",
             f"INV{' ' * 8}2026{' ' * 8}12\nInvoice Date{' ' * 12}:{' ' * 9}March 5,{' ' * 8}2026\nDue Date: May{' ' * 8}5, 2026 {rule}", "", "TOTAL AMOUNT 3.00 total 4.00"]
    fields = {"number": x.invoice_number, "issued": x.invoice_date, "due": x.due_date, "po": x.po_number, "subtotal": x.subtotal_text, "total": x.total_text,
              "rate": lambda c: x.tax_texts(c)[0], "tax": lambda c: x.tax_texts(c)[1]}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    read = lambda c: [tuple(r) for r in df.select(*[f(c).alias(n) for n, f in fields.items()]).collect()]
    assert read(short_runs(F.col("t"))) == read(F.col("t"))
    assert df.select(F.max(F.length(short_runs(F.lit(rule + " " * 80)))).alias("n")).first().n < 60

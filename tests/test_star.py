"""Star schema, checks and reports on rows made for the purpose."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from invoicemill.operators import quality
from invoicemill.plans import reports
from invoicemill.plans.star import MARTS, build_star
from invoicemill.schemas import SILVER_INVOICES, SILVER_LINE_ITEMS
from invoicemill.sources.tables import stored_silver

T = dt.datetime


def invoice(key, vendor, total, status="passed", day=dt.date(2026, 1, 10), at=T(2026, 1, 10), **other):
    row = dict(document_id=key, vendor_name=vendor, vendor_address="1 St", vendor_city="Rome", vendor_state=" ny",
               vendor_zip="1", vendor_phone="p-" + key, vendor_email="A@B.C ", invoice_number="I" + key, invoice_date=day,
               due_date=day and day + dt.timedelta(30), po_number=None, subtotal=None if total is None else D(total),
               tax_amount=D("0.00"), total_amount=None if total is None else D(total), currency=" usd", parse_confidence=0.9,
               validation_status=status, parse_timestamp=at)
    return tuple((row | other).values())


def line(key, document, amount, number=1):
    return (key, document, number, " thing ", D(1), D("1.00"), None if amount is None else D(amount), 0.9)


@pytest.fixture(scope="module")
def silver(spark):
    invoices = [
        invoice("a", "Acme", "12000.00"), invoice("b", "ACME ", "50.00", at=T(2026, 1, 11), vendor_email=None),
        invoice("c", "acme", "70.00", at=T(2026, 1, 11)), invoice("d", "Bolt", "10000.00", "review_needed", day=None),
        invoice("e", "Bolt", "9.00", "failed"), invoice("f", "Coil", None, None), invoice("g", None, "5.00"),
        invoice("h", "Coil", None, subtotal=D("0.00"))]
    lines = [line("1", "a", "11000.00"), line("2", "a", "1000.00", 2), line("3", "a", "0.01", 3), line("4", "b", None),
             line("5", "e", "9.00"), line("6", "nowhere", "1.00"), line("7", "c", "70.00")]
    return spark.createDataFrame(invoices, SILVER_INVOICES), spark.createDataFrame(lines, SILVER_LINE_ITEMS)


@pytest.fixture(scope="module")
def star(silver):
    return build_star(*silver)


def test_staging(star):
    rows = {r.document_id: r for r in star.stg_parsed_invoices.collect()}
    assert set(rows) == set("abcdgh")
    assert (rows["a"].vendor_state, rows["a"].vendor_email, rows["a"].currency, rows["b"].vendor_name) == ("NY", "a@b.c", "USD", "ACME")
    assert {r.line_item_id for r in star.stg_parsed_line_items.collect()} == {"1", "2", "3", "4", "7"}


def test_cleaned(star):
    rows = {r.document_id: r for r in star.int_cleaned_invoices.collect()}
    assert rows["a"].vendor_id == rows["b"].vendor_id == rows["c"].vendor_id and rows["a"].payment_terms_days == 30
    assert {k: r.is_high_value for k, r in rows.items()} == dict(a=True, b=False, c=False, d=True, g=False, h=False)
    assert rows["h"].effective_tax_rate is None and rows["a"].effective_tax_rate == D("0.0000")
    assert rows["d"].payment_terms_days is None


def test_vendor_takes_the_latest_row_and_breaks_ties_by_document(star):
    acme = star.int_normalized_vendors.where("lower(vendor_name) = 'acme'").first()
    assert (acme.vendor_name, acme.vendor_phone, acme.document_count) == ("acme", "p-c", 3)


def test_keys(star):
    for table, key, order in (("dim_vendors", "vendor_key", "vendor_id"), ("dim_documents", "document_key", "document_id")):
        rows = getattr(star, table).orderBy(key).collect()
        assert [r[key] for r in rows] == list(range(1, len(rows) + 1))
        assert [r[order] for r in rows] == sorted(r[order] for r in rows)
    assert [r.line_item_key for r in star.fact_invoice_line_items.orderBy("line_item_key").collect()] == [1, 2, 3, 4, 5]


def test_summary(star):
    rows = star.fact_invoice_summary.join(star.dim_documents.select("document_key", "document_id"), "document_key").collect()
    got = {r.document_id: (r.total_line_items, r.avg_line_item_amount, r.max_line_item_amount, r.min_line_item_amount) for r in rows}
    assert got["a"] == (3, D("4000.00"), D("11000.00"), D("0.01"))
    assert got["b"] == (1, D("0.00"), D("0.00"), D("0.00")) and got["d"] == (0, D("0.00"), D("0.00"), D("0.00"))
    assert all(r.summary_key == r.document_key for r in rows)


def test_reports(star):
    k = reports.kpis(star.fact_invoice_summary, star.dim_vendors).first()
    assert (k.total_invoices, k.total_spend, k.num_vendors) == (6, D("22125.00"), 3)
    by_vendor = reports.spend_by_vendor(star.fact_invoice_summary, star.dim_vendors).collect()
    assert [tuple(r) for r in by_vendor] == [("Coil", D("0.00")), ("Bolt", D("10000.00")), ("acme", D("12120.00"))]
    assert [tuple(r) for r in reports.spend_by_date(star.fact_invoice_summary).collect()] == [(dt.date(2026, 1, 10), D("12125.00"))]
    newest = reports.summary_by_date(star.fact_invoice_summary, star.dim_vendors).collect()
    assert newest[0].invoice_date is None and len(newest) == 6
    top = reports.top_line_items(star.fact_invoice_line_items, star.dim_vendors).collect()
    assert [r.line_amount for r in top] == [None, D("11000.00"), D("1000.00"), D("70.00"), D("0.01")]
    assert top[1].vendor_name == "acme"


def test_loader_summary_skips_zero_and_null(silver, spark):
    invoices, lines = silver
    lines = lines.unionByName(spark.createDataFrame([line("8", "c", "0.00", 2)], SILVER_LINE_ITEMS))
    got = {r.document_id: r for r in reports.loader_summary(invoices, lines).collect()}
    assert (got["c"].total_line_items, got["c"].avg_line_item_amount) == (2, D("70.00"))
    assert (got["b"].total_line_items, got["b"].avg_line_item_amount, got["b"].max_line_item_amount) == (1, None, None)
    assert got["d"].total_line_items == 0 and "e" not in got


def test_recent_submissions(silver):
    rows = reports.recent_submissions(silver[0]).collect()
    assert [r["Invoice #"] for r in rows[:3]] == ["Ib", "Ic", "Ia"]
    by = {r["Invoice #"]: r for r in rows}
    assert by["If"]["Total"] == "--" and by["If"]["Status"] == "--" and by["Id"]["Invoice Date"] == "--"
    assert by["Ia"]["Total"] == "$12,000.00" and by["Ie"]["Status"] == "Needs Review"
    assert by["Ia"]["Submitted"] == "Jan 10, 2026 12:00 AM"


def test_checks_count_failures(silver, star, spark):
    invoices, lines = silver
    tables = {"parsed_invoices": invoices.unionByName(invoices.where("document_id in ('a', 'b')")),
              "parsed_line_items": lines} | vars(star)
    bad = star.dim_documents.withColumn("total_amount", F.when(F.col("document_id") == "a", D("1.00")).otherwise(F.col("total_amount")))
    report = quality.dq_report(tables | {"dim_documents": bad}).collect()
    assert len(report) == 32
    failures = {(r.check_name, r.model, r.column_name): r.failures for r in report if r.failures}
    assert failures == {
        ("unique", "parsed_invoices", "document_id"): 2, ("relationships", "parsed_line_items", "document_id"): 1,
        ("not_null", "stg_parsed_invoices", "vendor_name"): 1, ("not_null", "stg_parsed_invoices", "total_amount"): 1,
        ("not_null", "dim_vendors", "vendor_name"): 1, ("totals_match", "dim_documents", "total_amount"): 1}


def test_marts_are_written_and_silver_read_back(silver, star, spark, tmp_path):
    root = str(tmp_path)
    star.write(root)
    for name in MARTS:
        assert spark.read.parquet(f"{root}/gold/{name}").count() == getattr(star, name).count()
    silver[0].write.parquet(f"{root}/silver/parsed_invoices")
    silver[1].write.parquet(f"{root}/silver/parsed_line_items")
    again = stored_silver(spark, root)
    assert again[0].count() == 8 and again[1].count() == 7
    assert build_star(*again).fact_invoice_summary.count() == 6

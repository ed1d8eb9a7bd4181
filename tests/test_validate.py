from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from invoicemill.operators.extract import extract, flatten
from invoicemill.operators.validate import rule_results, rule_summary, validate
from tests.samples import LARGE, PLAIN

SCHEMA = ("document_id string, invoice_number string, vendor_name string, vendor_phone string, vendor_email string, "
          "invoice_date date, due_date date, subtotal decimal(12,2), tax_rate decimal(10,8), tax_amount decimal(12,2), "
          "total_amount decimal(12,2), line_item_count bigint, line_items_total decimal(24,2), line_items_missing bigint")
GOOD = dict(document_id="d", invoice_number="INV-1", vendor_name="Acme", vendor_phone="(217) 555-0142",
            vendor_email=None, invoice_date=date(2026, 1, 15), due_date=date(2026, 2, 14), subtotal=D("210.00"),
            tax_rate=D("0.08"), tax_amount=D("16.80"), total_amount=D("226.80"), line_item_count=2,
            line_items_total=D("210.00"), line_items_missing=0)
CASES = {
    # name: (changes, status, names of failed rules)
    "good": ({}, "passed", []),
    "no number": (dict(invoice_number=None), "failed", ["required_field"]),
    "empty number": (dict(invoice_number=""), "passed", []),
    "no vendor": (dict(vendor_name=None), "failed", ["required_field", "vendor_contact_info"]),
    "no total": (dict(total_amount=None), "failed", ["required_field"]),
    "no date": (dict(invoice_date=None), "review_needed", ["required_field"]),
    "odd number": (dict(invoice_number="INV 1"), "review_needed", ["invoice_number_format"]),
    "number with line end": (dict(invoice_number="INV-1\n"), "passed", []),
    "wrong total": (dict(total_amount=D("999.99")), "failed", ["total_matches_components"]),
    "two cents": (dict(total_amount=D("226.82")), "passed", []),
    "three cents": (dict(total_amount=D("226.83")), "failed", ["total_matches_components"]),
    "zero total": (dict(total_amount=D("0.00")), "passed", []),
    "wrong subtotal": (dict(subtotal=D("999.99")), "failed",
                       ["total_matches_components", "subtotal_matches_line_items", "tax_calculation"]),
    "no items": (dict(line_item_count=0, line_items_total=D("0.00")), "passed", []),
    "tax off": (dict(tax_amount=D("17.80"), total_amount=D("227.80")), "review_needed", ["tax_calculation"]),
    "old": (dict(invoice_date=date(2025, 1, 30)), "review_needed", ["date_range"]),
    "just new enough": (dict(invoice_date=date(2025, 1, 31)), "passed", []),
    "far ahead": (dict(invoice_date=date(2026, 3, 3), due_date=None), "review_needed", ["date_range"]),
    "due before": (dict(due_date=date(2026, 1, 14)), "review_needed", ["due_date_order"]),
    "negative": (dict(tax_amount=D("-1.00"), total_amount=D("209.00")), "failed",
                 ["tax_calculation", "amounts_positive"]),
    "item lacks amount": (dict(line_items_missing=1), "review_needed", ["line_items_complete"]),
    "no contact": (dict(vendor_phone="", vendor_email=None), "review_needed", ["vendor_contact_info"]),
    "nothing": ({k: None for k in GOOD if k != "document_id"}, "failed",
                ["required_field"] * 4 + ["vendor_contact_info"]),
}


@pytest.fixture(scope="module")
def judged(spark):
    rows = [tuple((GOOD | changes | {"document_id": name}).values()) for name, (changes, _, _) in CASES.items()]
    return validate(spark.createDataFrame(rows, SCHEMA), as_of="2026-01-31").cache()


@pytest.fixture(scope="module")
def by_name(judged):
    return {r.document_id: r for r in judged.collect()}


@pytest.mark.parametrize("name", CASES)
def test_status_and_failures(by_name, name):
    row = by_name[name]
    assert row.validation_status == CASES[name][1]
    assert [r.rule_name for r in row.rules if not r.passed] == CASES[name][2]
    assert len(row.rules) == 13


def test_messages(by_name):
    message = lambda case, rule: next(r for r in by_name[case].rules if r.rule_name == rule)
    total = message("wrong total", "total_matches_components")
    assert total.message == "Total (999.99) does not match subtotal + tax (226.8)"
    assert (total.expected, total.actual, total.severity) == ("226.8", "999.99", "error")
    assert message("good", "date_range").message == \
        "Invoice date 2026-01-15 is within expected range (2025-01-31 to 2026-03-02)"
    assert message("negative", "amounts_positive").message == "Negative amounts found: ['tax_amount']"
    assert message("item lacks amount", "line_items_complete").message == "1 of 2 line items have amounts"
    assert message("no items", "subtotal_matches_line_items").severity == "warning"


def test_views(judged):
    assert rule_results(judged).count() == 13 * len(CASES)
    row = rule_summary(judged).where(F.col("document_id") == "wrong subtotal").first()
    assert (row.total_rules, row.passed, row.errors, row.warnings) == (13, 10, 2, 1)


def test_samples_do_not_fail(spark):
    texts = spark.createDataFrame([("p", PLAIN), ("l", LARGE)], "document_id string, raw_text string")
    judged = validate(flatten(extract(texts)), as_of="2026-02-15")
    assert {r.validation_status for r in judged.collect()} == {"passed"}


def test_results_without_messages(spark):
    """Verdicts are the same without their messages, and the array is worked out apart from whole-stage code."""
    texts = [("1", PLAIN), ("2", LARGE), ("3", "nothing"), ("4", PLAIN.replace("INV-", "? ")), ("5", None)]
    rows = flatten(extract(spark.createDataFrame(texts, "document_id string, raw_text string")))
    whole, lean = (validate(rows, as_of="2026-03-01", messages=m) for m in (True, False))
    assert whole.schema["rules"].dataType.elementType.names[:3] == ["rule_name", "passed", "severity"] == lean.schema["rules"].dataType.elementType.names
    view = lambda df: sorted(df.select("document_id", "validation_status", F.transform("rules", lambda r: F.struct(r["rule_name"], r["passed"], r["severity"])).cast("string").alias("r")).collect())
    assert view(whole) == view(lean) and rule_summary(whole).exceptAll(rule_summary(lean)).isEmpty()
    assert "transform(array(" in whole.select("rules")._jdf.queryExecution().executedPlan().toString()

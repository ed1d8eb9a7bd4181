"""Business rules as columns: ten rules, thirteen results per invoice, one status.

A rule is a function of the limits that returns its results; add a rule by adding it to ``RULES``.
Input columns are those of the cleaned layer plus the aggregates ``line_item_count``,
``line_items_total`` (NULL and zero amounts count as nothing) and ``line_items_missing``, so
an invoice with very many lines is judged without gathering its lines.
"""

from __future__ import annotations

import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.numbers import MONEY, float_text
from invoicemill.functions.text import rx, truthy

_TEXT = "string"


class Result(NamedTuple):
    """One rule's verdict, apart from its full record, so that the status alone needs no messages."""
    rule: Column
    passed: Column
    severity: Column
    record: Column


def _result(rule: str, passed, severity: str, message: Column, field: str | None = None,
            expected: Column | None = None, actual: Column | None = None) -> Result:
    null = F.lit(None).cast(_TEXT)
    passed = F.lit(passed) if isinstance(passed, bool) else passed
    record = F.struct(F.lit(rule).alias("rule_name"), passed.alias("passed"), F.lit(severity).alias("severity"),
                      message.alias("message"), F.lit(field).cast(_TEXT).alias("field_name"),
                      (null if expected is None else expected).alias("expected"),
                      (null if actual is None else actual).alias("actual"))
    return Result(F.lit(rule), passed, F.lit(severity), record)


def _checked_if(possible: Column, checked: Result, rule: str, why_not: str) -> Result:
    """The check where it is possible; elsewhere a pass that says why it was skipped."""
    skipped = _result(rule, True, fv.WARNING, F.lit(why_not))
    return Result(*(F.when(possible, ours).otherwise(theirs) for ours, theirs in zip(checked, skipped)))


def _within(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(fv.AMOUNT_TOLERANCE).cast(MONEY)


def required_fields(as_of: Column) -> list[Result]:
    def check(label: str, column: str, required: bool) -> Result:
        found = F.col(column).isNotNull()
        state = F.when(found, "present").otherwise("missing")
        return _result("required_field", found, fv.ERROR if required else fv.WARNING,
                       F.concat(F.lit(f"{'Required' if required else 'Expected'} field '{label}' is "), state),
                       label, actual=state)
    return [check("invoice_number", "invoice_number", True), check("vendor.name", "vendor_name", True),
            check("total_amount", "total_amount", True), check("invoice_date", "invoice_date", False)]


def invoice_number_format(as_of: Column) -> list[Result]:
    number = F.col("invoice_number")
    fits = number.rlike(rx(fv.INVOICE_NUMBER_FORMAT))
    verdict = F.when(fits, "matches").otherwise("does not match")
    checked = _result("invoice_number_format", fits, fv.WARNING,
                      F.concat(F.lit("Invoice number '"), number, F.lit("' "), verdict, F.lit(" expected format")),
                      "invoice_number", actual=number)
    return [_checked_if(truthy(number), checked, "invoice_number_format",
                        "Invoice number not present, skipping format check")]


def _amount_rule(rule: str, severity: str, field: str, expected: Column, can_check: Column, skip: str,
                 message) -> list[Result]:
    actual = F.col(field)
    fits = _within(actual, expected)
    verdict = F.when(fits, "matches").otherwise("does not match")
    checked = _result(rule, fits, severity, message(float_text(actual), verdict, float_text(expected)), field,
                      float_text(expected), float_text(actual))
    return [_checked_if(can_check, checked, rule, skip)]


def total_matches_components(as_of: Column) -> list[Result]:
    expected = F.col("subtotal") + F.coalesce("tax_amount", F.lit(0).cast(MONEY))
    return _amount_rule(
        "total_matches_components", fv.ERROR, "total_amount", expected,
        truthy(F.col("total_amount"), "number") & truthy(F.col("subtotal"), "number"),
        "Cannot verify total (subtotal or total missing)",
        lambda a, v, e: F.concat(F.lit("Total ("), a, F.lit(") "), v, F.lit(" subtotal + tax ("), e, F.lit(")")))


def subtotal_matches_line_items(as_of: Column) -> list[Result]:
    return _amount_rule(
        "subtotal_matches_line_items", fv.ERROR, "subtotal", F.col("line_items_total"),
        truthy(F.col("line_item_count"), "number") & truthy(F.col("subtotal"), "number"),
        "Cannot verify subtotal (line items or subtotal missing)",
        lambda a, v, e: F.concat(F.lit("Subtotal ("), a, F.lit(") "), v, F.lit(" sum of line items ("), e, F.lit(")")))


def tax_calculation(as_of: Column) -> list[Result]:
    expected = F.round(F.col("subtotal") * F.col("tax_rate"), 2)
    return _amount_rule(
        "tax_calculation", fv.WARNING, "tax_amount", expected,
        truthy(F.col("tax_rate"), "number") & truthy(F.col("subtotal"), "number") & F.col("tax_amount").isNotNull(),
        "Cannot verify tax (rate, subtotal, or amount missing)",
        lambda a, v, e: F.concat(F.lit("Tax amount ("), a, F.lit(") "), v, F.lit(" expected ("), e, F.lit(")")))


def date_range(as_of: Column) -> list[Result]:
    day = F.col("invoice_date")
    oldest, newest = F.date_sub(as_of, fv.MAX_INVOICE_AGE_DAYS), F.date_add(as_of, fv.MAX_DAYS_AHEAD)
    inside = day.between(oldest, newest)
    message = F.concat(F.lit("Invoice date "), day.cast(_TEXT), F.lit(" is "),
                       F.when(inside, "within").otherwise("outside"), F.lit(" expected range ("),
                       oldest.cast(_TEXT), F.lit(" to "), newest.cast(_TEXT), F.lit(")"))
    checked = _result("date_range", inside, fv.WARNING, message, "invoice_date", actual=day.cast(_TEXT))
    return [_checked_if(day.isNotNull(), checked, "date_range", "No invoice date to validate")]


def due_date_order(as_of: Column) -> list[Result]:
    issued, due = F.col("invoice_date"), F.col("due_date")
    ordered = due >= issued
    message = F.concat(F.lit("Due date ("), due.cast(_TEXT), F.lit(") is "),
                       F.when(ordered, "on or after").otherwise("before"),
                       F.lit(" invoice date ("), issued.cast(_TEXT), F.lit(")"))
    checked = _result("due_date_order", ordered, fv.WARNING, message, "due_date")
    return [_checked_if(issued.isNotNull() & due.isNotNull(), checked, "due_date_order",
                        "Cannot compare dates (one or both missing)")]


def amounts_positive(as_of: Column) -> list[Result]:
    negative = F.concat_ws(", ", *[F.when(F.col(name) < 0, F.lit(f"'{name}'"))
                                   for name in ("subtotal", "tax_amount", "total_amount")])
    message = F.when(negative == "", "All amounts are positive").otherwise(
        F.concat(F.lit("Negative amounts found: ["), negative, F.lit("]")))
    return [_result("amounts_positive", negative == "", fv.ERROR, message)]


def line_items_complete(as_of: Column) -> list[Result]:
    missing, count = F.col("line_items_missing"), F.col("line_item_count")
    message = F.concat(F.when(missing == 0, "All").otherwise(F.concat(missing.cast(_TEXT), F.lit(" of"))),
                       F.lit(" "), count.cast(_TEXT), F.lit(" line items have amounts"))
    checked = _result("line_items_complete", missing == 0, fv.WARNING, message, "line_items")
    return [_checked_if(truthy(count, "number"), checked, "line_items_complete", "No line items to validate")]


def vendor_contact_info(as_of: Column) -> list[Result]:
    complete = truthy(F.col("vendor_name")) & (truthy(F.col("vendor_phone")) | truthy(F.col("vendor_email")))
    message = F.concat(F.lit("Vendor "), F.when(complete, "has").otherwise("missing"),
                       F.lit(" name and contact info"))
    return [_result("vendor_contact_info", complete, fv.WARNING, message, "vendor")]


RULES = [required_fields, invoice_number_format, total_matches_components, subtotal_matches_line_items,
         tax_calculation, date_range, due_date_order, amounts_positive, line_items_complete, vendor_contact_info]


def as_day(as_of: datetime.date | str | None) -> Column:
    """The day that date rules compare with: today unless given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def validate(invoices: DataFrame, as_of: datetime.date | str | None = None, rules=None, *, messages: bool = True) -> DataFrame:
    """Adds ``rules`` (array of results) and ``validation_status``: failed with any failed error,
    else review_needed with any failed warning, else passed. Without ``messages`` a result has its rule, verdict and severity only:
    Spark does not prune fields inside a filtered array, and the texts are nearly all of the work."""
    results = [result for rule in (rules or RULES) for result in rule(as_day(as_of))]
    failed = lambda severity: reduce(Column.__or__, (~r.passed & (r.severity == severity) for r in results))
    status = F.when(failed(fv.ERROR), fv.FAILED).when(failed(fv.WARNING), fv.REVIEW_NEEDED).otherwise(fv.PASSED)
    records = [r.record if messages else F.struct(r.rule.alias("rule_name"), r.passed.alias("passed"), r.severity.alias("severity")) for r in results]
    # A lambda keeps the array out of whole-stage code, where all messages make one method that is too long for the JVM to compile.
    return invoices.withColumns({"rules": F.transform(F.array(*records), lambda r: r), "validation_status": status})


# ---- views of the results ----

def failures(rules: Column, severity: str | None = None) -> Column:
    """Failed results, optionally of one severity only."""
    if severity is None:
        return F.filter(rules, lambda r: ~r.passed)
    return F.filter(rules, lambda r: ~r.passed & (r.severity == severity))


def rule_results(validated: DataFrame) -> DataFrame:
    """One row per rule result; ``rule_number`` keeps the order of the rules."""
    return validated.select("document_id", F.posexplode("rules").alias("rule_number", "result")).select(
        "document_id", (F.col("rule_number") + 1).alias("rule_number"), "result.*")


def rule_summary(validated: DataFrame) -> DataFrame:
    """Per invoice: status, number of rules, and how many passed, failed hard or warned."""
    count = lambda c: F.size(c).cast("bigint")
    return validated.select(
        "document_id", "invoice_number", F.col("validation_status").alias("status"),
        count(F.col("rules")).alias("total_rules"), count(F.filter("rules", lambda r: r.passed)).alias("passed"),
        count(failures(F.col("rules"), fv.ERROR)).alias("errors"),
        count(failures(F.col("rules"), fv.WARNING)).alias("warnings"))


def status_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("validation_status").agg(F.count("*").alias("invoices"))

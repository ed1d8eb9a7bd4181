"""Readable digests and insights, one expression per document.

Input: extracted records with flat party columns and the ``line_items`` array, and ``rules`` with
``validation_status`` where the digest shall report on data quality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.numbers import MONEY, general_text, money_text, sum_of
from invoicemill.functions.text import truthy
from invoicemill.operators.validate import failures




def right_align(c: Column, width: int) -> Column:
    return F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(width) - F.length(c), F.lit(0))), c)


def left_align(c: Column, width: int) -> Column:
    return F.concat(c, F.repeat(F.lit(" "), F.greatest(F.lit(width) - F.length(c), F.lit(0))))


def _line(condition: Column, *parts) -> Column:
    """Text when the condition holds, else NULL (which ``concat_ws`` skips)."""
    return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def _dollars(c: Column, width: int = 0) -> Column:
    text = money_text(c)
    return F.concat(F.lit("$"), right_align(text, width) if width else text)


def brief(name: str = "digest_brief") -> Column:
    """``Invoice X from V for $1,234.56 dated Jan 15, 2026`` with what there is."""
    text = F.concat_ws(
        " ",
        _line(truthy(F.col("invoice_number")), "Invoice ", F.col("invoice_number")),
        _line(truthy(F.col("vendor_name")), "from ", F.col("vendor_name")),
        _line(F.col("total_amount").isNotNull(), "for ", _dollars(F.col("total_amount"))),
        _line(F.col("invoice_date").isNotNull(), "dated ", F.date_format("invoice_date", "MMM dd, yyyy")))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("Invoice details not available")).alias(name)


def _header() -> Column:
    long_date = lambda name: F.date_format(name, "MMMM dd, yyyy")
    issued, due = F.col("invoice_date").isNotNull(), F.col("due_date").isNotNull()
    return F.concat_ws(
        "\n", F.lit("DOCUMENT SUMMARY"), F.lit("=" * 40),
        _line(truthy(F.col("invoice_number")), "Invoice Number:  ", F.col("invoice_number")),
        _line(issued, "Invoice Date:    ", long_date("invoice_date")),
        _line(due, "Due Date:        ", long_date("due_date")),
        _line(issued & due, "Payment Terms:   Net ", F.date_diff("due_date", "invoice_date").cast("string")),
        _line(truthy(F.col("po_number")), "PO Reference:    ", F.col("po_number")))


def _vendor() -> Column:
    filled = lambda name: F.nullif(F.col(name), F.lit(""))
    place = F.concat_ws(", ", filled("vendor_city"), filled("vendor_state"))
    place = F.when(place != "", F.concat_ws(" ", place, filled("vendor_zip")))
    address = F.concat_ws(", ", filled("vendor_address"), place)
    return F.when(truthy(F.col("vendor_name")), F.concat_ws(
        "\n", F.lit("VENDOR"), F.lit("-" * 40), F.concat(F.lit("Name:    "), F.col("vendor_name")),
        _line(address != "", "Address: ", address),
        _line(truthy(F.col("vendor_phone")), "Phone:   ", F.col("vendor_phone")),
        _line(truthy(F.col("vendor_email")), "Email:   ", F.col("vendor_email"))))


def _financial() -> Column:
    known = lambda name: F.col(name).isNotNull()
    percent = F.round(F.col("tax_rate") * 100, 2).cast("decimal(12,2)").cast("string")
    rate = F.coalesce(F.concat(F.lit("  ("), percent, F.lit("%)")), F.lit(""))
    return F.concat_ws(
        "\n", F.lit("FINANCIAL SUMMARY"), F.lit("-" * 40),
        _line(known("subtotal"), "Subtotal:    ", _dollars(F.col("subtotal"), 12)),
        _line(known("tax_amount"), "Tax:         ", _dollars(F.col("tax_amount"), 12), rate),
        _line(known("total_amount"), "=" * 30),
        _line(known("total_amount"), "TOTAL:       ", _dollars(F.col("total_amount"), 12), "  ", F.col("currency")))


def _value(item: Column) -> Column:
    return F.coalesce(item["amount"], F.lit(0).cast(MONEY))


def largest_item(items: Column) -> Column:
    """Item with the largest amount; the first one where several share it."""
    return F.array_max(F.transform(items, lambda i, n: F.struct(_value(i).alias("value"), (-n).alias("place"), i.alias("item"))))["item"]


def smallest_item(items: Column) -> Column:
    return F.array_min(F.transform(items, lambda i, n: F.struct(_value(i).alias("value"), n.alias("place"), i.alias("item"))))["item"]


def _items() -> Column:
    items = F.col("line_items")

    def line(item: Column, position: Column) -> Column:
        name = F.coalesce(F.nullif(item["description"], F.lit("")), F.lit("Unknown item"))
        head = F.concat(F.lit("  "), (position + 1).cast("string"), F.lit(". "), name)
        priced = F.concat(head, F.lit(" — Qty: "), general_text(item["quantity"]), F.lit(" x "),
                          _dollars(item["unit_price"]), F.lit(" = "), _dollars(item["amount"]))
        has_amount = truthy(item["amount"], "number")
        return (F.when(has_amount & truthy(item["quantity"], "number"), priced)
                .when(has_amount, F.concat(head, F.lit(" — "), _dollars(item["amount"]))).otherwise(head))

    top = largest_item(items)
    highest = _line(truthy(top["amount"], "number"), "\n  Highest value item: ", top["description"], " (",
                    _dollars(top["amount"]), ")")
    return F.when(F.size(items) > 0, F.concat_ws(
        "\n", F.concat(F.lit("LINE ITEMS ("), F.size(items).cast("string"), F.lit(" items)")), F.lit("-" * 40),
        F.array_join(F.transform(items, line), "\n"), highest))


def _quality() -> Column:
    rules = F.col("rules")
    label = F.coalesce(*[F.when(F.col("validation_status") == status, text)
                         for status, text in fv.STATUS_DIGEST_LABELS.items()], F.col("validation_status"))

    def listed(title: str, severity: str) -> Column:
        found = failures(rules, severity)
        return _line(F.size(found) > 0, f"\n{title} (", F.size(found).cast("string"), "):\n",
                     F.array_join(F.transform(found, lambda r: F.concat(F.lit("  - "), r["message"])), "\n"))

    return F.concat_ws(
        "\n", F.lit("DATA QUALITY"), F.lit("-" * 40), F.concat(F.lit("Status: "), label),
        F.concat(F.lit("Rules checked: "), F.size(rules).cast("string")),
        F.concat(F.lit("Passed: "), F.size(F.filter(rules, lambda r: r["passed"])).cast("string")),
        listed("Errors", fv.ERROR), listed("Warnings", fv.WARNING))


def quality_band(confidence: Column) -> Column:
    band = F
    for floor, name in fv.QUALITY_BANDS:
        band = band.when(confidence >= F.lit(float(floor)), name)
    return band.otherwise(fv.QUALITY_LOWEST)


def _confidence() -> Column:
    percent = lambda c: F.concat(F.bround(c * 100, 0).cast("int").cast("string"), F.lit("%"))
    score = F.col("parse_confidence")
    return F.concat_ws(
        "\n", F.lit("EXTRACTION QUALITY"), F.lit("-" * 40),
        F.concat(F.lit("Confidence: "), percent(score), F.lit(" ("), quality_band(score), F.lit(")")),
        F.concat(F.lit("Key fields extracted: "), percent(F.col("key_field_rate"))))


def full(with_validation: bool = True, name: str = "digest") -> Column:
    """Sections joined by a blank line; sections without content are left out."""
    sections = [_header(), _vendor(), _financial(), _items()]
    if with_validation:
        sections.append(_quality())
    return F.concat_ws("\n\n", *sections, _confidence()).alias(name)


def insights(records: DataFrame, keys: list[str]) -> DataFrame:
    """Up to three remarks per document, one row each, in fixed order."""
    items = F.col("line_items")
    priced = F.filter(items, lambda i: truthy(i["amount"], "number"))
    facts = records.where(F.size(priced) > 0).withColumns({
        "_top": largest_item(items), "_low": smallest_item(items), "_priced": F.size(priced),
        "_mean": (sum_of(items, "amount") / F.size(priced)).cast(MONEY),
    }).withColumn("_percent", F.when(
        truthy(F.col("total_amount"), "number"),
        F.col("_top.amount").cast("double") / F.col("total_amount").cast("double") * 100).otherwise(F.lit(0.0)))

    bulk = F.filter(items, lambda i: F.coalesce(i["quantity"] >= fv.BULK_QUANTITY, F.lit(False)))
    bulk_text = F.array_join(F.transform(
        bulk, lambda i: F.concat(general_text(i["quantity"]), F.lit("x "), i["description"])), ", ")
    dominant = F.col("_percent") > fv.TOP_SPEND_PERCENT
    total = F.when(truthy(F.col("total_amount"), "number"), _dollars(F.col("total_amount"))).otherwise(
        "an unspecified amount")
    remark = lambda kind, text: F.when(text.isNotNull(), F.struct(F.lit(kind).alias("kind"), text.alias("text")))
    remarks = F.array_compact(F.array(
        remark("top_spend", _line(dominant, "Top spend: ", F.col("_top.description"), " drives ",
                                  F.bround("_percent", 0).cast("bigint").cast("string"), "% of this invoice (",
                                  _dollars(F.col("_top.amount")), " of ", total, ").")),
        remark("bulk_orders", _line(F.size(bulk) > 0, "Bulk orders: ", bulk_text, ".")),
        remark("range", _line((F.col("_priced") > 1) & (F.col("_top.amount") != F.col("_low.amount")),
                              "Line items range from ", _dollars(F.col("_low.amount")), " to ",
                              _dollars(F.col("_top.amount")), " (avg ", _dollars(F.col("_mean")), ").")),
        remark("largest_item", _line(~dominant, "Largest item: ", F.col("_top.description"), " at ",
                                     _dollars(F.col("_top.amount")), "."))))
    return facts.select(*keys, F.posexplode(F.slice(remarks, 1, fv.MAX_INSIGHTS)).alias("_place", "_remark")).select(
        *keys, (F.col("_place") + 1).alias("insight_number"), "_remark.kind", "_remark.text")

"""Field extraction: the text of every document becomes columns. No shuffle, no Python in tasks.

``extract`` works in three projections: split the text, read the fields, score the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.dates import labelled_date
from invoicemill.functions.numbers import MONEY, PARSED_QUANTITY, QUANTITY, TAX_RATE, parse_number, sum_of
from invoicemill.functions.text import (
    filled_lines, find, find_first, present, rx, short_runs, strip, truthy,
)

# A hit can only begin where a run of its leading class begins. Saying so keeps the search
# linear in long runs and leaves the first hit the same.
_EMAIL = r"(?=[a-zA-Z0-9._%+\-])(?<![a-zA-Z0-9._%+\-])" + fv.EMAIL_PATTERN      # the look ahead is the cheaper one
_CITY = r"(?<![A-Za-z\s])" + fv.CITY_STATE_ZIP_PATTERN


# ---- single fields ----

def invoice_number(text: Column) -> Column:
    return find_first(text, fv.INVOICE_NUMBER_PATTERNS, ignore_case=True)


def invoice_date(text: Column) -> Column:
    return labelled_date(text, fv.INVOICE_DATE_LABEL)


def due_date(text: Column) -> Column:
    return labelled_date(text, fv.DUE_DATE_LABEL)


def po_number(text: Column) -> Column:
    return find_first(text, fv.PO_NUMBER_PATTERNS, ignore_case=True)


def phone(text: Column) -> Column:
    return find(text, fv.PHONE_PATTERN, 0)


def email(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("@")), find(text, _EMAIL, 0))


def city_state_zip(line: Column) -> list[Column]:
    return [find(line, _CITY, group).alias(name) for group, name in ((1, "city"), (2, "state"), (3, "zip"))]


def _city_line(lines: Column, start: int) -> Column:
    """First line from ``start`` (1-based) that holds a city which is not blank."""
    return F.get(F.filter(F.slice(lines, start, F.greatest(F.size(lines), F.lit(1))),
                          lambda line: F.contains(line, F.lit(",")) & find(line, _CITY, 1).isNotNull()), F.lit(0))


# ---- sections ----

def vendor_section(text: Column) -> Column:
    """What comes before the first ``Bill To``; the rest of the text is not copied."""
    return F.regexp_extract(text, rx(rf"^(.*?)(?:{fv.BILL_TO_SPLIT_PATTERN}|\z)", ignore_case=True, dot_all=True), 1)


def vendor_lines(section: Column) -> Column:
    """Lines of the section but for blank ones, rules and the title."""
    return filled_lines(section, unless=rf"{fv.RULE_LINE_PATTERN[1:-1]}\s*$|(?i:{fv.TITLE_LINE})\s*$")


def bill_to_lines(text: Column) -> Column:
    return filled_lines(F.regexp_extract(text, rx(fv.BILL_TO_SECTION_PATTERN, ignore_case=True, dot_all=True), 1))


def party(lines: Column, city_line: Column) -> list[Column]:
    return [F.get(lines, F.lit(0)).alias("name"), F.get(lines, F.lit(1)).alias("address"), *city_state_zip(city_line)]


# ---- money ----

def subtotal_text(text: Column) -> Column:
    return find(text, fv.SUBTOTAL_PATTERN, ignore_case=True)


def tax_texts(text: Column) -> tuple[Column, Column]:
    """(rate in percent, amount) as text; the form with a rate goes first."""
    rated = F.regexp_extract(text, rx(fv.TAX_WITH_RATE_PATTERN, ignore_case=True), 0)
    part = lambda group: find(rated, fv.TAX_WITH_RATE_PATTERN, group, ignore_case=True)
    return part(1), F.coalesce(part(2), find(text, fv.TAX_PATTERN, ignore_case=True))


def total_text(text: Column) -> Column:
    """First line that names a total and is no subtotal line; on that line the last amount so named.
    Lines without an amount are passed over first, as that is cheaper to see; so is the first letter of a name."""
    guards = rf"(?=.*\.\d{{2}})(?!\s*{fv.TOTAL_SKIP_PATTERN})"
    named = fv.TOTAL_PATTERN.replace(".*(?:TOTAL", ".*(?=[ta])(?:TOTAL", 1)
    return find(text, "^" + guards + named, ignore_case=True, by_line=True)


# ---- line items ----

_CELL_MARK = "\x00"
_CELLS = _CELL_MARK.join(f"${group}" for group in range(1, 5))


def _cells(line: Column, wide: Column) -> Column:
    """One pass per form where the mark cannot be met in the line; a line that holds it is taken group by group. ``wide``: the line after the first form."""
    narrow = F.regexp_replace(line, rx(fv.ITEM_NARROW_PATTERN), _CELLS)
    marked = F.split(F.when(wide != line, wide).otherwise(narrow), _CELL_MARK)
    by_group = lambda pattern: F.array(*[F.regexp_extract(line, rx(pattern), group) for group in range(1, 5)])
    apart = F.when(line.rlike(rx(fv.ITEM_WIDE_PATTERN)), by_group(fv.ITEM_WIDE_PATTERN)).when(
        line.rlike(rx(fv.ITEM_NARROW_PATTERN)), by_group(fv.ITEM_NARROW_PATTERN)).otherwise(F.array(line))
    return F.when(F.instr(line, _CELL_MARK) > 0, apart).otherwise(marked)


def item_cells(text: Column) -> Column:
    """[description, quantity, price, amount] as text for each line that is an item.

    Both item patterns end in a two-decimal amount, so only lines that do are taken from the
    text; the costly patterns see no others.
    """
    no_item = f"(?i:{fv.ITEM_HEADER_PATTERN}|{fv.ITEM_SKIP_PATTERN[1:]})"
    candidates = filled_lines(text, unless=no_item, until=r"\.\d{2}")
    skipped = lambda name: (F.length(name).isin(*{len(d) for d in fv.ITEM_SKIP_DESCRIPTIONS})
                            & F.lower(name).isin(fv.ITEM_SKIP_DESCRIPTIONS))
    # Lambdas work out what they name several times; the pass of the wide form is an element of its own.
    tried = F.transform(candidates, lambda line: F.struct(line.alias("line"), F.regexp_replace(line, rx(fv.ITEM_WIDE_PATTERN), _CELLS).alias("wide")))
    cells = F.transform(tried, lambda x: _cells(x["line"], x["wide"]))
    return F.filter(cells, lambda cells: (F.size(cells) == 4) & ~skipped(strip(cells[0])))


def line_items(cells: Column) -> Column:
    def item(cell: Column, position: Column) -> Column:
        quantity = parse_number(cell[1], PARSED_QUANTITY)
        price, amount = parse_number(cell[2], MONEY), parse_number(cell[3], MONEY)
        return F.struct((position + 1).alias("line_number"), strip(cell[0]).alias("description"),
                        quantity.alias("quantity"), price.alias("unit_price"), amount.alias("amount"))
    return F.transform(cells, item)


def default_amount(quantity: Column, unit_price: Column, amount: Column) -> Column:
    """A missing amount is quantity times price where both are known."""
    return F.coalesce(amount, F.round(quantity * unit_price, 2).cast(MONEY))


# ---- whole record ----

def confidence(*, number: Column, vendor_name: Column, total: Column, issued: Column, due: Column,
               item_count: Column, items_total: Column, bill_to_name: Column, po: Column,
               subtotal: Column, tax_amount: Column) -> Column:
    """Weighted share of the fields found, two decimals. Zero and empty count as missing,
    but a tax of zero counts as found."""
    found = {
        "invoice_number": truthy(number), "vendor_name": truthy(vendor_name),
        "total_amount": truthy(total, "number"), "invoice_date": present(issued), "due_date": present(due),
        "line_items": truthy(item_count, "number"), "bill_to_name": truthy(bill_to_name), "po_number": truthy(po),
        "subtotal": truthy(subtotal, "number"), "tax_amount": present(tax_amount),
    }
    weights = fv.CONFIDENCE_WEIGHTS
    score = sum((F.when(hit, weights[name]).otherwise(0) for name, hit in found.items()), F.lit(0))
    comparable = truthy(item_count, "number") & truthy(subtotal, "number")
    agrees = comparable & (F.abs(items_total - subtotal) < F.lit(fv.AMOUNT_TOLERANCE).cast(MONEY))
    bonus = weights["items_match_subtotal"]
    possible = F.lit(sum(weights[name] for name in found)) + F.when(comparable, bonus).otherwise(0)
    return F.round((score + F.when(agrees, bonus).otherwise(0)).cast("double") / possible.cast("double"), 2)


def key_field_rate(number: Column, issued: Column, vendor_name: Column, total: Column) -> Column:
    """Share of the four key fields that are not NULL."""
    return sum((c.isNotNull().cast("int") for c in (number, issued, vendor_name, total)), F.lit(0)) / F.lit(4.0)


def extract(documents: DataFrame, text: str = "raw_text") -> DataFrame:
    """Adds the invoice record to a DataFrame of document texts.

    Values that were found but do not fit (an amount beyond DECIMAL(12,2), a tax rate beyond
    100 %) leave the field NULL and are named in ``reject_reasons``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = documents.withColumns({
        "_section": vendor_section(body),
        "_short": short_runs(body),
    }).withColumns({
        "_vendor_lines": vendor_lines(F.col("_section")),
        "_bill_to_lines": bill_to_lines(body),
        "_cells": item_cells(body),
    })

    short = F.col("_short")
    rate_text, tax_text = tax_texts(short)
    read = split.withColumns({
        "_vendor_city_line": _city_line(F.col("_vendor_lines"), 3),
        "_bill_to_city_line": _city_line(F.col("_bill_to_lines"), 2),
        "_subtotal": subtotal_text(short), "_rate": rate_text, "_tax": tax_text,
        "_total": total_text(short),
        "line_items": line_items(F.col("_cells")),
    }).withColumns({
        "invoice_number": invoice_number(short),
        "invoice_date": invoice_date(short),
        "due_date": due_date(short),
        "po_number": po_number(short),
        "vendor": F.struct(*party(F.col("_vendor_lines"), F.col("_vendor_city_line")),
                           phone(F.col("_section")).alias("phone"), email(F.col("_section")).alias("email")),
        "bill_to": F.struct(*party(F.col("_bill_to_lines"), F.col("_bill_to_city_line"))),
        "subtotal": parse_number(F.col("_subtotal"), MONEY),
        "tax_amount": parse_number(F.col("_tax"), MONEY),
        "total_amount": parse_number(F.col("_total"), MONEY),
        "_rate_value": (parse_number(F.col("_rate"), "decimal(20,10)") / 100),
        "currency": F.lit(fv.DEFAULT_CURRENCY),
        "line_item_count": F.size("line_items").cast("bigint"),
        "line_items_total": sum_of(F.col("line_items"), "amount"),
        "line_items_missing": F.size(F.filter("line_items", lambda i: i.amount.isNull())).cast("bigint"),
    }).withColumn(
        "tax_rate", F.when(F.col("_rate_value") <= 1, F.col("_rate_value").try_cast(TAX_RATE)))

    unfit = lambda raw, value, reason: F.when(F.col(raw).isNotNull() & F.col(value).isNull(), reason)
    bad_item = F.exists("line_items", lambda i: i.quantity.try_cast(QUANTITY).isNull() | i.unit_price.isNull() | i.amount.isNull())
    scored = read.withColumns({
        "reject_reasons": F.array_compact(F.array(
            unfit("_subtotal", "subtotal", "subtotal_out_of_range"),
            unfit("_rate", "tax_rate", "tax_rate_out_of_range"),
            unfit("_tax", "tax_amount", "tax_amount_out_of_range"),
            unfit("_total", "total_amount", "total_amount_out_of_range"),
            F.when(bad_item, "line_item_out_of_range"))),
        "parse_confidence": confidence(
            number=F.col("invoice_number"), vendor_name=F.col("vendor.name"), total=F.col("total_amount"),
            issued=F.col("invoice_date"), due=F.col("due_date"), item_count=F.col("line_item_count"),
            items_total=F.col("line_items_total"), bill_to_name=F.col("bill_to.name"), po=F.col("po_number"),
            subtotal=F.col("subtotal"), tax_amount=F.col("tax_amount")),
        "key_field_rate": key_field_rate(F.col("invoice_number"), F.col("invoice_date"),
                                         F.col("vendor.name"), F.col("total_amount")),
    })
    return scored.drop(*[c for c in scored.columns if c.startswith("_") and c not in documents.columns])


def flatten(records: DataFrame) -> DataFrame:
    """The nested parties as the flat columns that the cleaned layer uses."""
    flat = {f"vendor_{n}": F.col(f"vendor.{n}") for n in ("name", "address", "city", "state", "zip", "phone", "email")}
    flat |= {f"bill_to_{n}": F.col(f"bill_to.{n}") for n in ("name", "address", "city", "state", "zip")}
    return records.withColumns(flat).drop("vendor", "bill_to")


def explode_items(records: DataFrame) -> DataFrame:
    """One row per line item, numbered from 1 in document order.

    An inner explode would let Spark infer a filter on the array and push it below the projections that work it out, so that texts are
    rewritten and read a second time for it; items are never NULL, so the outer one with its empty rows dropped gives the same.
    """
    items = records.select("document_id", F.explode_outer("line_items").alias("item"))
    return items.where(F.col("item").isNotNull()).select("document_id", "item.*")

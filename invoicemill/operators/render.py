"""Invoice texts from structured rows, so that extraction can be tested against what went in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from invoicemill.functions.numbers import general_text, money_text
from invoicemill.operators.digest import left_align, right_align

# Rules, widths and wording of the text layout.
DOUBLE_RULE, THIN_RULE, THICK_RULE = "=" * 60, "─" * 60, "═" * 60
TITLE = " " * 24 + "INVOICE"
DESCRIPTION_WIDTH, QUANTITY_WIDTH, AMOUNT_WIDTH, LABEL_WIDTH = 35, 5, 12, 54
TABLE_HEAD = "Description                           Qty   Unit Price       Amount"
FOOT = "\nPayment Terms: Net 30\nThank you for your business!\n"


def item_line() -> Column:
    column = lambda text, width: F.concat(F.lit(" "), right_align(text, width))
    return F.concat(left_align(F.col("description"), DESCRIPTION_WIDTH),
                    column(general_text(F.col("quantity").cast("decimal(18,6)")), QUANTITY_WIDTH),
                    column(money_text(F.col("unit_price")), AMOUNT_WIDTH),
                    column(money_text(F.col("line_amount")), AMOUNT_WIDTH))


def _invoice_text(items: Column) -> Column:
    labelled = lambda label, name: F.concat(F.lit(f"{label:<17}"), F.col(name).cast("string"))
    place = lambda kind: F.concat(F.col(f"{kind}_city"), F.lit(", "), F.col(f"{kind}_state"), F.lit(" "),
                                  F.col(f"{kind}_zip"))
    amount = lambda label, name: F.concat(left_align(label, LABEL_WIDTH), F.lit(" "),
                                          right_align(money_text(F.col(name)), AMOUNT_WIDTH))
    rate = F.round(F.col("tax_rate") * 100, 2).cast("decimal(12,2)").cast("string")
    return F.concat_ws(
        "\n", *map(F.lit, ("", DOUBLE_RULE, TITLE, DOUBLE_RULE, "")),
        F.col("vendor_name"), F.col("vendor_address"), place("vendor"),
        F.concat(F.lit("Phone: "), F.col("vendor_phone")), F.concat(F.lit("Email: "), F.col("vendor_email")),
        *map(F.lit, ("", THIN_RULE, "", "Bill To:")),
        F.col("bill_to_name"), F.col("bill_to_address"), place("bill_to"), F.lit(""),
        labelled("Invoice Number:", "invoice_number"), labelled("Invoice Date:", "invoice_date"),
        labelled("Due Date:", "due_date"), labelled("PO Number:", "po_number"),
        *map(F.lit, ("", THIN_RULE, TABLE_HEAD, THIN_RULE)), items, F.lit(THIN_RULE),
        amount(F.lit("Subtotal:"), "subtotal"),
        amount(F.concat(F.lit("Tax ("), rate, F.lit("%):")), "tax_amount"), F.lit(THICK_RULE),
        amount(F.lit("TOTAL DUE:"), "total_amount"), F.lit(THICK_RULE), F.lit(FOOT))


def render(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """(document_id, raw_text): every invoice is one text, with all its lines in order."""
    texts = (lines.select("document_id", F.struct("line_number", item_line().alias("text")).alias("line"))
             .groupBy("document_id")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list("line")), lambda x: x["text"]), "\n").alias("_items")))
    return headers.join(texts, "document_id", "left").select("document_id", _invoice_text(F.col("_items")).alias("raw_text"))

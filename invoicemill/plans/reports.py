"""Dashboard queries. Everything is reduced on the cluster; only aggregates or a top-k leave it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.numbers import MONEY, money_text
from invoicemill.operators.hot_keys import join_to_unique

SPEND = "decimal(38,2)"


def _by_vendor(summary: DataFrame, vendors: DataFrame) -> DataFrame:
    """Invoices and spend per vendor: reduced by key first, named afterwards, so the join
    sees one row per vendor however many invoices one vendor has."""
    reduced = summary.groupBy("vendor_key").agg(F.count("*").alias("invoices"), F.sum("total_amount").alias("spend"))
    return reduced.join(vendors.select("vendor_key", "vendor_name"), "vendor_key", "left")


def kpis(summary: DataFrame, vendors: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return _by_vendor(summary, vendors).agg(
        F.coalesce(F.sum("invoices"), F.lit(0)).alias("total_invoices"),
        F.coalesce(F.sum("spend"), F.lit(0)).cast(SPEND).alias("total_spend"),
        distinct("vendor_name").alias("num_vendors"))


def spend_by_vendor(summary: DataFrame, vendors: DataFrame) -> DataFrame:
    return (_by_vendor(summary, vendors).where(F.col("vendor_name").isNotNull()).groupBy("vendor_name")
            .agg(F.coalesce(F.sum("spend"), F.lit(0)).cast(SPEND).alias("total_amount"))
            .orderBy("total_amount", "vendor_name"))


def spend_by_date(summary: DataFrame) -> DataFrame:
    day = summary.withColumn("invoice_date", F.col("invoice_date").try_cast("date"))
    return (day.where(F.col("invoice_date").isNotNull()).groupBy("invoice_date")
            .agg(F.coalesce(F.sum("total_amount"), F.lit(0)).cast(SPEND).alias("total_amount"))
            .orderBy("invoice_date"))


def summary_by_date(summary: DataFrame, vendors: DataFrame) -> DataFrame:
    """All invoices, newest first, undated ones on top. The document key breaks ties, which also lets the
    sort split a date that holds very many invoices."""
    named = join_to_unique(summary, vendors.select("vendor_key", "vendor_name"), "vendor_key", spread=["document_key"],
                           counts=vendors.select("vendor_key", F.col("document_count").alias("row_count")))
    return named.orderBy(F.desc_nulls_first("invoice_date"), "document_key").select(
        "document_key", "vendor_name", "total_amount", "subtotal", "tax_amount", "total_line_items", "invoice_date")


def top_line_items(line_facts: DataFrame, vendors: DataFrame) -> DataFrame:
    """The lines with the largest amounts. The cut comes before the join: five rows are broadcast."""
    top = line_facts.orderBy(F.desc_nulls_first("line_amount"), "line_item_key").limit(fv.TOP_LINE_ITEMS)
    named = vendors.select("vendor_key", "vendor_name").join(F.broadcast(top), "vendor_key", "right")
    return named.orderBy(F.desc_nulls_first("line_amount"), "line_item_key").select(
        "description", "quantity", "unit_price", "line_amount", "vendor_name")


def top_line_items_display(line_facts: DataFrame, vendors: DataFrame) -> DataFrame:
    return top_line_items(line_facts, vendors).withColumnsRenamed({
        "description": "Description", "quantity": "Qty", "unit_price": "Unit Price", "line_amount": "Amount",
        "vendor_name": "Vendor"})


def recent_submissions(invoices: DataFrame) -> DataFrame:
    """The ten latest submissions, formatted for display."""
    latest = invoices.orderBy(F.desc("parse_timestamp"), "document_id").limit(fv.RECENT_SUBMISSIONS)
    or_dashes = lambda c: F.coalesce(c, F.lit("--"))
    labels = F.create_map(*[F.lit(x) for pair in fv.STATUS_LIST_LABELS.items() for x in pair])
    status = F.col("validation_status")
    total = F.when(F.col("total_amount") != 0, F.concat(F.lit("$"), money_text(F.col("total_amount"))))
    return latest.select(
        F.col("invoice_number").alias("Invoice #"), F.col("vendor_name").alias("Vendor"),
        or_dashes(total).alias("Total"), or_dashes(F.col("invoice_date").cast("string")).alias("Invoice Date"),
        or_dashes(F.coalesce(F.try_element_at(labels, status), F.nullif(status, F.lit("")))).alias("Status"),
        or_dashes(F.date_format("parse_timestamp", "MMM dd, yyyy hh:mm a")).alias("Submitted"))


def loader_summary(invoices: DataFrame, line_items: DataFrame) -> DataFrame:
    """Per-document summary of the incremental load: mean and maximum skip amounts that are
    NULL or zero and are NULL where nothing is left (the star's summary says zero there)."""
    amount = F.nullif("line_amount", F.lit(0).cast(MONEY))
    per_document = line_items.groupBy("document_id").agg(
        F.count("*").alias("n"), F.round(F.avg(amount), 2).cast(MONEY).alias("avg_line_item_amount"),
        F.max(amount).alias("max_line_item_amount"))
    loaded = invoices.where(F.col("validation_status") != fv.FAILED)
    return loaded.join(per_document, "document_id", "left").select(
        "document_id", F.coalesce("n", F.lit(0)).alias("total_line_items"), "subtotal", "tax_amount", "total_amount",
        "avg_line_item_amount", "max_line_item_amount", "invoice_date")

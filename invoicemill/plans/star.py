"""Star schema over the cleaned layer: two staging, two intermediate and four mart tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.numbers import MONEY, QUANTITY
from invoicemill.operators.hot_keys import dense_numbers, join_to_unique
from invoicemill.operators.identity import vendor_id_star
from invoicemill.sources.order_tables import line_counts

VENDOR_COLUMNS = ["vendor_name", "vendor_address", "vendor_city", "vendor_state", "vendor_zip", "vendor_phone",
                  "vendor_email"]


def stg_parsed_invoices(invoices: DataFrame) -> DataFrame:
    """Headers that did not fail, trimmed and typed."""
    trimmed = lambda *cols: [F.trim(c).alias(c) for c in cols]
    return invoices.where(F.col("validation_status").isin(fv.ACCEPTED_STATUSES)).select(
        "document_id", *trimmed("vendor_name", "vendor_address", "vendor_city"),
        F.upper(F.trim("vendor_state")).alias("vendor_state"), *trimmed("vendor_zip", "vendor_phone"),
        F.lower(F.trim("vendor_email")).alias("vendor_email"), *trimmed("invoice_number"),
        F.col("invoice_date").cast("date").alias("invoice_date"), F.col("due_date").cast("date").alias("due_date"),
        *trimmed("po_number"), "subtotal", "tax_amount", "total_amount",
        F.upper(F.trim("currency")).alias("currency"), "parse_confidence", "validation_status", "parse_timestamp")


def stg_parsed_line_items(line_items: DataFrame, staged_invoices: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Lines of the staged invoices."""
    kept = join_to_unique(line_items, staged_invoices.select("document_id"), "document_id",
                          spread=["line_item_id"], how="left_semi", counts=counts)
    return kept.select("line_item_id", "document_id", "line_number", F.trim("description").alias("description"),
                       F.col("quantity").cast(QUANTITY).alias("quantity"),
                       F.col("unit_price").cast(MONEY).alias("unit_price"),
                       F.col("line_amount").cast(MONEY).alias("line_amount"), "extraction_confidence")


def int_cleaned_invoices(staged_invoices: DataFrame) -> DataFrame:
    rate = F.when((F.col("subtotal") > 0) & F.col("tax_amount").isNotNull(),
                  F.round(F.col("tax_amount") / F.col("subtotal"), 4).cast("decimal(16,4)"))
    return staged_invoices.select(
        "document_id", *VENDOR_COLUMNS, vendor_id_star(F.col("vendor_name"), F.col("vendor_address")).alias("vendor_id"),
        "invoice_number", "invoice_date", "due_date", "po_number",
        F.date_diff("due_date", "invoice_date").alias("payment_terms_days"),
        "subtotal", "tax_amount", "total_amount", "currency", rate.alias("effective_tax_rate"),
        F.coalesce(F.col("total_amount") >= fv.HIGH_VALUE_AMOUNT, F.lit(False)).alias("is_high_value"),
        "parse_confidence", "validation_status", "parse_timestamp")


def int_normalized_vendors(cleaned: DataFrame) -> DataFrame:
    """Latest contact data and activity per vendor, in one aggregation that combines map-side:
    a vendor with a third of all invoices costs each task one row."""
    latest = F.max_by(F.struct(*VENDOR_COLUMNS), F.struct("parse_timestamp", "document_id"))
    return cleaned.groupBy("vendor_id").agg(
        latest.alias("latest"), F.min("invoice_date").alias("first_seen_date"),
        F.max("invoice_date").alias("last_seen_date"), F.count("*").alias("document_count"),
    ).select("vendor_id", "latest.*", "first_seen_date", "last_seen_date", "document_count")


def dim_vendors(vendors: DataFrame) -> DataFrame:
    now = F.current_timestamp().cast("timestamp_ntz")
    return dense_numbers(vendors, ["vendor_id"], "vendor_key").select(
        "vendor_key", *vendors.columns, now.alias("created_at"), now.alias("updated_at"))


def dim_documents(cleaned: DataFrame, vendors: DataFrame) -> DataFrame:
    keyed = join_to_unique(cleaned, vendors.select("vendor_id", "vendor_key"), "vendor_id", spread=["document_id"],
                           counts=vendors.select("vendor_id", F.col("document_count").alias("row_count")))
    rows = keyed.select(
        "document_id", "vendor_key", F.lit(fv.DOCUMENT_TYPE).alias("document_type"), "invoice_number", "invoice_date",
        "due_date", "po_number", "payment_terms_days", "subtotal", "tax_amount", "total_amount", "effective_tax_rate",
        "currency", "is_high_value", "parse_confidence", "validation_status",
        F.col("parse_timestamp").alias("upload_timestamp"))
    return dense_numbers(rows, ["document_id"], "document_key").select(
        "document_key", *rows.columns, F.current_timestamp().cast("timestamp_ntz").alias("created_at"))


def fact_invoice_line_items(staged_lines: DataFrame, documents: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    keyed = join_to_unique(staged_lines, documents.select("document_id", "document_key", "vendor_key"), "document_id",
                           spread=["line_item_id"], how="inner", counts=counts)
    rows = keyed.select("line_item_id", "document_key", "vendor_key", "line_number", "description", "quantity",
                        "unit_price", "line_amount")
    return dense_numbers(rows, ["line_item_id"], "line_item_key").select(
        "line_item_key", *[c for c in rows.columns if c != "line_item_id"],
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"))


def fact_invoice_summary(documents: DataFrame, line_items: DataFrame, key: str = "document_key") -> DataFrame:
    """One row per document. Lines are reduced before the join, so both sides are unique on ``key``
    (``document_key`` of the line facts or ``document_id`` of the staged lines: the same grain)."""
    per_document = line_items.groupBy(key).agg(
        F.count("*").alias("total_line_items"), F.avg("line_amount").alias("avg_amount"),
        F.max("line_amount").alias("max_amount"), F.min("line_amount").alias("min_amount"))
    or_zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return documents.join(per_document, key, "left").select(
        F.col("document_key").alias("summary_key"),   # dense and one row per document already
        "document_key", "vendor_key", or_zero("total_line_items").alias("total_line_items"),
        "subtotal", "tax_amount", "total_amount",
        F.round(or_zero("avg_amount"), 2).cast(MONEY).alias("avg_line_item_amount"),
        or_zero("max_amount").cast(MONEY).alias("max_line_item_amount"),
        or_zero("min_amount").cast(MONEY).alias("min_line_item_amount"),
        "invoice_date", "due_date", "payment_terms_days", "parse_confidence", "is_high_value",
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"))


MARTS = ["dim_vendors", "dim_documents", "fact_invoice_line_items", "fact_invoice_summary"]


@dataclass
class Star:
    stg_parsed_invoices: DataFrame
    stg_parsed_line_items: DataFrame
    int_cleaned_invoices: DataFrame
    int_normalized_vendors: DataFrame
    dim_vendors: DataFrame
    dim_documents: DataFrame
    fact_invoice_line_items: DataFrame
    fact_invoice_summary: DataFrame

    def write(self, root: str) -> None:
        """Full refresh of the four marts; the other models stay views."""
        for name in MARTS:
            getattr(self, name).write.mode("overwrite").parquet(f"{root}/gold/{name}")


    def save_tables(self, database: str) -> None:
        """The four marts as tables of a database in Spark's catalog, overwritten by each run, and the other models as views of this session."""
        for name in MARTS:
            getattr(self, name).write.mode("overwrite").saveAsTable(f"{database}.{name}")
        for name in vars(self):
            if name not in MARTS:
                getattr(self, name).createOrReplaceTempView(name)


def build_star(invoices: DataFrame, line_items: DataFrame) -> Star:
    counts = line_counts(invoices) if "line_item_count" in invoices.columns else None
    staged = stg_parsed_invoices(invoices)
    staged_lines = stg_parsed_line_items(line_items, staged, counts)
    cleaned = int_cleaned_invoices(staged)
    normalized = int_normalized_vendors(cleaned)
    vendors = dim_vendors(normalized)
    documents = dim_documents(cleaned, vendors)
    lines = fact_invoice_line_items(staged_lines, documents, counts)
    return Star(staged, staged_lines, cleaned, normalized, vendors, documents, lines,
                fact_invoice_summary(documents, lines))

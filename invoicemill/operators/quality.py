"""Data-quality checks over the layers: each check yields its number of failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.numbers import MONEY

UNIQUE = [
    ("parsed_invoices", "document_id"), ("parsed_line_items", "line_item_id"),
    ("stg_parsed_invoices", "document_id"), ("stg_parsed_line_items", "line_item_id"),
    ("int_cleaned_invoices", "document_id"), ("int_normalized_vendors", "vendor_id"),
    ("dim_vendors", "vendor_key"), ("dim_vendors", "vendor_id"),
    ("dim_documents", "document_key"), ("dim_documents", "document_id"),
    ("fact_invoice_line_items", "line_item_key"), ("fact_invoice_summary", "summary_key"),
]
NOT_NULL = [
    ("parsed_invoices", "document_id"), ("parsed_line_items", "line_item_id"), ("parsed_line_items", "document_id"),
    ("stg_parsed_invoices", "document_id"), ("stg_parsed_invoices", "vendor_name"),
    ("stg_parsed_invoices", "total_amount"),
    ("stg_parsed_line_items", "line_item_id"), ("stg_parsed_line_items", "document_id"),
    ("int_cleaned_invoices", "document_id"), ("int_normalized_vendors", "vendor_id"),
    ("dim_vendors", "vendor_key"), ("dim_vendors", "vendor_id"), ("dim_vendors", "vendor_name"),
    ("dim_documents", "document_key"), ("dim_documents", "document_id"),
    ("fact_invoice_line_items", "line_item_key"), ("fact_invoice_summary", "summary_key"),
]
ACCEPTED_VALUES = [("stg_parsed_invoices", "validation_status", fv.STATUS_VALUES)]
RELATIONSHIPS = [("parsed_line_items", "document_id", "parsed_invoices", "document_id")]
TOTALS_MATCH = ("dim_documents", "total_amount")


def _report(df: DataFrame, check: str, model: str, column: str) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                     F.col("failures").cast("bigint").alias("failures"))


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
            .where("n_records > 1"))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with their number of rows. Rows are counted per key before
    the join, so a key with very many rows weighs no more than any other."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    parents = parent.select(F.col(parent_column).alias("_parent"))
    return keys.join(parents, F.col(column) == F.col("_parent"), "left_anti")


def totals_mismatch(documents: DataFrame) -> DataFrame:
    """Documents whose total differs from subtotal plus tax by more than the tolerance."""
    zero = F.lit(0).cast(MONEY)
    expected = F.coalesce("subtotal", zero) + F.coalesce("tax_amount", zero)
    difference = F.abs(F.col("total_amount") - F.col("expected_total"))
    known = F.col("subtotal").isNotNull() & F.col("tax_amount").isNotNull() & F.col("total_amount").isNotNull()
    return (documents.where(known)
            .select("document_key", "invoice_number", "subtotal", "tax_amount", "total_amount",
                    expected.alias("expected_total"))
            .withColumn("difference", difference)
            .where(F.col("difference") > F.lit(fv.AMOUNT_TOLERANCE).cast(MONEY)))


def _key_and_row_checks(df: DataFrame, model: str) -> DataFrame | None:
    """All checks of one table that need no other table, in one pass. Rows are reduced to one per value of each unique column
    (several columns of a row stand as (place, value) below each other), with the failures of row checks added up on the first of them."""
    unique = [c for m, c in UNIQUE if m == model]
    checks = [("not_null", c, F.col(c).isNull()) for m, c in NOT_NULL if m == model]
    checks += [("accepted_values", c, ~F.col(c).isin(values)) for m, c, values in ACCEPTED_VALUES if m == model]
    if not unique:
        return None
    failed = [F.coalesce(f, F.lit(False)).cast("bigint").alias(f"f{i}") for i, (_, _, f) in enumerate(checks)]
    names = [f"f{i}" for i in range(len(checks))]
    keys = ([F.lit(0).alias("which"), F.col(unique[0]).alias("key")] if len(unique) == 1 else
            [F.posexplode(F.array(*[F.col(c).cast("string") for c in unique])).alias("which", "key")])
    keyed = df.select(*failed, *keys)
    per_key = keyed.groupBy("which", "key").agg(F.count("*").alias("n"), *[F.sum(f).alias(f) for f in names])
    twice = [F.count_if((F.col("which") == i) & F.col("key").isNotNull() & (F.col("n") > 1)).alias(f"u{i}") for i in range(len(unique))]
    counted = per_key.agg(*twice, *[F.coalesce(F.sum(F.when(F.col("which") == 0, F.col(f))), F.lit(0)).alias(f) for f in names])
    found = [("unique", c, f"u{i}") for i, c in enumerate(unique)] + [(check, c, f) for (check, c, _), f in zip(checks, names)]
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                 F.col(f).cast("bigint").alias("failures")) for check, c, f in found])))


def dq_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check (check_name, model, column_name, failures)."""
    count = lambda df: df.agg(F.count("*").alias("failures"))
    parts = [r for r in (_key_and_row_checks(df, model) for model, df in tables.items()) if r is not None]
    parts += [_report(orphan_keys(tables[m], c, tables[pm], pc).agg(F.coalesce(F.sum("n_records"), F.lit(0))
                      .alias("failures")), "relationships", m, c) for m, c, pm, pc in RELATIONSHIPS]
    model, column = TOTALS_MATCH
    parts.append(_report(count(totals_mismatch(tables[model])), "totals_match", model, column))
    return reduce(DataFrame.unionByName, parts)

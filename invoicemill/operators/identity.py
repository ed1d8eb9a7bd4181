"""Business keys. All are functions of content, so a rerun gives the same ones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from invoicemill.functions.text import strip


def document_id(source_path: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\n", F.coalesce(source_path, F.lit("")), F.coalesce(text, F.lit(""))), 256),
                       1, 32)


def line_item_id(document: Column, line_number: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", document, line_number.cast("string")), 256), 1, 32)


def vendor_id_star(name: Column, address: Column) -> Column:
    """Key of the batch-built star: MD5 of the lower-cased, trimmed name and address."""
    part = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.md5(F.concat(part(name), F.lit("|"), part(address)))


def vendor_id_incremental(name: Column, address: Column) -> Column:
    """Key of the incrementally loaded vendors: sixteen hex digits of SHA-256."""
    part = lambda c: strip(F.lower(F.coalesce(c, F.lit(""))))
    return F.substring(F.sha2(F.concat(part(name), F.lit("|"), part(address)), 256), 1, 16)

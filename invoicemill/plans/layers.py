"""Raw, cleaned and dimensional layers: what a load writes, for a whole batch at once.

``Layers`` keeps its tables under one root folder. A load owns the ``batch_id=N`` partition of every append-only table and
overwrites it. The ids of all documents and the vendor dimension lie in hash parts: a load looks up the parts that its own rows touch and writes version N of those, made
from the last version before N, so what it reads does not grow with the number of loads. A load that is repeated, after a failure or on replay, leaves the same tables.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.functions.numbers import QUANTITY
from invoicemill.operators.edits import apply_edits
from invoicemill.operators.extract import extract, flatten
from invoicemill.operators.hot_keys import join_to_unique
from invoicemill.operators.identity import line_item_id, vendor_id_incremental
from invoicemill.operators.upsert import upsert_vendors
from invoicemill.operators.validate import failures, validate
from invoicemill.plans.reports import loader_summary
from invoicemill.schemas import SILVER_EXTRA, SILVER_INVOICES, SILVER_LINE_ITEMS, VENDOR_DIMENSION, names
from invoicemill.session import COMPACT, TEXT_GROUPS, freed_shuffles, written
from invoicemill.sources.files import rejected
from invoicemill.sources.hash_parts import PARTS, HashParts

BROADCAST_IDS = 200_000     # ids of 32 characters that are broadcast after they were counted (some 10 MB); more are joined by a shuffle


def as_timestamp(moment: datetime.datetime) -> Column:
    """Literal without a time zone (``lit`` of a datetime would shift it by the local zone)."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


# ---- rows of each table ----

def bronze(parse_results: DataFrame, ingested_at: Column) -> DataFrame:
    """Every document as it came, bad ones too; missing parts get their defaults."""
    have = lambda name, default: F.coalesce(F.col(name), default) if name in parse_results.columns else default
    as_json = lambda name, empty: (F.coalesce(F.to_json(name), F.lit(empty)) if name in parse_results.columns
                                   else F.lit(empty))
    path = F.col("source_path") if "source_path" in parse_results.columns else F.lit(None).cast("string")
    return parse_results.select(
        "document_id", have("file_name", F.lit("unknown")).alias("file_name"),
        have("file_type", F.lit("unknown")).alias("file_type"),
        have("file_size_bytes", F.lit(0)).cast("bigint").alias("file_size_bytes"),
        have("text", F.lit("")).alias("raw_text"), as_json("tables", "[]").alias("raw_tables_json"),
        as_json("metadata", "{}").alias("metadata_json"), ingested_at.alias("ingestion_timestamp"),
        path.alias("source_path"))


def parsed_documents(raw: DataFrame, parsed_at: Column, as_of: datetime.date | str | None = None) -> DataFrame:
    """Raw documents to extracted and judged records; narrow, one row in and one out."""
    return validate(flatten(extract(raw)), as_of).withColumn("parse_timestamp", parsed_at)


def silver_invoices(records: DataFrame) -> DataFrame:
    return records.select(*names(SILVER_INVOICES), *names(SILVER_EXTRA))


def silver_line_items(records: DataFrame) -> DataFrame:
    lines = records.select("document_id", "parse_confidence", F.explode("line_items").alias("item"))
    return lines.select(
        line_item_id(F.col("document_id"), F.col("item.line_number")).alias("line_item_id"), "document_id",
        F.col("item.line_number").alias("line_number"), F.col("item.description").alias("description"),
        F.col("item.quantity").try_cast(QUANTITY).alias("quantity"), F.col("item.unit_price").alias("unit_price"),
        F.col("item.amount").alias("line_amount"), F.col("parse_confidence").alias("extraction_confidence"))


def gold_accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col("validation_status") != fv.FAILED)


def gold_rejects(records: DataFrame) -> DataFrame:
    """Documents that may not enter the dimensional layer, with the messages of their errors."""
    return records.where(F.col("validation_status") == fv.FAILED).select(
        "document_id", "invoice_number", F.lit("validation_failed").alias("reason"),
        F.transform(failures(F.col("rules"), fv.ERROR), lambda r: r["message"]).alias("errors"))


def extraction_rejects(records: DataFrame) -> DataFrame:
    """Values found in a text that no column can hold."""
    return records.where(F.size("reject_reasons") > 0).select("document_id", F.explode("reject_reasons").alias("reason"))


def gold_documents(accepted: DataFrame, now: Column) -> DataFrame:
    return accepted.select(
        "document_id", vendor_id_incremental(F.col("vendor_name"), F.col("vendor_address")).alias("vendor_id"),
        F.lit(fv.DOCUMENT_TYPE).alias("document_type"), F.lit(None).cast("string").alias("file_name"),
        "invoice_number", "invoice_date", "due_date", "po_number", "subtotal", "tax_amount", "total_amount",
        "currency", "parse_confidence", now.alias("upload_timestamp"))


def gold_line_items(documents: DataFrame, line_items: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Line facts with the business keys of document and vendor."""
    keyed = join_to_unique(line_items, documents.select("document_id", "vendor_id"), "document_id",
                           spread=["line_item_id"], how="inner", counts=counts)
    return keyed.select("document_id", "vendor_id", "line_number", "description", "quantity", "unit_price", "line_amount")


def gold_summary(documents: DataFrame, accepted: DataFrame, line_items: DataFrame) -> DataFrame:
    vendors = documents.select("document_id", "vendor_id")
    return loader_summary(accepted, line_items).join(vendors, "document_id")


def load_status(records: DataFrame) -> DataFrame:
    """Outcome per document: loaded with its vendor id, or rejected with the reason."""
    failed = F.col("validation_status") == fv.FAILED
    return records.select(
        "document_id", F.when(failed, "rejected").otherwise("loaded").alias("status"),
        F.when(failed, "validation_failed").alias("reason"),
        F.when(~failed, vendor_id_incremental(F.col("vendor_name"), F.col("vendor_address"))).alias("vendor_id"))


# ---- loads ----

@dataclass
class Layers:
    spark: SparkSession
    root: str
    id_parts: int = PARTS
    vendor_parts: int = PARTS

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def ids(self) -> HashParts:
        """The ids of all documents that any load has taken, rejected ones too."""
        return HashParts(self.spark, self.path("index/document_ids"), "document_id", "document_id string", parts=self.id_parts)

    @property
    def vendors(self) -> HashParts:
        return HashParts(self.spark, self.path("state/dim_vendors"), "vendor_id", VENDOR_DIMENSION, parts=self.vendor_parts)

    def read(self, table: str) -> DataFrame:
        """A stored table with its ``batch_id`` (vendors: the latest version)."""
        return self.vendors.read() if table == "gold/dim_vendors" else self.spark.read.parquet(self.path(table))

    def _put(self, df: DataFrame, table: str, batch_id: int) -> DataFrame:
        path = f"{self.path(table)}/batch_id={batch_id}"
        with freed_shuffles(self.spark):
            df.write.mode("overwrite").options(**(TEXT_GROUPS if table == "bronze/raw_documents" else COMPACT)).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def load(self, parse_results: DataFrame, batch_id: int = 0, *, as_of: datetime.date | str | None = None,
             loaded_at: datetime.datetime | None = None, edits: DataFrame | None = None,
             dry_run: bool = False) -> dict[str, DataFrame]:
        """One load through all layers; returns what it wrote (with ``dry_run``: would write).

        A document that comes several times counts once, and documents that an earlier load has are left out, so vendors are
        counted once per document. Parse results with a ``reject_reason`` enter the raw layer like all others and ``rejects/files`` with the reason, and go no further.
        ``edits`` correct extracted fields after the rules ran.
        """
        at = as_timestamp(loaded_at or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None, microsecond=0))
        put = (lambda df, *_: df) if dry_run else self._put
        touched = self.ids.touched(parse_results)
        known = self.ids.lookup(touched, batch_id)
        # What is known of this load's parts is reduced to the ids of this load first. Known documents go first, so that fewer texts are brought together.
        seen = known.join(parse_results.select("document_id"), "document_id", "left_semi").distinct()
        parse_results = one_per_document(without(parse_results, seen))
        out = {}
        if "reject_reason" in parse_results.columns:
            bad = out["rejects/files"] = put(rejected(parse_results), "rejects/files", batch_id)
            everything = put(bronze(parse_results, at), "bronze/raw_documents", batch_id)
            raw = without(everything, bad.select("document_id"))
        else:
            everything = raw = put(bronze(parse_results, at), "bronze/raw_documents", batch_id)
        records = parsed_documents(raw, at, as_of).drop("raw_text")
        # Every table below is made from the records: a dry run keeps them as scratch too, or each would read all texts again.
        records = written(records, "dry-run-records", COMPACT) if dry_run else put(records, "work/parsed_documents", batch_id)
        if edits is not None:
            records = apply_edits(records, edits)
        out |= {"bronze/raw_documents": everything, "records": records}
        out["silver/parsed_invoices"] = put(silver_invoices(records), "silver/parsed_invoices", batch_id)
        lines = out["silver/parsed_line_items"] = put(silver_line_items(records), "silver/parsed_line_items", batch_id)
        out["rejects/extraction"] = put(extraction_rejects(records), "rejects/extraction", batch_id)
        out["rejects/gold"] = put(gold_rejects(records), "rejects/gold", batch_id)

        fit = gold_accepted(records)
        documents = out["gold/dim_documents"] = put(gold_documents(fit, at), "gold/dim_documents", batch_id)
        counts = records.select("document_id", F.col("line_item_count").alias("row_count"))
        out["gold/fact_invoice_line_items"] = put(
            gold_line_items(documents, lines, counts), "gold/fact_invoice_line_items", batch_id)
        out["gold/fact_invoice_summary"] = put(
            gold_summary(documents, fit, lines), "gold/fact_invoice_summary", batch_id)
        arrived = fit.select(vendor_id_incremental(F.col("vendor_name"), F.col("vendor_address")).alias("vendor_id"))
        parts = self.vendors.touched(arrived)
        current = self.vendors.lookup(parts, batch_id).select(*names(VENDOR_DIMENSION))
        vendors = upsert_vendors(current, fit, at.cast("date"), at)
        if dry_run:
            out["gold/dim_vendors"] = vendors
            return out
        self.vendors.replace(vendors, parts, batch_id)
        out["gold/dim_vendors"] = self.vendors.read(batch_id + 1)
        self.ids.add(everything.select("document_id"), self.ids.touched(everything), batch_id)
        return out


def without(rows: DataFrame, ids: DataFrame, *, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Rows whose document is not among ``ids``. A few ids are broadcast, so rows with their texts stay where they are."""
    ids = written(ids, "ids-left-out")
    n = ids.count()
    if not n:
        return rows
    some = F.broadcast(ids) if n <= broadcast_ids else ids
    some = some.withColumnRenamed("document_id", "_out")
    return rows.join(some, F.col("document_id").eqNullSafe(F.col("_out")), "left_anti")


def one_per_document(parse_results: DataFrame, *, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """One row per document_id; ids are hashes of content, so the rows of one id are copies. Where they differ, the smallest row stays.

    Only ids are counted. Rows of an id that comes once pass as they are; only those of the others are brought together.
    """
    repeated = parse_results.groupBy("document_id").agg(F.count("*").alias("n")).where("n > 1").select("document_id")
    repeated = written(repeated, "repeated-ids")
    n = repeated.count()
    if not n:
        return parse_results
    once = None
    rows = parse_results
    if n <= broadcast_ids:
        match = F.col("document_id").eqNullSafe(F.col("_again"))
        again = F.broadcast(repeated.withColumnRenamed("document_id", "_again"))
        once, rows = rows.join(again, match, "left_anti"), rows.join(again, match, "left_semi")
    others = [c for c in rows.columns if c != "document_id"]
    ordered = [f.name for f in rows.schema if f.name in others and f.dataType.typeName() != "map"]
    # A text is held and moved twice where the row and what it is ordered by are two values; only maps, which have no order, need that.
    least = F.min(F.struct(*others)) if ordered == others else F.min_by(F.struct(*others), F.struct(*ordered))
    kept = rows.groupBy("document_id").agg(least.alias("_row"))
    kept = kept.select("document_id", "_row.*").select(*parse_results.columns)
    return kept if once is None else once.unionByName(kept)


def run_counts(parse_results: DataFrame, records: DataFrame) -> DataFrame:
    """Counts of a run: documents found, parsed, extracted, and loaded into the dimensional layer."""
    found = parse_results.agg(
        F.count("*").alias("found"),
        (F.count_if(F.col("reject_reason").isNull()) if "reject_reason" in parse_results.columns
         else F.count("*")).alias("parsed"))
    loaded = records.agg(F.count("*").alias("extracted"),
                         F.count_if(F.col("validation_status") != fv.FAILED).alias("loaded"))
    counts = ("found", "parsed", "extracted", "loaded")
    return found.unionByName(loaded, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in counts])

"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicemill.functions import numbers
from invoicemill.operators import digest, edits, extract as ex, hot_keys, identity, quality, upsert, validate as va
from invoicemill.plans import layers, reports, star
from invoicemill.session import COMPACT, TEXT_GROUPS, new_folder, written
from invoicemill.sources import files, order_tables as ot, tables
from invoicemill.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
LOADED_AT = datetime.datetime(2001, 8, 1)
UPSERT_SPLIT = "2000-01-01"

_memo: dict[tuple, object] = {}


def _once(name: str, spark: SparkSession, sf_dir: str, build):
    """Build something once per application and data folder (stored tables that several reports read)."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _memo:
        _memo[key] = build()
    return _memo[key]


def _star(spark: SparkSession, sf_dir: str) -> star.Star:
    return _once("star", spark, sf_dir, lambda: star.build_star(*ot.silver(spark, sf_dir)))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted and judged records of the rendered corpus."""
    return _once("records", spark, sf_dir, lambda: written(
        va.validate(ex.flatten(ex.extract(ot.corpus(spark, sf_dir)[2])).drop("raw_text"), as_of=ot.AS_OF), "records", COMPACT))


def _read_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records where one query reads them: the landed ones if this application has them, else made from the texts, so that Spark leaves out what is not read."""
    landed = _memo.get(("records", spark.sparkContext.applicationId, sf_dir))
    return landed if landed is not None else va.validate(_extracted(spark, sf_dir), as_of=ot.AS_OF)


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with planted faults, judged by the rules, with every result whole. What reads less than that takes ``ot.judged_headers`` as it is, so that
    Spark leaves out what is not read."""
    return _once("judged", spark, sf_dir, lambda: written(ot.judged_headers(spark, sf_dir), "judged", COMPACT))


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop("created_at", "updated_at")


# ---- star schema ----

def stg_invoices(spark, sf_dir):
    return star.stg_parsed_invoices(ot.silver_headers(spark, sf_dir))


def stg_line_items(spark, sf_dir):
    invoices, lines = ot.silver(spark, sf_dir)
    return star.stg_parsed_line_items(lines, star.stg_parsed_invoices(invoices), ot.line_counts(invoices))


def int_cleaned(spark, sf_dir):
    return star.int_cleaned_invoices(stg_invoices(spark, sf_dir))


def vendors_latest(spark, sf_dir):
    return star.int_normalized_vendors(int_cleaned(spark, sf_dir))


def dim_vendors(spark, sf_dir):
    return _no_audit(star.dim_vendors(vendors_latest(spark, sf_dir)))


def dim_documents(spark, sf_dir):
    return _no_audit(star.dim_documents(int_cleaned(spark, sf_dir), dim_vendors(spark, sf_dir)))


def fact_line_items(spark, sf_dir):
    invoices, lines = ot.silver(spark, sf_dir)
    counts = ot.line_counts(invoices)
    staged = star.stg_parsed_line_items(lines, star.stg_parsed_invoices(invoices), counts)
    return _no_audit(star.fact_invoice_line_items(staged, dim_documents(spark, sf_dir), counts))


def fact_summary(spark, sf_dir):
    lines = ot.silver(spark, sf_dir)[1]
    return _no_audit(star.fact_invoice_summary(dim_documents(spark, sf_dir), lines, "document_id"))


# ---- reports ----

def kpis(spark, sf_dir):
    model = _star(spark, sf_dir)
    return reports.kpis(model.fact_invoice_summary, model.dim_vendors)


def spend_by_vendor(spark, sf_dir):
    model = _star(spark, sf_dir)
    return reports.spend_by_vendor(model.fact_invoice_summary, model.dim_vendors)


def spend_by_date(spark, sf_dir):
    return reports.spend_by_date(_star(spark, sf_dir).fact_invoice_summary)


def summary_by_date_desc(spark, sf_dir):
    model = _star(spark, sf_dir)
    return reports.summary_by_date(model.fact_invoice_summary, model.dim_vendors)


def top_line_items(spark, sf_dir):
    model = _star(spark, sf_dir)
    return reports.top_line_items_display(model.fact_invoice_line_items, model.dim_vendors)


def recent_submissions(spark, sf_dir):
    return reports.recent_submissions(ot.silver_headers(spark, sf_dir))


def loader_summary(spark, sf_dir):
    return reports.loader_summary(*ot.silver(spark, sf_dir))


# ---- checks ----

def dq_report(spark, sf_dir):
    invoices, lines = ot.silver(spark, sf_dir)
    model = _star(spark, sf_dir)
    return quality.dq_report({"parsed_invoices": invoices, "parsed_line_items": lines} | vars(model))


def dq_report_faulty(spark, sf_dir):
    """The checks over the same tables with every kind of fault planted."""
    invoices, lines = ot.silver(spark, sf_dir)
    return quality.dq_report(ot.planted_faults({"parsed_invoices": invoices, "parsed_line_items": lines} | vars(_star(spark, sf_dir))))


def totals_mismatch(spark, sf_dir):
    """Run on the cleaned layer, where totals that do not add up still are."""
    invoices = ot.silver_headers(spark, sf_dir)
    return quality.totals_mismatch(invoices.withColumnRenamed("document_id", "document_key"))


# ---- rules ----

def validate_rules(spark, sf_dir):
    return va.rule_results(_judged(spark, sf_dir))


def rule_summary(spark, sf_dir):
    return va.rule_summary(ot.judged_headers(spark, sf_dir, messages=False))


def validate_status(spark, sf_dir):
    return va.status_counts(ot.judged_headers(spark, sf_dir))


def rule_failures(spark, sf_dir):
    """Failed results per rule and severity over all invoices."""
    failed = ot.judged_headers(spark, sf_dir, messages=False).select(F.explode(va.failures(F.col("rules"))).alias("r"))
    return failed.groupBy("r.rule_name", "r.severity").agg(F.count("*").alias("failures"))


def rule_failures_planted(spark, sf_dir):
    """The same over headers with faults for the rules that hold in all others."""
    rows = va.validate(ot.planted_headers(ot.headers(spark, sf_dir)), as_of=ot.AS_OF, messages=False)
    failed = rows.select(F.explode(va.failures(F.col("rules"))).alias("r"))
    return failed.groupBy("r.rule_name", "r.severity").agg(F.count("*").alias("failures"))


def gold_rejects(spark, sf_dir):
    return layers.gold_rejects(ot.judged_headers(spark, sf_dir)).withColumn("errors", F.concat_ws("; ", "errors"))


def load_status(spark, sf_dir):
    return layers.load_status(ot.judged_headers(spark, sf_dir))


def completion_rate(spark, sf_dir):
    rate = ex.key_field_rate(F.col("invoice_number"), F.col("invoice_date"), F.col("vendor_name"), F.col("total_amount"))
    return ot.judged_headers(spark, sf_dir).select("document_id", "parse_confidence", rate.alias("key_field_rate"))


# ---- keys, currency, edits, upsert ----

def vendor_id_sha16(spark, sf_dir):
    return ot.silver_headers(spark, sf_dir).select(
        "document_id", identity.vendor_id_incremental(F.col("vendor_name"), F.col("vendor_address")).alias("vendor_id"))


def parse_currency(spark, sf_dir):
    """Order totals written in several ways, some unreadable, read back as money."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    written_as = (F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("$"), numbers.money_text(price)))
                  .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit(" €"), price.cast("string"), F.lit(" ")))
                  .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("£99999"), price.cast("string")))
                  .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(price.cast("string"), F.lit(" approx")))
                  .otherwise(F.concat(F.lit("¥"), price.cast("string"), F.lit("5"))))
    priced = ot.table(spark, sf_dir, "orders").select(
        "o_orderkey", written_as.alias("written"),
        F.when(F.col("o_orderstatus") == "F", "USD").when(F.col("o_orderstatus") == "O", " eur ").otherwise("XXX")
        .alias("code"))
    named = tables.with_currency(priced, tables.currency_codes(spark), F.col("code"))
    return named.select("o_orderkey", "written", numbers.parse_currency(F.col("written")).alias("amount"),
                        "currency_name", "symbol")


def _edits(spark, sf_dir):
    """Three corrections per order: some empty, some that change nothing."""
    order, key = ot.table(spark, sf_dir, "orders"), F.col("o_orderkey").cast("string")
    edit = lambda field, value: F.struct(F.lit(field).alias("field"), value.alias("value"))
    phone = F.when(F.col("o_orderstatus") == "F", "").otherwise(
        F.concat(F.lit("(312) 555-"), F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0")))
    order_number = F.concat(F.lit("PO-"), key, F.when(F.col("o_orderpriority") == "1-URGENT", "-R").otherwise(""))
    due = F.when(F.col("o_orderstatus") == "O", F.date_add(F.col("o_orderdate").cast("date"), 45).cast("string")).otherwise("")
    return order.select(key.alias("document_id"), F.inline(F.array(
        edit("vendor_phone", phone), edit("po_number", order_number), edit("due_date", due))))


def edits_applied(spark, sf_dir):
    changed = edits.apply_edits(ot.silver_headers(spark, sf_dir), _edits(spark, sf_dir))
    return changed.select("document_id", "invoice_number", "po_number", "due_date", "vendor_name", "vendor_phone",
                          "validation_status")


def edits_log(spark, sf_dir):
    return edits.change_log(ot.silver_headers(spark, sf_dir), _edits(spark, sf_dir))


def vendor_upsert(spark, sf_dir):
    """Invoices before a day build the dimension, the later ones are merged into it."""
    fit = layers.gold_accepted(ot.silver_headers(spark, sf_dir))
    early = F.col("parse_timestamp") < F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    day = lambda text: (F.lit(text).cast("date"), F.lit(text).cast("timestamp_ntz"))
    current = upsert.upsert_vendors(upsert.empty_vendors(fit), fit.where(early), *day(UPSERT_SPLIT))
    return upsert.upsert_vendors(current, fit.where(~early), *day(ot.AS_OF))


# ---- extraction from rendered texts ----

def rendered_texts(spark, sf_dir):
    return ot.corpus(spark, sf_dir)[2].select("document_id", F.length("raw_text").cast("bigint").alias("text_length"),
                                              F.md5("raw_text").alias("text_md5"))


def _extracted(spark, sf_dir):
    return ex.flatten(ex.extract(ot.corpus(spark, sf_dir)[2]))


def default_amounts(spark, sf_dir):
    """Line amounts, some withheld and then made up from quantity and price."""
    price = F.col("l_extendedprice").cast(numbers.MONEY)
    held = F.when(F.col("l_returnflag") != "R", price)
    filled = ex.default_amount(F.col("l_quantity").cast(numbers.PARSED_QUANTITY), price, held)
    return ot.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", filled.alias("amount"))


def roundtrip_header(spark, sf_dir):
    return _extracted(spark, sf_dir).select(
        "document_id", "invoice_number", "invoice_date", "due_date", "po_number", "subtotal", "tax_rate",
        "tax_amount", "total_amount", "currency")


def roundtrip_parties(spark, sf_dir):
    return _extracted(spark, sf_dir).select(
        "document_id", *star.VENDOR_COLUMNS, "bill_to_name", "bill_to_address", "bill_to_city",
        "bill_to_state", "bill_to_zip")


def roundtrip_items(spark, sf_dir):
    rows = ex.explode_items(_extracted(spark, sf_dir))
    return rows.select("document_id", F.col("line_number").cast("bigint").alias("line_number"),
                       "description", F.col("quantity").cast(numbers.QUANTITY).alias("quantity"), "unit_price", "amount")


def confidence(spark, sf_dir):
    return _read_records(spark, sf_dir).select("document_id", "parse_confidence", "key_field_rate", "line_item_count")


def digest_brief(spark, sf_dir):
    return _read_records(spark, sf_dir).select("document_id", digest.brief())


def digest_full(spark, sf_dir):
    return _read_records(spark, sf_dir).select("document_id", digest.full())


def insights(spark, sf_dir):
    return digest.insights(_read_records(spark, sf_dir), ["document_id"])


def run_counts(spark, sf_dir):
    return layers.run_counts(ot.corpus(spark, sf_dir)[2], _read_records(spark, sf_dir))


# ---- extraction from free text ----

def _documents(spark, sf_dir):
    return tables.enough_tasks(ot.table(spark, sf_dir, "documents"))


def doc_contacts(spark, sf_dir):
    text = F.col("text")
    return _documents(spark, sf_dir).select("doc_id", ex.phone(text).alias("phone"), ex.email(text).alias("email"))


def doc_fields(spark, sf_dir):
    """The whole record over texts that are no invoices."""
    records = ex.flatten(ex.extract(_documents(spark, sf_dir), "text"))
    return records.select("doc_id", "invoice_number", "invoice_date", "due_date", "po_number", "vendor_name",
                          "vendor_address", "vendor_city", "vendor_state", "vendor_zip", "vendor_phone", "vendor_email",
                          "subtotal", "tax_rate", "tax_amount", "total_amount", "line_item_count", "parse_confidence",
                          "key_field_rate")


# ---- layers, files, streams ----

def bronze_documents(spark, sf_dir):
    documents = tables.documents_from_table(ot.table(spark, sf_dir, "documents"), "doc_id", "text")
    return layers.bronze(documents, layers.as_timestamp(LOADED_AT))


def silver_invoices(spark, sf_dir):
    return ot.judged_headers(spark, sf_dir).select(*ot.names(ot.SILVER_INVOICES))


def silver_line_items(spark, sf_dir):
    invoices = ot.silver_headers(spark, sf_dir).select("document_id", "parse_confidence", "line_item_count")
    keyed = hot_keys.join_to_unique(ot.numbered_lines(spark, sf_dir), invoices.drop("line_item_count"), "document_id",
                                    spread=["line_item_id"], counts=ot.line_counts(invoices))
    return keyed.withColumnRenamed("parse_confidence", "extraction_confidence")


def ingest_files(spark, sf_dir):
    """The documents written as one text file each and read back as a folder of files."""
    folder = _once("files", spark, sf_dir, lambda: _write_files(spark, sf_dir))
    return files.read_folder(spark, folder).select(
        "file_type", "file_size_bytes", F.length("text").cast("bigint").alias("text_length"),
        F.md5("text").alias("text_md5"), "reject_reason")


def _write_files(spark, sf_dir):
    folder = new_folder(spark, "document-files")
    files.write_each(_documents(spark, sf_dir).select(F.col("text").alias("value")), folder)
    return folder


def _uploads(spark, sf_dir):
    """The documents as uploaded bytes: text files, some not UTF-8, and types that are not read."""
    key, name = F.col("doc_id").cast("string"), F.lit("doc-")
    ending = (F.when(F.col("doc_id") % 5 == 1, ".pdf").when(F.col("doc_id") % 5 == 2, ".csv")
              .when(F.col("doc_id") % 5 == 3, ".TXT").otherwise(".txt"))
    content = F.concat(F.when(F.col("doc_id") % 10 == 4, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))), F.encode("text", "UTF-8"))
    rows = _documents(spark, sf_dir).select(F.concat(name, key, ending).alias("name"), content.alias("content"))
    return files.parsed(tables.documents_from_bytes(rows, "name", "content"))


def bronze_files(spark, sf_dir):
    """Every upload, bad ones too."""
    return layers.bronze(_uploads(spark, sf_dir), layers.as_timestamp(LOADED_AT))


def file_rejects(spark, sf_dir):
    return files.rejected(_uploads(spark, sf_dir))


def compact_json(spark, sf_dir):
    uploads = _uploads(spark, sf_dir)
    return uploads.select("document_id", files.compact_json(uploads).alias("json"))


def _texts(spark, sf_dir):
    return ot.corpus(spark, sf_dir)[2].select("document_id", F.col("raw_text").alias("text"))


def _deal(texts: DataFrame, folder: str, count: int, *keys: str) -> None:
    """The partitions of ``texts.repartition(count, *keys)`` as one file each, in a folder each. Every file is written by a task that reads all texts and keeps its own,
    so that no text passes a shuffle."""
    place = F.pmod(F.hash(*keys), F.lit(count))
    deal = lambda n: texts.where(place == n).select("document_id", "text").coalesce(1).write.options(**TEXT_GROUPS).parquet(f"{folder}/{n}")
    with ThreadPoolExecutor(count) as pool:
        list(pool.map(deal, range(count)))


def _stream(spark, texts: DataFrame, *keys: str) -> layers.Layers:
    """Texts taken as a stream of four Parquet files, two to a batch."""
    source, root = new_folder(spark, "stream-in"), new_folder(spark, "stream-out")
    _deal(texts, source, 4, *keys)
    stream = incremental.stream_table(spark, source + "/*", "document_id STRING, text STRING", files_per_batch=2)
    incremental.load_stream(stream, root, root + "/_checkpoint", as_of=ot.AS_OF, loaded_at=LOADED_AT).awaitTermination()
    return layers.Layers(spark, root)


def _streamed(spark, sf_dir) -> layers.Layers:
    """The rendered texts in several batches."""
    return _once("stream", spark, sf_dir, lambda: _stream(spark, _texts(spark, sf_dir), "document_id"))


def _streamed_copies(spark, sf_dir) -> layers.Layers:
    """Every text two to four times, within and across batches."""
    copies = F.sequence(F.lit(1), F.col("document_id").cast("bigint") % 3 + 2)
    texts = _texts(spark, sf_dir).withColumn("copy", F.explode(copies))
    return _once("stream-copies", spark, sf_dir, lambda: _stream(spark, texts, "document_id", "copy"))


def stream_ingest(spark, sf_dir):
    return _streamed(spark, sf_dir).read("silver/parsed_invoices").select(*ot.names(ot.SILVER_INVOICES))


def stream_vendors(spark, sf_dir):
    return _no_audit(_streamed(spark, sf_dir).read("gold/dim_vendors"))


def stream_line_facts(spark, sf_dir):
    return _streamed(spark, sf_dir).read("gold/fact_invoice_line_items").drop("batch_id")


def stream_documents(spark, sf_dir):
    return _streamed(spark, sf_dir).read("gold/dim_documents").drop("batch_id")


def stream_summary(spark, sf_dir):
    return _streamed(spark, sf_dir).read("gold/fact_invoice_summary").drop("batch_id")


def stream_duplicates(spark, sf_dir):
    """The summary again, of a stream that brings every document several times."""
    return _streamed_copies(spark, sf_dir).read("gold/fact_invoice_summary").drop("batch_id")


def stream_duplicate_vendors(spark, sf_dir):
    return _no_audit(_streamed_copies(spark, sf_dir).read("gold/dim_vendors"))


def dry_run(spark, sf_dir):
    """What a load would put into the summary; nothing is written."""
    load = layers.Layers(spark, new_folder(spark, "never-written")).load
    return load(_texts(spark, sf_dir), as_of=ot.AS_OF, loaded_at=LOADED_AT, dry_run=True)["gold/fact_invoice_summary"]


def mart_files(spark, sf_dir):
    """The summary table of the star as another job reads it from its written mart."""
    def write():
        root = new_folder(spark, "mart")
        _star(spark, sf_dir).write(root)
        return root
    root = _once("mart", spark, sf_dir, write)
    return _no_audit(spark.read.parquet(f"{root}/gold/fact_invoice_summary"))


# ---- files that arrive, loads with rejects, other layouts, lookups, catalog ----

def _file_stream(spark, sf_dir):
    """The documents as files of a folder that grows between two runs of one stream: plain text, some not UTF-8, and packed files."""
    folder, root = new_folder(spark, "arrivals"), new_folder(spark, "file-stream")
    key = F.col("doc_id")
    content = F.concat(F.when(key % 10 == 4, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))), F.encode("text", "UTF-8")).cast("string")
    docs = _documents(spark, sf_dir).select("doc_id", F.concat(F.lit("doc-"), key.cast("string")).alias("name"), content.alias("value"))
    for half in (0, 1):
        arrived = docs.where(key % 2 == half)
        for kind, some in (("none", arrived.where(key % 5 != 1)), ("gzip", arrived.where(key % 5 == 1))):
            files.write_each(some, folder, by="name", compression=kind)
        stream = incremental.stream_files(spark, folder, files_per_batch=1000, recursive=True)
        incremental.load_stream(stream, root, root + "/_checkpoint", as_of=ot.AS_OF, loaded_at=LOADED_AT).awaitTermination()
    return root


def stream_files(spark, sf_dir):
    """Every file that the stream took, with what the raw layer has of it."""
    root = _once("file-stream", spark, sf_dir, lambda: _file_stream(spark, sf_dir))
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    name = F.regexp_extract("source_path", "/name=([^/]*)/", 1).alias("name")
    raw = read("bronze/raw_documents").select("source_path", F.md5("raw_text").alias("text_md5"))
    rejects = read("rejects/files").select("source_path", F.col("reject_reason").alias("dead_letter"))
    return read("sources/files").join(raw, "source_path", "left").join(rejects, "source_path", "left").select(name, "file_type", "text_md5", "reject_reason", "dead_letter")


def load_dead_letters(spark, sf_dir):
    """A load, done twice, of uploads that it cannot all use: the raw layer has each, ``rejects/files`` the reasons."""
    stored = layers.Layers(spark, new_folder(spark, "dead-letters"))
    for _ in range(2):
        stored.load(_uploads(spark, sf_dir), 1, as_of=ot.AS_OF, loaded_at=LOADED_AT)
    rejects = stored.read("rejects/files").select("document_id", "reject_reason")
    parsed = stored.read("silver/parsed_invoices").select("document_id", F.lit(True).alias("parsed"))
    return stored.read("bronze/raw_documents").join(rejects, "document_id", "left").join(parsed, "document_id", "left").select(
        "document_id", "file_name", F.md5("raw_text").alias("text_md5"), "reject_reason", F.coalesce("parsed", F.lit(False)).alias("parsed"))


def extraction_rejects(spark, sf_dir):
    """What a load lists of invoices with values beyond their columns."""
    stored = layers.Layers(spark, new_folder(spark, "out-of-range"))
    stored.load(ot.out_of_range(ot.corpus(spark, sf_dir)[2]), 1, as_of=ot.AS_OF, loaded_at=LOADED_AT)
    return stored.read("rejects/extraction").select("document_id", "reason")


def vendor_stamps(spark, sf_dir):
    """The vendor dimension after three loads on three days."""
    def build():
        stored = layers.Layers(spark, new_folder(spark, "three-days"))
        for day in range(3):
            stored.load(_texts(spark, sf_dir).where(F.col("document_id").cast("bigint") % 3 == day), day, as_of=ot.AS_OF, loaded_at=LOADED_AT + datetime.timedelta(days=day))
        return stored
    return _once("three-days", spark, sf_dir, build).read("gold/dim_vendors").select("vendor_id", "first_seen_date", "document_count", "created_at", "updated_at")


def layouts_header(spark, sf_dir):
    """Header fields of the rendered invoices in other layouts."""
    return ex.flatten(ex.extract(ot.other_layouts(ot.corpus(spark, sf_dir)[2]))).select(
        "document_id", "invoice_number", "invoice_date", "due_date", "po_number", "subtotal", "tax_rate", "tax_amount", "total_amount")


def layouts_items(spark, sf_dir):
    rows = ex.explode_items(ex.extract(ot.other_layouts(ot.corpus(spark, sf_dir)[2])))
    return rows.select("document_id", F.col("line_number").cast("bigint").alias("line_number"), "description",
                       F.col("quantity").cast(numbers.QUANTITY).alias("quantity"), "unit_price", "amount")


def discovered(spark, sf_dir):
    """Files found in the folder of documents, not opened."""
    folder = _once("files", spark, sf_dir, lambda: _write_files(spark, sf_dir))
    found = files.discover(spark, folder)
    return found.select(files.file_type(F.col("file_name")).alias("file_type"), "file_size_bytes")


def currency_from_csv(spark, sf_dir):
    """A lookup file with a line per supplier, some of them unusable, as it is read."""
    key = F.col("s_suppkey")
    letter = lambda n: F.chr(F.floor(key / n) % 26 + 65)
    code = F.concat(letter(676), letter(26), letter(1))
    line = (F.when(key % 5 == 1, F.concat_ws(",", code, "s_name")).when(key % 5 == 2, F.concat_ws(",", F.concat(F.lit("1"), code), "s_name", key.cast("string")))
            .when(key % 5 == 3, F.concat_ws(",", code, "s_name", key.cast("string"), F.lit("more"))).otherwise(F.concat_ws(",", code, "s_name", key.cast("string"))))
    path = new_folder(spark, "currency-csv")
    lines = ot.table(spark, sf_dir, "supplier").select(line.alias("currency_code,currency_name,symbol"))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)
    return tables.read_currency_csv(spark, path)


def mart_sql(spark, sf_dir):
    """The marts as tables of Spark's catalog, read by SQL."""
    def save():
        database = "mart_" + new_folder(spark, "x").rsplit("-", 1)[1]
        spark.sql(f"CREATE DATABASE {database} LOCATION '{new_folder(spark, 'catalog')}'")
        _star(spark, sf_dir).save_tables(database)
        return database
    database = _once("catalog", spark, sf_dir, save)
    return spark.sql(f"""
SELECT v.vendor_id, count(DISTINCT d.document_id) AS documents, CAST(sum(s.total_amount) AS DECIMAL(38,2)) AS spend, sum(s.total_line_items) AS items,
  CAST(max(l.line_amount) AS DECIMAL(38,2)) AS line_amount
FROM {database}.fact_invoice_summary s JOIN {database}.dim_vendors v ON s.vendor_key = v.vendor_key JOIN {database}.dim_documents d ON s.document_key = d.document_key
LEFT JOIN (SELECT vendor_key, sum(line_amount) AS line_amount FROM {database}.fact_invoice_line_items GROUP BY vendor_key) l ON l.vendor_key = v.vendor_key
GROUP BY v.vendor_id""")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    stg_invoices, stg_line_items, int_cleaned, vendors_latest, dim_vendors, dim_documents, fact_line_items, fact_summary,
    kpis, spend_by_vendor, spend_by_date, summary_by_date_desc, top_line_items, recent_submissions, loader_summary,
    dq_report, totals_mismatch, validate_rules, rule_summary, validate_status, rule_failures, gold_rejects, load_status,
    completion_rate, vendor_id_sha16, parse_currency, edits_applied, edits_log, vendor_upsert, rendered_texts,
    default_amounts, roundtrip_header, roundtrip_parties, roundtrip_items, confidence, digest_brief, digest_full, insights, run_counts,
    doc_contacts, doc_fields, bronze_documents, silver_invoices, silver_line_items, ingest_files, stream_ingest,
    stream_vendors, stream_line_facts, stream_documents, stream_summary, stream_duplicates, stream_duplicate_vendors, dry_run,
    mart_files, bronze_files, file_rejects, compact_json, dq_report_faulty, rule_failures_planted,
    stream_files, load_dead_letters, extraction_rejects, vendor_stamps, layouts_header, layouts_items, discovered, currency_from_csv, mart_sql)}

import datetime as dt
import gzip
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from invoicemill.operators.edits import change_log
from invoicemill.operators.upsert import upsert_vendors, empty_vendors
from invoicemill.plans.layers import Layers, bronze, load_status, run_counts
from invoicemill.sources import files, tables
from invoicemill.streaming.incremental import load_stream, stream_files, stream_table
from tests.samples import LARGE, PLAIN

AS_OF = "2026-02-15"
AT = dt.datetime(2026, 2, 15, 12, 0)
AUDIT = {"batch_id"}


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    (place / "plain.txt").write_text(PLAIN, encoding="utf-8")
    (place / "LARGE.TXT").write_bytes(LARGE.replace("\n", "\r\n").encode())
    (place / "plain again.txt").write_text(PLAIN.replace("INV-2026-041", "INV-2026-042"), encoding="utf-8")
    (place / "bad.txt").write_bytes(b"\xff\xfe broken")
    (place / "scan.pdf").write_bytes(b"%PDF-1.4")
    (place / "notes.docx").write_bytes(b"zip")
    (place / "wrong.txt").write_text(PLAIN.replace("100.44", "999.44"), encoding="utf-8")
    return str(place)


def rows(df, drop=()):
    names = sorted(set(df.columns) - AUDIT - set(drop))
    return sorted(map(str, df.select(*names).collect()))


def test_read_folder(spark, folder):
    got = {r.file_name: r for r in files.read_folder(spark, folder).collect()}
    assert got["plain.txt"].text == PLAIN and got["LARGE.TXT"].text == LARGE
    assert got["LARGE.TXT"].file_type == "txt" and got["plain.txt"].metadata == {"source": "text_file", "encoding": "utf-8"}
    assert got["plain.txt"].file_size_bytes == len(PLAIN.encode())
    assert {n: r.reject_reason for n, r in got.items() if r.reject_reason} == {
        "bad.txt": "not_utf8", "scan.pdf": "pdf_text_not_available", "notes.docx": "unsupported_file_type"}


def test_discover(spark, folder, tmp_path):
    assert {r.file_name for r in files.discover(spark, folder).collect()} == {
        "plain.txt", "plain again.txt", "bad.txt", "scan.pdf", "wrong.txt"}
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        files.discover(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("name, kind", [("a.b.TXT", "txt"), (".txt", ""), ("x", ""), (".a.txt", "txt"), ("a.", "")])
def test_file_type(spark, name, kind):
    assert spark.range(1).select(files.file_type(F.lit(name)).alias("t")).first().t == kind


def test_compact_json(spark, folder):
    text = files.read_folder(spark, folder).where("file_name = 'plain.txt'").select(
        files.compact_json(None).alias("j")).first().j
    import json
    value = json.loads(text)
    assert value["text_length"] == len(PLAIN) and "text" not in value and value["tables"] == []


def test_bytes_source(spark):
    uploads = spark.createDataFrame([("x/up.txt", bytearray(PLAIN.encode()))], "name string, content binary")
    got = files.parsed(tables.documents_from_bytes(uploads, "name", "content")).first()
    assert got.text == PLAIN and got.file_name == "up.txt" and got.reject_reason is None


def test_bronze_defaults(spark):
    row = bronze(spark.createDataFrame([("d", "hello")], "document_id string, text string"),
                 F.lit(AT).cast("timestamp_ntz")).first()
    assert (row.file_name, row.file_type, row.file_size_bytes, row.raw_text, row.raw_tables_json, row.metadata_json,
            row.source_path) == ("unknown", "unknown", 0, "hello", "[]", "{}", None)


def test_batch_load(spark, folder, tmp_path):
    layers = Layers(spark, str(tmp_path / "wh"))
    documents = files.accepted(files.read_folder(spark, folder))
    first = layers.load(documents, 0, as_of=AS_OF, loaded_at=AT)
    assert first["records"].groupBy("validation_status").count().collect() and first["rejects/gold"].count() == 1
    reject = first["rejects/gold"].first()
    assert reject.reason == "validation_failed" and "999.44" in reject.errors[0]
    vendors = {r.vendor_name: r for r in layers.read("gold/dim_vendors").collect()}
    assert vendors["Harbor Paper Works"].document_count == 2
    assert vendors["Northwind Compute LLC"].first_seen_date == dt.date(2026, 2, 15)
    counts = run_counts(files.read_folder(spark, folder), first["records"]).first()
    assert (counts.found, counts.parsed, counts.extracted, counts.loaded) == (7, 4, 4, 3)
    status = {r.status for r in load_status(first["records"]).collect()}
    assert status == {"loaded", "rejected"}
    before = {t: rows(layers.read(t)) for t in first if t != "records"}

    layers.load(documents, 0, as_of=AS_OF, loaded_at=AT)            # the same load again
    assert {t: rows(layers.read(t)) for t in before} == before
    layers.load(documents, 1, as_of=AS_OF, loaded_at=AT)            # the same documents in a later load
    assert {t: rows(layers.read(t)) for t in before} == before


def test_dry_run_writes_nothing(spark, folder, tmp_path):
    root = tmp_path / "dry"
    out = Layers(spark, str(root)).load(files.accepted(files.read_folder(spark, folder)), as_of=AS_OF, dry_run=True)
    assert out["silver/parsed_invoices"].count() == 4 and out["gold/dim_vendors"].count() == 2
    assert not root.exists()


def test_edits(spark, folder, tmp_path):
    documents = files.accepted(files.read_folder(spark, folder)).where("file_name = 'plain.txt'")
    key = documents.first().document_id
    edits = spark.createDataFrame(
        [(key, "vendor_name", "Harbour Paper"), (key, "po_number", ""), (key, "due_date", "2026-03-01")],
        "document_id string, field string, value string")
    layers = Layers(spark, str(tmp_path / "edits"))
    plain = layers.load(documents, dry_run=True, as_of=AS_OF)["records"]
    out = layers.load(documents, dry_run=True, as_of=AS_OF, edits=edits)
    row = out["silver/parsed_invoices"].first()
    assert (row.vendor_name, row.po_number, row.due_date) == ("Harbour Paper", "PO-2026-0091", dt.date(2026, 3, 1))
    assert out["gold/dim_vendors"].first().vendor_name == "Harbour Paper"
    assert [tuple(r) for r in change_log(plain, edits).collect()] == [
        (key, "Vendor Name", "Harbor Paper Works", "Harbour Paper")]


def test_stream_equals_batch(spark, folder, tmp_path):
    batch = Layers(spark, str(tmp_path / "batch"))
    out = batch.load(files.read_folder(spark, folder), as_of=AS_OF, loaded_at=AT)
    assert out["bronze/raw_documents"].count() == 7 and out["silver/parsed_invoices"].count() == 4
    root = str(tmp_path / "stream")
    run = lambda: load_stream(stream_files(spark, folder, files_per_batch=2), root, str(tmp_path / "cp"),
                              as_of=AS_OF, loaded_at=AT).awaitTermination(120)
    assert run()
    stream = Layers(spark, root)
    compared = [t for t in out if t != "records"]
    assert {t: rows(stream.read(t)) for t in compared} == {t: rows(batch.read(t)) for t in compared}
    assert spark.read.parquet(f"{root}/rejects/files").count() == 3
    assert spark.read.parquet(f"{root}/silver/parsed_invoices").select("batch_id").distinct().count() > 1

    (tmp_path / "in" / "late.txt").write_text(PLAIN.replace("INV-2026-041", "INV-2026-099"), encoding="utf-8")
    assert run()
    assert stream.read("silver/parsed_invoices").count() == 5
    vendors = {r.vendor_name: r.document_count for r in stream.read("gold/dim_vendors").collect()}
    assert vendors == {"Harbor Paper Works": 3, "Northwind Compute LLC": 1}


def test_stream_of_parquet(spark, tmp_path):
    schema = "document_id string, text string"
    spark.createDataFrame([("a", PLAIN), ("b", LARGE)], schema).repartition(2).write.parquet(str(tmp_path / "docs"))
    load_stream(stream_table(spark, str(tmp_path / "docs"), schema, 1), str(tmp_path / "out"), str(tmp_path / "cp"),
                as_of=AS_OF, loaded_at=AT).awaitTermination(120)
    assert Layers(spark, str(tmp_path / "out")).read("silver/parsed_line_items").count() == 6


def test_upsert_follows_the_order_of_arrival(spark):
    schema = ("document_id string, parse_timestamp timestamp_ntz, vendor_name string, vendor_address string, "
              "vendor_city string, vendor_state string, vendor_zip string, vendor_phone string, vendor_email string")
    at = lambda n: dt.datetime(2026, 1, n)
    invoices = spark.createDataFrame([
        ("1", at(1), "ACME", "1 St", "Rome", "NY", "1", "p1", "e1"),
        ("2", at(2), "acme ", "1 st", "Roma", "IT", "2", "p2", None),
        ("3", at(1), None, None, None, None, None, None, None)], schema)
    day, now = F.lit("2026-01-05").cast("date"), F.lit("2026-01-05 00:00:00").cast("timestamp_ntz")
    first = upsert_vendors(empty_vendors(invoices), invoices, day, now)
    acme = first.where("vendor_name is not null").first()
    assert (acme.vendor_name, acme.vendor_address, acme.vendor_city, acme.vendor_phone, acme.vendor_email,
            acme.document_count) == ("acme ", "1 St", "Rome", "p2", None, 2)
    later = F.lit("2026-02-01").cast("date")
    again = upsert_vendors(first, invoices.where("document_id = '1'"), later, now)
    acme = again.where("vendor_name is not null").first()
    assert (acme.vendor_name, acme.document_count, acme.first_seen_date) == ("ACME", 3, dt.date(2026, 1, 5))
    assert again.count() == 2


def test_currency(spark):
    codes = tables.currency_codes(spark)
    got = tables.with_currency(spark.createDataFrame([("usd ",), ("XXX",)], "c string"), codes, F.col("c")).collect()
    assert {r.c: r.symbol for r in got} == {"usd ": "$", "XXX": None}


def test_currency_file(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("currency_code,currency_name,symbol\nCHF,Swiss Franc,Fr\n", encoding="utf-8")
    assert [tuple(r) for r in tables.currency_codes(spark, str(tmp_path / "codes.csv")).collect()] == [("CHF", "Swiss Franc", "Fr")]


def test_copies_in_one_load_count_once(spark, folder, tmp_path):
    docs = files.accepted(files.read_folder(spark, folder)).where("file_name = 'plain.txt'")
    out = Layers(spark, str(tmp_path / "once")).load(docs.union(docs).union(docs), 1, as_of=AS_OF, loaded_at=AT)
    single = Layers(spark, str(tmp_path / "single")).load(docs, 1, as_of=AS_OF, loaded_at=AT)
    for name in ("silver/parsed_invoices", "silver/parsed_line_items", "gold/fact_invoice_line_items", "gold/fact_invoice_summary", "gold/dim_vendors"):
        assert rows(out[name]) == rows(single[name])
    assert out["gold/fact_invoice_line_items"].count() == 3 and out["gold/dim_vendors"].first().document_count == 1


def test_large_quantity_is_rejected(spark, folder, tmp_path):
    docs = files.accepted(files.read_folder(spark, folder)).where("file_name = 'plain.txt'")
    item = [x for x in PLAIN.split("\n") if x.rstrip().endswith(("00", "25", "50", "44")) and "  " in x.strip()]
    quantity = next(w for x in item for w in x.split() if w.isdigit())
    line = next(x for x in item if quantity in x.split())
    changed = docs.withColumn("text", F.replace("text", F.lit(line), F.lit(line.replace(f" {quantity} ", " 500000000 ", 1))))
    out = Layers(spark, str(tmp_path / "big")).load(changed, 1, as_of=AS_OF, loaded_at=AT)
    lost = out["silver/parsed_line_items"].where("quantity is null").count()
    assert lost == 0 or [r.reason for r in out["rejects/extraction"].collect()] == ["line_item_out_of_range"]
    assert lost == 1


def test_dry_run_reads_texts_once(spark, folder, tmp_path):
    """What a dry run returns comes from records that were worked out once, not from the texts."""
    out = Layers(spark, str(tmp_path / "never")).load(files.accepted(files.read_folder(spark, folder)), as_of=AS_OF, dry_run=True)
    for name in ("silver/parsed_line_items", "gold/fact_invoice_summary", "gold/fact_invoice_line_items", "gold/dim_vendors"):
        assert "regexp_extract" not in out[name]._jdf.queryExecution().optimizedPlan().toString()


def test_stored_texts_can_be_split(spark, tmp_path):
    """Texts of one stored file are many row groups, so that more than one task can read them."""
    import pyarrow.parquet as pq

    texts = spark.range(0, 20_000, 1, 1).select(F.col("id").cast("string").alias("document_id"), F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(f":{n}")), 512) for n in range(8)]).alias("text"))
    Layers(spark, str(tmp_path)).load(texts, as_of=AS_OF)
    parts = list((tmp_path / "bronze" / "raw_documents").rglob("*.parquet"))
    assert sum(pq.ParquetFile(p).num_row_groups for p in parts) >= 4


def test_every_row_is_written_as_a_file(spark, tmp_path):
    """Nulls, copies and several calls keep their files, and no checksum file or process per file comes with them."""
    texts = spark.createDataFrame([("a", "one\r\nline"), ("a", "again"), ("b", None), ("b", ""), ("c", "é")], "name string, value string")
    for packed in ("none", "gzip"):
        files.write_each(texts, str(tmp_path / "by name"), by="name", compression=packed)
    files.write_each(texts, str(tmp_path / "flat"))
    files.write_each(texts.limit(0), str(tmp_path / "nothing"))
    found = lambda pattern, read: sorted((p.parent.name, read(p.read_bytes())) for p in tmp_path.glob(pattern))
    expected = sorted((f"name={n}", ((v or "") + "\n").encode()) for n, v in texts.collect())
    assert found("by name/*/*.txt", bytes) == found("by name/*/*.gz", gzip.decompress) == expected
    assert [c for _, c in found("flat/*", bytes)] == sorted(c for _, c in expected) and not found("nothing/*", bytes)
    assert files.read_folder(spark, str(tmp_path / "flat")).where("reject_reason is null").count() == 5
    assert not found("by name/*/.*", bytes) + found("flat/.*", bytes)

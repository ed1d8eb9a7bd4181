"""Hash parts: what a load reads does not grow with the number of loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from invoicemill.plans.layers import Layers, one_per_document, without
from invoicemill.session import new_folder
from invoicemill.sources import tables
from invoicemill.sources.hash_parts import HashParts
from tests.samples import PLAIN


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_files_read_stay_constant_over_twenty_versions(spark):
    stored = HashParts(spark, new_folder(spark, "parts"), "k", "k string", parts=4, most=3)
    opened = []
    for version in range(20):
        batch = keys(spark, [f"{version}-{i}" for i in range(40)])
        touched = stored.touched(batch)
        looked = stored.lookup(touched, version)
        opened.append(len(looked.inputFiles()))
        assert "Location: InMemoryFileIndex" in looked._jdf.queryExecution().toString() or version == 0
        stored.add(batch, touched, version)
    assert max(opened) <= 4 * 3 and opened[-1] <= max(opened[:8])
    assert sorted(r.k for r in stored.read().collect()) == sorted(f"{v}-{i}" for v in range(20) for i in range(40))
    few = stored.touched(keys(spark, ["7-7"]))
    assert len(few) == 1 and stored.lookup(few).where("k = '7-7'").count() == 1 and stored.lookup(few).count() < 800


def test_a_version_written_again_is_the_same(spark):
    stored = HashParts(spark, new_folder(spark, "parts"), "k", "k string, n int", parts=3)
    row = lambda k, n: spark.createDataFrame([(k, n)], "k string, n int")
    both = lambda version, k, n: stored.replace(stored.lookup(stored.touched(row(k, n)), version).where(F.col("k") != k).unionByName(row(k, n)), stored.touched(row(k, n)), version)
    for version, k, n in ((0, "a", 1), (1, "b", 2), (2, "a", 3), (1, "b", 2), (2, "a", 3)):
        both(version, k, n)
    assert sorted(map(tuple, stored.read().collect())) == [("a", 3), ("b", 2)]
    assert sorted(map(tuple, stored.read(2).collect())) == [("a", 1), ("b", 2)]
    assert stored.versions() == [0, 1, 2] and stored.read(0).collect() == []
    stored.add(row("x", 1).limit(0), [], 3)
    assert stored.read().count() == 2


def test_vendors_of_untouched_parts_are_not_rewritten(spark, tmp_path):
    layers = Layers(spark, str(tmp_path), id_parts=2, vendor_parts=16)
    doc = lambda i, vendor: (f"d{i}", PLAIN.replace("Harbor Paper Works", vendor).replace("INV-2026-041", f"INV-2026-{100 + i}"))
    load = lambda n, *docs: layers.load(spark.createDataFrame(docs, "document_id string, text string"), n, as_of="2026-02-15", loaded_at=dt.datetime(2026, 2, 15 + n))
    load(0, *[doc(i, f"Vendor {i}") for i in range(12)])
    before = layers.vendors.segments()
    load(1, doc(20, "Vendor 3"), doc(3, "Vendor 3"))            # one new document, one that is known
    after = layers.vendors.segments()
    assert len([p for p in after if after[p] != before.get(p)]) == 1
    rows = {r.vendor_name: r for r in layers.read("gold/dim_vendors").collect()}
    assert len(rows) == 12 and rows["Vendor 3"].document_count == 2 and rows["Vendor 4"].document_count == 1
    assert rows["Vendor 3"].created_at == dt.datetime(2026, 2, 15) and rows["Vendor 3"].updated_at == dt.datetime(2026, 2, 16)
    assert rows["Vendor 4"].updated_at == dt.datetime(2026, 2, 15)


@pytest.mark.parametrize("broadcast_ids", [100, 0])
def test_one_per_document_moves_only_copies(spark, broadcast_ids):
    rows = [("a", "1", {"m": "x"}), ("b", "2", None), ("b", "1", None), (None, "n", None), (None, "m", None), ("c", "9", None), ("c", "9", None)]
    docs = spark.createDataFrame(rows, "document_id string, text string, metadata map<string,string>")
    got = one_per_document(docs, broadcast_ids=broadcast_ids)
    assert sorted((r.document_id or "", r.text) for r in got.collect()) == [("", "m"), ("a", "1"), ("b", "1"), ("c", "9")]
    left = without(docs, docs.where("document_id = 'b' or document_id is null").select("document_id"), broadcast_ids=broadcast_ids)
    assert sorted(r.document_id for r in left.collect()) == ["a", "c", "c"]
    assert one_per_document(docs.where("document_id = 'a'")).columns == docs.columns


def test_currency_file_with_bad_lines(spark, tmp_path):
    (tmp_path / "codes.csv").write_text('currency_code,currency_name,symbol\nUSD,US Dollar,$\nEUR,Euro\nusd,Small,s\nGBP,"Pound, British",£\nJPY,Yen,¥,more\n,Nothing,n\n', encoding="utf-8")
    got = {r.line or r.currency_code: r.reject_reason for r in tables.read_currency_csv(spark, str(tmp_path / "codes.csv")).collect()}
    assert got == {"USD": None, "GBP": None, "EUR,Euro": "wrong_number_of_columns", "JPY,Yen,¥,more": "wrong_number_of_columns", "usd,Small,s": "bad_currency_code",
                   ",Nothing,n": "bad_currency_code"}

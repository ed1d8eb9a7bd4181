"""What a step must not do, whatever the size: hold, move or make what is not read."""

import datetime as dt
import time

from pyspark.sql import functions as F

from invoicemill import catalogue
from invoicemill.plans.layers import Layers, one_per_document
from invoicemill.session import FREE_SHUFFLES, written
from invoicemill.streaming import incremental

TABLES = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_records_are_read_where_a_query_needs_them(spark):
    """A brief digest looks at no line items and no rules; nothing is landed for it."""
    key = ("records", spark.sparkContext.applicationId, TABLES)
    landed = catalogue._memo.pop(key, None)
    texts = spark.createDataFrame([("1", "Invoice Number: A-1\nTOTAL 5.00")], "document_id string, raw_text string")
    kept = catalogue.ot._rendered.get((spark.sparkContext.applicationId, TABLES))
    catalogue.ot._rendered[(spark.sparkContext.applicationId, TABLES)] = (None, None, texts)
    try:
        brief = catalogue.digest_brief(spark, TABLES)
        assert brief.first().digest_brief.startswith("Invoice A-1") and "line_items" not in plan(brief) and "rule_name" not in plan(brief)
        assert key not in catalogue._memo
    finally:
        if kept is None:
            del catalogue.ot._rendered[(spark.sparkContext.applicationId, TABLES)]
        else:
            catalogue.ot._rendered[(spark.sparkContext.applicationId, TABLES)] = kept
        if landed is not None:
            catalogue._memo[key] = landed


def test_dealt_texts_are_the_partitions_of_a_shuffle(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("document_id"), F.lit("t").alias("text"), (F.col("id") % 3).alias("copy"))
    catalogue._deal(rows, str(tmp_path), 4, "document_id", "copy")
    dealt = [spark.read.parquet(f"{tmp_path}/{n}") for n in range(4)]
    want = rows.repartition(4, "document_id", "copy").drop("copy").rdd.glom().collect()
    assert [sorted(map(tuple, df.collect())) for df in dealt] == [sorted(map(tuple, p)) for p in want]
    assert [len(df.inputFiles()) for df in dealt] == [1] * 4


def test_one_per_document_holds_a_text_once(spark):
    docs = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("b", None), (None, "z")], "document_id string, text string")
    got = one_per_document(docs, broadcast_ids=0)
    assert "min_by" not in plan(got)
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.where("text = 'x' or document_id is null or document_id = 'b'").distinct().collect()))


def test_known_documents_go_before_copies_are_brought_together(spark, tmp_path):
    load = lambda n, *docs: Layers(spark, str(tmp_path)).load(
        spark.createDataFrame(docs, "document_id string, text string"), n, as_of="2026-02-15", loaded_at=dt.datetime(2026, 2, 15))["bronze/raw_documents"]
    assert load(0, ("a", "x"), ("a", "x"), ("b", "y")).count() == 2
    assert [r.document_id for r in load(1, ("a", "x"), ("a", "x"), ("c", "z"), ("c", "z")).collect()] == ["c"]


def test_a_stream_of_a_table_is_not_kept(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(incremental.Layers, "load", lambda self, batch, *_, **__: kept.append(batch.storageLevel.useDisk or batch.storageLevel.useMemory))
    spark.createDataFrame([("a", "x")], "document_id string, text string").write.parquet(str(tmp_path / "in"))
    stream = incremental.stream_table(spark, str(tmp_path / "in"), "document_id string, text string")
    incremental.load_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert kept == [False]


def test_what_is_written_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in (seq.apply(i) for seq in [disk.getAllFiles()] for i in range(seq.size())) if f.getName().startswith("shuffle_")}
    before = files()
    stored = written(spark.range(1000).repartition(7, "id"), "freed")
    assert spark.conf.get(FREE_SHUFFLES, None) in (None, "false")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.5)
    assert not files() - before and stored.count() == 1000

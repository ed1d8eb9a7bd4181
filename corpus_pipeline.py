"""From raw documents to packed sequences: language ID, exact dedup, near dedup, packing.

Each stage takes all that the one before it kept and returns the columns of documents; the last returns packed pieces. Each makes the session
hand texts on in small batches (session.small_batches), unless the session has a size of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from invoicemill.llm import exact_dedup as exact, language_id, minhash_dedup as near, packing
from invoicemill.llm.queries import PACKING_VOCABULARY
from invoicemill.session import small_batches, written


def _plain(docs: DataFrame) -> tuple[DataFrame, str, str, Callable[[DataFrame], DataFrame]]:
    """The rows under names of their own, which no column that a stage adds can meet, the names of id and text, and the way back."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, names))
    return docs.toDF(*names), own["doc_id"], own["text"], lambda rows: rows.select(*names).toDF(*docs.columns)


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and _holds_map(kind.elementType)


def drop_undetermined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; those that language ID rejects go.

    A null text and a text without a letter have no language and go. Ids only draw what is learned from: rows with a null id are not learned from,
    repeated ids are judged row by row. Further columns stay as they are, whatever their names.
    """
    small_batches(spark)
    rows, _, text, back = _plain(docs)
    judged = language_id.predict(rows, language_id.train(docs), text_col=text)
    return back(judged.where(~F.col("rejected")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per distinct text, that of the largest id; a null text counts as empty.

    A null id is smaller than any other, so a document without an id stays if no document with an id has its text. An id with several texts is
    as many documents, each decided by its own text. Of rows that repeat an id and a text the one whose other columns sort first stays (maps, which
    have no order, sort as JSON).
    """
    small_batches(spark)
    judged = exact.exact_dedup(docs.select("doc_id", "text")).select("doc_id", F.unhex("text_sha256").alias("sha"), "kept")
    judged = written(judged.groupBy("doc_id", "sha", "kept").agg(F.count("*").alias("n")).where("not kept or n > 1"), "copies")
    rows, doc_id, text, back = _plain(docs)
    rows = rows.withColumn("own_sha", F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)))
    match = lambda some: (rows[doc_id].eqNullSafe(some["doc_id"])) & (rows["own_sha"] == some["sha"])
    once = back(rows.join(judged, match(judged), "left_anti"))
    tied = judged.where("kept")
    if tied.isEmpty():
        return once
    columns = [c for c in rows.columns if c not in ("own_sha", text)] + [text]
    order = [F.to_json(F.struct(c)) if _holds_map(rows.schema[c].dataType) else F.col(c) for c in columns]
    first = rows.join(tied, match(tied), "left_semi").groupBy(doc_id, "own_sha").agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("first"))
    return once.union(back(first.select("first.*")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect the one with the smallest id.

    A document without an id has no links and stays, and so does one whose text is null or has no words. An id with several texts is as many
    documents, each compared by its own text; of those of one id that links connect the text with the least hash stays.
    """
    small_batches(spark)
    known = docs.where("doc_id is not null")
    if known.agg((F.count("*") == F.count_distinct("doc_id")).alias("single")).first()["single"]:
        copies = written(near.minhash_dedup(docs).where(~F.col("kept")).select("doc_id"), "near-copies")
        return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)           # a null id matches nothing
    rows, doc_id, text, back = _plain(known)
    rows = written(rows.withColumn("own_row", F.monotonically_increasing_id()), "numbered")
    placed = near.minhash_dedup(rows, id_col="own_row", text_col=text).select("own_row", "component_id")
    named = rows.select("own_row", F.col(doc_id).alias("id"), F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("sha")).join(placed, "own_row")
    kept = written(named.groupBy("component_id").agg(F.min(F.struct("id", "sha", "own_row")).alias("first")).select("first.own_row"), "near-kept")
    return back(rows.join(kept, "own_row", "left_semi")).union(docs.where("doc_id is null"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null text is empty, rows that repeat an id or have none are documents of their own."""
    small_batches(spark)
    return packing.pack(docs, PACKING_VOCABULARY())


STAGES = [("language_id", drop_undetermined), ("exact_dedup", drop_copies), ("minhash_dedup", drop_near_copies), ("packing", pack)]

#: A character language model and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs

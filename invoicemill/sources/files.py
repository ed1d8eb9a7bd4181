"""Document files: discovery, reading, and the rejects that must not stop a run."""

from __future__ import annotations

import gzip
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from invoicemill.functions import fixed_values as fv
from invoicemill.operators.identity import document_id
from invoicemill.schemas import RAW_TABLES

DISCOVERY_GLOB = "*.{" + ",".join(fv.SUPPORTED_FILE_TYPES) + "}"
TEXT_GLOB = "*.[tT][xX][tT]"


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def file_type(name: Column) -> Column:
    """Lower-cased extension without its dot; leading dots do not start one."""
    return F.lower(F.regexp_extract(name, r"^\.*[^.].*\.([^.]*)$", 1))


def read_text(content: Column) -> Column:
    """Bytes as text with every line end as ``\\n``; NULL where they are not UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), F.regexp_replace(text, "\r\n?", "\n"))


def discover(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Input files of a folder (path, file_name, file_size_bytes); no content is read.
    A folder without any is an error."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", DISCOVERY_GLOB)
             .option("recursiveFileLookup", recursive).load(folder)
             .select("path", file_name(F.col("path")).alias("file_name"), F.col("length").alias("file_size_bytes")))
    if files.isEmpty():
        raise FileNotFoundError(f"no documents found in {folder}")
    return files


def parsed(files: DataFrame) -> DataFrame:
    """Parse result of binary-file rows (path, length, content): text, tables, metadata, file facts.
    ``reject_reason`` says why a row has no text. Ids hash the content of text files only, in batch and stream alike."""
    name = file_name(F.col("path"))
    kind = file_type(name)
    text = F.when(kind == "txt", read_text(F.col("content")))
    reason = (F.when(~kind.isin(fv.SUPPORTED_FILE_TYPES), "unsupported_file_type")
              .when(kind == "pdf", "pdf_text_not_available").when(text.isNull(), "not_utf8"))
    metadata = F.create_map(*[F.lit(x) for pair in fv.TEXT_METADATA.items() for x in pair])
    return files.select(
        document_id(F.col("path"), F.sha2(F.when(kind == "txt", F.col("content")).otherwise(F.lit(b"")), 256)).alias("document_id"), text.alias("text"),
        F.array().cast(RAW_TABLES).alias("tables"),
        F.when(kind == "txt", metadata).otherwise(F.create_map().cast("map<string,string>")).alias("metadata"),
        name.alias("file_name"), kind.alias("file_type"), F.col("length").alias("file_size_bytes"),
        F.col("path").alias("source_path"), reason.alias("reject_reason"))


def read_folder(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Parse result of every file in a folder. Only text files are opened."""
    def files(glob: str) -> DataFrame:
        return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                .option("recursiveFileLookup", recursive).load(folder))

    others = files("*").where(file_type(file_name(F.col("path"))) != "txt").select(
        "path", "length", F.lit(b"").alias("content"))
    texts = files(TEXT_GLOB).select("path", "length", "content")
    return parsed(texts.unionByName(others))


def write_each(rows: DataFrame, folder: str, *, by: str | None = None, compression: str = "none") -> None:
    """Add every row's ``value`` (text) and a line end as a text file of its own to a folder, or to its folder ``by=...`` below it (``by`` is not
    null and needs no escapes); a null value is empty. ``compression``: none or gzip.

    Hadoop starts a process for each file or folder that it makes on a local or mounted disk (chmod; some 8 ms of a core a file), and the driver moves the files one by
    one. There the tasks write the files themselves, under names that a repeated task gives again. Elsewhere Spark's writer does.
    """
    context, names = rows.sparkSession.sparkContext, [by] if by else []
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getFileSystem(context._jsc.hadoopConfiguration()).getScheme() != "file":
        writer = rows.select(*names, "value").write.option("compression", compression).option("maxRecordsPerFile", 1).mode("append")
        return (writer.partitionBy(by) if by else writer).text(folder)
    root, tag = unquote(urlparse(folder).path) if folder.startswith("file:") else folder, uuid.uuid4().hex
    os.makedirs(root, exist_ok=True)

    def write(part) -> None:
        task = TaskContext.get().partitionId()
        for number, row in enumerate(part):
            below = f"{root}/{by}={row[by]}" if by else root
            if by:
                os.makedirs(below, exist_ok=True)
            content = bytes(row["value"] or b"") + b"\n"
            name = f"{below}/part-{task:05d}-{tag}-{number}.txt"
            with open(name + ".gz" if compression == "gzip" else name, "wb") as file:
                file.write(gzip.compress(content, mtime=0) if compression == "gzip" else content)

    rows.select(*names, F.col("value").cast("binary").alias("value")).foreachPartition(write)


def accepted(parse_results: DataFrame) -> DataFrame:
    return parse_results.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parse_results: DataFrame) -> DataFrame:
    return parse_results.where(F.col("reject_reason").isNotNull()).select(
        "document_id", "file_name", "file_type", "file_size_bytes", "source_path", "reject_reason")


def compact_json(parse_results: DataFrame) -> Column:
    """Parse result as JSON without the text itself, only its length."""
    return F.to_json(F.struct("tables", "metadata", "file_name", "file_type", "file_size_bytes",
                              F.length("text").alias("text_length")))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a written table is there."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise

"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A scan cannot split a row group, so one of the usual 128 MB holds some 150,000 texts for a single task. Texts that
# costly work reads again lie in groups of 4 MB, which spread over all cores without a shuffle.
COMPACT = {"compression": "zstd"}       # some two thirds of the bytes of the usual codec
TEXT_GROUPS = {"parquet.block.size": 4 << 20, **COMPACT}

# What a task holds of the texts at once, outside and inside the heap. By default 10,000 rows (64 MB) go to a Python worker at once and 4,096 rows are
# decoded at once, so a task holds its whole share of the documents several times.
TEXT_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m", "spark.sql.parquet.columnarReaderBatchSize": "512"}


def local_session(cores: str = "8", name: str = "invoicemill") -> SparkSession:
    """Session for tests and the benchmark; on a cluster use the session it gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )


def small_batches(spark: SparkSession) -> None:
    """From now on this session reads and hands on texts in small batches; what it sets itself stays. Results do not depend on it."""
    for key, value in TEXT_BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local session may fall back to its own."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/invoicemill/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """What is written meanwhile frees its shuffle files as soon as it is done; else they lie on the disks until the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, name: str, options: dict[str, object] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: survives lost executors,
    cuts the lineage, and fixes what a nondeterministic column said."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with freed_shuffles(spark):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

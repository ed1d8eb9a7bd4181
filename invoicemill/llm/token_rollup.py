"""Token counts kept as additive totals by source, language and tokenizer version.

A batch holds inserts, deletes and revised counts. Each becomes signed deltas: an insert adds a document and its tokens, a delete takes away what the
document has contributed so far, a revision does both. Totals are the sums of all deltas; a batch adds its own sums to the totals before it.

A batch is committed under its id: its signed deltas, the contributions of its documents and the new totals are written, and at last a row of the
manifest in the folder, which says what holds. A batch without that row is written anew, one with it changes nothing when run again, whichever
process opens the folder. Batches are applied one after the other.

Contributions are laid out by a hash of the document, and a batch reads only the parts that its documents fall in. They lie in runs: two runs of
equal rank become one of the next rank, so after n batches there are at most log2(n) + 1 runs, and a contribution is copied as often.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicemill.llm.texts import runs_of_rows, text_bytes
from invoicemill.llm.word_ids import word_ids

INSERT, DELETE, REVISE = "insert", "delete", "revise"
KEYS = ["source", "lang", "tokenizer_version"]
CONTRIBUTION = "doc_id bigint, source string, lang string, tokenizer_version string, tokens bigint"
TOTALS = "source string, lang string, tokenizer_version string, documents bigint, tokens bigint"
MANIFEST = "turn int, batch string, runs array<struct<path:string,rank:int>>"
PARTS = 64


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        for batch in batches:
            data, where = text_bytes(batch.column(1))
            for first, last in runs_of_rows(where):
                if last - first == 1:
                    n = np.array([len(encoder.encode(data[where[first]:where[last]]))])
                else:
                    n = np.diff(encoder.encode_rows(data[where[first]:where[last]], where[first:last + 1] - where[first])[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(n, pa.int64())], ["row", "tokens"])
    return run


def count_tokens(docs: DataFrame, tokenizer: str, *, text_col: str = "text") -> DataFrame:
    """Replaces the text by ``tokens``, its number of ids under the vocabulary at ``tokenizer`` (one that drops white space). A null text has none."""
    kept = [c for c in docs.columns if c not in (text_col, "tokens")]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_counts(tokenizer), f"row {rows.schema['row'].dataType.simpleString()}, tokens bigint").select("row.*", "tokens")


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


@dataclass
class Rollup:
    """Totals in ``folder``, which all executors share. ``history`` are the ids of the batches to look at, in order: all that are committed, unless given."""

    spark: SparkSession
    folder: str
    history: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        rows = []
        if _exists(self.spark, f"{self.folder}/manifest"):
            rows = sorted(self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{self.folder}/manifest").collect())    # a row per batch
        self.committed = tuple(r["batch"] for r in rows)
        self.runs = [(r["path"], r["rank"]) for r in rows[-1]["runs"]] if rows else []
        if self.history is None:
            self.history = self.committed

    def _path(self, table: str, batch: str) -> str:
        return f"{self.folder}/{table}/batch={batch}"

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, documents, tokens) after the last batch; keys without documents are not listed."""
        if not self.history:
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(self._path("totals", self.history[-1]))

    def _contributions(self, runs: list[tuple[str, int]]) -> DataFrame:
        """What each document of these runs counts for since the last of them that touched it; null tokens: it is gone."""
        rows = self.spark.createDataFrame([], CONTRIBUTION + ", part int, turn int")
        for turn, (path, _) in enumerate(runs):
            rows = rows.unionByName(self.spark.read.schema(CONTRIBUTION + ", part int").parquet(f"{self.folder}/{path}").withColumn("turn", F.lit(turn)))
        return rows

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id", "part").agg(F.max_by(F.struct(*KEYS, "tokens"), "turn").alias("c")).select("doc_id", "c.*", "part")

    @staticmethod
    def _lay_out(rows: DataFrame, path: str) -> None:
        rows.repartition("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(32))).write.mode("overwrite").partitionBy("part").parquet(path)

    def _merged(self, runs: list[tuple[str, int]], turn: int) -> list[tuple[str, int]]:
        while len(runs) > 1 and runs[-2][1] == runs[-1][1]:
            rank, rows = runs[-1][1] + 1, self._latest(self._contributions(runs[-2:]))
            path = f"merged/turn={turn}-rank={rank}"
            self._lay_out(rows if len(runs) > 2 else rows.where("tokens is not null"), f"{self.folder}/{path}")      # nothing lies before the first run
            runs = [*runs[:-2], (path, rank)]
        return runs

    def commit(self, batch: str, changes: DataFrame) -> "Rollup":
        """Apply changes (op, doc_id, source, lang, tokenizer_version, tokens) as batch ``batch``.

        A document that is inserted again, or revised, counts once, with its new values; a delete of an unknown document changes nothing. Of several
        changes of one document in a batch the last in the order of (op, source, lang, tokenizer_version, tokens) holds. Null sources,
        languages and versions are keys of their own; null tokens count as 0; changes without a doc_id or with another op are ignored.
        """
        now = Rollup(self.spark, self.folder)
        if batch not in now.committed:
            now._apply(batch, changes)
        return Rollup(self.spark, self.folder)

    def _apply(self, batch: str, changes: DataFrame) -> None:
        values = F.struct("op", "source", "lang", "tokenizer_version", F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))
        asked = changes.where(F.col("doc_id").isNotNull() & F.col("op").isin(INSERT, DELETE, REVISE)).groupBy(
            F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(values).alias("c"))
        asked = asked.select("doc_id", "c.*").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
        state = self._path("contributions", batch)
        # A deleted document stays as a row without tokens and without keys, so that later batches see that it is gone.
        kept = F.col("op") != DELETE
        laid = asked.select("doc_id", *[F.when(kept, F.col(k)).alias(k) for k in KEYS], F.when(kept, F.col("tokens")).alias("tokens"), "part")
        self._lay_out(laid, state)
        new = self.spark.read.schema(CONTRIBUTION + ", part int").parquet(state)
        plus = new.where("tokens is not null").select("doc_id", *KEYS, F.lit(1).alias("documents"), "tokens")
        deltas = plus
        if self.history:
            parts = [r[0] for r in new.select("part").distinct().collect()]             # at most PARTS numbers
            before = self._contributions(self.runs).where(F.col("part").isin(parts)).join(new.select("doc_id"), "doc_id", "left_semi")
            before = self._latest(before).where("tokens is not null")
            deltas = plus.unionByName(before.select("doc_id", *KEYS, F.lit(-1).alias("documents"), (-F.col("tokens")).alias("tokens")))
        deltas.write.mode("overwrite").parquet(self._path("deltas", batch))
        sums = self.spark.read.schema("doc_id bigint, source string, lang string, tokenizer_version string, documents int, tokens bigint").parquet(self._path("deltas", batch))
        total = self.totals().unionByName(sums.select(*KEYS, F.col("documents").cast("bigint").alias("documents"), "tokens")).groupBy(*KEYS).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0 or tokens <> 0")
        total.write.mode("overwrite").parquet(self._path("totals", batch))
        turn = len(self.committed)
        runs = self._merged([*self.runs, (f"contributions/batch={batch}", 0)], turn)
        self.spark.createDataFrame([(turn, batch, runs)], MANIFEST).coalesce(1).write.parquet(f"{self.folder}/manifest/turn={turn:08d}")

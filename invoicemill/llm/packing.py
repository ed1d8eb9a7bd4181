"""Packing of tokenised documents into windows by minimum bin slack.

A document's ids and one end id are cut into full windows and one remainder. Only the remainders have to be packed, and there are
fewer than ``window`` different lengths of them, so the plan needs a histogram of lengths and not the documents: a window takes
the longest length left, and a subset-sum over the other lengths (a bitset of reachable sums) picks the multiset that
fills it closest to the window. The same choice is repeated as often as the counts allow, so at least one length is used up
by each choice and there are fewer choices than lengths.

Documents get their place by rank within their length: ranks are numbered in slices by hash, so that a length that very
many documents share is numbered by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from invoicemill.llm.texts import give_back, runs_of_rows, text_bytes
from invoicemill.llm.word_ids import word_ids
from invoicemill.session import written

WINDOW = 4096
END_ID = 2
PART = 1 << 19              # bytes encoded at once: hashes and places of words take some 100 times as much
SLICES = 256                # slices in which the documents of one length are numbered


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is closest to ``capacity`` from below: {length: uses}."""
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= capacity), reverse=True):
        left, piece = min(counts[length], capacity // length), 1
        while left and not reach >> capacity & 1:            # copies of a length in powers of two
            piece = min(piece, left)
            steps.append((length, piece, reach))
            reach |= reach << length * piece & mask
            left, piece = left - piece, piece * 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, piece, before in reversed(steps):
        if not before >> total & 1:
            total -= length * piece
            used[length] = used.get(length, 0) + piece
    return used


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first_rank, ranks, uses, first_sequence, offset): document ``r`` of a length, first_rank <= r < first_rank + ranks, goes to
    sequence first_sequence + (r - first_rank) // uses, at offset + (r - first_rank) % uses * length."""
    counts, given, rows, sequence = {n: c for n, c in histogram.items() if c}, {}, [], 0
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        uses = best_fill({n: c for n, c in counts.items() if c}, window - longest)
        counts[longest] += 1
        uses[longest] = uses.get(longest, 0) + 1
        times, offset = min(counts[n] // u for n, u in uses.items()), 0
        for length in sorted(uses, reverse=True):
            u = uses[length]
            rows.append((length, given.get(length, 0), u * times, u, sequence, offset))
            given[length] = given.get(length, 0) + u * times
            offset += u * length
            counts[length] -= u * times
            if not counts[length]:
                del counts[length]
        sequence += times
    return rows


def _pieces(path: str, window: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(path), np.array([end_id], np.int32)
        for batch in batches:
            data, where = text_bytes(batch.column(1))
            for first, last in runs_of_rows(where, PART):
                if last - first == 1:
                    ids = encoder.encode(data[where[first]:where[last]], PART)
                    edges = np.array([0, len(ids)])
                else:
                    ids, edges = encoder.encode_rows(data[where[first]:where[last]], where[first:last + 1] - where[first])
                row, start, crc, total, kept = [], [], [], [], []
                for i in range(last - first):
                    own = np.concatenate([ids[edges[i]:edges[i + 1]], end])
                    for at in range(0, len(own), window):
                        piece = own[at:at + window].astype("<u4").tobytes()
                        row.append(first + i), start.append(at), crc.append(zlib.crc32(piece)), total.append(len(own))
                        if with_ids:
                            kept.append(own[at:at + window])
                length = np.minimum(np.array(total) - np.array(start), window)
                columns = [batch.column(0).take(pa.array(row)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total, pa.int64())]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(columns)])
            del batch, data
            pa.default_memory_pool().release_unused()
        give_back()
    return run


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with ``with_ids`` also ids, the token ids.

    ``tokenizer`` is the path of a vocabulary that drops white space, the same on all executors. A document's ids are followed
    by ``end_id``; its full windows are sequences of their own and its remainder is packed with others. A null text is empty: one piece
    that holds the end id. Rows that repeat an id, and rows with a null id, are documents of their own. Other columns are
    not looked at. An empty table gives an empty table. Sequence ids start at 0 and leave no gap.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(rows.mapInArrow(_pieces(tokenizer, window, end_id, with_ids), schema), "pieces")
    pieces = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SLICES)))
    sizes = written(pieces.groupBy("length", "slice").agg(F.count("*").alias("n")), "sizes")           # at most window * SLICES rows
    histogram = {length: n for length, n in sizes.groupBy("length").agg(F.sum("n")).collect()}         # at most ``window`` rows
    chosen = spark.createDataFrame(plan(histogram, window), "length bigint, first_rank bigint, ranks bigint, uses bigint, first_sequence bigint, first_offset bigint")
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)))
    place = F.row_number().over(Window.partitionBy("length", "slice").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = pieces.withColumn("place", place).join(before.select("length", "slice", F.coalesce("before", F.lit(0)).alias("before")), ["length", "slice"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("place"))
    own = ranked.join(F.broadcast(chosen), "length").where("rank >= first_rank and rank < first_rank + ranks")
    turn = F.col("rank") - F.col("first_rank")
    return own.select(
        F.col("doc_id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.floor(turn / F.col("uses"))).cast("bigint").alias("sequence_id"),
        (F.col("first_offset") + turn % F.col("uses") * F.col("length")).cast("bigint").alias("offset"), *["ids"] * with_ids)

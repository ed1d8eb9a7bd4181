"""Joins and numbering that hold when one key carries a large share of all rows.

Keys above ``HOT_ROWS`` rows are treated apart, all of them, whether they have a match or not. They are few by
arithmetic: at most one for every HOT_ROWS rows of the table. That bounds what is broadcast.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from invoicemill.session import COMPACT, written

HOT_ROWS = 1_000_000     # keys with fewer rows than this fit one task anyway
COPIES_PER_ROW = 1_000_000


def row_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, row_count); counted map-side first, so a hot key costs one row per task."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))


def hot_keys(counts: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """All keys above ``hot_rows`` (HOT_ROWS unless given)."""
    return counts.where(F.col("row_count") > (hot_rows or HOT_ROWS)).select(key)


def join_to_unique(facts: DataFrame, dimension: DataFrame, key: str, *, spread: list[str], how: str = "left",
                   counts: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """Join rows to a side that has at most one row per key (``how``: left, inner or left_semi).

    Rows of hot keys take their match, if there is one, from a broadcast of the hot keys and are then
    spread over all tasks by a hash of ``spread`` (columns that tell rows apart). The rest is an ordinary
    equi-join, for which Spark picks the strategy. ``counts`` (key, row_count) saves a
    counting pass where the counts are known already.
    """
    payload = [c for c in dimension.columns if c != key]
    side = dimension.select(F.col(key).alias("_key"), F.struct(key, *payload).alias("_match"))
    hot = hot_keys(row_counts(facts, key) if counts is None else counts, key, hot_rows)
    hot = hot.select(F.col(key).alias("_hot_key"))
    matches = side.join(F.broadcast(hot), F.col("_key") == F.col("_hot_key"), "left_semi")
    hot_side = hot.join(matches, F.col("_hot_key") == F.col("_key"), "left").select(
        F.col("_hot_key").alias(key), F.lit(True).alias("_is_hot"), F.col("_match").alias("_hot_match"))

    apart = F.col("_is_hot").isNotNull() | F.col(key).isNull()
    marked = facts.join(F.broadcast(hot_side), key, "left").withColumn(
        "_key", F.when(apart, F.concat(F.lit("h"), F.xxhash64(*spread).cast("string")))
        .otherwise(F.concat(F.lit("k"), F.col(key).cast("string"))))
    joined = marked.join(side.withColumn("_key", F.concat(F.lit("k"), F.col("_key").cast("string"))), "_key", "left")
    joined = joined.withColumn("_match", F.coalesce("_hot_match", "_match"))
    if how in ("inner", "left_semi"):
        joined = joined.where(F.col("_match").isNotNull())
    extra = [] if how == "left_semi" else [F.col(f"_match.{c}").alias(c) for c in payload]
    return joined.select(*facts.columns, *extra)


def dense_numbers(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Numbers 1..N in the order of ``order_by``, which must tell rows apart.

    A window over everything would run in one task. Instead the rows are range-partitioned, sorted and written
    with their place inside the range; the ranges' sizes then give each range its offset.
    Writing first fixes the ranges, so that both steps see the same ones, retries included.
    Only the sizes reach the driver: one number per shuffle partition, whatever the size of the data.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    stored = written(ranged.withColumns({
        "_range": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
    }), f"ranges-{name}", COMPACT)
    sizes = sorted(tuple(row) for row in stored.groupBy("_range").agg(F.count("*")).collect())
    starts = accumulate((size for _, size in sizes), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(number, start) for (number, _), start in zip(sizes, starts)], "_range int, _offset bigint")
    return stored.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_offset") + F.col("_place") + 1).cast("bigint").alias(name))


def tell_copies_apart(df: DataFrame, name: str, copies_per_row: int = COPIES_PER_ROW) -> DataFrame:
    """Adds a number that makes identical rows distinct. Copies are counted, not gathered, and
    laid out again in pieces, so a row with very many copies fills many tasks."""
    packed = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    pieces = packed.withColumn("_piece", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / copies_per_row).cast("bigint"))))
    pieces = pieces.repartition("_piece", *df.columns)
    first = F.col("_piece") * copies_per_row + 1
    last = F.least(F.col("_copies"), first + copies_per_row - 1)
    return pieces.select(*df.columns, F.explode(F.sequence(first, last)).alias(name))


def numbers_within(df: DataFrame, group: str, order_by: list[str], name: str, *,
                   hot_rows: int | None = None, copies_per_row: int = COPIES_PER_ROW) -> DataFrame:
    """``row_number`` per group; rows equal in ``order_by`` must be copies of each other.

    Groups too large for one task are numbered by position over ranges instead of a window.
    """
    hot = written(hot_keys(row_counts(df, group), group, hot_rows), "hot-groups")
    number = F.row_number().over(Window.partitionBy(group).orderBy(*order_by)).cast("int")
    if hot.isEmpty():
        return df.withColumn(name, number)
    rest = df.join(F.broadcast(hot), group, "left_anti").select(*df.columns).withColumn(name, number)
    apart = tell_copies_apart(df.join(F.broadcast(hot), group, "left_semi").select(*df.columns), "_copy", copies_per_row)
    placed = dense_numbers(apart, [group, *order_by, "_copy"], "_position")
    starts = placed.groupBy(group).agg(F.min("_position").alias("_start"))
    large = placed.join(F.broadcast(starts), group).withColumn(
        name, (F.col("_position") - F.col("_start") + 1).cast("int"))
    return rest.unionByName(large.select(*df.columns, name))

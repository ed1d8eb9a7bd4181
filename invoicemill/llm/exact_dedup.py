"""Exact duplicates by block naming.

A text is cut into blocks of fixed size. Equal blocks get equal integers and different blocks different ones, by sorting
the blocks themselves; then adjacent names are paired and the pairs named in the same way, until one name per document
is left. Names are ranks, not hashes, so two documents share (number of blocks, name) only if their texts are equal.

How it spreads: a hash of a value only decides where the value is sorted. Values that hold more than 1/HOT_SHARE of the
rows are at most HOT_SHARE by arithmetic; they are named apart and their names are broadcast, so their rows, however many,
are never sorted or moved with their content. Each level of names is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from invoicemill.session import written

BLOCK_BYTES = 4096
HOT_SHARE = 1000
BUCKETS = 1 << 20           # slices of the value space; a slice is sorted by one task
RANKS = 1 << 40             # names of one slice


def name_values(rows: DataFrame, values: list[str], total: int) -> DataFrame:
    """Replaces the columns ``values`` by ``name``: equal for equal values, different for different ones.

    ``total`` is the number of rows. Values must not be null.
    """
    rows = rows.withColumn("_h", F.xxhash64(*values))
    hot = rows.groupBy("_h").count().where(F.col("count") * HOT_SHARE > F.lit(max(total, HOT_SHARE))).select("_h")
    hot = written(hot, "hot-hashes")                                                    # fewer than HOT_SHARE rows
    hot_values = rows.join(F.broadcast(hot), "_h", "left_semi").groupBy("_h", *values).count()
    hot_names = written(hot_values.select(
        "_h", *values, F.dense_rank().over(Window.orderBy("_h", *values)).cast("bigint").alias("_hot_name")), "hot-names")
    named = rows.join(F.broadcast(hot_names), ["_h", *values], "left")
    is_hot = F.col("_hot_name").isNotNull()
    # Hot rows lose their content before the sort and are dealt out by row.
    others = [c for c in rows.columns if c not in ("_h", *values)]
    named = named.select(*others, "_hot_name", *[F.when(~is_hot, F.col(v)).alias(v) for v in values],
                         F.when(is_hot, F.pmod(F.xxhash64(*others), F.lit(BUCKETS)) + BUCKETS)
                         .otherwise(F.pmod("_h", F.lit(BUCKETS))).alias("_slice"))
    rank = F.dense_rank().over(Window.partitionBy("_slice").orderBy(*values))
    return named.select(*others, F.coalesce("_hot_name", (F.col("_slice") + 1) * RANKS + rank).alias("name"))


def identities(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, tag, n_blocks, name) per distinct (id, text); equal texts and no others share (n_blocks, name).

    ``tag`` tells rows apart that share an id. A null text counts as empty, and an empty text is one empty block.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / block_bytes)).cast("bigint")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(data).alias("tag"), data.alias("data"), n.alias("n_blocks"))
    blocks, longest = texts.agg(F.coalesce(F.sum("n_blocks"), F.lit(0)), F.coalesce(F.max("n_blocks"), F.lit(1))).first()
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1))
    cut = texts.select("id", "tag", "n_blocks", at.alias("place"), "data").withColumn(
        "data", F.expr(f"substring(data, cast(place * {block_bytes} + 1 as int), {block_bytes})"))
    level = written(name_values(cut, ["data"], blocks), "names")
    done = level.where("n_blocks = 1")
    width = longest
    rest = level.where("n_blocks > 1").withColumn("left", F.col("n_blocks"))
    while width > 1:
        pairs = rest.groupBy("id", "tag", "n_blocks", F.floor(F.col("place") / 2).alias("place")).agg(
            F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("first"),
            F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(0)).alias("second"),
            F.max(F.ceil(F.col("left") / 2)).alias("left"))
        pairs = written(pairs, "pairs")
        level = written(name_values(pairs, ["first", "second"], pairs.count()), "names")
        done = done.unionByName(level.where("`left` = 1").drop("left"))
        rest = level.where("`left` > 1")
        width = -(-width // 2)
    return done.select("id", "tag", "n_blocks", "name").distinct()


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are compared byte by byte, with no change. Of equal texts the row with the largest id stays; rows that repeat an id
    and a text are one document that is counted as often as it occurs. A null text counts as empty, empty texts equal each
    other. A null id is smaller than any other. Other columns are not looked at, and an empty table gives an empty table.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    names = identities(docs, id_col=id_col, text_col=text_col, block_bytes=block_bytes)
    rows = docs.select(F.col(id_col).alias("r_id"), F.xxhash64(data).alias("r_tag"), F.sha2(data, 256).alias("text_sha256"))
    rows = rows.join(names, F.expr("r_id <=> id and r_tag = tag")).drop("id", "tag", "r_tag")
    groups = rows.groupBy("n_blocks", "name").agg(F.max("r_id").alias("keep_id"), F.count("*").alias("group_size"))
    return rows.join(groups, ["n_blocks", "name"]).select(
        F.col("r_id").alias(id_col), "keep_id", "group_size", F.expr("r_id <=> keep_id").alias("kept"), "text_sha256")

"""Near duplicates of documents by bottom-k sketches from one hash function.

1. One pass over the texts: the distinct word shingles of a document as 64-bit hashes, of which the k smallest are its sketch.
   Documents with the same set of shingles become one class; only the classes go on.
2. Inverted lists: retained values held by one class only lead nowhere. Two sets as similar as the threshold
   share many retained values, so it is enough that each class enters the lists of its rarest ones (the prefix of its sketch in the order
   of rising frequency). Values of passages that very many documents share are at the end of that order.
3. Each list has a leader, its class of the least hash, and every class is compared with the leaders that it met. Groups of near copies
   fall into few components that way, with one pair per class and leader.
4. What is left are pairs around one leader that are in different components. The classes around a leader are dealt into
   blocks, and two blocks are compared in one task by the overlap of their sketches. Few passing pairs become rows: the sketch of the union
   estimates their similarity and whole sets decide. A block with very many passing pairs (a dense group of copies that drift apart)
   gets the whole sets instead, and only a spanning forest of its links leaves the task.

So rows grow with the classes and the lists they are in, not with the pairs of a group, and no list and no class has a cap.

Exactness: a pair at the threshold has 48 of K = 64 retained values in common on average, with a deviation of 3.5; TAU and the estimate leave more than
five deviations. Sets are compared as sets of 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from invoicemill.llm.components import components
from invoicemill.llm.texts import give_back, groups, lower_ascii, mix, runs_of_rows, text_bytes, word_hashes
from invoicemill.session import written

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
K = 64                      # retained values of a sketch
TAU = 28                    # retained values that two sets at the threshold have in common, at least
ESTIMATE_SLACK = 5          # standard deviations
BLOCK = 256                 # classes of a block; a group of two blocks is compared by one task at a time
COLUMNS = 4096              # members of sets in one product
SPARSE_PAIRS = 4            # pairs for each class up to which a group's pairs are rows; a denser group gets whole sets
BROADCAST_IDS = 1_000_000   # ids (16 MB); more are joined by a shuffle

_FACTORS = mix(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of one text; with fewer words, the whole sequence as one; without words, none."""
    w = word_hashes(lower_ascii(data))
    if not len(w):
        return w
    size = min(words, len(w))
    n = len(w) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += w[i:i + n] * _FACTORS[i]
    return np.unique(mix(total))


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY_PERCENT) -> bool:
    """Jaccard similarity of two sorted sets of at least ``percent``, in integers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and len(b) > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def may_be_similar(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, k: int = K, percent: int = SIMILARITY_PERCENT) -> bool:
    """Estimate from the sketch of the union: of the k smallest values of both sketches, the share that both hold."""
    if 100 * min(size_a, size_b) < percent * max(size_a, size_b):
        return False
    union = np.union1d(a, b)[:k]
    both = len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True))
    t = percent / 100
    slack = 0 if len(a) == size_a < k and len(b) == size_b < k and len(union) < k else ESTIMATE_SLACK * (t * (1 - t) / len(union)) ** 0.5
    return both >= (t - slack) * len(union) - 1e-9


def _sketches(words: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, where = text_bytes(batch.column(1))
            sizes, high, low, tops = [], [], [], []
            for i in range(len(batch)):
                found = shingles(data[where[i]:where[i + 1]], words)
                name = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                sizes.append(len(found)), high.append(name[0]), low.append(name[1]), tops.append(found[:k].view(np.int64))
            ends = np.cumsum([0, *map(len, tops)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *tops])))],
                ["doc_id", "n_shingles", "set_high", "set_low", "sketch"])
        give_back()
    return run


def _sketch_filter(k: int, percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("sketch_a"), batch.column("sketch_b")
            keep = [may_be_similar(a[i].values.to_numpy().view(np.uint64), b[i].values.to_numpy().view(np.uint64), na, nb, k, percent)
                    for i, (na, nb) in enumerate(zip(batch.column("size_a").to_pylist(), batch.column("size_b").to_pylist()))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            data, where = text_bytes(batch.column(1))
            for first, last in runs_of_rows(where):
                found = [shingles(data[where[i]:where[i + 1]], words).view(np.int64) for i in range(first, last)]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate(found)))], ["doc_id", "members"])
        give_back()
    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("set_a"), batch.column("set_b")
            keep = [similar(a[i].values.to_numpy(), b[i].values.to_numpy(), percent) for i in range(len(batch))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _members(table: pa.Table) -> list[np.ndarray]:
    column = table.column("members").combine_chunks()
    return [column[i].values.to_numpy().view(np.uint64) for i in range(len(column))]


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many members each set of ``a`` has in common with each of ``b``: products of incidence matrices, some members at a time."""
    total = np.zeros((len(a), len(b)), np.float32)
    if not a or not b:
        return total
    rows = lambda sets: np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    all_a, all_b, rows_a, rows_b = np.concatenate(a), np.concatenate(b), rows(a), rows(b)
    shared = np.intersect1d(all_a, all_b)
    keep_a, keep_b = np.isin(all_a, shared), np.isin(all_b, shared)
    at_a, at_b, rows_a, rows_b = np.searchsorted(shared, all_a[keep_a]), np.searchsorted(shared, all_b[keep_b]), rows_a[keep_a], rows_b[keep_b]
    for first in range(0, len(shared), COLUMNS):
        x, y = np.zeros((len(a), COLUMNS), np.float32), np.zeros((len(b), COLUMNS), np.float32)
        in_a, in_b = (at_a >= first) & (at_a < first + COLUMNS), (at_b >= first) & (at_b < first + COLUMNS)
        x[rows_a[in_a], at_a[in_a] - first] = 1
        y[rows_b[in_b], at_b[in_b] - first] = 1
        total += x @ y.T
    return total


def _cross_pairs(table: pa.Table, test) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids between the two sides of a group, or within it if it has one side, that are in different components,
    of which neither is the leader (its pairs are known) and whose overlap passes ``test(overlap, sizes_a, sizes_b)``."""
    side, ids = table.column("side").to_numpy(), table.column("doc_id").to_numpy()
    component, size = table.column("component").to_numpy(), table.column("n_shingles").to_numpy()
    sets, leader = _members(table), table.column("leader")[0].as_py()
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    within = not len(b) and table.column("lower")[0].as_py() == table.column("upper")[0].as_py() and table.column("step")[0].as_py() == 0
    if within:
        b = a
    if not len(a) or not len(b):
        return ids[:0], ids[:0]
    open_pairs = component[a][:, None] != component[b][None, :]
    open_pairs &= (ids[a] != leader)[:, None] & (ids[b] != leader)[None, :]
    if within:
        open_pairs &= ids[a][:, None] < ids[b][None, :]
    if not open_pairs.any():
        return ids[:0], ids[:0]
    passed = open_pairs & test(_overlaps([sets[i] for i in a], [sets[i] for i in b]), size[a][:, None], size[b][None, :])
    at_a, at_b = np.nonzero(passed)
    return ids[a][at_a], ids[b][at_b]


GROUP = ["leader", "class", "step", "lower", "upper"]
GROUP_SCHEMA = "leader bigint, class int, step int, lower bigint, upper bigint"


def _sketch_overlaps(k: int, tau: int, percent: int):
    """For each group the pairs with enough retained values in common, or if they are many the group's name only (dense)."""
    def enough(overlap, size_a, size_b):
        least = lambda n: np.where(n <= k * percent // 100, -(-n * percent // 100), tau)
        return (overlap >= np.minimum(least(size_a), least(size_b))) & (100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b))

    def run(batches):
        names = [*GROUP, "a", "b", "dense"]
        for table in groups(batches, GROUP):
            a, b = _cross_pairs(table, enough)
            if not len(a):
                continue
            dense = len(a) > SPARSE_PAIRS * len(table)
            if dense:
                a, b = a[:0].tolist() + [None], b[:0].tolist() + [None]
            key = [pa.array([table.column(c)[0].as_py()] * len(a), table.schema.field(c).type) for c in GROUP]
            yield pa.RecordBatch.from_arrays([*key, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([dense] * len(a), pa.bool_())], names)
    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the links: as much as components need."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept: tuple[list[int], list[int]] = ([], [])
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            kept[0].append(x), kept[1].append(y)
    return kept


def _whole_sets(percent: int):
    """For each dense group all its links by whole sets, as a spanning forest."""
    def run(batches):
        for table in groups(batches, GROUP):
            a, b = _forest(*_cross_pairs(table, lambda o, x, y: 100 * o.astype(np.int64) >= percent * (x + y - o.astype(np.int64))))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


class _Lists:
    """Inverted lists, and the sketches and sets of the classes that share a retained value with another one."""

    def __init__(self, docs: DataFrame, sketches: DataFrame, words: int, k: int, tau: int, percent: int):
        self.k, self.tau, self.percent = k, tau, percent
        held = sketches.select("doc_id", "n_shingles", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
        # Counted map-side and joined back: a value that very many classes retain is split by the join, as a window could not be.
        often = written(held.groupBy("value").agg(F.count("*").alias("lists")).where("lists > 1"), "frequent-values")
        shared = held.join(often, "value")
        small = k * percent // 100
        least = F.when(F.col("n_shingles") <= small, F.ceil(F.col("n_shingles") * percent / 100)).otherwise(tau)
        # Rank in the order of rising frequency: values held once come first, and they are not in ``shared``.
        prefix = shared.groupBy("doc_id", "n_shingles", "kept").agg(
            F.sort_array(F.collect_list(F.struct("lists", "value"))).alias("values"))
        take = F.greatest(F.lit(0), F.col("kept") - least + 1 - (F.col("kept") - F.size("values"))).cast("int")
        entries = written(prefix.select("doc_id", F.explode(F.slice("values", 1, take)).alias("v"))
                          .select("doc_id", F.col("v.value").alias("value")), "lists")
        leader = entries.groupBy("value").agg(
            F.min(F.struct(F.xxhash64("doc_id").alias("rank"), "doc_id")).alias("leader"), F.count("*").alias("n")).where("n > 1")
        self.met = written(entries.join(leader, "value").select(F.col("leader.doc_id").alias("leader"), "doc_id").distinct(), "met")
        active = written(self.met.where("leader <> doc_id").select(F.explode(F.array("leader", "doc_id")).alias("doc_id")).distinct(), "active")
        self.n_active = active.count()
        near = F.broadcast(active) if self.n_active <= BROADCAST_IDS else active
        self.sketches = written(sketches.join(near, "doc_id", "left_semi").select("doc_id", "n_shingles", "sketch"), "active-sketches")
        texts = docs.select("doc_id", "text").join(near, "doc_id", "left_semi")
        self.sets = written(texts.mapInArrow(_sets(words), "doc_id bigint, members array<bigint>"), "active-sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar: first by the estimate, then by whole sets."""
        side = lambda x: self.sketches.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_sketch_filter(self.k, self.percent), "a bigint, b bigint")
        near = written(near, "near")
        members = lambda x: self.sets.select(F.col("doc_id").alias(x), F.col("members").alias(f"set_{x}"))
        both = near.join(members("a"), "a").join(members("b"), "b")
        return written(both.mapInArrow(_verify(self.percent), "a bigint, b bigint"), "verified")

    def open_groups(self, found: DataFrame) -> DataFrame:
        """One row per class and group to compare: the classes that met a leader and are not in one component yet.

        The classes around a leader are dealt by size (similar ones are in the same or the next size class) and by hash into blocks of some
        BLOCK classes; a group is two blocks. So a leader with very many classes becomes many groups of bounded size.
        """
        placed = self.met.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
            "component", F.coalesce("component", "doc_id"))
        still = placed.groupBy("leader").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low <> high and n > 2")
        placed = placed.join(still.select("leader"), "leader", "left_semi").join(self.sketches.select("doc_id", "n_shingles"), "doc_id")
        base = math.log(101 / self.percent)
        placed = written(placed.withColumn("class", F.floor(F.log("n_shingles") / base).cast("int")), "placed")
        blocks = placed.groupBy("leader", "class").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).groupBy("leader").agg(
            F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("of_class"))
        dealt = placed.join(blocks, "leader").withColumn("own", F.expr("pmod(xxhash64(doc_id, 7), of_class[class])"))
        group = lambda c, step, low, high, side: f"named_struct('class', {c}, 'step', {step}, 'lower', {low}, 'upper', {high}, 'side', {side})"
        every = lambda c, of: f"transform(sequence(0L, coalesce(of_class[{c}], 0L)), j -> if(j < coalesce(of_class[{c}], 0L), {of}, null))"
        same = every("class", group("class", 0, "least(own, j)", "greatest(own, j)", "if(own <= j, 0, 1)"))
        above = every("class + 1", group("class", 1, "own", "j", 0))
        below = every("class - 1", group("class - 1", 1, "j", "own", 1))
        return dealt.select("leader", "doc_id", "component", "n_shingles", F.explode(F.expr(f"filter(concat({same}, {above}, {below}), x -> x is not null)")).alias("g")
                            ).select("leader", "g.*", "doc_id", "component", "n_shingles")

    def cross_links(self, found: DataFrame) -> DataFrame:
        """Links between components, all that components need."""
        rows = written(self.open_groups(found), "groups")
        met = rows.join(self.sketches.select("doc_id", F.col("sketch").alias("members")), "doc_id")
        near = written(_by_group(met).mapInArrow(_sketch_overlaps(self.k, self.tau, self.percent), f"{GROUP_SCHEMA}, a bigint, b bigint, dense boolean"), "overlaps")
        links = self.verified(near.where("not dense").select("a", "b").distinct())
        dense = rows.join(near.where("dense").select(*GROUP), GROUP, "left_semi").join(self.sets, "doc_id")
        return links.union(written(_by_group(dense).mapInArrow(_whole_sets(self.percent), "a bigint, b bigint"), "dense-links"))


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)


def near_duplicate_links(docs: DataFrame, sketches: DataFrame, *, words: int = SHINGLE_WORDS, k: int = K, tau: int = TAU,
                         percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """(node, component) over the classes of ``sketches`` (doc_id, n_shingles, sketch); single classes are not listed."""
    lists = _Lists(docs, sketches, words, k, tau, percent)
    links = lists.verified(lists.met.where("leader <> doc_id").select(F.col("doc_id").alias("a"), F.col("leader").alias("b")))
    found = written(components(links.toDF("u", "v")), "components")
    return components(links.union(lists.cross_links(found)).toDF("u", "v"))


def minhash_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, k: int = K,
                  tau: int = TAU, percent: int = SIMILARITY_PERCENT) -> DataFrame:
    """One row per distinct id: id, n_shingles, component_id, kept.

    Words are runs without space and 0x09-0x0D after A-Z is lower-cased. Documents are linked if their sets of shingles are similar by at
    least ``percent``; component_id is the smallest id that links reach. A text without words, or a null, has an empty set and
    no links. Rows with a null id are one document of their own each and never linked: component_id is null and kept true.
    Of rows that repeat an id the text that sorts first is taken. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, n_shingles bigint, set_high bigint, set_low bigint, sketch array<bigint>"
    every = written(rows.mapInArrow(_sketches(words, k), schema), "sketches")
    known = every.where("doc_id is not null")
    if known.agg(F.count("*"), F.count_distinct("doc_id")).where("`count(1)` <> `count(DISTINCT doc_id)`").count():
        rows = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text")).union(rows.where("doc_id is null"))
        every = written(rows.mapInArrow(_sketches(words, k), schema), "sketches")
        known = every.where("doc_id is not null")
    key = ["n_shingles", "set_high", "set_low"]
    classes = known.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("first_id"))
    classes = written(classes, "classes")
    firsts = known.join(classes.select(F.col("first_id").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "n_shingles", "sketch")
    found = near_duplicate_links(rows, firsts, words=words, k=k, tau=tau, percent=percent)
    placed = classes.join(found, F.col("first_id") == F.col("node"), "left").select(
        *key, F.coalesce("component", "first_id").alias("component_id"))
    result = every.select("doc_id", *key).join(placed, key, "left")
    component = F.coalesce("component_id", "doc_id")
    return result.select(F.col("doc_id").alias(id_col), "n_shingles",
                         F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))

"""Merkle manifest of a dataset, and what a change of single leaves makes of it.

The tree is persistent: a version with one changed leaf shares every node it does not lie above and copies only the ancestors of that leaf. Inside
an aligned block of ``FAN ** BLOCK_LEVELS`` leaves the copies are made where the block lies; above, the blocks' roots are the leaves of the next tree of
blocks, and so on, so a version goes on as its block's path through the upper trees, which are written once for all versions.

How it spreads: leaves are digests taken where the rows are read (texts are never moved), numbered over range partitions. A block has at most
512 leaves whatever the size of its group, so no task gets a group as a whole and a group with a third of all rows is many blocks. The upper trees have
1/512 of the rows each time. Digests are kept as 32 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from invoicemill.operators.hot_keys import dense_numbers, join_to_unique
from invoicemill.session import written

FAN = 8
BLOCK_LEVELS = 3
BLOCK = FAN ** BLOCK_LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
BROADCAST_GROUPS = 100_000      # groups (some 50 bytes each) that are broadcast after they were counted


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (32 bytes) over all fields, each with its length before it, a null as one hyphen: no two rows give the same input."""
    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[part(f) for f in fields]).cast("binary"), 256))


def _parent(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def block_tree(leaves: list[str], alone: bool) -> list[list[str]]:
    """All levels of one block, the leaves first. A block that is its whole group ends at one node, any other after BLOCK_LEVELS levels."""
    levels = [leaves]
    while len(levels[-1]) > 1 if alone else len(levels) <= BLOCK_LEVELS:
        below = levels[-1]
        levels.append([_parent(below[i:i + FAN]) for i in range(0, len(below), FAN)])
    return levels


def siblings(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """Per level what stands left and right of the path of a leaf within its run."""
    found = []
    for level in levels[:-1]:
        first = place // FAN * FAN
        found.append(("".join(level[first:place]), "".join(level[place + 1:first + FAN])))
        place //= FAN
    return found


def copied_path(digest: str, path: list[tuple[str, str]]) -> list[str]:
    """The nodes that a version with this leaf copies, from the leaf to the end of the path; all others are shared."""
    copies = [digest]
    for left, right in path:
        copies.append(sha256((left + copies[-1] + right).encode()).hexdigest())
    return copies


def _blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Nodes (grp, top, place, total, digest and payload) as one row per aligned block; ``nodes`` holds its at most BLOCK rows in order."""
    return nodes.groupBy("grp", "top", (F.col("place") / BLOCK).cast("bigint").alias("block"), "total").agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", *payload))).alias("nodes"))


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = []
        for nodes, total in zip(batch.column("nodes"), batch.column("total")):
            digests = [d.as_py().hex() for d in nodes.values.field("digest")]
            roots.append(bytes.fromhex(block_tree(digests, total.as_py() <= BLOCK)[-1][0]))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("grp", "top", "block", "total")], pa.array(roots, pa.binary())],
                                         ["grp", "top", "place", "total", "digest"])


def _up(blocks: DataFrame) -> DataFrame:
    """The roots of blocks as nodes of the tree above; each group's number of nodes shrinks to its number of blocks."""
    roots = blocks.select("grp", "top", "block", "total", "nodes").mapInArrow(
        _roots, "grp string, top boolean, place bigint, total bigint, digest binary")
    return roots.withColumn("total", F.ceil(F.col("total") / BLOCK).cast("bigint"))


PATH = "array<struct<left:string,right:string>>"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    for batch in batches:
        for nodes, total, grp, top, above in zip(*[batch.column(c) for c in ("nodes", "total", "grp", "top", "above")]):
            levels = block_tree([d.as_py().hex() for d in nodes.values.field("digest")], total.as_py() <= BLOCK)
            rest = [(p["left"], p["right"]) for p in above.as_py() or []]
            paths = [[{"left": a, "right": b} for a, b in siblings(levels, i) + rest] for i in range(len(levels[0]))]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(grp, len(paths)), pa.repeat(top, len(paths)), nodes.values.field("place"), pa.array(paths, kind)], ["grp", "top", "place", "above"])


def _same_group(a: DataFrame, b: DataFrame) -> Column:
    return a["grp"].eqNullSafe(b["grp"]) & (a["top"] == b["top"])


class MerkleManifest:
    """The tree over a table. ``leaves`` has id, grp, place and digest of every row; ``subroots`` one row per group; ``root`` is a hex string
    (that of no input at all is None). ``versions`` folds changed leaves.

    Leaves of a group ascend by id, nulls first, equal ids by digest; rows that repeat an id are leaves of their own. Groups are ordered as UTF-8 bytes,
    null before all; a null group and an empty string are two groups. Columns other than the named fields are not looked at.
    """

    def __init__(self, docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang", fields: list[str] = FIELDS, changed: Column | None = None):
        """``changed``: 32 bytes of a changed leaf (or null) as an expression over ``docs``, read in the same pass as the leaves."""
        self.id_col = id_col
        rows = docs.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
                           (F.lit(None).cast("binary") if changed is None else changed).alias("changed"))
        rows = dense_numbers(written(rows, "merkle-leaves"), ["grp", "id", "digest"], "number")     # texts are read and hashed once, not for sampling ranges too
        groups = rows.groupBy("grp").agg(F.min("number").alias("first"), F.count("*").alias("total"))
        groups = written(groups.withColumn("known", F.coalesce(F.concat(F.lit("="), "grp"), F.lit("-"))).drop("grp"), "merkle-groups")
        rows = rows.withColumn("known", F.coalesce(F.concat(F.lit("="), "grp"), F.lit("-")))
        if groups.count() <= BROADCAST_GROUPS:
            rows = rows.join(F.broadcast(groups), "known")
        else:
            rows = join_to_unique(rows, groups, "known", spread=["number"], how="inner", counts=groups.select("known", F.col("total").alias("row_count")))
        placed = rows.select("grp", F.lit(False).alias("top"), (F.col("number") - F.col("first")).alias("place"), "total", "digest", "id", "changed")
        self.blocks = written(_blocks(placed, ["id", "changed"]), "merkle-blocks")
        self.trees, tops = self._climb(_up(self.blocks))
        self.subroots = tops.select("grp", "digest")
        tree = written(dense_numbers(self.subroots, ["grp"], "number").select(
            "grp", (F.col("number") - 1).alias("place"), "digest"), "merkle-subroots")
        self.named, total = tree.select("grp", "place"), tree.count()
        first = tree.select(F.lit(None).cast("string").alias("grp"), F.lit(True).alias("top"), "place", F.lit(total).cast("bigint").alias("total"), "digest")
        lowest = written(_blocks(first, []), "merkle-top")
        above, ends = self._climb(_up(lowest))
        self.top_trees, end = [lowest, *above], ends.first()
        self.root = bytes(end["digest"]).hex() if end else None

    @staticmethod
    def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
        """The blocks of each tree above ``nodes``, until every group is one node, and these last nodes."""
        trees, done = [], None
        while True:
            nodes = written(nodes, "merkle-nodes")
            ended = nodes.where("total = 1")
            done = ended if done is None else done.unionByName(ended)
            if nodes.where("total > 1").isEmpty():
                return trees, done
            trees.append(written(_blocks(nodes.where("total > 1"), []), "merkle-tree"))
            nodes = _up(trees[-1])

    def _above(self, trees: list[DataFrame], start: DataFrame) -> DataFrame:
        """(grp, top, place, above): for each block of the lowest tree the siblings on its way to the root. ``start`` has those of each group's end."""
        known = start
        for tree in reversed(trees):
            by = tree.join(known.select(F.col("grp").alias("g"), F.col("top").alias("t"), F.col("place").alias("p"), "above"),
                           F.expr("grp <=> g and top = t and block = p"), "left").drop("g", "t", "p")
            found = by.select("nodes", "total", "grp", "top", "above").mapInArrow(_paths, f"grp string, top boolean, place bigint, above {PATH}")
            # A group that ends as one block of this tree or a lower one keeps its start for the trees below.
            known = written(found.unionByName(known.join(tree.where("block = 0").select(F.col("grp").alias("g"), F.col("top").alias("t")).distinct(),
                                                         F.expr("grp <=> g and top = t"), "left_anti")), "merkle-paths")
        return known

    def versions(self) -> DataFrame:
        """One row per leaf: id, leaf, subroot, root, proof_sha256, folded_root, verified (hex strings).

        The proof is the siblings, level by level to the root. ``folded_root`` is the root of the version whose only difference is this leaf's
        changed digest (of the original tree where nothing changed); ``verified`` tells whether that is the root. ``n_copied`` is the number of nodes that
        the version copied; it shares all others.
        """
        none = F.array().cast(PATH)
        start = self.named.select(F.lit(None).cast("string").alias("grp"), F.lit(True).alias("top"), F.lit(0).cast("bigint").alias("place"), none.alias("above")).limit(1)
        named = self.named
        tops = self._above(self.top_trees, start).select(F.col("place").alias("p"), "above")
        groups = named.join(tops, named["place"] == tops["p"]).select("grp", F.lit(False).alias("top"), F.lit(0).cast("bigint").alias("place"), "above")
        above = self._above(self.trees, written(groups, "merkle-group-paths"))
        above = above.select(F.col("grp").alias("g"), F.col("place").alias("p"), "above")
        subroots = self.subroots.select(F.col("grp").alias("s"), F.col("digest").alias("subroot"))
        blocks = self.blocks.join(above, F.expr("grp <=> g and block = p")).join(subroots, F.expr("grp <=> s"))
        kind = "id bigint, leaf string, proof_sha256 string, folded_root string, n_copied bigint, subroot string"
        kind = kind.replace("id bigint", f"id {dict(self.blocks.selectExpr('nodes[0].id as id').dtypes)['id']}")
        folded = blocks.select("nodes", "total", "above", F.lower(F.hex("subroot")).alias("subroot")).mapInArrow(_fold, kind)
        root = F.lit(self.root).cast("string")
        return folded.select(F.col("id").alias(self.id_col), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                             (F.col("folded_root") == root).alias("verified"), "n_copied")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for nodes, total, above, subroot in zip(*[batch.column(c) for c in ("nodes", "total", "above", "subroot")]):
            rows = nodes.values
            leaves = [d.as_py().hex() for d in rows.field("digest")]
            levels, rest = block_tree(leaves, total.as_py() <= BLOCK), [(p["left"], p["right"]) for p in above.as_py()]
            proofs, folded, copied = [], [], []
            for place, (leaf, other) in enumerate(zip(leaves, rows.field("changed").to_pylist())):
                path = siblings(levels, place) + rest
                proofs.append(sha256("".join(a + b for a, b in path).encode()).hexdigest())
                copies = copied_path(leaf if other is None else other.hex(), path)
                folded.append(copies[-1])
                copied.append(len(copies) if other is not None and other.hex() != leaf else 0)
            yield pa.RecordBatch.from_arrays(
                [rows.field("id"), pa.array(leaves), pa.array(proofs), pa.array(folded), pa.array(copied, pa.int64()), pa.repeat(subroot, len(leaves))],
                ["id", "leaf", "proof_sha256", "folded_root", "n_copied", "subroot"])

"""Near duplicates of embeddings by an inverted multi-index.

Unit vectors are split into halves; each half has a codebook of its own, and the pairs of codewords form a grid of cells. Every vector is filed under
the cell of its nearest codewords. As a query it visits cells in the order of the sum of both distances (multi-sequence traversal: the next cell
is always the best one whose predecessors in row and column were visited). How many cells are visited is fitted: the partners of sampled vectors
are found by brute force among all vectors, and the traversal goes on until on average TARGET_RECALL of a vector's partners are met, over
all sampled vectors with a link and over those with few partners. What meets in a cell is verified by the cosine in double precision.

Codebooks are fitted on at most SAMPLE vectors; all vectors are filed and all are queries. The number of codewords follows the number of
vectors, so that a cell holds about the same number of vectors at any size. Vectors that are equal are filed once, and a cell with very many vectors
is cut into blocks that meet in pairs, each in a task of its own. Links leave a task as counts and as one link per vector to the smallest id it
reaches there, never as all pairs.
"""

from __future__ import annotations

import heapq
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from invoicemill.llm.components import components
from invoicemill.llm.texts import groups, mix
from invoicemill.session import written

COSINE = 0.9
SAMPLE = 20_000             # vectors that codebooks are fitted on, at most
QUERIES = 2048              # vectors whose partners are looked for among all vectors in one pass, at most
ENOUGH = 200                # queries with a link that the depth is fitted on; with fewer a further pass follows
PASSES = 8                  # at most
PARTNERS = 16               # partners of a query that the depth is fitted on, at most
PARTNER_VALUES = 1 << 23    # numbers in the partners of one pass (64 MB), at most
FEW = 8                     # partners up to which a vector counts as one of a small group
CELL = 32                   # vectors per cell that the number of codewords aims at
MOST_CODEWORDS = 1024
ROUNDS = 8                  # of k-means
TARGET_RECALL = 0.995
MOST_CELLS = 64             # cells a query visits, at most; beyond, fewer codewords are used
BLOCK = 512
PAIRS_AT_ONCE = 1 << 20
MEMBERS = "vec_id bigint, n_links bigint, component_id bigint"


def _nearest(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """Squared distances to all codewords."""
    return np.maximum(0, (x ** 2).sum(1)[:, None] - 2 * x @ codebook.T + (codebook ** 2).sum(1)[None, :])


def codebook(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """k-means; a codeword that loses all its vectors takes the farthest one."""
    centres = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        distance = _nearest(x, centres)
        own = distance.argmin(1)
        count = np.bincount(own, minlength=len(centres))
        sums = np.array([np.bincount(own, x[:, j], len(centres)) for j in range(x.shape[1])]).reshape(x.shape[1], len(centres)).T
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
        empty = np.flatnonzero(count == 0)
        if len(empty):
            centres[empty] = x[np.argsort(distance.min(1))[-len(empty):]]
    return centres


def traverse(first: np.ndarray, second: np.ndarray, cells: int) -> list[int]:
    """The ``cells`` nearest cells (row * columns + column), by a queue over the product of both sorted distance lists."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    queue, seen, found = [(first[rows[0]] + second[columns[0]], 0, 0)], {(0, 0)}, []
    while queue and len(found) < cells:
        _, i, j = heapq.heappop(queue)
        found.append(int(rows[i]) * len(second) + int(columns[j]))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(rows) and b < len(columns) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(queue, (first[rows[a]] + second[columns[b]], a, b))
    return found


class MultiIndex:
    def __init__(self, first: np.ndarray, second: np.ndarray, depth: int = 1):
        self.first, self.second, self.depth = first, second, depth
        self.recall = self.recall_few = None            # over sampled queries, and over those with few partners

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _nearest(x[:, :half], self.first), _nearest(x[:, half:], self.second)

    def homes(self, x: np.ndarray) -> np.ndarray:
        a, b = self._halves(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def visits(self, x: np.ndarray, depth: int | None = None) -> list[list[int]]:
        a, b = self._halves(x)
        return [traverse(p, q, depth or self.depth) for p, q in zip(a, b)]


def fit(x: np.ndarray, total: int, queries: np.ndarray, of: np.ndarray, partners: np.ndarray, few: np.ndarray, target: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks from a sample ``x`` of unit vectors out of ``total``, depth from true links: ``partners[i]`` is one of ``queries[of[i]]``.

    Each query weighs the same, however many partners it has, and those with ``few`` partners have to reach the target by themselves too.
    """
    half = x.shape[1] // 2
    k = int(np.clip(round((total / CELL) ** 0.5), 1, MOST_CODEWORDS))
    while True:
        index = MultiIndex(codebook(x[:, :half], k), codebook(x[:, half:], k))
        if not len(queries):
            return index
        # At which place of a query's traversal the home of its partner comes.
        orders = [{c: n for n, c in enumerate(cells)} for cells in index.visits(queries, MOST_CELLS)]
        home = np.concatenate([index.homes(partners[at:at + 4096]) for at in range(0, len(partners), 4096)])
        met = np.zeros((len(queries), MOST_CELLS + 1))
        np.add.at(met, (of, [orders[q].get(c, MOST_CELLS) for q, c in zip(of.tolist(), home.tolist())]), 1)
        met = met.cumsum(1)[:, :MOST_CELLS] / met.sum(1)[:, None]
        # The query that stands closer finds the pair for both, so this recall is a lower bound.
        every, small = met.mean(0), met[few].mean(0) if few.any() else np.ones(MOST_CELLS)
        enough = np.flatnonzero((every >= target - 1e-9) & (small >= target - 1e-9))
        if len(enough):
            index.depth = int(enough[0]) + 1
            index.recall, index.recall_few = float(every[enough[0]]), float(small[enough[0]])
            return index
        k = max(1, k // 2)


def _partners(shared, cosine: float, keep: int):
    """For each query the number of its partners among all vectors of a task, and at most ``keep`` of them drawn by hash."""
    def run(batches):
        ids, queries = shared.value
        n, limit = np.zeros(len(ids), np.int64), np.full(len(ids), 1 << 63, np.uint64)
        query, rank, who = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                own = part.column("vec_id").to_numpy()
                i, q = np.nonzero((_matrix(part.column("unit")) @ queries.T >= cosine) & (own[:, None] != ids[None, :]))
                n += np.bincount(q, minlength=len(ids))
                drawn = mix(mix(own.astype(np.uint64))[i] + q.astype(np.uint64)) >> np.uint64(1)
                lower = drawn < limit[q]
                if lower.any():
                    query, rank, who = np.concatenate([query, q[lower]]), np.concatenate([rank, drawn[lower]]), np.concatenate([who, own[i[lower]]])
                    order = np.lexsort((rank, query))
                    query, rank, who = query[order], rank[order], who[order]
                    place = np.arange(len(query)) - np.searchsorted(query, query)
                    limit[query[place == keep - 1]] = rank[place == keep - 1]
                    query, rank, who = (c[place < keep] for c in (query, rank, who))
        counted = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([counted, query]), pa.int64()), pa.array([None] * len(counted) + rank.tolist(), pa.int64()),
            pa.array([None] * len(counted) + who.tolist(), pa.int64()), pa.array(np.concatenate([n[counted], np.zeros(len(query), np.int64)]), pa.int64())],
            ["query", "rank", "vec_id", "n"])
    return run


def true_links(classes: DataFrame, total: int, dim: int, cosine: float, most: int = QUERIES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    """Sampled vectors that have a link, for some of their partners the place of the vector and the partner, which vectors have few partners, and whether
    all vectors were asked.

    Partners are looked for among all vectors by brute force, ``most`` queries in a pass. Further passes follow while fewer than ENOUGH queries have a link.
    """
    spark, keep = classes.sparkSession, int(np.clip(PARTNER_VALUES // (most * max(1, dim)), 1, PARTNERS))
    share, asked, linked = min(1.0, 0.9 * most / total), 0.0, 0
    found = [(np.zeros((0, dim)), np.zeros(0, np.int64), np.zeros((0, dim)), np.zeros(0, bool))]
    place = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(1 << 30)) / (1 << 30)
    for _ in range(PASSES):
        drawn = classes.where((place >= asked) & (place < asked + share)).select("vec_id", "unit").limit(most).toArrow()
        asked += share
        if drawn.num_rows:
            queries = _matrix(drawn.column("unit"))
            shared = spark.sparkContext.broadcast((drawn.column("vec_id").to_numpy(), queries))
            pairs = classes.select("vec_id", "unit").mapInArrow(_partners(shared, cosine, keep), "query bigint, rank bigint, vec_id bigint, n bigint")
            pairs = written(pairs, "true-links")
            n = np.zeros(len(queries), np.int64)
            for q, count in pairs.where("vec_id is null").groupBy("query").agg(F.sum("n")).collect():
                n[q] = count
            own = pairs.where("vec_id is not null").withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("rank", "vec_id")))
            own = classes.select("vec_id", "unit").join(F.broadcast(own.where(F.col("place") <= keep).select("vec_id", "query")), "vec_id")
            own = own.select("query", "unit").toArrow()             # at most PARTNER_VALUES numbers
            if own.num_rows:
                at = np.cumsum(n > 0) - 1 + linked
                found.append((queries[n > 0], at[own.column("query").to_numpy()], _matrix(own.column("unit")), n[n > 0] <= FEW))
                linked += int((n > 0).sum())
        if asked >= 1 or linked >= ENOUGH:
            break
    queries, of, partners, few = (np.concatenate(c) for c in zip(*found))
    return queries, of, partners, few, asked >= 1


def planted(x: np.ndarray, cosine: float, seed: int = 6) -> np.ndarray:
    """For each unit vector one at the cosine ``cosine`` from it, in a random direction."""
    aside = np.random.default_rng(seed).normal(size=x.shape)
    aside -= (aside * x).sum(1)[:, None] * x
    aside /= np.maximum(np.linalg.norm(aside, axis=1), 1e-12)[:, None]
    return cosine * x + max(0.0, 1 - cosine ** 2) ** 0.5 * aside


def _unit(cosine_dim: int):
    """Unit vectors; null, zero, non-finite and ones of another length are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept = [], []
            for i, v in enumerate(batch.column(1)):
                if v.is_valid and len(v) == cosine_dim and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    top = np.abs(x).max() if np.isfinite(x).all() and len(x) else 0.0
                    if top > 0:
                        x = x / top
                        rows.append(i), kept.append(x / np.linalg.norm(x))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(kept, pa.list_(pa.float64()))], ["vec_id", "unit"])
    return run


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _file(index):
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column("unit"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("copies"), pa.array(index.value.homes(x), pa.int64()), pa.array(index.value.visits(x), pa.list_(pa.int64()))],
                    ["vec_id", "copies", "home", "visits"])
    return run


def reached(near: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and each column of a matrix of links reaches, by passing on what is smallest so far."""
    none = np.iinfo(np.int64).max
    while True:
        by_row = np.minimum(rows, np.where(near, columns[None, :], none).min(1))
        by_column = np.minimum(columns, np.where(near, by_row[:, None], none).min(0))
        if (by_row == rows).all() and (by_column == columns).all():
            return rows, columns
        rows, columns = by_row, by_column


def _visited(visits: pa.ListArray, homes: np.ndarray) -> np.ndarray:
    """A matrix: whether each row of ``visits`` holds each of the sorted ``homes``."""
    values = visits.flatten().to_numpy()
    row = np.repeat(np.arange(len(visits)), visits.value_lengths().to_numpy())
    place = np.minimum(np.searchsorted(homes, values), len(homes) - 1)
    hit = homes[place] == values
    found = np.zeros((len(visits), len(homes)), bool)
    found[row[hit], place[hit]] = True
    return found


def _meet(cosine: float):
    """For each group (a cell's block of residents and a block of visitors): links as counts per vector, and (u, v): v is the smallest id that u reaches.

    A pair of different cells may meet in both of them; it is counted once for each side: for the visitor always, for the resident only if
    it does not itself visit the visitor's home.
    """
    names = ["u", "v", "n"]

    def run(batches):
        for table in groups(batches, ["cell", "residents", "visitors"]):
            side, ids, home = (table.column(c).to_numpy() for c in ("side", "vec_id", "home"))
            copies, unit, visits = table.column("copies").to_numpy(), _matrix(table.column("unit")), table.column("visits").combine_chunks()
            r, v = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(r) or not len(v):
                continue
            count, from_, to, own_visits = np.zeros(len(ids), np.int64), [], [], visits.take(pa.array(r))
            for at in range(0, len(v), max(1, PAIRS_AT_ONCE // len(r))):
                some = v[at:at + max(1, PAIRS_AT_ONCE // len(r))]
                near = (unit[some] @ unit[r].T >= cosine) & (ids[some][:, None] != ids[r][None, :])
                if not near.any():
                    continue
                count[some] += near @ copies[r]
                strangers = np.flatnonzero((home[some] != home[r[0]]) & near.any(1))
                if len(strangers):
                    homes, own = np.unique(home[some[strangers]], return_inverse=True)
                    count[r] += copies[some[strangers]] @ (near[strangers] & ~_visited(own_visits, homes)[:, own].T)
                for own, least in zip((ids[some], ids[r]), reached(near, ids[some], ids[r])):
                    joined = own != least
                    from_.append(own[joined]), to.append(least[joined])
            counted = np.flatnonzero(count)
            u, least = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (from_, to))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([ids[counted], u]), pa.int64()),
                pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(least, pa.int64())]),
                pa.array(np.concatenate([count[counted], np.zeros(len(u), np.int64)]), pa.int64())], names)
    return run


def _fitted(classes: DataFrame, total: int, dim: int, cosine: float, sample: int, target: float, most: int) -> MultiIndex:
    draw = lambda share: classes.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < share * (1 << 30)).select("unit").limit(sample).toArrow()
    drawn = draw(min(1.0, 0.9 * sample / total))
    x = _matrix((drawn if drawn.num_rows else draw(1.0)).column("unit"))
    queries, of, partners, few, all_asked = true_links(classes, total, dim, cosine, most)
    linked = len(queries)
    if linked < ENOUGH and not all_asked:           # too few to measure by: pairs at the threshold, the hardest ones, count too
        more = x[:ENOUGH]
        of = np.concatenate([of, linked + np.arange(len(more))])
        queries, partners, few = np.concatenate([queries, more]), np.concatenate([partners, planted(more, cosine)]), np.concatenate([few, np.ones(len(more), bool)])
    index = fit(x, total, queries, of, partners, few, target)
    logging.getLogger(__name__).info("%d x %d codewords, %d cells visited; %d linked queries and %d planted ones, recall %s, with at most %d partners %s",
                                     len(index.first), len(index.second), index.depth, linked, len(queries) - linked, index.recall, FEW, index.recall_few)
    return index


def _of_length(known: DataFrame, dim: int, cosine: float, sample: int, target: float, queries: int) -> DataFrame:
    """(vec_id, n_links, component_id) of the vectors of one length that may link; each length has an index of its own."""
    spark = known.sparkSession
    unit = written(known.mapInArrow(_unit(dim), "vec_id bigint, unit array<double>"), "unit-vectors")
    classes = unit.groupBy("unit").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = written(classes, "vector-classes")
    total = classes.count()
    if total:
        index = _fitted(classes, total, dim, cosine, sample, target, queries)
        shared = spark.sparkContext.broadcast(index)                # at most 2 * MOST_CODEWORDS codewords
        filed = written(classes.select("vec_id", "copies", "unit").mapInArrow(_file(shared), "vec_id bigint, copies bigint, home bigint, visits array<bigint>"), "filed")
        links = _links(filed, classes, cosine)
    else:
        links = spark.createDataFrame([], "u bigint, v bigint, n bigint")
        filed = spark.createDataFrame([], "vec_id bigint, copies bigint, home bigint, visits array<bigint>")
    counts = links.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    found = components(links.where("v is not null").select("u", "v"))
    placed = classes.select("unit", "vec_id", "copies").join(counts, F.col("vec_id") == F.col("u"), "left").join(found, F.col("vec_id") == F.col("node"), "left").select(
        F.col("unit").alias("of_unit"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return unit.join(placed, F.col("unit") == F.col("of_unit")).select("vec_id", "n_links", "component_id")


def embedding_dedup(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                    sample: int = SAMPLE, target: float = TARGET_RECALL, queries: int = QUERIES) -> DataFrame:
    """One row per distinct id: id, n_links, component_id, kept.

    n_links counts the other vectors with a cosine of at least ``cosine`` that were found, component_id is the smallest id that links reach. Null and zero vectors,
    ones with null or non-finite components link with nothing, and vectors of different lengths do not link; every length costs jobs of its own. Of rows that
    repeat an id the vector that sorts first is taken; rows with a null id are each returned with no links, component_id null and kept true.
    Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    known = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    known = written(known, "vectors")
    lengths = [r[0] for r in known.where("size(vector) > 0").select(F.size("vector")).distinct().collect()]
    members = spark.createDataFrame([], MEMBERS)
    for dim in sorted(lengths):
        members = members.union(_of_length(known.where(F.size("vector") == dim), dim, cosine, sample, target, queries))
    every = known.select("vec_id").join(members, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    none = rows.where("vec_id is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return every.union(none).select(F.col("vec_id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _links(filed: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """(u, null, n): u has n more links; (u, v, 0): links lead from u to v."""
    home_blocks = filed.groupBy(F.col("home").alias("cell")).agg(F.ceil(F.count("*") / BLOCK).alias("resident_blocks"))
    visiting = filed.select("vec_id", "copies", "home", "visits", F.explode("visits").alias("cell"))
    visit_blocks = visiting.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("visitor_blocks"))
    blocks = written(home_blocks.join(visit_blocks, "cell"), "blocks")
    own = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col(n))
    columns = ["cell", "residents", "visitors", "side", "vec_id", "copies", "home", "visits"]
    resident = filed.withColumn("cell", F.col("home")).join(blocks, "cell").withColumn("residents", own("resident_blocks")).withColumn(
        "visitors", F.explode(F.expr("sequence(0L, visitor_blocks - 1)"))).withColumn("side", F.lit(0)).select(*columns)
    visitor = visiting.join(blocks, "cell").withColumn("visitors", own("visitor_blocks")).withColumn(
        "residents", F.explode(F.expr("sequence(0L, resident_blocks - 1)"))).withColumn("side", F.lit(1)).select(*columns)
    both = resident.union(visitor).join(classes.select("vec_id", "unit"), "vec_id")
    both = both.repartition("cell", "residents", "visitors").sortWithinPartitions("cell", "residents", "visitors")
    return written(both.mapInArrow(_meet(cosine), "u bigint, v bigint, n bigint"), "links")

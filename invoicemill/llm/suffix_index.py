"""Removal of long passages that occur earlier, by a logarithmic family of sparse suffix arrays.

Suffixes are taken at synchronising positions: of each window of LENGTH bytes the start of the piece of PIECE bytes whose hash is least, so every window holds
one, and equal windows hold it at the same place. A batch's suffix array is its suffixes in the order of the fingerprint of their first piece. It is merge-scanned
against the levels that exist, which tells the pieces that occur twice; then it becomes a level, and levels of equal size merge, as often as there are any.
Texts are read again only for suffixes whose piece occurs twice, and decided byte by byte:

* Windows that share a synchronising position follow each other. All of them together are a span; of equal spans the earliest place stands and every byte of the later is covered.
* Different spans around one piece may have some windows in common. Their bytes are brought together and each window is compared; where very many spans share a piece, their windows are
  dealt out by their own fingerprint instead.

How it spreads: texts are dealt once into homes of bounded size, in a bucketed table; whatever returns to a home joins it without moving texts again. Each home sends one entry per
distinct piece, span or window, so a passage in a third of all rows costs one entry per home. Fingerprints have 64 bits for pieces (a false match costs work only) and
128 bits for spans and windows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from invoicemill.llm.texts import mix, text_bytes
from invoicemill.llm.word_ids import held, ragged
from invoicemill.session import new_folder, written

LENGTH = 100                # bytes of a match
PIECE = 36                  # bytes of a fingerprinted piece; a window has LENGTH - PIECE + 1 of them
SLICE = 1 << 17             # windows hashed at once
BATCHES = 4
HOT_SPANS = 20_000          # spans around one piece that one task compares; more are dealt out by window
BUCKET_BYTES = (8 << 20, 256 << 20)     # bytes of text per bucket of fingerprints: in small tables, in large ones
HOME_BYTES = (16 << 20, 256 << 20)      # bytes of text per home
BASE = 0x5851F42D4C957F2D
_ODD = np.uint64(0x9E3779B97F4A7C15)
U64, I64, I32 = np.uint64, np.int64, np.int32


# Bytes

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def up(base: int) -> np.ndarray:
        steps = np.full(n, base, U64)
        steps[0] = 1
        return np.multiply.accumulate(steps)
    return up(BASE), up(pow(BASE, -1, 1 << 64))


class Hasher:
    """Fingerprints of ranges of a slice of bytes, by differences of a running sum over a random value per byte."""

    values = mix(np.arange(1, 257, dtype=U64) * _ODD)
    up, down = _powers(1)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Hasher.up) <= n:
            Hasher.up, Hasher.down = _powers(max(n + 1, 2 * SLICE))
        self.total = np.zeros(n + 1, U64)
        np.cumsum(self.values[data] * self.up[:n], out=self.total[1:])

    def all_of(self, size: int) -> np.ndarray:
        """Of every range of ``size`` bytes, not mixed."""
        return (self.total[size:] - self.total[:-size]) * self.down[:len(self.total) - size]

    def ranges(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[begins]) * self.down[begins] + (ends - begins).astype(U64) * _ODD)


def spans_of(data: np.ndarray, bounds: np.ndarray, length: int, piece: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per slice (h, s, at, low, high) of the spans of texts that lie one after the other (``bounds``: where each begins, and the end).

    h: fingerprint of the piece at ``at``. s: fingerprint of the bytes from ``low`` to the end of the window that begins at ``high``, and of where the piece lies in them. A slice
    may cut a span in two; both parts are spans.
    """
    pieces = length - piece + 1
    bits = U64(max(1, (SLICE + length).bit_length()))
    for first in range(0, len(data) - length + 1, SLICE):
        part = data[first:first + SLICE + length - 1]
        windows = len(part) - length + 1
        hasher = Hasher(part)
        raw = hasher.all_of(piece)
        order = raw ^ (raw >> U64(32))
        order *= U64(0x94D049BB133111EB)
        order = (order >> bits << bits) | np.arange(len(order), dtype=U64)      # of equal pieces the leftmost
        least, reach = order, 1
        while reach * 2 <= pieces:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < pieces:
            least = np.minimum(least[:len(least) - (pieces - reach)], least[pieces - reach:])
        at = (least[:windows] & ((U64(1) << bits) - U64(1))).astype(I64)
        ends = bounds[1:-1] - first
        ends = ends[(ends > 0) & (ends < len(part))]
        if len(ends):                                                           # no window crosses a bound
            crossing = (ends[:, None] - np.arange(1, length)).ravel()
            at[crossing[(crossing >= 0) & (crossing < windows)]] = -1
        begins = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        lasts = np.concatenate([begins[1:], [windows]]) - 1
        real = at[begins] >= 0
        low, high = begins[real], lasts[real]
        at = at[low]
        h = mix(raw[at])
        s = mix(hasher.ranges(low, high + length) ^ ((at - low).astype(U64) * _ODD) ^ ((high - low).astype(U64) << U64(40)))
        yield h, s, at + first, low + first, high + first


def _counted(h: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, with the sum of n."""
    order = np.lexsort((s, h))
    h, s, n = h[order], s[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])])) if len(h) else np.zeros(0, I64)
    return h[at], s[at], np.add.reduceat(n, at) if len(h) else n


def cover(doc: np.ndarray, low: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of bytes by document, merged where they overlap or touch."""
    if not len(doc):
        return doc, low, end
    order = np.lexsort((low, doc))
    doc, low, end = doc[order], low[order], end[order]
    # Ends that count within a document only: documents are moved apart.
    step = int(end.max()) + 2
    reach = np.maximum.accumulate(end + doc.astype(I64) * step) - doc.astype(I64) * step
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (low[1:] > reach[:-1])])
    at = np.flatnonzero(new)
    return doc[at], low[at], np.maximum.reduceat(end, at)


# Columns of numbers in one binary value

def packed(columns: list[np.ndarray]) -> bytes:
    """Columns one after the other, each as planes of bytes; a first column that is sorted is stored by its steps, whose high planes are zeros."""
    out = []
    for i, c in enumerate(columns):
        if i == 0:
            c = np.diff(c, prepend=c.dtype.type(0))
        out.append(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T).tobytes())
    return b"".join(out)


def unpacked(value: bytes, kinds: list[type]) -> list[np.ndarray]:
    data = np.frombuffer(value, np.uint8)
    n, out, at = len(data) // sum(np.dtype(k).itemsize for k in kinds), [], 0
    for i, kind in enumerate(kinds):
        size = np.dtype(kind).itemsize
        c = np.ascontiguousarray(data[at:at + n * size].reshape(size, n).T).view(kind).ravel()
        out.append(np.cumsum(c, dtype=kind) if i == 0 else c)
        at += n * size
    return out


def joined(values: list[bytes], kinds: list[type]) -> list[np.ndarray]:
    parts = [unpacked(v, kinds) for v in values]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def dealt(buckets: int, h: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed columns) by the range that a fingerprint lies in; the first column must be ``h``, sorted."""
    edges = np.concatenate([[0], np.searchsorted(h, np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=U64)), [len(h)]])
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), packed([c[edges[b]:edges[b + 1]] for c in columns])


WINDOWS_AT_ONCE = 500_000
ENTRY = [U64, U64, I64, np.uint32, I64, I32, I32, I32, I32]     # fingerprint, second one, id, tie, home, row, at, low, high
ENTRY_BYTES = sum(np.dtype(k).itemsize for k in ENTRY)
TWICE = [U64, np.uint32]                                        # fingerprint of a piece, number of different spans around it in a home
COVER = [I32, I32, I32]                                         # row, begin, end
SPAN = [I32, I32, I32, I32, U64]                                # row, at, low, high, fingerprint


def _earliest(e: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries sorted by both fingerprints and place, and which of them are the earliest of theirs."""
    order = np.lexsort((e[7], e[5], e[4], e[3], e[2], e[1], e[0]))
    e = [c[order] for c in e]
    return e, np.concatenate([[True], (e[0][1:] != e[0][:-1]) | (e[1][1:] != e[1][:-1])]) if len(e[0]) else np.zeros(0, bool)


def _covers(e: list[np.ndarray], length: int) -> Iterator[tuple[int, bytes]]:
    """(home, packed covers) of entries whose windows all occur earlier."""
    for home in np.unique(e[4]):
        of = e[4] == home
        yield int(home), packed(list(cover(e[5][of], e[7][of], e[8][of] + I32(length))))


# Homes

class _Home:
    """The texts of one home, one after the other."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks().sort_by("row")
        self.rows = table.column("row").to_numpy()
        self.ids = table.column("id").fill_null(np.iinfo(I64).min).to_numpy()
        texts = table.column("data").combine_chunks().cast(pa.large_binary()).cast(pa.large_string(), safe=False)
        self.data, self.bounds = text_bytes(texts)
        self.ties: dict[int, int] = {}
        if len(self.rows) and (self.rows[-1] != len(self.rows) - 1):
            raise RuntimeError("a home lacks rows")

    def tie(self, docs: np.ndarray) -> np.ndarray:
        for d in np.unique(docs).tolist():
            if d not in self.ties:
                self.ties[d] = zlib.crc32(self.data[self.bounds[d]:self.bounds[d + 1]])
        return np.fromiter((self.ties[d] for d in docs.tolist()), np.uint32, len(docs))

    def bytes_of(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
        """The bytes of spans one after the other."""
        return self.data[ragged(self.bounds[rows] + low, high.astype(I64) - low + length)]

    def entries(self, h, s, at, low, high, home: int) -> list[np.ndarray]:
        doc = np.searchsorted(self.bounds, low, "right") - 1
        base = self.bounds[doc]
        return [h, s, self.ids[doc], self.tie(doc), np.full(len(h), home, I64), doc.astype(I32), (at - base).astype(I32), (low - base).astype(I32), (high - base).astype(I32)]


def _windows(data: np.ndarray, e: list[np.ndarray], length: int, by_window: bool) -> list[np.ndarray]:
    """Entries of all windows of spans, whose bytes lie one after the other in ``data``; the first fingerprint is the piece's or the window's own."""
    n = e[8] - e[7] + 1
    starts = np.cumsum(n + length - 1) - (n + length - 1)
    inside = ragged(np.zeros(len(n), I64), n)
    begins, of = ragged(starts, n), np.repeat(np.arange(len(n)), n)
    one = Hasher(data).ranges(begins, begins + length)
    low = e[7][of] + inside.astype(I32)
    h = e[0][of]
    if by_window:
        h = mix(one ^ h ^ ((e[6][of] - low).astype(U64) * _ODD))
    return [h, one, *[c[of] for c in e[2:6]], e[6][of], low, low]


def _settled_windows(data: np.ndarray, e: list[np.ndarray], length: int, by_window: bool) -> tuple[list[np.ndarray], list[tuple]]:
    """The earliest windows of spans, and covers of all others."""
    w, first = _earliest(_windows(data, e, length, by_window))
    return [c[first] for c in w], [(n, "cover", None, v, None) for n, v in _covers([c[~first] for c in w], length)]


def homes(docs: DataFrame, *, id_col: str, text_col: str, home_bytes: int) -> DataFrame:
    """(home, row, id, data) as a table in buckets by home. A null text is empty; a text longer than a home has its own."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home, row, used = TaskContext.get().partitionId() << 24, 0, 0
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("data")).to_numpy(zero_copy_only=False)
            where = []
            for size in sizes.tolist():
                if used and used + size > home_bytes:
                    home, row, used = home + 1, 0, 0
                where.append((home, row))
                row, used = row + 1, used + size
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in where], pa.int64()), pa.array([r for _, r in where], pa.int32()), batch.column("id"), batch.column("data")],
                                             ["home", "row", "id", "data"])

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    rows = rows.mapInArrow(deal, "home bigint, row int, id bigint, data binary")
    name = f"suffix_homes_{uuid.uuid4().hex}"
    writer = rows.write.option("path", new_folder(spark, "homes")).option("compression", "zstd").format("parquet")
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "home").saveAsTable(name)
    return spark.table(name), name


# The index

class SuffixIndex:
    """The family of levels, each a sorted array of distinct fingerprints by bucket. ``add`` takes a batch, reports what occurs twice, and merges levels of equal size.

    The list of levels lies in the folder: a new process that opens it goes on where the last one ended, and a batch that is added again changes nothing.
    """

    LEVEL = "bucket int, keys binary"
    MANIFEST = "version int, batch string, level int, path string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _manifest(self) -> list:
        path = f"{self.folder}/manifest"
        return self.spark.read.schema(self.MANIFEST).parquet(path).collect() if self._exists(path) else []      # one row per batch and level

    def levels(self) -> dict[int, str]:
        rows = self._manifest()
        return {r["level"]: r["path"] for r in rows if r["version"] == max(x["version"] for x in rows) and r["level"] >= 0}

    def repeated(self) -> DataFrame:
        """(bucket, keys): sorted fingerprints that were found twice, one row per batch and bucket."""
        paths = [r["path"] for r in self._manifest() if r["level"] == -1]
        return self.spark.read.schema(self.LEVEL).parquet(*paths) if paths else self.spark.createDataFrame([], self.LEVEL)

    def add(self, batch: str, arrays: DataFrame) -> None:
        """``arrays`` (bucket, keys, twice): sorted distinct fingerprints of each home, and those that the home has twice."""
        manifest = self._manifest()
        if batch in {r["batch"] for r in manifest}:
            return
        levels, version = self.levels(), max((r["version"] for r in manifest), default=0) + 1
        merging = 0
        while merging in levels:                    # like adding one to a binary number
            merging += 1
        source = arrays.select("bucket", F.lit(-1).alias("level"), "keys", "twice")
        for level, path in levels.items():
            stored = self.spark.read.schema(self.LEVEL).parquet(path)
            source = source.unionByName(stored.select("bucket", F.lit(level).alias("level"), "keys", F.lit(None).cast("binary").alias("twice")))

        def merge_scan(table: pa.Table) -> pa.Table:
            level, keys, twice = table.column("level").to_pylist(), table.column("keys"), table.column("twice")
            own = [unpacked(k.as_py(), [U64])[0] for k, at in zip(keys, level) if at == -1]
            array, found = np.zeros(0, U64), [unpacked(t.as_py(), TWICE)[0] for t in twice if t.as_py()]
            if own:
                array, n = np.unique(np.concatenate(own), return_counts=True)
                found.append(array[n > 1])
            merged = [array]
            for k, at in zip(keys, level):
                if at >= 0 and len(array):
                    stored = unpacked(k.as_py(), [U64])[0]
                    found.append(np.intersect1d(array, stored, assume_unique=True))
                    merged += [stored] if at < merging else []
                elif 0 <= at < merging:
                    merged.append(unpacked(k.as_py(), [U64])[0])
            both = np.unique(np.concatenate(found)) if found else np.zeros(0, U64)
            bucket = table.column("bucket")[0].as_py()
            out = [(bucket, level, packed([k])) for level, k in ((merging, np.unique(np.concatenate(merged))), (-1, both)) if len(k)]
            return pa.table({"bucket": pa.array([b for b, _, _ in out], pa.int32()), "level": pa.array([at for _, at, _ in out], pa.int32()),
                             "keys": pa.array([k for _, _, k in out], pa.binary())})

        path = f"{self.folder}/level-{version}-{uuid.uuid4().hex}"
        source.groupBy("bucket").applyInArrow(merge_scan, "bucket int, level int, keys binary").write.partitionBy("level").parquet(path)
        made = {level: f"{path}/level={level}" for level in (merging, -1) if self._exists(f"{path}/level={level}")}
        kept = {level: p for level, p in levels.items() if level > merging} | made
        rows = [(version, batch, level, p) for level, p in kept.items()] or [(version, batch, -2, "")]
        self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")


# The operator

ROW = "home bigint, kind string, bucket int, value binary, data binary"


def _table(rows: list[tuple]) -> pa.Table:
    home, kind, bucket, value, data = zip(*rows) if rows else ((), (), (), (), ())
    return pa.table({"home": pa.array(home, pa.int64()), "kind": pa.array(kind, pa.string()), "bucket": pa.array(bucket, pa.int32()), "value": pa.array(value, pa.binary()), "data": pa.array(data, pa.binary())})


def _scaled(total: int, small_large: tuple[int, int], share: int) -> int:
    return min(max(small_large[0], total // share), small_large[1])


def long_match_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, piece: int | None = None, batches: int = BATCHES,
                     hot_spans: int = HOT_SPANS, index_folder: str | None = None, texts: bool = False) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and with ``texts`` kept (the bytes that stay, as binary).

    Texts are UTF-8 bytes and null is empty. A byte goes if a string of ``length`` bytes that covers it starts earlier too: in a document of smaller id or before in the same one. Whether it does is judged on
    the input. n_spans counts maximal runs of bytes that go. A null id counts as the least integer; rows that share an id are taken in the order of their texts' CRC-32, equal rows in
    any order. Other columns are not looked at; an empty table gives an empty table. What stays may end within a character.
    """
    spark = docs.sparkSession
    piece = piece or max(1, length * PIECE // LENGTH)
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    buckets = max(1, -(-total // _scaled(total, BUCKET_BYTES, 1024)))
    table, name = homes(docs, id_col=id_col, text_col=text_col, home_bytes=_scaled(total, HOME_BYTES, 512))

    def arrays(rows: pa.Table) -> pa.Table:
        home, found = _Home(rows), [(np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, I64))]
        for h, s, *_ in spans_of(home.data, home.bounds, length, piece):
            found.append(_counted(h, s, np.ones(len(h), I64)))
        h, s, n = _counted(*[np.concatenate(c) for c in zip(*found)])
        keys, first, different = np.unique(h, return_index=True, return_counts=True)
        twice = (np.add.reduceat(n, first) if len(n) else n) > 1
        number = rows.column("home")[0].as_py()
        repeats = dict(dealt(buckets, keys[twice], [keys[twice], different[twice].astype(np.uint32)]))
        out = [(number, b, k, repeats.get(b)) for b, k in dealt(buckets, keys, [keys])]
        home_, b, k, t = zip(*out) if out else ((), (), (), ())
        return pa.table({"home": pa.array(home_, pa.int64()), "bucket": pa.array(b, pa.int32()), "keys": pa.array(k, pa.binary()), "twice": pa.array(t, pa.binary())})

    own = written(table.groupBy("home").applyInArrow(arrays, "home bigint, bucket int, keys binary, twice binary"), "suffix-arrays")
    index = SuffixIndex(spark, index_folder or new_folder(spark, "suffix-index"))
    for number in range(batches):
        index.add(str(number), own.where(F.pmod(F.xxhash64("home"), F.lit(batches)) == number).select("bucket", "keys", "twice"))

    def known(rows: pa.Table) -> pa.Table:
        """Of each home's fingerprints those that occur twice; apart those around which more spans lie than one task compares."""
        homes_, keys, twice = rows.column("home").to_pylist(), rows.column("keys").to_pylist(), rows.column("twice").to_pylist()
        both = np.unique(np.concatenate([np.zeros(0, U64), *[unpacked(k, [U64])[0] for k, home in zip(keys, homes_) if home is None]]))
        spans, here = np.zeros(len(both), I64), {}
        for home, k, t in zip(homes_, keys, twice):
            if home is not None:
                k = unpacked(k, [U64])[0]
                here[home] = k[held(both, k)]
                spans[np.searchsorted(both, here[home])] += 1
                if t:
                    k, n = unpacked(t, TWICE)
                    spans[np.searchsorted(both, k)] += n.astype(I64) - 1
        hot = spans > hot_spans
        out = []
        for home, k in here.items():
            is_hot = hot[np.searchsorted(both, k)]
            out += [(home, kind, 0, packed([some]), None) for kind, some in (("keys", k[~is_hot]), ("hot", k[is_hot])) if len(some)]
        return _table(out)

    asked = own.unionByName(index.repeated().select(F.lit(None).cast("bigint").alias("home"), "bucket", "keys", F.lit(None).cast("binary").alias("twice")))
    back = asked.groupBy("bucket").applyInArrow(known, ROW)

    def own_entries(key: tuple, rows: pa.Table, side: pa.Table) -> pa.Table:
        """One entry per distinct span whose piece occurs twice; later places of the same span in this home are covered."""
        if not len(side) or not len(rows):
            return _table([])
        home, number = _Home(rows), key[0].as_py()
        sets = {kind: np.sort(joined([v for v, k in zip(side.column("value").to_pylist(), side.column("kind").to_pylist()) if k == kind], [U64])[0]) for kind in ("keys", "hot")}
        found, out = {"keys": [], "hot": []}, []
        for h, *rest in spans_of(home.data, home.bounds, length, piece):
            for kind, keys in sets.items():
                here = held(keys, h)
                e, first = _earliest(home.entries(h[here], *[c[here] for c in rest], number))
                out += [(n, "cover", None, v, None) for n, v in _covers([c[~first] for c in e], length)]
                found[kind].append([c[first] for c in e])
        for kind, parts in found.items():
            if parts:
                e, first = _earliest([np.concatenate(c) for c in zip(*parts)])
                out += [(n, "cover", None, v, None) for n, v in _covers([c[~first] for c in e], length)]
                e = [c[first] for c in e]
                if kind == "hot":
                    e, covers = _settled_windows(home.bytes_of(e[5], e[7], e[8], length), e, length, True)
                    out += covers
                out += [(None, "entry" if kind == "keys" else "window", b, v, None) for b, v in dealt(buckets, e[0], e)]
        return _table(out)

    first_pass = written(table.groupBy("home").cogroup(back.groupBy("home")).applyInArrow(own_entries, ROW), "span-entries")

    def settle(rows: pa.Table) -> pa.Table:
        """Later places of equal spans are covered; the earliest places of different spans around one piece are asked for their bytes."""
        e, first = _earliest(joined([v.as_py() for v in rows.column("value")], ENTRY))
        out = [(n, "cover", None, v, None) for n, v in _covers([c[~first] for c in e], length)]
        e = [c[first] for c in e]
        _, where, n = np.unique(e[0], return_inverse=True, return_counts=True)
        n = n[where]
        e, n = [c[n > 1] for c in e], n[n > 1]
        for home in np.unique(e[4]):
            of = np.flatnonzero(e[4] == home)
            of = of[np.argsort(e[5][of], kind="stable")]
            out.append((int(home), "span", None, packed([e[c][of] for c in (5, 6, 7, 8, 0)]), None))
        return _table(out)

    second_pass = written(first_pass.where("kind = 'entry'").groupBy("bucket").applyInArrow(settle, ROW), "spans")

    def span_bytes(key: tuple, rows: pa.Table, side: pa.Table) -> pa.Table:
        """The spans that are asked for with their bytes, dealt by piece."""
        if not len(side):
            return _table([])
        home, number = _Home(rows), key[0].as_py()
        row, at, low, high, h = joined([v.as_py() for v in side.column("value")], SPAN)
        order = np.argsort(h, kind="stable")
        row, at, low, high, h = [c[order] for c in (row, at, low, high, h)]
        e = [h, np.zeros(len(h), U64), home.ids[row], home.tie(row), np.full(len(h), number, I64), row, at, low, high]
        data = home.bytes_of(row, low, high, length)
        ends = np.concatenate([[0], np.cumsum(high.astype(I64) - low + length)])
        out, done = [], 0
        for b, v in dealt(buckets, h, e):
            n = len(v) // ENTRY_BYTES
            out.append((None, "bytes", b, v, data[ends[done]:ends[done + n]].tobytes()))
            done += n
        return _table(out)

    asked = second_pass.where("kind = 'span'")
    third_pass = table.groupBy("home").cogroup(asked.groupBy("home")).applyInArrow(span_bytes, ROW)

    def compare(rows: pa.Table) -> pa.Table:
        """Windows of different spans around one piece; all spans of a piece are here."""
        e = joined([v.as_py() for v in rows.column("value")], ENTRY)
        sizes = e[8].astype(I64) - e[7] + length
        begins = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(v.as_py() for v in rows.column("data")), np.uint8)
        order = np.argsort(e[0], kind="stable")
        e, begins, sizes = [c[order] for c in e], begins[order], sizes[order]
        out, pieces = [], np.concatenate([[0], np.flatnonzero(e[0][1:] != e[0][:-1]) + 1, [len(order)]])
        windows = np.concatenate([[0], np.cumsum(e[8].astype(I64) - e[7] + 1)])
        at = 0
        while at < len(pieces) - 1:                 # some pieces at a time, so that few windows are held at once
            to = max(at + 1, int(np.searchsorted(windows[pieces], windows[pieces[at]] + WINDOWS_AT_ONCE)))
            to = min(to, len(pieces) - 1)
            some = slice(pieces[at], pieces[to])
            out += _settled_windows(data[ragged(begins[some], sizes[some])], [c[some] for c in e], length, False)[1]
            at = to
        return _table(out)

    compared = third_pass.groupBy("bucket").applyInArrow(compare, ROW)

    def later(rows: pa.Table) -> pa.Table:
        e, first = _earliest(joined([v.as_py() for v in rows.column("value")], ENTRY))
        return _table([(n, "cover", None, v, None) for n, v in _covers([c[~first] for c in e], length)])

    last = first_pass.where("kind = 'window'").groupBy("bucket").applyInArrow(later, ROW)
    covers = first_pass.where("kind = 'cover'").unionByName(second_pass.where("kind = 'cover'")).unionByName(compared).unionByName(last)

    def cut(key: tuple, rows: pa.Table, side: pa.Table) -> pa.Table:
        home = _Home(rows)
        doc, low, end = cover(*joined([v.as_py() for v in side.column("value")], COVER))
        edges = np.searchsorted(doc, np.arange(len(home.rows) + 1))
        sizes = np.diff(home.bounds)
        removed = np.concatenate([[0], np.cumsum(end.astype(I64) - low)])
        removed, spans, digests, left = removed[edges[1:]] - removed[edges[:-1]], np.diff(edges), [], []
        for i in range(len(home.rows)):
            text, at, kept = home.data[home.bounds[i]:home.bounds[i + 1]], 0, []
            for a, b in zip(low[edges[i]:edges[i + 1]].tolist(), end[edges[i]:edges[i + 1]].tolist()):
                kept.append(text[at:a].tobytes())
                at = b
            whole = b"".join([*kept, text[at:].tobytes()])
            digests.append(hashlib.sha256(whole).hexdigest())
            left.append(whole if texts else None)
        ids = rows.sort_by("row").column("id")
        return pa.table({"id": ids, "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                         "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(left, pa.binary())})

    kind = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    done = table.groupBy("home").cogroup(covers.groupBy("home")).applyInArrow(cut, kind)
    spark.sql(f"DROP TABLE {name}")         # the files stay: they are the caller's to clear, like all written tables
    done = done.withColumnRenamed("id", id_col)
    return done if texts else done.drop("kept")

"""Exact and near duplicates of lines by a deletion-neighbourhood join, in DataFrame expressions only.

Two lines within one edit (a character changed, added or removed) have a variant in common: each with one character deleted, or the shorter
as it is. Emitting all variants of all lines would be as many rows as the corpus has characters. But a single edit leaves all but one segment
of a line as it is, so a line first emits one hash per segment, of everything but that segment; only segments whose rest another line shares go on, and
only their deletions are emitted as hashed keys. Each segment is hashed once; what is left and right of it is a sum of such hashes, so the work is linear in the line.

Keys of changed characters hold the place of the deletion, so all lines with one key are within one edit of each other, and it is enough to compare each
with the earliest. A key of an added character meets the one line that it is equal to. So rows grow with the lines, and a key that very many lines
share is summed map-side; no pairs within a group are formed. The witnesses found are verified by their edit distance.

Lines are known by two 64-bit hashes; texts are moved only for lines that share a segment key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from invoicemill.session import written

SEGMENTS = 3                # segments of a line of up to SEGMENTS * SEGMENT_CHARS characters
SEGMENT_CHARS = 256         # characters of each segment of a longer one
SUMS = 128                  # running sums that are built at once
BROADCAST_ROWS = 1_000_000  # keys (16 MB); more are joined by a shuffle
LINE = ["h", "h2"]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line: doc_id, line_no from 0, line, its hashes and length."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n", -1)).alias("line_no", "line"))
    return rows.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line", F.xxhash64("line").alias("h"),
                       F.xxhash64(F.lit(2), "line").alias("h2"), F.char_length("line").alias("n"))


def _bounded(rows: DataFrame, most: int) -> DataFrame:
    """A small table is broadcast after its rows were counted; another one is left to a shuffle."""
    return F.broadcast(rows) if rows.count() <= most else rows


def _short_hashes(lines: DataFrame) -> DataFrame:
    """The hashes of the segments of lines of few segments, in columns, so that they compile to straight code: e as prefix and suffix of the line as it is, p and s as
    the longer one."""
    def part(m: str, t: int, moved: int) -> Column:
        edge = lambda t: f"cast(floor(({m}) * {t} / {SEGMENTS}) as int)"
        return F.expr(f"if(({m}) <= {SEGMENTS * SEGMENT_CHARS}, xxhash64(substring(line, {edge(t)} + {1 + moved}, {edge(t + 1)} - {edge(t)})), 0L)")
    return lines.withColumns({f"e{t}": part("n", t, 0) for t in range(SEGMENTS)} | {f"p{t}": part("n - 1", t, 0) for t in range(SEGMENTS - 1)}
                             | {f"s{t}": part("n - 1", t, 1) for t in range(1, SEGMENTS)})


def _short(m: str, before: str, after: str) -> str:
    """Keys of a line of few segments from the hashes before and after each."""
    one = lambda t: (f"named_struct('m', {m}, 't', {t}, 'rest', xxhash64({m}, {t}" + "".join(f", {before if j < t else after}{j}" for j in range(SEGMENTS) if j != t) + "))")
    return ", ".join(map(one, range(SEGMENTS)))


def _long(m: str) -> str:
    """Keys of a line of many segments. Segment j as prefix and as suffix counts with its place; key t is the sum of prefixes before it and suffixes after it."""
    pieces = lambda of: f"transform(regexp_extract_all({of}, '(?s).{{1,{SEGMENT_CHARS}}}', 0), (c, j) -> shiftrightunsigned(xxhash64(j, c), 8))"
    prefixes, suffixes = pieces("line"), pieces(f"if(n = {m}, line, substring(line, 2))")
    # Sums of prefix minus suffix before each segment, some at a time so that arrays that grow stay short. Hashes have 56 bits and sums wrap within 60.
    wrap = lambda sum: f"(({sum}) & {(1 << 60) - 1})"
    chunk = f"slice(d, i * {SUMS} + 1, {SUMS})"
    inner = f"aggregate({chunk}, named_struct('sum', acc.sum, 'sums', cast(array() as array<bigint>)), (a, x) -> named_struct('sum', {wrap('a.sum + x')}, 'sums', concat(a.sums, array(a.sum))))"
    sums = (f"flatten(aggregate(sequence(0, cast(floor((size(d) - 1) / {SUMS}) as int)), named_struct('sum', 0L, 'all', cast(array() as array<array<bigint>>)), "
            f"(acc, i) -> transform(array({inner}), b -> named_struct('sum', b.sum, 'all', concat(acc.all, array(b.sums))))[0]).all)")
    total = f"aggregate(s, 0L, (a, x) -> {wrap('a + x')})"
    keys = (f"transform(arrays_zip(s, sums), (y, t) -> named_struct('m', {m}, 't', t, 'rest', transform(array(named_struct('after', y.s, 'before', y.sums)), "
            f"z -> xxhash64({m}, t, {wrap('total - z.after + z.before')}))[0]))")
    one = lambda name, value, body: f"flatten(transform(array({value}), {name} -> {body}))"
    return one("p", prefixes, one("s", suffixes, one("d", f"transform(s, (x, j) -> coalesce(p[j], 0L) - x)", one("sums", sums, one("total", total, keys)))))


def _segments() -> Column:
    """(m, t, rest) for the line as the shorter or an equal one (m = n) and as the longer one (m = n - 1): the hash of all but segment t. How a line is cut
    depends on m alone."""
    most, as_is, longer = SEGMENTS * SEGMENT_CHARS, _short("n", "e", "e"), _short("n - 1", "p", "s")
    return F.expr(f"if(n <= {most}, array({as_is}, {longer}), concat({_long('n')}, if(n - 1 <= {most}, array({longer}), {_long('n - 1')})))")


def _cut(keys: DataFrame) -> DataFrame:
    """How many characters of the line lie before and after the segment."""
    short = F.col("m") <= SEGMENTS * SEGMENT_CHARS
    edge = lambda t: F.when(short, F.floor(F.col("m") * t / SEGMENTS)).otherwise(F.least(F.col("m"), t * SEGMENT_CHARS)).cast("int")
    return keys.withColumns({"before": edge(F.col("t")), "after": F.col("m") - edge(F.col("t") + 1)})


def _variants() -> Column:
    """Keys of one segment: 'e' with a character deleted, for lines of equal length; 'w' as it is; 'l' with a character deleted, for the longer line."""
    middle = "substring(line, before + 1, n - before - after)"
    deleted = f"transform(sequence(1, n - before - after), i -> {{}})"
    rest = "concat(substring(x, 1, i - 1), substring(x, i + 1))"
    equal = "named_struct('kind', 'e', 'key', xxhash64('e', rest, i, " + rest + "))"
    longer = "named_struct('kind', 'l', 'key', xxhash64('w', rest, " + rest + "))"
    whole = "array(named_struct('kind', 'w', 'key', xxhash64('w', rest, x)))"
    over = lambda what: f"if(n - before - after < 1, array(), {deleted.format(what)})"
    return F.expr(f"flatten(transform(array({middle}), x -> if(m = n, concat({whole}, {over(equal)}), {over(longer)})))")


def _within_one(a: str, b: str) -> Column:
    """At most one edit. Of long lines only what is left between equal chunks from the begin and from the end is compared."""
    chunks = lambda x: F.regexp_extract_all(x, F.lit(f"(?s).{{1,{SEGMENT_CHARS}}}"), F.lit(0))

    def apart(x: Column, y: Column) -> tuple[Column, Column]:
        """Both without the chunks that they begin with alike, and turned round."""
        same = F.array_position(F.zip_with(chunks(x), chunks(y), lambda v, w: v.eqNullSafe(w)), False) - 1
        rest = lambda z: F.reverse(F.substring(z, (same * SEGMENT_CHARS + 1).cast("int"), F.lit(1 << 30)))
        return rest(x), rest(y)

    near = lambda x, y: F.levenshtein(x, y, 1).between(0, 1)
    middle = F.get(F.transform(F.array(F.struct(*[c.alias(n) for c, n in zip(apart(F.col(a), F.col(b)), "xy")])), lambda r: F.struct(*[
        c.alias(n) for c, n in zip(apart(r["x"], r["y"]), "xy")])), F.lit(0))
    long = (F.length(middle["x"]) <= 4 * SEGMENT_CHARS) & (F.length(middle["y"]) <= 4 * SEGMENT_CHARS) & near(middle["x"], middle["y"])
    return F.when(F.greatest(F.length(a), F.length(b)) <= 4 * SEGMENT_CHARS, near(F.col(a), F.col(b))).otherwise(long)


def _solid(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("line").rlike("[^ \\t\\r\\f\\x0b]"))


def near_lines(docs: DataFrame, first: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(h, h2, witness): lines whose first place has an earlier line within one edit; the witness is the earliest such line's first place."""
    lines = _solid(_lines(docs, id_col, text_col))
    keyed = written(_short_hashes(lines).select(*LINE, "n", F.explode(_segments()).alias("s")).select(*LINE, "n", "s.*"), "segments")
    shared = keyed.groupBy("rest").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high").select("rest")
    shared = _bounded(written(shared, "shared-rests"), broadcast_rows)
    hits = written(_cut(keyed.join(shared, "rest", "left_semi").distinct()), "hits")
    named = _bounded(written(hits.select(*LINE).distinct(), "hit-lines"), broadcast_rows)
    texts = written(lines.join(named, LINE, "left_semi").groupBy(*LINE).agg(F.min("line").alias("line")), "hit-texts")
    placed = hits.select(*LINE).distinct().join(first, LINE)
    texts = written(texts.join(placed, LINE), "hit-places")
    emitted = hits.join(texts.select(*LINE, "line", "first"), LINE).select(
        *LINE, F.struct("first.doc_id", "first.line_no", *LINE).alias("place"), F.explode(_variants()).alias("v")).select(*LINE, "place", "v.*")
    emitted = written(emitted, "variants")
    least = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("place"))).alias(kind)
    best = emitted.groupBy("key").agg(F.count("*").alias("n"), least("e"), least("w"), least("l")).where("n > 1").drop("n")
    witness = F.when(F.col("kind") == "e", F.col("e")).when(F.col("kind") == "l", F.col("w")).otherwise(F.col("l"))
    found = emitted.join(best, "key").withColumn("witness", witness).where("witness is not null and witness < place")
    found = found.groupBy(*LINE).agg(F.min("witness").alias("witness"))
    side = texts.select(F.col("h").alias("wh"), F.col("h2").alias("wh2"), F.col("line").alias("other"))
    checked = found.join(texts.select(*LINE, "line"), LINE).join(side, (F.col("witness.h") == F.col("wh")) & (F.col("witness.h2") == F.col("wh2")))
    return checked.where(_within_one("line", "other")).select(*LINE, F.struct("witness.doc_id", "witness.line_no").alias("witness"))


def line_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per line that is not blank: id, line_no, kept, keep_doc_id, keep_line_no, edits.

    Lines are what line feeds part, numbered from 0 within a row. The earliest place in the order of (id, line_no) of equal lines stays. A line
    goes, everywhere, if an earlier line that is not blank is within one edit of it; edits is then 1 and the keep columns name the earliest such
    line, else they name the first place of the line itself and edits is 0. A null text has no lines, blank lines always stay and are not listed. A null id
    is before all others; rows that repeat an id have the same places, and the first of equal places stands for both. Other
    columns are not looked at.
    """
    lines = _solid(_lines(docs, id_col, text_col)).drop("line", "n")
    first = written(lines.groupBy(*LINE).agg(F.min(F.struct("doc_id", "line_no")).alias("first")), "first-places")
    near = near_lines(docs, first, id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows)
    decided = first.join(near, LINE, "left").select(*LINE, "first", "witness")
    keep = F.coalesce("witness", "first")
    return lines.join(decided, LINE).select(
        F.col("doc_id").alias(id_col), "line_no",
        (F.col("witness").isNull() & F.expr("struct(doc_id, line_no) <=> first")).alias("kept"),
        keep["doc_id"].alias("keep_doc_id"), keep["line_no"].alias("keep_line_no"),
        F.when(F.col("witness").isNull(), 0).otherwise(1).cast("bigint").alias("edits"))


def without_dropped_lines(docs: DataFrame, decisions: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their dropped lines taken out; all other columns as they are."""
    dropped = decisions.where("not kept").groupBy(F.col(id_col).alias("_id")).agg(F.collect_set("line_no").alias("_dropped"))
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.array_contains("_dropped", i.cast("bigint")), F.lit(False))), "\n")
    return docs.join(dropped, F.col(id_col).eqNullSafe(F.col("_id")), "left").withColumn(text_col, left).select(*docs.columns)

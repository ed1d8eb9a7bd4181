"""Repair of the structure of conversations at least cost, by an automaton whose nodes are shared suffixes of role/fault signatures.

Each row of a conversation is one symbol: the initial of its role and its fault. What it costs to repair the rest of a conversation depends on that rest and on
the state of the grammar alone, so it is worked out once per distinct suffix and state, whatever the number of conversations that end
alike: signatures are sorted by their reverse, neighbours share the nodes of their common suffix, and a task keeps only the nodes of one signature.
A node holds, per state, the cost, the first edit of the cheapest audit and the state that this edit leads to; the rest of the audit is that of the node it points to.

How it spreads: signatures are built from range partitions of narrow rows, so one conversation with a third of all rows is many pieces of one byte a row; joining the
pieces gives a value as long as the audit that is asked for. Texts move once, for the digest of the repaired conversation, which is sequential: one task
reads a conversation as a stream and keeps no row of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from invoicemill.operators.hot_keys import join_to_unique
from invoicemill.session import written

WHITE = "\\x20\\x09-\\x0D"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"                        # any other role is the fourth
LEGAL = ("su", "ua", "au")
START, SYSTEM, USER, ASSISTANT = range(4)                           # states of s?(ua)+: what came last
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}       # of user and assistant the one that may follow
KEEP, REROLE, DELETE, INSERT = ("K", 0), ("R", 2), ("D", 3), ("I", 2)
TRUNCATED_COST = 1
FAR = 1 << 60

Node = list[tuple[int, str, int]]       # per state: cost, first edit, state after it


def symbol(role: Column, fault: Column) -> Column:
    """One character per row: a for s/none, b for s/blank, ... by initial, then fault."""
    initial = F.substring(role, 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(97) + number * 4 + fault)


def read_symbol(code: str) -> tuple[str, int]:
    initial, fault = divmod(ord(code) - 97, 4)
    return "sua?"[initial], fault


def _with_inserts(node: Node) -> Node:
    """Adds the edit of inserting the row that each state waits for; two in a row are enough, as a third would only repeat the first."""
    for _ in range(3):
        for state, wanted in WANTED.items():
            after = NEXT[state, wanted]
            node[state] = min(node[state], (node[after][0] + INSERT[1], INSERT[0], after))
    return node


def last_node() -> Node:
    """Nothing is left: the conversation may end as it began or after an assistant."""
    return _with_inserts([(0, "", START) if s in (START, ASSISTANT) else (FAR, "", s) for s in range(4)])


def node_before(code: str, rest: Node) -> Node:
    """The node of a suffix from its first symbol and the node of the rest. All edits of one state differ in their letter, so a tie is settled by it."""
    initial, fault = read_symbol(code)
    node = []
    for state in range(4):
        edits = [(rest[state][0] + DELETE[1], DELETE[0], state)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED_COST if fault == TRUNCATED else 0
            if (state, initial) in NEXT:
                after = NEXT[state, initial]
                edits.append((rest[after][0] + KEEP[1] + more, KEEP[0], after))
            after = NEXT[state, WANTED[state]]
            edits.append((rest[after][0] + REROLE[1] + more, REROLE[0], after))
        node.append(min(edits))
    return _with_inserts(node)


class SuffixNodes:
    """The nodes of one signature's suffixes, from the end; the next signature reuses those of the suffix both have in common."""

    def __init__(self) -> None:
        self.codes, self.nodes, self.made = "", [last_node()], 1

    def read(self, signature: str) -> tuple[int, str]:
        """(cost, audit) of a signature."""
        backward, common = signature[::-1], 0
        most = min(len(backward), len(self.codes))
        while common < most and backward[common] == self.codes[common]:
            common += 1
        del self.nodes[common + 1:]
        for code in backward[common:]:
            self.nodes.append(node_before(code, self.nodes[-1]))
        self.made += len(backward) - common
        self.codes = backward
        state, left, audit = START, len(backward), []
        while (edit := self.nodes[left][state])[1]:
            audit.append(edit[1])
            left, state = left - (edit[1] != INSERT[0]), edit[2]
        return self.nodes[-1][START][0], "".join(audit)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = SuffixNodes()
    for batch in batches:
        found = [automaton.read(s) for s in batch.column("signature").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("signature"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                                         ["signature", "cost", "audit"])


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of each distinct signature. Sorted by their reverse, those of one task that end alike follow each other."""
    backward = F.reverse("signature")
    ranged = signatures.select("signature").distinct().repartitionByRange(backward).sortWithinPartitions(backward)
    return ranged.mapInArrow(_judge, "signature string, cost bigint, audit string")


def _rows(turns: DataFrame) -> DataFrame:
    """Rows with a place: turn (nulls first), then a digest of role and text, so that rows of one turn have an order and equal rows are equal."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").alias("conv"), "turn", clean("role").alias("role"), clean("text").alias("text"))
    return rows.withColumn("tie", F.unhex(F.sha2(F.concat("role", F.lit(":"), "text").cast("binary"), 256)))


def _faults(rows: DataFrame) -> DataFrame:
    """Narrow rows (conv, turn, tie, symbols): equal rows of one turn are one row with as many symbols. ``first`` is the earliest place of the same role and text."""
    ends = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    fault = F.when(~F.col("text").rlike(f"[^{WHITE}]"), BLANK).when(~ends.rlike("[.!?]\\z"), TRUNCATED).otherwise(NONE)
    said = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    narrow = rows.select("conv", "turn", "tie", said.alias("said"), symbol(F.col("role"), fault).alias("symbol"), symbol(F.col("role"), F.lit(DUPLICATE)).alias("again"),
                         (fault == BLANK).alias("is_blank"))
    narrow = written(narrow.groupBy("conv", "turn", "tie", "said", "symbol", "again", "is_blank").agg(F.count("*").alias("n")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "tie")
    first = narrow.groupBy(F.col("conv").alias("c"), F.col("said").alias("s")).agg(F.min(place).alias("first"), F.count("*").alias("places")).where("places > 1")
    found = narrow.join(first, F.expr("conv <=> c and said = s"), "left")
    earliest = F.coalesce(place == F.col("first"), F.col("first").isNull())
    repeats = F.when(F.col("is_blank"), F.expr("repeat(symbol, cast(n as int))")).when(
        earliest, F.concat("symbol", F.expr("repeat(again, cast(n - 1 as int))"))).otherwise(F.expr("repeat(again, cast(n as int))"))
    return found.select("conv", "turn", "tie", repeats.alias("symbols"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The symbols of each run of one conversation in a sorted partition, at most one Arrow batch to a piece."""
    for number, batch in enumerate(batches):
        convs, symbols = batch.column("conv").to_pylist(), batch.column("symbols").to_pylist()
        cuts = [0, *(i for i in range(1, len(convs)) if convs[i] != convs[i - 1]), len(convs)] if convs else []
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv").take(pa.array(cuts[:-1], pa.int64())), batch.column("part").take(pa.array(cuts[:-1], pa.int64())),
             pa.array([number] * max(0, len(cuts) - 1), pa.int64()), pa.array(["".join(symbols[a:b]) for a, b in zip(cuts, cuts[1:])], pa.string())],
            ["conv", "part", "number", "piece"])


def signatures(rows: DataFrame) -> DataFrame:
    """(conv, signature, gaps) of every conversation that has rows."""
    faults = written(_faults(rows), "turn-symbols")
    conv = dict(faults.dtypes)["conv"]
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "tie"]
    ranged = faults.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "symbols", F.spark_partition_id().cast("bigint").alias("part"))
    pieces = ranged.mapInArrow(_pieces, f"conv {conv}, part bigint, number bigint, piece string")
    whole = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "number", "piece"))).alias("pieces"))
    whole = whole.select("conv", F.array_join("pieces.piece", "").alias("signature"))
    turns = faults.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    return whole.join(turns, F.expr("conv <=> c")).drop("c")


def _count(fault: int) -> Column:
    codes = "".join(chr(97 + i * 4 + fault) for i in range(4))
    return F.octet_length(F.regexp_replace("signature", f"[^{codes}]", "")).cast("bigint")


def _illegal() -> Column:
    """Neighbours whose initials are no legal pair; a look-ahead finds pairs that overlap."""
    initials = F.translate("signature", "abcdefghijklmnop", "ssssuuuuaaaa????")
    legal = F.regexp_count(initials, F.lit("(?=" + "|".join(LEGAL) + ")"))
    return F.greatest(F.octet_length("signature") - 1 - legal, F.lit(0)).cast("bigint")


class _Repaired:
    """Applies an audit to the rows of a conversation as they come and digests what stays."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.lines = audit, 0, START, sha256(), 0

    def _line(self, role: str, text: str, initial: str) -> None:
        self.digest.update(f"{'' if not self.lines else chr(10)}{role}:{text}".encode())
        self.lines, self.state = self.lines + 1, NEXT[self.state, initial]

    def _wanted(self, text: str) -> None:
        initial = WANTED[self.state]
        self._line("user" if initial == "u" else "assistant", text, initial)

    def inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == INSERT[0]:
            self.at += 1
            self._wanted("")

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP[0]:
            self._line(role, text, role[:1])
        elif edit == REROLE[0]:
            self._wanted(text)

    def end(self) -> str:
        self.inserts()
        return self.digest.hexdigest()


HEAD = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A stream in the order of conversation and place; the first row of each conversation has its audit."""
    now, head = None, None
    done: list[tuple] = []

    def out(schema: pa.Schema) -> pa.RecordBatch:
        kinds = [schema.field(n).type for n in HEAD] + [pa.string()]
        columns = list(zip(*done)) or [()] * len(kinds)
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*HEAD, "repaired_sha256"])
        done.clear()
        return batch

    schema = None
    for batch in batches:
        schema = batch.schema
        heads = batch.select(HEAD)
        for i, (is_row, role, text) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("is_row", "role", "text")])):
            if is_row:
                now.row(role, text)
                continue
            if now is not None:
                done.append((*head, now.end()))
            head = tuple(c[i].as_py() for c in heads.columns)
            now = _Repaired(head[-1])
        if done:
            yield out(schema)
    if now is not None:
        done.append((*head, now.end()))
        yield out(schema)


def conversation_repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` has conv_id, turn, role and text; ``conversations`` (conv_id) lists conversations that must be in the result even without a row; theirs are zeros, an empty audit and the
    digest of nothing. Rows are taken by turn, nulls first; rows of one turn by the SHA-256 of ``role:text``. A null role or text is one space. A null
    conversation id is one conversation. Of equal rows (role and text) the earliest is no duplicate; a blank row is blank even if it was said before. gaps counts turns that
    are missing between the first and the last. Other columns are not looked at; an empty table gives the listed conversations only.
    """
    rows = _rows(turns)
    listed = turns.select(F.col("conv_id").alias("conv"))
    if conversations is not None:
        listed = listed.unionByName(conversations.select(F.col("conv_id").alias("conv")))
    signed = signatures(rows)
    signed = listed.distinct().join(signed.withColumnRenamed("conv", "c"), F.expr("conv <=> c"), "left").select(
        "conv", F.coalesce("signature", F.lit("")).alias("signature"), F.coalesce("gaps", F.lit(0).cast("bigint")).alias("gaps"))
    signed = written(signed, "signatures")
    judged = written(audits(signed).withColumns({"blank": _count(BLANK), "duplicate": _count(DUPLICATE), "truncated": _count(TRUNCATED), "illegal": _illegal()}), "audits")
    counts = signed.groupBy("signature").agg(F.count("*").alias("row_count"))
    heads = join_to_unique(signed, judged, "signature", spread=["conv"], how="inner", counts=counts)
    head = heads.select(*HEAD, F.lit(False).alias("is_row"), F.lit(None).cast(dict(rows.dtypes)["turn"]).alias("turn"), F.lit(None).cast("binary").alias("tie"),
                        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    body = rows.select("conv", *[F.lit(None).cast(dict(heads.dtypes)[c]).alias(c) for c in HEAD[1:]], F.lit(True).alias("is_row"), "turn", "tie", "role", "text")
    order = [F.col("conv").asc_nulls_first(), "is_row", F.col("turn").asc_nulls_first(), "tie"]
    stream = head.unionByName(body).repartition("conv").sortWithinPartitions(*order).select(*HEAD, "is_row", "role", "text")
    conv = dict(rows.dtypes)["conv"]
    kind = f"conv {conv}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    return stream.mapInArrow(_repair, kind).withColumnRenamed("conv", "conv_id")


def damaged(turns: DataFrame) -> DataFrame:
    """Planted faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its end marks out, 3 repeats it, 4 makes it the user's."""
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(clean("conv_id"), F.lit(":"), clean("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", clean("role").alias("role"), clean("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")

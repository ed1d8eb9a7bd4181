"""Manifest trees, passages that repeat and conversation repair against brute force, with nulls, ties, repeated rows, empty tables and clashing names."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from invoicemill.llm import conversation_repair as repair, merkle_manifest as merkle, suffix_index as suffix
from invoicemill.session import new_folder

H = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()


# Merkle manifest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, grp string, place bigint, total string, digest string, known string, number bigint"


def leaf(row, text):
    parts = [row[0], row[3], row[2], row[4], text]
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts)


def brute_manifest(rows):
    """Levels as plain lists, each changed leaf folded by building the whole tree again."""
    def tree(leaves):
        while len(leaves) > 1:
            leaves = [H(leaves[i:i + 8]) for i in range(0, len(leaves), 8)]
        return leaves[0]

    def proof(leaves, at):
        found = []
        while len(leaves) > 1:
            first = at // 8 * 8
            found += leaves[first:at] + leaves[at + 1:first + 8]
            leaves, at = [H(leaves[i:i + 8]) for i in range(0, len(leaves), 8)], at // 8
        return found

    low = lambda t: None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row, row[1]), leaf(row, low(row[1])), row[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    lists = {g: [x[2] for x in sorted(groups[g], key=lambda x: x[:3])] for g in names}
    roots = [tree(lists[g]) for g in names]
    out = Counter()
    for n, g in enumerate(names):
        for at, (has_id, _, digest, other, doc) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            chosen = has_id and zlib.crc32(str(doc).encode()) % 3 == 0
            leaves = list(lists[g])
            leaves[at] = other if chosen else digest
            folded = tree([*roots[:n], tree(leaves), *roots[n + 1:]])
            out[doc, digest, roots[n], tree(roots), H(proof(lists[g], at) + proof(roots, n)), folded, folded == tree(roots)] += 1
    return out


@pytest.mark.parametrize("sizes", [[1], [8, 1], [9, 600, 64, 65, 2, 1, 3, 4, 5, 7], [1100]])
def test_merkle_manifest(spark, monkeypatch, sizes):
    r = random.Random(sum(sizes))
    langs = [None, "", "en", "é", "z", "A", "de", "fr", "日", "es"]
    rows = [(i * 10 + n if r.random() > 0.02 else None, r.choice(["Big", "small", "", None, "ÄÖ Long " * 50]), langs[n], r.choice(["s", None]), r.choice([None, 3]), "g", 1, "t", "d", "k", 2)
            for n, size in enumerate(sizes) for i in range(size)]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_digest([lowered if f == "text" else F.col(f) for f in merkle.FIELDS]))
    if len(sizes) > 2:          # groups are joined by a shuffle
        monkeypatch.setattr(merkle, "BROADCAST_GROUPS", 2)
    got = merkle.MerkleManifest(docs, changed=changed).versions().select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert Counter(map(tuple, got.collect())) == brute_manifest(rows)


def test_merkle_versions_share_nodes(spark):
    rows = [(i, "T", "en", "s", 1, "", 1, "", "", "", 1) for i in range(5000)]
    docs = spark.createDataFrame(rows, DOCS)
    changed = F.when(F.col("doc_id") == 4321, F.unhex(F.sha2(F.lit("other"), 256)))
    got = merkle.MerkleManifest(docs, changed=changed).versions().groupBy("verified", "n_copied").count().collect()
    assert sorted(map(tuple, got)) == [(False, 6, 1), (True, 0, 4999)]      # a leaf and five ancestors, of 5000 + 625 + 79 + 10 + 2 + 1 nodes


def test_merkle_of_nothing(spark):
    manifest = merkle.MerkleManifest(spark.createDataFrame([], DOCS))
    assert manifest.root is None and manifest.versions().collect() == []


# Passages that repeat

def brute_removed(rows, length):
    """Rows are taken by id (null as the least), then by CRC-32 of the text."""
    order = sorted(range(len(rows)), key=lambda k: (-1 << 63 if rows[k][0] is None else rows[k][0], zlib.crc32((rows[k][1] or "").encode())))
    seen, out = set(), Counter()
    for k in order:
        data = (rows[k][1] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            window = data[p:p + length]
            if window in seen:
                gone[p:p + length] = True
            seen.add(window)
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[rows[k][0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


SHORT = "doc_id bigint, text string, home bigint, row int, id string, data string, bucket int, keys string"


def passages(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(k) for k in (12, 20, 40, 300)]
    rows = [(i, " ".join(r.choice([text(8), r.choice(shared)]) for _ in range(r.randint(1, 8)))) for i in range(120)]
    rows += [(200, None), (201, ""), (None, shared[2]), (202, shared[2]), (202, shared[2]), (202, shared[3] + "x"), (203, "x" * 5000), (204, "ab" * 3000), (205, "é" * 90 + shared[1])]
    whole = text(60)
    rows += [(300 + i, f"{text(3)} {whole} {text(3)}") for i in range(60)]          # one passage in a third of all rows
    rows += [(400 + i, whole[i:i + 101 + i % 3]) for i in range(0, 150, 7)]
    rows += [(500, text(20000)), (-5, whole[50:]), (501, "y" * 99), (502, "y" * 99), (503, "y" * 100), (504, "z" + "y" * 100)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot_spans, home_bytes", [(20_000, 1 << 24), (3, 20_000), (1, 3_000)])
def test_long_matches(spark, monkeypatch, hot_spans, home_bytes):
    rows = passages(7)
    monkeypatch.setattr(suffix, "HOME_BYTES", (home_bytes, home_bytes))
    monkeypatch.setattr(suffix, "BUCKET_BYTES", (50_000, 50_000))
    docs = spark.createDataFrame([(i, t, 1, 2, "i", "d", 3, "k") for i, t in rows], SHORT).repartition(3)
    got = suffix.long_match_dedup(docs, hot_spans=hot_spans)
    assert Counter(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())) == brute_removed(rows, 100)


def test_short_length_long_text_and_kept_bytes(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice("abc ") for _ in range(400))) for i in range(40)] + [(99, "".join(r.choice("abcdefgh") for _ in range(300_000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = suffix.long_match_dedup(docs, length=12, texts=True).collect()
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got) == brute_removed(rows, 12)
    assert all(hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 and len(x.kept) == x.n_bytes - x.n_removed for x in got)


def test_no_documents_to_cut(spark):
    docs = spark.createDataFrame([], SHORT)
    assert suffix.long_match_dedup(docs).collect() == []
    few = spark.createDataFrame([(1, None, 1, 1, "", "", 1, ""), (2, "short", 1, 1, "", "", 1, "")], SHORT)
    assert {(x.doc_id, x.n_bytes, x.n_removed, x.n_spans) for x in suffix.long_match_dedup(few).collect()} == {(1, 0, 0, 0), (2, 5, 0, 0)}


def test_levels_merge_like_a_binary_number_and_survive_the_process(spark):
    folder = new_folder(spark, "index-test")
    r = np.random.default_rng(1)
    batches = [np.unique(r.integers(0, 3000, 400).astype(np.uint64) << np.uint64(50)) for _ in range(7)]
    row = lambda keys: spark.createDataFrame([(b, v, None) for b, v in suffix.dealt(3, keys, [keys])], "bucket int, keys binary, twice binary")
    for n, keys in enumerate(batches):
        index = suffix.SuffixIndex(spark, folder)           # each batch comes with a new process
        index.add(f"batch-{n}", row(keys))
        index.add(f"batch-{n}", row(keys))                  # and comes twice
        assert sorted(index.levels()) == [b for b in range(3) if (n + 1) >> b & 1]
    found = np.unique(np.concatenate([suffix.unpacked(x.keys, [np.uint64])[0] for x in index.repeated().collect()]))
    counts = Counter(itertools.chain.from_iterable(b.tolist() for b in batches))
    assert found.tolist() == sorted(k for k, n in counts.items() if n > 1)
    index.add("empty", row(np.zeros(0, np.uint64)))
    assert sorted(index.levels()) == [3]


# Conversation repair

TURNS = "conv_id bigint, turn bigint, role string, text string, conv string, c bigint, signature string, cost string, tie string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_audit(symbols):
    """Cheapest first, then the least audit, over whole audits."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(symbols) and state in ("", "a"):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in "ua":
            if (state, role) in NEXT:
                heapq.heappush(heap, (cost + 2, audit + "I", i, NEXT[state, role]))
        if i < len(symbols):
            initial, fault = symbols[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (state, initial) in NEXT:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, NEXT[state, initial]))
                for role in "ua":
                    if (state, role) in NEXT:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, NEXT[state, role]))


def brute_repair(rows, listed):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = Counter()
    for conv in listed:
        said = sorted(groups.get(conv, []), key=lambda x: (x[0] is not None, x[0] or 0, hashlib.sha256(f"{x[1]}:{x[2]}".encode()).hexdigest()))
        symbols, seen = [], set()
        for turn, role, text in said:
            solid = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "none" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            symbols.append((role[:1], fault))
        turns = {t for t, _, _ in said if t is not None}
        counts = Counter(f for _, f in symbols)
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(symbols, symbols[1:]))
        cost, audit = brute_audit(symbols)
        lines, i, last = [], 0, ""
        for edit in audit:
            want = "assistant" if last == "u" else "user"
            if edit == "K":
                lines.append(f"{said[i][1]}:{said[i][2]}")
                last = said[i][1][:1]
            elif edit in "RI":
                lines.append(f"{want}:{said[i][2] if edit == 'R' else ''}")
                last = want[0]
            i += edit != "I"
        out[conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest()] += 1
    return out


def test_conversation_repair(spark):
    r = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys", "Assistant"]
    words = ["Yes.", "No", "", " \t\r\n", None, "What?", "ok!", "ok! \n", "a.\x0b", "...", "long text " * 2000, "é.", "\x85", "no."]
    rows = [(c, r.choice([t, t, t, t + 3, 0, None]), r.choice(roles), r.choice(words)) for c in [*range(250), None] for t in range(r.randint(0, 9))]
    rows += [(900, t, "user" if t % 2 else "assistant", f"t{t}" + "." * (t % 3 > 0)) for t in range(3000)]          # one long conversation
    rows += [(901, None, "user", "x")] * 5 + [(902, 1, "user", "Hi."), (902, 2, "assistant", "Hi.")] + rows[:30]
    turns = spark.createDataFrame([(*x, "v", 1, "q", "p", "t") for x in rows], TURNS).repartition(5)
    listed = [*range(250), None, 900, 901, 902, 1000]
    got = repair.conversation_repair(turns, spark.createDataFrame([(c,) for c in listed] * 2, "conv_id bigint"))
    assert Counter(map(tuple, got.collect())) == brute_repair(rows, listed)


def test_damage_and_empty_tables(spark):
    r = random.Random(6)
    rows = [(c, t if t < 7 else None, r.choice(["user", "assistant", None]), r.choice(["A. B? c!", None, "word"])) for c in range(300) for t in range(8)]
    want = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        changed = (conv, turn, "user" if fate == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text))
        want += [changed] * {0: 0, 3: 2}.get(fate, 1)
    turns = spark.createDataFrame([(*x, "v", 1, "q", "p", "t") for x in rows], TURNS)
    assert Counter(map(tuple, repair.damaged(turns).collect())) == Counter(want)
    none = spark.createDataFrame([], TURNS)
    assert repair.conversation_repair(none).collect() == []
    only = repair.conversation_repair(none, spark.createDataFrame([(1,)], "conv_id bigint")).collect()
    assert list(map(tuple, only)) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_nodes_are_shared_by_suffix():
    r = random.Random(1)
    signatures = sorted(("".join(r.choice("aeimd") for _ in range(r.randint(0, 6))) for _ in range(2000)), key=lambda s: s[::-1])
    automaton = repair.SuffixNodes()
    for s in signatures:
        symbols = [(repair.read_symbol(c)[0], ("none", "blank", "duplicate", "truncated")[repair.read_symbol(c)[1]]) for c in s]
        assert automaton.read(s) == brute_audit(symbols)
    assert automaton.made == len({s[i:] for s in signatures for i in range(len(s) + 1)})

"""Operators on documents against brute force on small tables, with nulls, ties, repeated rows, empty tables and clashing names."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from invoicemill.llm import chat_format as chat, language_id, license_scan as licenses, minhash_dedup as near, packing, piece_fst, texts
from invoicemill.llm.exact_dedup import exact_dedup
from invoicemill.llm.queries import PACKING_VOCABULARY
from invoicemill.llm.word_ids import WordIds
from invoicemill.llm.line_dedup import line_dedup, without_dropped_lines

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, name string, count string, h bigint, id string, row string"
WORDS = [f"w{i}" for i in range(400)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, "x", "y", 1, "z", "r") for i, t in rows], SCHEMA).repartition(3)


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def test_exact_dedup(spark):
    long = prose(1, 9000)
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, long), (6, long), (7, long + "x"), (8, long[:-1]), (None, "a"), (9, "é"), (9, "é"), (10, long[4096:] + long[:4096])]
    rows += [(100 + i, "hot " * 3000) for i in range(40)]
    got = exact_dedup(table(spark, rows), block_bytes=64).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = Counter()
    for i, t in rows:
        ids = groups[t or ""]
        keep = max(x for x in ids if x is not None)
        want[i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want


def brute_components(rows, percent=75):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def drifting(base, seed, edits):
    r, words = random.Random(seed), base.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"e{r.random()}"
    return " ".join(words)


def test_minhash_dedup(spark, monkeypatch):
    base, other = prose(2, 150), prose(3, 60)
    rows = [(i, drifting(base, i, i % 9)) for i in range(150)]                     # a dense group that drifts apart
    rows += [(300 + i, f"{other} {prose(900 + i, 60)}") for i in range(60)]         # a shared passage, no near copies
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "a b"), (504, "A\tB"), (505, "a  b c"), (506, "x " * 400), (507, "x " * 300)]
    rows += [(600 + i, base) for i in range(30)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near.minhash_dedup(table(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_minhash_dense_blocks(spark):
    """The same links when every group with candidates counts as dense and as sparse."""
    base = prose(5, 120)
    rows = [(i, drifting(base, i, i % 11)) for i in range(80)]
    want = brute_components(rows)
    for pairs in (0, 10 ** 6):
        code = near.SPARSE_PAIRS
        near.SPARSE_PAIRS = pairs
        try:
            lists = table(spark, rows)
            got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near.minhash_dedup(lists).collect()}
        finally:
            near.SPARSE_PAIRS = code
        assert got == want


def test_minhash_repeated_and_null_ids(spark):
    rows = [(1, "b b b b b b"), (1, "a a a a a a"), (None, "a a a a a a"), (None, None), (2, "a a a a a a a")]
    got = sorted(map(tuple, near.minhash_dedup(table(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (2, 1, 1, False), (None, 1, None, True), (None, 0, None, True)], key=str)


def levenshtein_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_line_dedup(spark):
    line, long = "the quick brown fox jumps", prose(8, 900)
    variants = [line, line + "s", line[1:], line.replace("q", "k"), line.replace("fox", "box"), line.replace("o", "0", 1), line.replace("o", "00", 1)]
    rows = [(3, "\n".join(variants)), (1, f"{line[:-1]}\n\n  \nshort\nshort\n{long}"), (2, "\n".join([long[:700] + long[701:], long[:700] + "#" + long[700:], "shorx", line])),
            (4, None), (5, ""), (6, "\n".join(f"page number {i % 37} of the book" for i in range(60))), (7, "é" * 20 + "\n" + "é" * 21 + "\r"),
            (8, "a\nb\nab\n-\nxyz\nxy\nq\n1234"), (9, "\n".join([long[:768], long[:769], long[:768] + "😀", long[1:769], long[:2500], long[:1300] + long[1301:2500], "z" + long[:2500]]))]
    docs = table(spark, rows)
    for most in (1_000_000, 0):
        got = {(r["doc_id"], r["line_no"]): tuple(r)[2:] for r in line_dedup(docs, broadcast_rows=most).collect()}
        places = [(i, n, x) for i, t in rows if t for n, x in enumerate(t.split("\n")) if x.strip()]
        first = {}
        for i, n, x in sorted(places):
            first.setdefault(x, (i, n))
        want = {}
        for i, n, x in places:
            earlier = [first[y] for y in first if first[y] < first[x] and levenshtein_one(x, y)]
            keep = min(earlier) if earlier else first[x]
            want[i, n] = (not earlier and (i, n) == first[x], *keep, int(bool(earlier)))
        assert got == want
    cleaned = {r["doc_id"]: r["text"] for r in without_dropped_lines(docs, line_dedup(docs)).collect()}
    assert cleaned[1].startswith(line[:-1] + "\n\n  \nshort\n") and cleaned[4] is None and cleaned[5] == ""


def test_lines_of_a_megabyte(spark):
    """Each text is one line; one character is changed, removed or added near its begin, middle and end."""
    r = random.Random(4)
    line = "".join(r.choice("abcdefghij é") for _ in range(1_000_000))
    cut = lambda at, what: line[:at] + what + line[at + 1:]
    texts = [line, cut(3, "#"), cut(500_000, ""), line[:999_990] + "é" + line[999_990:], line[::-1], cut(256 * 1000, "#"), cut(768, "")]
    started = time.time()
    got = {x["doc_id"]: (x["kept"], x["keep_doc_id"], x["edits"]) for x in line_dedup(table(spark, list(enumerate(texts)))).collect()}
    assert got == {0: (True, 0, 0), 1: (False, 0, 1), 2: (False, 0, 1), 3: (False, 0, 1), 4: (True, 4, 0), 5: (False, 0, 1), 6: (False, 0, 1)}
    assert time.time() - started < 120


def test_language_id(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.train(docs)
    held = language_id.predict(docs.where(~language_id.may_train(docs["doc_id"])), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert sum(r["rejected"] for r in held) <= 0.01 * len(held)
    odd = table(spark, [(1, None), (2, ""), (3, "12 !?"), (4, "xqzj vkwq zzxq " * 50), (5, "the and of that"), (None, "les de la une")])
    got = {r["doc_id"]: r for r in language_id.predict(odd, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[4]["rejected"] and not got[5]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and set(odd.columns) <= set(got[1].asDict())
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.train(odd)).collect()} == {"und"}


def test_languages_of_long_documents_are_learned(spark):
    """One language of long documents only, and one whose short documents are a small share of many."""
    def docs(lang, first, n, words):
        r = random.Random(lang)
        vocabulary = ["".join(r.choice(letters) for _ in range(r.randrange(2, 8))) for letters in [r.sample("abcdefghijklmnopqrstuvwxyz", 9)] for _ in range(200)]
        return [(first + i, " ".join(r.choice(vocabulary) for _ in range(words(i))), lang) for i in range(n)]

    rows = docs("aa", 0, 60, lambda i: 40) + docs("bb", 1000, 12, lambda i: 14_000) + docs("cc", 2000, 3000, lambda i: 40 if i < 5 else 250)
    assert all(len(t) > language_id.SAMPLE_CHARS for _, t, g in rows if g == "bb")
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    assert language_id.train(table.where("lang <> 'cc'")).languages == ["aa", "bb"]
    model = language_id.train(table, sample_docs=20, sample_chars=500)
    assert model.languages == ["aa", "bb", "cc"]
    held = language_id.predict(table.where(~language_id.may_train(table["doc_id"])), model).collect()
    assert {r["lang"] for r in held} == {"aa", "bb", "cc"} and all(r["lang"] == r["lang_pred"] for r in held)
    assert sum(r["rejected"] for r in held) <= 0.01 * len(held)


def test_language_model_is_a_distribution():
    model = language_id.fit({"a": ["abab abba baab", "ab ba"] * 8, "b": ["cdcd dccd", "cd"] * 8})
    for before in (" a", "ab", " c"):
        codes = [np.array([language_id.BLANK, *map(ord, before.strip()), ord(x)], np.uint32) for x in "abcd "]
        total = sum(np.exp(model.log_probabilities(c, len(c) - 1)) for c in codes)
        assert (total <= 1 + 1e-9).all() and (total > 0.75).all()


def test_long_text_is_scored_whole():
    model = language_id.fit({"a": ["abab abba baab"] * 8, "b": ["cdcd dccd cd"] * 8})
    codes = language_id.letters("abab cdcd " * 400)
    whole = model.cross_entropy(codes)
    part, language_id.PART = language_id.PART, 37
    try:
        assert np.allclose(model.cross_entropy(codes), whole)
    finally:
        language_id.PART = part


VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_packing(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = [(i, prose(i, 20 + 7 * i % 300)) for i in range(60)] + [(100, None), (101, ""), (102, prose(102, 4000)), (103, "x" * 5000), (None, "a b"), (7, "again")]
    rows += [(200 + i, "same text") for i in range(50)] + [(300, "É́ <|endoftext|>a \x85y İI ﬁ \t\n 4½")]
    got = packing.pack(table(spark, rows), VOCABULARY, window=256, with_ids=True).collect()
    want = Counter()
    for i, t in rows:
        want[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])] += 1
    pieces, found = defaultdict(list), Counter()
    for r in got:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in got) == sum(len(ids) for (_, ids), n in want.items() for _ in range(n))
    for r in sorted(got, key=lambda r: r["start"]):
        if r["start"] == 0 and r["doc_tokens"] == r["length"]:
            found[r["doc_id"], tuple(r["ids"])] += 1
    assert all(want[k] == n for k, n in found.items())
    for spans in pieces.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    assert sorted(pieces) == list(range(len(pieces)))
    filled = sum(r["length"] for r in got)
    assert len(pieces) <= -(-filled // 256) + 2


def test_best_fill_is_best():
    r = random.Random(4)
    for _ in range(60):
        counts = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(5)}
        capacity = r.randrange(1, 60)
        used = packing.best_fill(counts, capacity)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        assert sum(n * u for n, u in used.items()) == max(s for s in sums if s <= capacity)
        assert all(u <= counts[n] for n, u in used.items())


def test_license_scan(spark):
    rows = [(1, "Licensed under CC-BY, cc by; CC\nBY cc by."), (2, None), (3, ""), (4, "The GNU General Public License. ALL rights\n\n reserved"),
            (5, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause\nx"), (6, "cc bye ccby é cc by"),
            (7, "SPDX-License-Identifier: MIT OR"), (None, "all rights reserved"), (7, "spdx license identifier")]
    got = defaultdict(list)
    for r in licenses.license_scan(table(spark, rows)).collect():
        got[r["doc_id"]].append(r)
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(n, p) for p in phrases for n in range(len(w)) if w[n:n + len(p.split())] == p.split()]
        want = (len(w), len(places), min((n for n, _ in places), default=None), max((n for n, _ in places), default=None), sorted({phrases[p] for _, p in places}))
        assert any((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want and 0 <= r["score"] <= 1 for r in got[i])
    five = got[5][0]["expressions"][0]
    assert five["valid"] and five["permissive"] and five["identifiers"] == ["mit", "gpl-2.0-only", "bsd-3-clause"]
    assert not [r for r in got[7] if r["n_words"] > 3][0]["expressions"][0]["valid"]


def _value(text):
    """A second evaluator: recursive descent, OR below AND below WITH."""
    tokens = re.findall(r"[()]|[^\s()]+", text.lower())

    def either():
        found = both()
        while tokens and tokens[0] == "or":
            tokens.pop(0)
            found = both() or found
        return found

    def both():
        found = one()
        while tokens and tokens[0] == "and":
            tokens.pop(0)
            found = one() and found
        return found

    def one():
        name = tokens.pop(0)
        if name == "(":
            found = either()
            tokens.pop(0)
            return found
        found = name in ("mit", "isc", "apache-2.0")
        if tokens and tokens[0] == "with":
            tokens.pop(0)
            found = tokens.pop(0).startswith("classpath") or found
        return found

    return either()


def test_license_expressions_against_a_second_evaluator():
    r = random.Random(4)

    def build(depth):
        if depth and r.random() < 0.6:
            return f"{r.choice(['', '('])}{build(depth - 1)} {r.choice(['AND', 'OR'])} {build(depth - 1)}"
        return r.choice(["MIT", "ISC", "Apache-2.0", "GPL-2.0-only", "LGPL-2.1+", "GPL-3.0-or-later WITH Classpath-exception-2.0", "GPL-2.0 WITH Autoconf-exception"])

    for _ in range(300):
        text = build(4)
        text += ")" * text.count("(")
        got = licenses.parse_expression(text)
        assert got.valid and got.permissive == _value(text)


@pytest.mark.parametrize("behind,labels,valid,permissive", [
    (": MIT this file is part of x", ["spdx-mit"], True, True), (": BSD-Protection", ["spdx-bsd-protection"], True, False), (": mitigated", [], False, False),
    (": MIT OR", [], False, False), (": (MIT", [], False, False), (" MIT) and more", ["spdx-mit"], True, True), (": GPL-2.0-only WITH MIT", ["spdx-gpl-2.0-only"], True, False), ("", [], False, False)])
def test_labels_of_expressions(behind, labels, valid, permissive):
    found = licenses.scan("// SPDX-License-Identifier" + behind)
    assert found[3] == labels and [(e.valid, e.permissive) for e in found[5]] == [(valid, permissive)] and (found[6] > 0) == valid


def test_license_scan_is_linear_in_the_text():
    seconds = []
    for n in (35_000, 350_000):
        begin = time.process_time()
        found = licenses.scan("SPDX-License-Identifier: MIT\n" * n)
        seconds.append(time.process_time() - begin)
        assert len(found[5]) == n and found[4][-1] == ("tag", 4 * (n - 1), 3) and found[3] == ["spdx-mit"]
    assert seconds[1] < 25 * seconds[0] and seconds[1] < 20


@pytest.mark.parametrize("text,postfix", [("a or b and c", "a b c and or"), ("(a or b) and c with d", "a b or c d with and"), ("a and b or c", "a b and c or")])
def test_shunting_yard(text, postfix):
    assert licenses.to_postfix(re.findall(r"[()]|\w+", text)) == postfix.split()


@pytest.mark.parametrize("text", ["a b", "a or", "or a", "(a", "a)", "", "()", "a (b)"])
def test_shunting_yard_refuses(text):
    with pytest.raises(ValueError):
        licenses.to_postfix(re.findall(r"[()]|\w+", text))


def test_piece_encoding(spark):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(1, "The  quick\tbrown fox.\n"), (2, None), (3, ""), (4, " "), (5, "日本語 é𝄞 \x00"), (6, "x" * 700), (None, "a  b   c"), (7, prose(7, 300000 // 5)), (8, "!!! ... ???"), (8, "tie")]
    docs = table(spark, rows)
    got = [(r["doc_id"], r["text"], r["ids"], r["decoded"]) for r in piece_fst.decode(piece_fst.encode(docs, path), path).collect()]
    assert len(got) == len(rows)
    for _, text, ids, decoded in got:
        assert ids == model.encode(text or "") and decoded == (text or "")


def _model_file(path, pieces, kind):
    """A model file written field by field: pieces with score and type, the type of the model, a normaliser that only marks blanks."""
    varint = lambda n: bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)
    part = lambda number, data: varint(number * 8 + 2) + varint(len(data)) + data
    whole = lambda number, n: varint(number * 8) + varint(n)
    entries = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [(p, x, 1) for p, x in pieces]
    data = b"".join(part(1, part(1, p.encode()) + varint(2 * 8 + 5) + struct.pack("<f", x) + whole(3, t)) for p, x, t in entries)
    data += part(2, whole(3, kind) + whole(35, 1)) + part(3, part(1, b"identity") + whole(3, 1) + whole(4, 0) + whole(5, 1))
    path.write_bytes(data)
    return str(path)


def test_unigram_encoding(tmp_path):
    """Of a unigram model the path of the greatest score, against all ways to cut short words and against the library."""
    import sentencepiece
    r = random.Random(3)
    letters = ["\u2581", *"abcd"]
    pieces = {x: -r.uniform(3, 6) for x in letters} | {"".join(r.choice("abcd") for _ in range(r.randrange(2, 5))): -r.uniform(2, 9) for _ in range(60)}
    pieces |= {"\u2581" + "".join(r.choice("abcd") for _ in range(2)): -r.uniform(2, 9) for _ in range(10)}
    path = _model_file(tmp_path / "unigram.model", pieces.items(), 1)
    model, library = piece_fst.PieceTransducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert model.kind == piece_fst.UNIGRAM and piece_fst.model_kind(public_tokenizers.path("piece_bpe_32k.model")) == piece_fst.BPE
    name = {library.piece_to_id(p): p for p in pieces}
    for _ in range(200):
        text = "".join(r.choice("abcd") for _ in range(r.randrange(1, 9)))
        best = [0.0] + [-1e9] * (len(text) + 1)
        for j in range(1, len(text) + 2):
            best[j] = max((best[i] + pieces.get(("\u2581" + text)[i:j], -1e9) for i in range(j)), default=-1e9)
        got = model.encode(text.encode()).tolist()
        assert "".join(name[i] for i in got) == "\u2581" + text and abs(sum(pieces[name[i]] for i in got) - best[-1]) < 1e-3
    for text in ("abc dabba  cad", "ab\u00e9c d", "", "abcd" * 300, "dcab \u65e5" * 40):
        assert model.encode(text.encode()).tolist() == library.encode(text) and piece_fst.PieceOutputs(path).decode(model.encode(text.encode())).decode() == text


def test_long_runs_are_encoded_in_linear_time():
    import base64
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = piece_fst.PieceTransducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    text = base64.b64encode(random.Random(1).randbytes(750_000)).decode()
    begin = time.process_time()
    got = model.encode(text.encode()).tolist()
    assert time.process_time() - begin < 40 and got == library.encode(text)
    for text in ("a" * 1000, "\u00e9\U0001F600xyz" * 60, "ab\0c" * 50, "=" * 5000, "x" * piece_fst.LONG, "x" * (piece_fst.LONG + 1)):
        assert model.encode(text.encode()).tolist() == library.encode(text)
    most, piece_fst.MOST_PAIRS = piece_fst.MOST_PAIRS, 200             # verdicts that start anew change nothing
    try:
        small = piece_fst.PieceTransducer(path)
        assert small.encode(prose(3, 2000).encode()).tolist() == library.encode(prose(3, 2000))
        assert sum(map(len, small.pairs.codes)) <= 400
    finally:
        piece_fst.MOST_PAIRS = most


def test_places_are_left_where_no_piece_goes_on(tmp_path):
    """A long piece in the vocabulary does not make every place of every word look for pieces of all lengths up to it."""
    import sentencepiece
    r = random.Random(5)
    pieces = [(x, -1.0 - i) for i, x in enumerate(["\u2581", *"abcdz", "ab", "cd", "abc", "\u2581d"])]
    words = " ".join("".join(r.choice("abcd") for _ in range(90)) for _ in range(120))
    took = []
    for name, more in (("short", []), ("long", [("z" * 80, -20.0)])):
        path = _model_file(tmp_path / name, pieces + more, 2)
        model, best = piece_fst.PieceTransducer(path), []
        for _ in range(9):
            model._clear()
            begin = time.process_time()
            got = model.encode(words.encode()).tolist()
            best.append(time.process_time() - begin)
        took.append(min(best))
        assert got == sentencepiece.SentencePieceProcessor(model_file=path).encode(words)
    assert took[1] < 3 * took[0]


def test_table_of_numbers():
    r = np.random.default_rng(2)
    keys = r.permutation(np.unique(np.concatenate([np.arange(30_000), r.integers(0, 1 << 60, 200_000), np.arange(1000) << 44])))
    numbers, table = r.integers(0, 1 << 30, len(keys)).astype(np.int32), piece_fst._Table(np.int32)
    for first in range(0, len(keys) // 2, 999):
        some = slice(first, min(first + 999, len(keys) // 2))
        assert (table.look_up(keys[some]) == -1).all()
        table.learn(keys[some], numbers[some])
    half = len(keys) // 2
    assert (table.look_up(keys) == np.where(np.arange(len(keys)) < half, numbers, -1)).all() and 2 * half <= len(table.keys)
    table.clear()
    assert (table.look_up(keys) == -1).all() and len(table.look_up(keys[:0])) == 0


def test_word_hashes_cut_anywhere():
    data = np.frombuffer((prose(1, 500) + " " + "y" * 900 + " z").encode(), np.uint8)
    whole = texts.word_hashes(data)
    size, texts.PART_BYTES = texts.PART_BYTES, 64
    try:
        cut = np.concatenate([texts.hash_runs(p, *texts.word_bounds(p)) for p in texts.parts(data, 64)])
    finally:
        texts.PART_BYTES = size
    assert (whole == cut).all() and len(set(whole.tolist())) == len(set(data.tobytes().split()))


def test_chat_format(spark):
    same = "</s>[INST] ok [/INST]"
    turns = [(1, 0, "user", same), (1, 1, "assistant", same), (2, 1, "assistant", "b\\"), (2, 0, "we\nird\\n</s>", "\\<s>\\\\n<<s>[/INST]\\"), (3, None, None, None),
             (3, 0, "assistant", ""), (3, 0, "assistant", "é<|im_end|>"), (None, 0, "user", "x"), (4, 5, "system", "<<SYS>><</SYS>>")]
    docs = spark.createDataFrame([(*t, "clash", 7) for t in turns], "conv_id bigint, turn bigint, role string, text string, formatted string, chars int").repartition(3)
    formatted = chat.chat_format(docs)
    for r in formatted.collect():
        body = r["formatted"][len("<s>"):-len("</s>")]
        assert not any(c.decode() in body for c in chat.CONTROLS) and len(r["formatted"]) == r["chars"]
    got = {r["conv_id"]: r for r in chat.conversation_digests(formatted).collect()}
    groups = defaultdict(list)
    for c, t, role, text in turns:
        groups[c].append((-1 if t is None else t, role or "", text or ""))
    for c, rows in groups.items():
        rows.sort(key=lambda r: r[0])
        said = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(rows), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_empty_tables(spark):
    none = table(spark, [(1, "x")]).where("doc_id > 1")
    assert exact_dedup(none).count() == near.minhash_dedup(none).count() == line_dedup(none).count() == 0
    assert packing.pack(none, VOCABULARY).count() == licenses.license_scan(none).count() == 0
    assert language_id.predict(none, language_id.train(none)).count() == 0
    assert chat.conversation_digests(chat.chat_format(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))).count() == 0


def test_words_are_encoded_a_few_at_a_time():
    """The tokenizer keeps some 1 KB of each word that it is given at once."""
    encoder, most = WordIds(PACKING_VOCABULARY()), []
    whole = encoder.tokenizer
    class Seen:
        def encode_batch_fast(self, words, **options):
            most.append(len(words))
            return whole.encode_batch_fast(words, **options)
    encoder.tokenizer = Seen()
    text = " ".join(f"w{i}" for i in range(10_000))
    ids = encoder.encode(np.frombuffer(text.encode(), np.uint8), 1 << 14)
    assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids and max(most) <= 4096 and sum(most) == 10_000
    del most[:]
    encoder._clear()
    assert encoder.encode(np.frombuffer(text.encode(), np.uint8)).tolist() == ids.tolist() and len(most) == 3

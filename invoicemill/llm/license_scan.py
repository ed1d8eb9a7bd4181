"""Licence scans: an Aho-Corasick automaton finds identifier tags and notice phrases, a shunting-yard parser reads licence expressions.

A text is lower-cased (A-Z) and cut into words; the automaton runs once over the words with single blanks between them and finds every place
of every phrase, overlapping ones too. Behind an identifier tag stands an expression of identifiers with AND, OR, WITH and brackets, up to the next
tag at most; its longest prefix that reads as an expression is turned into postfix order and evaluated. The scan is one narrow pass over whole
texts, linear in their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notice phrases.
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd", "isc license": "isc", "mozilla public license": "mpl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "eclipse public license": "epl",
    "creative commons attribution": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0",
    "public domain": "public-domain", "do not redistribute": "restricted",
}
TAGS = ("spdx license identifier",)
# Forms of licence identifiers (lower case) that allow use without sharing changes, and of other identifiers.
PERMISSIVE = re.compile(r"mit(-0)?|0bsd|bsd-[1-4]-clause|apache-(1\.0|1\.1|2\.0)|isc|zlib|unlicense|cc0-1\.0|cc-by-[1-4]\.[05]|python-2\.0|psf-2\.0|bsl-1\.0")
SHARING = re.compile(r"[al]?gpl-[1-3]\.[0-9](-only|-or-later)?\+?|mpl-[12]\.[01]|epl-[12]\.0|eupl-1\.[0-2]|cddl-1\.[01]|gfdl-1\.[1-3](-only|-or-later)?|"
                     r"cc-by-(nc|nd|sa|nc-nd|nc-sa)-[1-4]\.[05]|bsd-protection|licenseref-[a-z0-9.-]+")
LINKING_EXCEPTION = re.compile(r"(classpath|gcc|llvm|linking|openssl)-exception(-[0-9.]+)?")
EXCEPTION = re.compile(r"[a-z0-9.+-]*exception[a-z0-9.+-]*")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
BASE_WEIGHT, NOTICE_WEIGHT, TAG_WEIGHT = 0.5, 0.7, 0.95

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_EXPRESSION = re.compile(rb"[^\S\n]*:?[^\S\n]*([A-Za-z0-9.+() \t-]*)")


class Expression(NamedTuple):
    text: str
    valid: bool
    permissive: bool
    identifiers: list[str]
    postfix: str


def to_postfix(tokens: list[str]) -> list[str]:
    """Postfix order by a shunting yard; raises ValueError where operands and operators do not alternate or brackets do not match."""
    out, waiting, operand = [], [], True
    for t in tokens:
        if t == "(":
            if not operand:
                raise ValueError("bracket after an operand")
            waiting.append(t)
        elif t == ")":
            if operand:
                raise ValueError("operand missing")
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError("bracket not opened")
            waiting.pop()
        elif t in PRECEDENCE:
            if operand:
                raise ValueError("operand missing")
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[t]:
                out.append(waiting.pop())
            waiting.append(t)
            operand = True
        else:
            if not operand:
                raise ValueError("operator missing")
            out.append(t)
            operand = False
    if operand or "(" in waiting:
        raise ValueError("unfinished")
    return out + waiting[::-1]


def evaluate(postfix: list[str]) -> bool:
    """True if the expression can be met by permissive licences: either side of OR, both of AND; WITH adds an exception to a licence."""
    stack: list[tuple[str, bool]] = []
    for t in postfix:
        if t not in PRECEDENCE:
            stack.append((t, bool(PERMISSIVE.fullmatch(t))))
            continue
        (right, may_right), (left, may_left) = stack.pop(), stack.pop()
        if t == "with":
            if not left or not right:
                raise ValueError("WITH needs a licence and an exception")
            stack.append(("", may_left or bool(LINKING_EXCEPTION.fullmatch(right))))
        else:
            stack.append(("", may_left or may_right if t == "or" else may_left and may_right))
    return stack[0][1]


def readable_prefix(tokens: list[str]) -> int:
    """How many tokens the longest prefix has that is an expression of known identifiers; an exception stands only behind an identifier and WITH."""
    longest, depth, before = 0, 0, "("              # before: an open or closed bracket, an operator, "name" or "exception"
    for i, t in enumerate(tokens):
        if t == "(":
            if before not in ("(", "and", "or"):
                break
            depth += 1
        elif t == ")":
            if before in ("(", "and", "or", "with") or not depth:
                break
            depth -= 1
        elif t in PRECEDENCE:
            if before in ("(", "and", "or", "with") or t == "with" and before != "name":
                break
        elif before == "with":
            if not EXCEPTION.fullmatch(t):
                break
            t = "exception"
        elif before in ("(", "and", "or") and (PERMISSIVE.fullmatch(t) or SHARING.fullmatch(t)):
            t = "name"
        else:
            break
        before = t
        if not depth and t in (")", "name", "exception"):
            longest = i + 1
    return longest


def parse_expression(text: str) -> Expression:
    """The longest readable prefix, judged; where operators or brackets alone follow it the expression is unfinished and not valid."""
    tokens = _TOKEN.findall(text.lower())
    read = readable_prefix(tokens)
    rest = tokens[read:]
    if not read or rest and all(t in PRECEDENCE or t == "(" for t in rest):
        return Expression(text, False, False, [], "")
    tokens = tokens[:read]
    names = [t for i, t in enumerate(tokens) if t not in PRECEDENCE and t not in "()" and (not i or tokens[i - 1] != "with")]
    postfix = to_postfix(tokens)
    return Expression(text, True, evaluate(postfix), names, " ".join(postfix))


_automata: list = []


def _automaton():
    if not _automata:
        import ahocorasick
        found = ahocorasick.Automaton()
        for phrase in {*BASE, *NOTICES, *TAGS}:
            found.add_word(f" {phrase} ", phrase)
        found.make_automaton()
        _automata.append(found)
    return _automata[0]


def scan(text: str | None) -> tuple:
    """(n_words, base places, labels of the base, all labels, spans (label, first word, words), expressions, score) of one text."""
    raw = (text or "").encode()
    marked = raw.translate(_WORDS)
    words = marked.split()
    joined = b" ".join([b"", *words, b""]).decode("latin-1")
    inside = np.frombuffer(b" " + marked + b" ", np.uint8) != 32
    begins, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    placed = np.cumsum(ends - begins + 1) - (ends - begins)             # where each word begins in the joined words
    spans, expressions, base = [], [], []
    found = [(end - len(phrase), phrase) for end, phrase in _automaton().iter(joined)]
    firsts = np.searchsorted(placed, np.array([at for at, _ in found], np.int64)).tolist()
    tagged = [int(begins[f]) for f, (_, phrase) in zip(firsts, found) if phrase in TAGS] + [len(raw)]
    for counted, (_, phrase) in zip(firsts, found):
        n = phrase.count(" ") + 1
        if phrase in TAGS:
            until = tagged[len(expressions) + 1]                        # tags are found in the order of their places
            expressions.append(parse_expression(_EXPRESSION.match(raw, int(ends[counted + n - 1]), until)[1].decode().strip()))
            spans.append(("tag", counted, n))
            continue
        if phrase in BASE:
            base.append((BASE[phrase], counted))
        spans.append((BASE.get(phrase) or NOTICES[phrase], counted, n))
        if phrase in NOTICES and phrase in BASE:
            spans.append((NOTICES[phrase], counted, n))
    spans.sort(key=lambda s: (s[1], s[2], s[0]))
    base_labels = sorted({label for label, _ in base})
    names = {f"spdx-{i}" for e in expressions for i in e.identifiers}      # of valid expressions only
    labels = sorted({s[0] for s in spans if s[0] != "tag"} | names)
    miss = 1.0
    for found, weight in ((base, BASE_WEIGHT), ([s for s in spans if s[0] not in base_labels and s[0] != "tag"], NOTICE_WEIGHT), ([e for e in expressions if e.valid], TAG_WEIGHT)):
        miss *= 1 - weight if found else 1
    return len(words), [w for _, w in base], base_labels, labels, spans, expressions, 1 - miss


SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, labels array<string>, "
          "spans array<struct<label:string,first_word:bigint,words:bigint>>, expressions array<struct<text:string,valid:boolean,permissive:boolean,identifiers:array<string>,postfix:string>>, score double")
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))
_EXPRESSIONS = pa.list_(pa.struct([("text", pa.string()), ("valid", pa.bool_()), ("permissive", pa.bool_()), ("identifiers", pa.list_(pa.string())), ("postfix", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in re.split(r", (?=\w+ )", SCHEMA)]
    for batch in batches:
        found = [scan(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([len(f[1]) for f in found], pa.int64()),
            pa.array([min(f[1], default=None) for f in found], pa.int64()), pa.array([max(f[1], default=None) for f in found], pa.int64()),
            pa.array([f[2] for f in found], pa.list_(pa.string())), pa.array([f[3] for f in found], pa.list_(pa.string())),
            pa.array([[dict(zip(("label", "first_word", "words"), s)) for s in f[4]] for f in found], _SPANS),
            pa.array([[e._asdict() for e in f[5]] for f in found], _EXPRESSIONS), pa.array([f[6] for f in found], pa.float64())], names)


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, spans, expressions, score.

    A null text is empty: no words, no labels, score 0. Rows that repeat an id, and rows with a null id, are scanned for themselves.
    An expression is the longest prefix of what stands behind a tag that reads as one of known identifiers; where none does, or where only operators
    follow it, it is listed as not valid, without identifiers, and gives no label. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scan, SCHEMA).withColumnRenamed("doc_id", id_col)

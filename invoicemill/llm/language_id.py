"""Language identification by interpolated Kneser-Ney character models.

Text becomes lower-case letters with one blank for everything between them. A model gives the probability of each letter after up to ORDER - 1
characters, with absolute discounting and continuation counts for the shorter contexts. The tables of all languages
lie side by side: per order one sorted array of n-gram hashes, and per language a column of log probabilities (complete, with the weight of
shorter contexts folded in) and a column of log back-off weights. A text is scored by binary search in the longest order; only n-grams
that no language has seen go on to a shorter one. The language with the lowest cross-entropy per character wins.

A text is rejected if its cross-entropy is beyond what the language's own texts reach: the limit comes from calibration documents that the model has
not seen, and is wider for short texts, in which the average varies more.

The model is fitted on a bounded sample: SAMPLE_DOCS documents per language, of each at most SAMPLE_CHARS characters from a place in it that its id
decides. Every labelled language is learned, however long its documents are. Everything else reads whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from invoicemill.llm.texts import beside_text, give_back, mix, runs_of_rows, text_bytes

ORDER = 4
SAMPLE_DOCS = 500
SAMPLE_CHARS = 50_000        # of a document, at most
LANGUAGES = 400              # most languages drawn; more raise an error
CALIBRATION_SHARE = 4        # one of so many sampled documents calibrates
MARGIN = 8.0                 # deviations beyond the calibration documents' mean
SLACK = 1.6                  # and at least so many times their mean
PART = 1 << 16               # characters scored at once
UNDETERMINED = "und"
BLANK = 32

_tables: dict[str, np.ndarray] = {}
_FACTORS = mix(np.arange(101, 101 + 16, dtype=np.uint64)) | np.uint64(1)


def _characters() -> np.ndarray:
    """For each code point its lower-case letter, or a blank if it is no letter."""
    if "lower" not in _tables:
        table = np.full(0x110000, BLANK, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _tables["lower"] = table
    return _tables["lower"]


def letters(text: str) -> np.ndarray:
    """The text's lower-case letters with single blanks between, before and after them; empty without a letter."""
    codes = _characters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    word = codes != BLANK
    if not word.any():
        return codes[:0]
    keep = word.copy()
    keep[1:] |= word[:-1]                       # a blank after a letter stays
    codes = codes[keep]
    ends = [np.array([BLANK], np.uint32)] if codes[-1] != BLANK else []
    return np.concatenate([np.array([BLANK], np.uint32), codes, *ends])


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each place from n-1 on."""
    total = np.full(max(0, len(codes) - n + 1), n, np.uint64)
    for i in range(n):
        total += (codes[i:len(codes) - n + 1 + i].astype(np.uint64) + np.uint64(1)) * _FACTORS[i]
    return mix(total)


@dataclass
class Model:
    languages: list[str]
    keys: list[np.ndarray]          # per order the sorted hashes
    log_p: list[np.ndarray]         # per order (n-grams, languages)
    contexts: list[np.ndarray]      # per order the sorted hashes of contexts
    back_off: list[np.ndarray]      # per order (contexts, languages)
    floor: np.ndarray               # log probability of a letter never seen
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None
    sharpness: float = 1.0

    def log_probabilities(self, codes: np.ndarray, first: int) -> np.ndarray:
        """Sum over the places from ``first`` on of log p(character | those before it), per language."""
        sums, todo = np.zeros(len(self.languages)), np.arange(max(first, 1), len(codes))
        for order in range(len(self.keys), 0, -1):
            reach = todo >= order - 1
            at, later = todo[reach], todo[~reach]
            if len(at):
                found = hashes(codes, order)[at - order + 1]
                place = np.minimum(np.searchsorted(self.keys[order - 1], found), len(self.keys[order - 1]) - 1)
                hit = self.keys[order - 1][place] == found
                sums += np.bincount(place[hit], minlength=len(self.keys[order - 1])) @ self.log_p[order - 1] if hit.sum() > len(self.keys[order - 1]) else self.log_p[order - 1][place[hit]].sum(0)
                at = at[~hit]
                if len(at) and order > 1:
                    context = hashes(codes, order - 1)[at - order + 1]
                    where = np.minimum(np.searchsorted(self.contexts[order - 1], context), len(self.contexts[order - 1]) - 1)
                    known = self.contexts[order - 1][where] == context
                    sums += self.back_off[order - 1][where[known]].sum(0)
                elif len(at):
                    sums += len(at) * self.floor
            todo = np.concatenate([at, later])
        return sums

    def cross_entropy(self, codes: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.languages))
        for first in range(1, len(codes), PART):
            start = max(0, first - len(self.keys) + 1)
            total += self.log_probabilities(codes[start:first + PART], first - start)
        return -total / max(1, len(codes) - 1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); the score is the language's share of the evidence, calibrated on documents not trained on."""
        codes = letters(text or "")
        if not len(codes):
            return UNDETERMINED, 0.0, True
        entropy = self.cross_entropy(codes)
        best = int(np.argmin(entropy))
        evidence = np.exp(-self.sharpness * (entropy - entropy[best]) * math.sqrt(len(codes)))
        limit = max(SLACK * self.mean[best], self.mean[best] + MARGIN * self.deviation[best]) + MARGIN * self.deviation[best] * math.sqrt(200 / len(codes))
        return self.languages[best], float(1 / evidence.sum()), bool(entropy[best] > limit)


def _grams(codes: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams as hashes: (whole, without the last character, without the first one, count)."""
    whole = np.concatenate([np.zeros(0, np.uint64), *(hashes(c, n) for c in codes)])
    if n == 1:
        before = after = np.zeros(len(whole), np.uint64)
    else:
        shorter = [hashes(c, n - 1) for c in codes if len(c) >= n]
        before = np.concatenate([np.zeros(0, np.uint64), *(h[:-1] for h in shorter)])
        after = np.concatenate([np.zeros(0, np.uint64), *(h[1:] for h in shorter)])
    whole, first, count = np.unique(whole, return_index=True, return_counts=True)
    return whole, before[first], after[first], count


def fit(samples: dict[str, list[str]], order: int = ORDER) -> Model:
    """Models of all languages from sampled texts; every ``CALIBRATION_SHARE``-th text is kept for calibration."""
    languages = sorted(samples)
    codes = {g: [letters(t) for i, t in enumerate(samples[g]) if i % CALIBRATION_SHARE or len(samples[g]) < CALIBRATION_SHARE] for g in languages}
    grams = {g: [_grams(codes[g], n) for n in range(1, order + 1)] for g in languages}
    keys, log_p, contexts, back_off, floor = [], [], [], [], np.zeros(len(languages))
    for n in range(1, order + 1) if languages else ():
        whole, first = np.unique(np.concatenate([grams[g][n - 1][0] for g in languages]), return_index=True)
        before, after = (np.concatenate([grams[g][n - 1][i] for g in languages])[first] for i in (1, 2))
        context, own_context = np.unique(before, return_inverse=True)
        shorter = np.searchsorted(keys[-1], after) if n > 1 else None
        values, weights = [], []
        for i, g in enumerate(languages):
            own = np.searchsorted(whole, grams[g][n - 1][0])
            count = np.zeros(len(whole))
            if n == order:
                count[own] = grams[g][n - 1][3]
            else:               # in how many ways it is continued to the left; what only begins a text counts once
                np.add.at(count, np.searchsorted(whole, grams[g][n][2]), 1)
                count[own] = np.maximum(count[own], 1)
            ones, twos = (count == 1).sum(), (count == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.75
            total = np.bincount(own_context, count, len(context))
            kinds = np.bincount(own_context, count > 0, len(context))
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            symbols = len(whole) + 1 if n == 1 else 0
            rest = np.exp(log_p[-1][shorter, i]) if n > 1 else np.full(len(whole), 1 / symbols)
            p = np.maximum(count - discount, 0) / np.maximum(total, 1)[own_context] + weight[own_context] * rest
            values.append(np.log(np.maximum(p, 1e-12))), weights.append(np.log(np.maximum(weight, 1e-12)))
            if n == 1:
                floor[i] = np.log(max(weight[0] / symbols, 1e-9)) if len(weight) else np.log(1e-9)
        keys.append(whole), log_p.append(np.stack(values, 1)), contexts.append(context), back_off.append(np.stack(weights, 1))
    model = Model(languages, keys, log_p, contexts, back_off, floor)
    _calibrate(model, samples)
    return model


def _calibrate(model: Model, samples: dict[str, list[str]]) -> None:
    """Mean and deviation of the cross-entropy of a language's own unseen texts, and how sharply differences tell languages apart."""
    size = len(model.languages)
    model.mean, model.deviation = np.full(size, 1.0), np.full(size, 0.1)
    seen = []
    for i, g in enumerate(model.languages):
        held = [letters(t) for j, t in enumerate(samples[g]) if j % CALIBRATION_SHARE == 0 or len(samples[g]) < CALIBRATION_SHARE]
        scored = [(c, model.cross_entropy(c)) for c in held if len(c)]
        own = np.array([e[i] for _, e in scored])
        if len(own):
            middle = float(np.median(own))
            model.mean[i], model.deviation[i] = middle, max(0.02 * middle, 1.4826 * float(np.median(np.abs(own - middle))))
        seen += [(i, e, len(c)) for c, e in scored]
    def loss(sharpness):
        return sum(np.log(np.exp(-sharpness * (e - e[i]) * math.sqrt(n)).sum()) for i, e, n in seen)
    with np.errstate(over="ignore"):
        model.sharpness = float(min((0.1, 0.3, 1.0, 3.0, 10.0), key=loss)) if seen else 1.0


def may_train(doc_id: Column) -> Column:
    """Documents that may be learned from: the checksum of the id as text is not 1 modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS,
          sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on at most ``sample_docs`` labelled documents per language, those whose ids hash lowest.

    A document of more than ``sample_chars`` characters is drawn like any other, and so many of its characters are learned from.
    """
    rank = F.xxhash64(F.col(id_col), F.lit(4))
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.coalesce(may_train(F.col(id_col)), F.lit(False)))
    first = F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.greatest(F.lit(1), F.length(text_col) - sample_chars + 1)) + 1
    piece = F.when(F.length(text_col) <= sample_chars, F.col(text_col)).otherwise(F.substring(F.col(text_col), first.cast("int"), F.lit(sample_chars)))
    rows = labelled.select(F.col(lang_col).alias("lang"), piece.alias("text"), rank.alias("rank"))
    counts = dict(rows.groupBy("lang").count().limit(LANGUAGES + 1).collect())
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return fit({})
    # First a share of each language by hash, so that the exact choice sorts a few documents only.
    share = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, min(1.0, 2 * sample_docs / n + 20 / n))])
    drawn = rows.where(F.pmod("rank", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    drawn = drawn.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "text"))).where(F.col("place") <= sample_docs)
    samples: dict[str, list[str]] = {}
    for row in drawn.select("lang", "text", "rank").orderBy("lang", "rank").toLocalIterator():
        samples.setdefault(row["lang"], []).append(row["text"])
    return fit(samples)


ADDED = ("lang_pred", "score", "rejected")


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in runs_of_rows(text_bytes(batch.column(1))[1]):
                part = batch.slice(first, last - first)
                found = [model.value.predict(x.as_py()) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_())))],
                                                 ["row", "text", *ADDED])
            del batch, part
            pa.default_memory_pool().release_unused()
        give_back()
    return run


def _only_undetermined(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0), "rejected": F.lit(True)})


def predict(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """Adds lang_pred, score and rejected to every row, from the text alone.

    A null text and a text without a letter is ``und``, with score 0 and rejected. A model without languages says ``und`` to everything. The columns of
    the input are kept; those that have one of the three names are replaced.
    """
    if not model.languages:
        return _only_undetermined(docs.select(*[c for c in docs.columns if c not in ADDED]))
    rows, schema, columns = beside_text(docs, text_col, ADDED)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(shared), schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")).select(*columns, *ADDED)

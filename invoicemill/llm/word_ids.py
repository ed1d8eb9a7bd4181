"""Token ids of texts, with each distinct word of a batch encoded once.

The vocabulary drops white space and never joins what white space parts, so a text's ids are the ids of its
words one after the other. Words are found and compared as 64-bit hashes in numpy; the tokenizer only sees words it has not met
lately, and the ids are laid out for all words at once.
"""

from __future__ import annotations

import os

import numpy as np

from invoicemill.llm.texts import PART_BYTES, hash_runs, parts, word_bounds

CACHE_WORDS = 1_000_000     # words kept per worker (about 40 MB); a full cache starts anew

ENCODED_AT_ONCE = 4096      # words; the tokenizer's record of one is some 1 KB

_loaded: dict[str, "WordIds"] = {}


def ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions begins[i], begins[i]+1, ... of all runs one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)


def held(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class RunIds:
    """A cache from runs of bytes (by hash) to their ids, in sorted arrays. ``bounds`` and ``ids_of`` say what a run is and what ids it has."""

    most_words = CACHE_WORDS

    def __init__(self) -> None:
        self._clear()

    def bounds(self, data: np.ndarray, starts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def ids_of(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs one after the other, how many each has)."""
        raise NotImplementedError

    def _clear(self) -> None:
        self.known, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _learn(self, hashes: np.ndarray, runs: list[bytes]) -> None:
        ids, n = self.ids_of(runs)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(max(len(ids), self.used), np.int32)])
        self.ids[self.used:self.used + len(ids)] = ids
        place = np.searchsorted(self.known, hashes)
        self.at = np.insert(self.at, place, self.used + np.cumsum(n) - n)
        self.n, self.known = np.insert(self.n, place, n), np.insert(self.known, place, hashes)
        self.used += len(ids)

    def encode_part(self, data: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each word begins, how many ids it has, all ids one after the other)."""
        begins, ends = self.bounds(data, starts)
        hashes = hash_runs(data, begins, ends)
        distinct, first = np.unique(hashes, return_index=True)
        if len(self.known) + len(distinct) > self.most_words:
            self._clear()
        new = ~held(self.known, distinct)
        if new.any():
            whole = data.tobytes()
            self._learn(distinct[new], [whole[begins[i]:ends[i]] for i in first[new]])
        place = np.searchsorted(self.known, hashes)
        n = self.n[place]
        return begins, n, self.ids[ragged(self.at[place], n)]

    def encode(self, data: np.ndarray, size: int = PART_BYTES) -> np.ndarray:
        """All ids of one text, whatever its length, from parts of some ``size`` bytes."""
        found = [self.encode_part(part)[2] for part in parts(data, size)]
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def encode_rows(self, data: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of several short texts, and where each text's begin (one more for the end)."""
        begins, n, ids = self.encode_part(data, where[:-1])
        total = np.concatenate([[0], np.cumsum(n)])
        return ids, total[np.searchsorted(begins, where)]


class WordIds(RunIds):
    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)

    def bounds(self, data, starts):
        return word_bounds(data, starts)

    def ids_of(self, runs):
        found = []
        for first in range(0, len(runs), ENCODED_AT_ONCE):
            some = [r.decode() for r in runs[first:first + ENCODED_AT_ONCE]]
            found += [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(n.sum())), n


def word_ids(path: str) -> WordIds:
    """One tokenizer and cache per worker process."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]

"""SentencePiece encoding and decoding as a weighted transducer.

Three transducers are compiled from a model file: the normaliser (a blank becomes the mark of a word's begin, and a text begins with one), the
pieces (an arc for every piece) and the byte fallback (a character that is no piece becomes the pieces of its bytes). Composed with an input they
give a lattice over its positions; encoding is the shortest path in the tropical semiring (min, +).

For a unigram model an arc weighs the negative score of its piece. For a byte-pair model merges decide, and these are local: a row of
pieces is what merging gives if and only if every two neighbours are what merging their join gives. So the states remember the last
piece, an arc between neighbours weighs 0 or infinity, and the only path of finite weight is the encoding.

No piece holds a mark behind another character, so a text's lattice falls into independent ones at each begin of a word. Those are composed
once per distinct word of a batch, words of like length side by side; a word of more than LONG characters is composed alone, place by place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from invoicemill.llm.texts import beside_text, runs_of_rows, text_bytes
from invoicemill.llm.word_ids import RunIds, ragged

MARK = "▁"
LONG = 96                   # characters of a word up to which words are composed side by side
AT_ONCE = 1 << 20           # places times lengths looked up at once
MOST_PAIRS = 2_000_000      # verdicts on neighbours kept per worker (38 MB at most); beyond it they start anew
BPE, UNIGRAM = "bpe", "unigram"
UNKNOWN_PENALTY = 10.0      # how much more than the rarest piece a byte-fallback character weighs, in a unigram model
NOTHING = (1 << 21) - 1     # where a word has ended; no character has this number


def _fields(message: bytes):
    """(number, value) of each field of a serialised message: integers, or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(message):
        number, wire = divmod(varint(), 8)
        n = varint() if wire in (0, 2) else 8 if wire == 1 else 4
        if wire:
            at += n
        yield number, message[at - n:at] if wire else n


def model_kind(path: str) -> str:
    """``bpe`` or ``unigram``, as the model file says (field 3 of its field 2; without it a model is a unigram one)."""
    with open(path, "rb") as f:
        trained = [v for n, v in _fields(f.read()) if n == 2]
    number = next((v for spec in trained for n, v in _fields(spec) if n == 3), 1)
    if number not in (1, 2):
        raise ValueError(f"a model of type {number} is neither unigram nor byte-pair")
    return BPE if number == 2 else UNIGRAM


class _Table:
    """Numbers (from 0) by keys (from 0): a key lies at the place its hash gives, or at the next free one. At most half of the places are taken."""

    def __init__(self, dtype) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self._empty(16)

    def _empty(self, bits: int) -> None:
        self.bits, self.n = bits, 0
        self.keys, self.numbers = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, self.dtype)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it has none."""
        at = self._home(keys)
        held, found = self.keys[at], self.numbers[at]
        wrong = np.flatnonzero(held != keys)
        if len(wrong):
            taken = held[wrong] >= 0
            found[wrong] = -1
            wrong = wrong[taken]
        at = at[wrong]
        while len(wrong):
            at = at + 1 & len(self.keys) - 1
            held = self.keys[at]
            hit = held == keys[wrong]
            found[wrong[hit]] = self.numbers[at[hit]]
            on = ~hit & (held >= 0)
            wrong, at = wrong[on], at[on]
        return found

    def learn(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Adds keys, each of them once and none that is there."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            kept = self.keys >= 0
            keys, numbers = np.concatenate([self.keys[kept], keys]), np.concatenate([self.numbers[kept], numbers])
            self._empty((2 * len(keys)).bit_length())
        self.n += len(keys)
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]        # of several keys for one place one stays, the others go on
            own = self.keys[at] == keys
            self.numbers[at[own]] = numbers[own]
            keys, numbers, at = keys[~own], numbers[~own], at[~own] + 1 & len(self.keys) - 1


class _Pairs(_Table):
    """Verdicts on pairs of neighbours, at most MOST_PAIRS."""

    def __init__(self) -> None:
        super().__init__(np.int8)

    @property
    def codes(self) -> list[np.ndarray]:
        return [self.keys[self.keys >= 0]]

    def learn(self, codes: np.ndarray, fit: np.ndarray) -> None:
        if self.n + len(codes) > MOST_PAIRS:
            self.clear()
        super().learn(codes[:MOST_PAIRS], fit[:MOST_PAIRS])


class PieceOutputs:
    """The output side: the bytes of every id, and texts from ids."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        out = []
        for i in range(model.get_piece_size()):
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            piece = model.id_to_piece(i)
            out.append(b"" if special else bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(MARK, " ").encode())
        self.n = np.array([len(x) for x in out])
        self.at, self.out = np.cumsum(self.n) - self.n, np.frombuffer(b"".join(out), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids: bytes of all pieces, without the blank that every text begins with."""
        out = self.out[ragged(self.at[ids], self.n[ids])].tobytes()
        return out[1:] if out[:1] == b" " else out


class PieceTransducer(RunIds):
    most_words = 400_000        # kept per worker (about 20 MB)

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" aé  ﬁ\t") != f"{MARK}{MARK}aé{MARK}{MARK}ﬁ\t":
            raise ValueError("the model's normaliser does more than marking blanks")
        self.kind, size = model_kind(path), model.get_piece_size()
        special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.piece_of = {i: model.id_to_piece(i) for i in range(size) if i not in special}
        self.id_of = {p: i for i, p in self.piece_of.items()}
        self.score = np.array([model.get_score(i) for i in range(size)])
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("a piece goes on over the begin of a word")
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.longest = max(map(len, self.id_of))
        # The arcs as a tree of characters: a state for each begin of a piece, and the piece that ends in a state.
        states = {"": 0}
        for piece in self.id_of:
            for end in range(1, len(piece) + 1):
                states.setdefault(piece[:end], len(states))
        begins = list(states)[1:]
        self.arcs = _Table(np.int32)
        self.arcs.learn(np.array([states[x[:-1]] << 21 | ord(x[-1]) for x in begins], np.int64), np.arange(1, len(states)))
        self.ends_in = np.array([self.id_of.get(x, -1) for x in states], np.int32)
        self.pairs = _Pairs()
        self.size, self.byte_weight = size, UNKNOWN_PENALTY - float(self.score[list(self.piece_of)].min())

    # ---- composition with one run: a begin of a word and what follows ----

    def merged(self, text: str) -> list[str]:
        """What merging gives: the neighbours whose join has the best score become one piece, as long as there are any."""
        parts = list(text)
        while len(parts) > 1:
            scored = [(self.score[self.id_of[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.id_of]
            if not scored:
                break
            i = -max(scored)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _neighbours(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """True where merging leaves the pieces ``left`` and ``right`` apart; left -1 is the begin, -2 a byte arc."""
        code = np.where(left >= 0, left, self.size).astype(np.int64) * (self.size + 1) + right
        fit = self.pairs.look_up(code)
        unknown = np.flatnonzero(fit < 0)
        if len(unknown):
            new, back = np.unique(code[unknown], return_inverse=True)
            verdicts = np.fromiter(map(self._apart, new.tolist()), np.int8, len(new))
            fit[unknown] = verdicts[back]
            self.pairs.learn(new, verdicts)
        return fit > 0

    def _apart(self, code: int) -> bool:
        a, b = divmod(code, self.size + 1)
        parts = [self.piece_of[b]] if a == self.size else [self.piece_of[a], self.piece_of[b]]
        return self.merged("".join(parts)) == parts

    def _pieces(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length (where pieces of that length begin, their ids). The words are the columns of ``codes``; places are numbered row by row."""
        n, m = codes.shape
        flat = codes.ravel().astype(np.int64)
        at, state, found = np.flatnonzero(flat != NOTHING), 0, []
        for length in range(1, min(self.longest, n) + 1):
            if length > 1:
                some = np.searchsorted(at, (n - length + 1) * m)        # further ones would go on below the last row
                at, state = at[:some], state[:some]
            state = self.arcs.look_up(state << 21 | flat[at + (length - 1) * m])
            goes = np.flatnonzero(state > 0)
            at, state = at[goes], state[goes].astype(np.int64)
            ids = self.ends_in[state]
            ended = np.flatnonzero(ids >= 0)
            found.append((at[ended], ids[ended]))
        return found

    def _shortest(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Shortest paths of all words (columns, filled up with NOTHING): in a row for each word, at each place the id of the piece that
        begins there, -1 if none does, -2 - c if character c becomes bytes."""
        n, m = codes.shape
        found = self._pieces(codes)
        edges = [np.searchsorted(at, np.arange(n + 1) * m).tolist() for at, _ in found]
        cost = np.full((n + 1, m), np.inf)
        cost[0] = 0
        last, back = np.full((n + 1, m), -1, np.int32), np.zeros((n + 1, m), np.int32)
        for j in range(1, n + 1):
            for length in range(min(len(found), j), 0, -1):
                begin, (at, ids) = j - length, found[length - 1]
                first, end = edges[length - 1][begin:begin + 2]
                if first == end:
                    continue
                words, piece = at[first:end] - begin * m, ids[first:end]
                total = cost[begin, words] if self.kind == BPE else cost[begin, words] - self.score[piece]
                better = np.flatnonzero(total < cost[j, words])
                if self.kind == BPE and len(better):
                    better = better[self._neighbours(last[begin, words[better]], piece[better])]
                words = words[better]
                cost[j, words], last[j, words], back[j, words] = total[better], piece[better], length
            alone = codes[j - 1] != NOTHING
            alone[found[0][0][edges[0][j - 1]:edges[0][j]] - (j - 1) * m] = False
            words = np.flatnonzero(alone)
            if len(words):
                total = cost[j - 1, words] + (0 if self.kind == BPE else self.byte_weight)
                better = total < cost[j, words]
                words = words[better]
                cost[j, words], last[j, words], back[j, words] = total[better], -2, 1
        path, at, words = np.full((m, n), -1, np.int64), lengths.copy(), np.arange(m)
        while len(words):
            j = at[words]
            begin = j - back[j, words]
            piece = last[j, words]
            path[words, begin] = np.where(piece == -2, -2 - codes[begin, words].astype(np.int64), piece)
            at[words] = begin
            words = words[begin > 0]
        return path

    def _shortest_long(self, codes: np.ndarray) -> np.ndarray:
        """The same for one long word, place by place; pieces are looked up for a bounded stretch at once."""
        n, longest, bpe = len(codes), self.longest, self.kind == BPE
        cost, last, back = [0.0] + [np.inf] * n, np.full(n + 1, -1, np.int64).tolist(), np.zeros(n + 1, np.int64).tolist()
        score, verdicts, size = self.score.tolist(), {}, self.size
        step = AT_ONCE // longest
        for first in range(0, n, step):
            ending: list[list] = [[] for _ in range(min(step, n - first))]
            begin = max(0, first - longest + 1)
            for length, (at, ids) in enumerate(self._pieces(codes[begin:first + step, None]), 1):
                ends = at + begin + length - 1 - first
                for e, piece in zip(ends[ends >= 0].tolist(), ids[ends >= 0].tolist()):
                    ending[e].append((length, piece))
            for j, arcs in enumerate(ending, first + 1):
                single = False
                for length, piece in arcs:
                    before, single = cost[j - length], single or length == 1
                    total = before if bpe else before - score[piece]
                    if total >= cost[j]:
                        continue
                    if bpe:
                        left = last[j - length]
                        code = (left if left >= 0 else size) * (size + 1) + piece
                        fit = verdicts.get(code)
                        if fit is None:
                            if len(verdicts) >= 500_000:
                                verdicts.clear()
                            fit = verdicts[code] = self._apart(code)
                        if not fit:
                            continue
                    cost[j], last[j], back[j] = total, piece, length
                if not single:
                    total = cost[j - 1] + (0 if bpe else self.byte_weight)
                    if total < cost[j]:
                        cost[j], last[j], back[j] = total, -2, 1
        path, j = np.full(n, -1, np.int64), n
        while j:
            piece, j = last[j], j - back[j]
            path[j] = -2 - int(codes[j]) if piece == -2 else piece
        return path

    def ids_of(self, runs):
        joined = b"".join(runs)
        every = np.frombuffer(joined.decode().replace(" ", MARK).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        lengths = np.add.reduceat(np.frombuffer(joined, np.uint8) & 0xC0 != 0x80, np.cumsum(sizes) - sizes, dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        by_length = np.argsort(lengths, kind="stable")
        in_order = lengths[by_length]
        n_ids, order, found, first = np.zeros(len(runs), np.int64), [], [], 0
        while first < len(runs):
            short = int(in_order[first])
            most = short if short > LONG else min(LONG, short + 1 + short // 4)
            last = min(int(np.searchsorted(in_order, most, "right")), first + max(1, AT_ONCE // (most * min(most, self.longest)))) if short <= LONG else first + 1
            some = by_length[first:last]
            first, own = last, lengths[some]
            if short > LONG:
                path = self._shortest_long(every[starts[some[0]]:starts[some[0]] + short])[None, :]
            else:
                n = np.arange(int(own.max()))[:, None]
                codes = np.where(n < own, every[np.minimum(starts[some] + n, len(every) - 1)], np.uint32(NOTHING))
                path = self._shortest(codes, own)
            begins = path != -1
            ids, count = path[begins], begins.sum(1)
            if (ids < 0).any():                 # characters that become bytes
                raw = ids < 0
                chars = -2 - ids[raw]
                size = np.ones(len(ids), np.int64)
                size[raw] = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
                count = np.bincount(np.repeat(np.arange(len(some)), count), size, len(some)).astype(np.int64)
                ids, raw = np.repeat(ids, size), np.repeat(raw, size)
                ids[raw] = self.byte_id[np.frombuffer(chars.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
            n_ids[some] = count
            order.append(some), found.append(ids)
        laid, order = np.concatenate(found).astype(np.int32), np.concatenate(order)
        begin = np.empty(len(runs), np.int64)
        begin[order] = np.cumsum(n_ids[order]) - n_ids[order]
        return laid[ragged(begin, n_ids)], n_ids

    def bounds(self, data, starts):
        blank = data == 32
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[starts[starts < len(data)]] = True
        begins = np.flatnonzero(begins)
        return begins, np.append(begins[1:], len(data))

    # ---- whole texts ----

    @staticmethod
    def normalised(text: bytes) -> bytes:
        """Marks read as blanks, and one blank before a text that is not empty."""
        return b" " + text.replace(MARK.encode(), b" ") if text else b""

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of one text, whatever its length; it is taken in parts that end at a begin of a word."""
        found, data = [], np.frombuffer(self.normalised(text), np.uint8)
        begins = self.bounds(data, np.zeros(1, np.int64))[0]
        cuts = begins[np.searchsorted(begins, np.arange(0, len(data), 1 << 20))[:-1]] if len(data) > 1 << 20 else begins[:1]
        edges = np.unique(np.concatenate([[0], cuts, [len(data)]]))
        for a, b in zip(edges[:-1], edges[1:]):
            found.append(self.encode_part(data[a:b], np.zeros(1, np.int64))[2])
        return np.concatenate(found) if found else np.zeros(0, np.int32)


_loaded: dict[str, PieceTransducer] = {}
_loaded_outputs: dict[str, PieceOutputs] = {}


def _outputs(path: str) -> PieceOutputs:
    if path not in _loaded_outputs:
        _loaded_outputs[path] = PieceOutputs(path)
    return _loaded_outputs[path]


def transducer(path: str) -> PieceTransducer:
    if path not in _loaded:
        _loaded[path] = PieceTransducer(path)
    return _loaded[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = transducer(path)
        for batch in batches:
            data, where = text_bytes(batch.column(1))
            for first, last in runs_of_rows(where):
                if last - first == 1:
                    ids = model.encode(data[where[first]:where[last]].tobytes())
                    edges = np.array([0, len(ids)])
                else:
                    texts = [model.normalised(data[where[i]:where[i + 1]].tobytes()) for i in range(first, last)]
                    starts = np.cumsum([0, *map(len, texts)])
                    begins, n, ids = model.encode_part(np.frombuffer(b"".join(texts), np.uint8), starts[:-1])
                    edges = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(begins, starts)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(first, last - first) for i in (0, 1)), pa.ListArray.from_arrays(
                    pa.array(edges.astype(np.int32)), pa.array(ids.astype(np.int32)))], ["row", "text", "ids"])
            del batch, data
            pa.default_memory_pool().release_unused()
    return run


def encode(docs: DataFrame, model: str, *, text_col: str = "text") -> DataFrame:
    """Adds ``ids``, the piece ids of the text. A null or empty text has none. ``model`` is the path of a model file, the same on all executors.
    Every row is encoded for itself; its columns are kept, an ``ids`` of its own is replaced."""
    rows, schema, columns = beside_text(docs, text_col, ("ids",))
    return rows.mapInArrow(_encode(model), schema.add("ids", ArrayType(IntegerType()))).select(*columns, "ids")


def _decode(path: str):
    def run(batches):
        model = _outputs(path)
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                texts = [model.decode(x.values.to_numpy()) if x.is_valid else b"" for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([t.decode(errors="replace") for t in texts], pa.string())], ["row", "text", "decoded"])
            del batch, part
            pa.default_memory_pool().release_unused()
    return run


def decode(rows: DataFrame, model: str, *, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids; bytes that are no UTF-8 become replacement characters. Null ids give an empty text.
    A mark (U+2581) in a text is encoded as a blank and is read back as one."""
    packed, schema, columns = beside_text(rows, ids_col, ("decoded",))
    return packed.mapInArrow(_decode(model), schema.add("decoded", "string")).select(*columns, "decoded")


def ids_crc32(ids) -> int:
    """Checksum of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())

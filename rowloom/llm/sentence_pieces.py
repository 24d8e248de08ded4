"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

Texts are cut into words where a blank follows a visible character (no piece reaches over such a place). New words of a
batch are grouped by length and advance together: at each place the substrings that end there are hashed, the hashes
probe sorted piece keys, and the best path over all words is kept with its backpointer. Words stay known to the worker.

For unigram models a path's value is the sum of its pieces' scores. A merge model (BPE) orders merges instead; there a
step from one piece to the next is open only if merging their joint characters leaves exactly these two pieces. Each
prefix of a word then has one open path, which is the model's own segmentation, so the same search serves both kinds.
"""

from __future__ import annotations

import codecs
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from rowloom.llm.common import fresh, quoted, worker_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
UNKNOWN_STEP = 10.0  # fixed value: how far an unknown character's score lies below the least score
MOST_REMEMBERED = 500_000
BATCHED_LENGTH = 64
_HASH = 0x9E3779B97F4A7C15
_FOREIGN = 1 << 24  # a character without piece is this plus its code point
_RUN = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+$")

codecs.register_error("rowloom_each_byte", lambda e: ("�", e.start + 1))


def _proto_fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a serialised message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = raw[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, raw[i:i + size]
            i += size


class PieceModel:
    def __init__(self, path: str | None = None, proto: bytes | None = None):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path) if proto is None else sentencepiece.SentencePieceProcessor(model_proto=proto)
        library = self.library
        message = list(_proto_fields(library.serialized_model_proto()))
        trainer = dict(_proto_fields(next(v for f, v in message if f == 2)))
        normalizer = dict(_proto_fields(next((v for f, v in message if f == 3), b"")))
        self.merging = trainer.get(3, 1) == 2
        self.prefix = bool(normalizer.get(3, 1))
        if not self.merging and trainer.get(3, 1) != 1:
            raise ValueError("only unigram and merge models are known")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that keep texts and blanks as they are (identity normalizer) are known")
        n = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(n)]
        self.unknown = library.unk_id()
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if library.is_byte(i)}
        plain = [i for i in range(n) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))]
        self.id_of = {names[i]: i for i in plain}
        self.name = names
        self.score = np.array([library.get_score(i) for i in range(n)], dtype=np.float64)
        self.scores = self.score.tolist()
        self.least = float(self.score[plain].min())
        self.longest = max(len(names[i]) for i in plain)
        self.free = not any(re.search(f"[^{BLANK}]{BLANK}", names[i]) for i in plain)
        # Sorted keys of the pieces of each length.
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in range(1, self.longest + 1):
            ids = np.array([i for i in plain if len(names[i]) == length], dtype=np.int64)
            if len(ids):
                points = np.frombuffer("".join(names[i] for i in ids).encode("utf-32-le"), np.uint32).reshape(len(ids), length)
                key = self._prefixes(points)[:, -1]
                order = np.argsort(key)
                self.keys[length] = key[order], ids[order]
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        whole = np.zeros(n, bool)
        whole[plain] = [not self.merging or self._merge(names[i]) == [names[i]] for i in plain]
        self.whole = whole
        texts = [names[i].replace(BLANK, " ").encode() for i in range(n)]
        for value, i in self.byte_id.items():
            texts[i] = bytes([value])
        for i in range(n):
            if library.is_control(i):
                texts[i] = b""
        texts[self.unknown] = trainer.get(44, " ⁇ ".encode())
        self.texts = texts

    @staticmethod
    def _prefixes(points: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes of words of one length."""
        out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
        for i in range(points.shape[1]):
            out[:, i + 1] = out[:, i] * np.uint64(_HASH) + points[:, i].astype(np.uint64) + np.uint64(1)
        return out

    def _merge(self, text: str) -> list[str]:
        """Symbols after merging: always the adjacent pair whose piece has the best score, the leftmost of equal ones."""
        symbols, id_of, scores = list(text), self.id_of, self.scores
        values = [scores[i] if (i := id_of.get(a + b)) is not None else None for a, b in zip(symbols, symbols[1:])]
        while True:
            best = at = None
            for k, v in enumerate(values):
                if v is not None and (best is None or v > best):
                    best, at = v, k
            if at is None:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del values[at]
            for k in (at - 1, at):
                if 0 <= k < len(values):
                    i = id_of.get(symbols[k] + symbols[k + 1])
                    values[k] = scores[i] if i is not None else None

    def _text_of(self, symbol: int) -> str:
        return chr(symbol - _FOREIGN) if symbol >= _FOREIGN else self.name[symbol]

    def _open(self, pair: int) -> bool:
        """Whether two symbols stay apart when their joint characters are merged."""
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= 2 * MOST_REMEMBERED:
                self.pairs.clear()
            a, b = self._text_of(pair >> 32), self._text_of(pair & 0xFFFFFFFF)
            known = self.pairs[pair] = self._merge(a + b) == [a, b]
        return known

    def _ids(self, symbols: list[int]) -> bytes:
        out: list[int] = []
        for s in symbols:
            if s < _FOREIGN:
                out.append(s)
            elif self.byte_id:
                out += [self.byte_id[b] for b in chr(s - _FOREIGN).encode()]
            else:
                out.append(self.unknown)
        return np.array(out, "<i4").tobytes()

    def search(self, words: list[str]) -> list[bytes]:
        """Identifiers of words of one length, which advance together."""
        n, length = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, length)
        prefix = self._prefixes(points)
        power = [pow(_HASH, k, 1 << 64) for k in range(self.longest + 1)]
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0.0
        step = np.zeros((n, length + 1), np.int32)
        piece = np.zeros((n, length + 1), np.int64)
        rows = np.arange(n)
        for i in range(1, length + 1):
            left = rows  # merge models: words whose open step is still sought
            for size in range(min(i, self.longest), 0, -1):
                if not len(left):
                    break
                j = i - size
                found = np.full(len(left), -1, np.int64)
                if size in self.keys:
                    keys, ids = self.keys[size]
                    h = prefix[left, i] - prefix[left, j] * np.uint64(power[size])
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    hit = keys[at] == h
                    found[hit] = ids[at[hit]]
                if self.merging:
                    found[(found >= 0) & ~self.whole[found]] = -1
                if size == 1:
                    none = found < 0
                    found[none] = _FOREIGN + points[left[none], j]
                which = np.flatnonzero(found >= 0)
                at_row, symbol = left[which], found[which]
                if self.merging:
                    if j:
                        pair, back = np.unique(piece[at_row, j] << 32 | symbol, return_inverse=True)
                        is_open = np.fromiter(map(self._open, pair.tolist()), bool, len(pair))[back]
                        which, at_row, symbol = which[is_open], at_row[is_open], symbol[is_open]
                    best[at_row, i], step[at_row, i], piece[at_row, i] = 0.0, size, symbol
                    left = np.delete(left, which)
                else:
                    known = symbol < _FOREIGN
                    value = best[at_row, j] + np.where(known, self.score[np.where(known, symbol, 0)], self.least - UNKNOWN_STEP)
                    better = value > best[at_row, i]
                    at_row = at_row[better]
                    best[at_row, i], step[at_row, i], piece[at_row, i] = value[better], size, symbol[better]
        # Follow the backpointers of all words together, from the end.
        place = np.full(n, length)
        path = np.full((n, length), -1, np.int64)
        k = 0
        while (place > 0).any():
            path[:, k] = np.where(place > 0, piece[rows, place], -1)
            place = place - np.where(place > 0, step[rows, place], 0)
            k += 1
        path = path[:, :k][:, ::-1]
        if path.max(initial=0) < _FOREIGN:
            flat, count = path[path >= 0].astype("<i4"), (path >= 0).sum(axis=1)
            at = np.concatenate([[0], np.cumsum(count)]) * 4
            raw = flat.tobytes()
            return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return [self._ids([s for s in row if s >= 0]) for row in path.tolist()]

    def search_one(self, word: str) -> bytes:
        """The same search for one very long word."""
        length = len(word)
        best, step, piece = [0.0] + [-np.inf] * length, [0] * (length + 1), [0] * (length + 1)
        for i in range(1, length + 1):
            for size in range(min(i, self.longest), 0, -1):
                j = i - size
                symbol = self.id_of.get(word[j:i])
                if symbol is None or not self.whole[symbol]:
                    if size > 1:
                        continue
                    symbol = _FOREIGN + ord(word[j]) if symbol is None else symbol
                if self.merging:
                    if not j or self._open(piece[j] << 32 | symbol):
                        best[i], step[i], piece[i] = 0.0, size, symbol
                        break
                else:
                    value = best[j] + (self.scores[symbol] if symbol < _FOREIGN else self.least - UNKNOWN_STEP)
                    if value > best[i]:
                        best[i], step[i], piece[i] = value, size, symbol
        out, i = [], length
        while i:
            out.append(piece[i])
            i -= step[i]
        return self._ids(out[::-1])

    def split(self, text: str) -> list[str]:
        body = (" " if self.prefix else "") + text
        parts = body.split(" ")
        if self.free and BLANK not in text and "" not in parts[1:] and (self.prefix or parts[0]):
            return [BLANK + p for p in parts[1:]] if self.prefix else [parts[0], *(BLANK + p for p in parts[1:])]
        body = body.replace(" ", BLANK)
        return _RUN.findall(body) if self.free else [body]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Identifiers of each text as little-endian 32-bit numbers."""
        split = [self.split(t) if t else [] for t in texts]
        new = {w for parts in split for w in parts if w not in self.words}
        if len(self.words) + len(new) > MOST_REMEMBERED:
            self.words.clear()
            new = {w for parts in split for w in parts}
        groups: dict[int, list[str]] = {}
        for w in sorted(new):
            groups.setdefault(len(w), []).append(w)
        words = self.words
        for length, group in groups.items():
            if length > BATCHED_LENGTH:
                words.update((w, self.search_one(w)) for w in group)
            else:
                size = max(1, 2_000_000 // length)
                for a in range(0, len(group), size):
                    words.update(zip(group[a:a + size], self.search(group[a:a + size])))
        out = [b"".join(map(words.__getitem__, parts)) for parts in split]
        for length, group in groups.items():
            if length > 4 * BATCHED_LENGTH:
                for w in group:
                    del words[w]
        return out

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.texts.__getitem__, ids))
        text = raw.decode("utf-8", errors="rowloom_each_byte")
        first = next((i for i in ids if self.texts[i]), None)
        return text[1:] if self.prefix and first is not None and self.name[first].startswith(BLANK) else text


def piece_model(path: str) -> PieceModel:
    """The model of ``path``, loaded once in each worker."""
    store = worker_store()
    if ("pieces", path) not in store:
        store["pieces", path] = PieceModel(path)
    return store["pieces", path]


def encode_pieces(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the piece identifiers of each whole text in ``ids_col`` (replaced if it is there).

    Null gives null, the empty text an empty list. Strings that look like control pieces are ordinary text; characters
    without piece become byte pieces, or the unknown piece where the model has none.
    """
    kept = [c for c in docs.columns if c.lower() != ids_col.lower()]
    text = fresh(kept, "text_to_encode")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, 2048):
                batch = whole.slice(begin, 2048)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                raw = model.encode(texts)
                at = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
                mask = pa.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")), mask=mask)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [*batch.schema.names[:-1], ids_col])

    rows = docs.select(*[quoted(c) for c in kept], quoted(text_col).cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}{', ' if kept else ''}`{ids_col}` array<int>")


def decode_pieces(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of each list of piece identifiers in ``text_col`` (replaced if it is there).

    Null gives null, an empty list the empty text. Byte pieces that form no character give U+FFFD each.
    """
    kept = [c for c in docs.columns if c.lower() != text_col.lower()]
    ids = fresh(kept, "ids_to_decode")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, 2048):
                batch = whole.slice(begin, 2048)
                lists = batch.column(batch.num_columns - 1)
                flat, at = lists.flatten().to_numpy(zero_copy_only=False), 0
                texts = []
                for n in lists.value_lengths().to_pylist():
                    texts.append(None if n is None else model.decode(flat[at:at + n].tolist()))
                    at += n or 0
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], text_col])

    rows = docs.select(*[quoted(c) for c in kept], quoted(ids_col).alias(ids))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}{', ' if kept else ''}`{text_col}` string")


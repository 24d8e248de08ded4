"""Identifiers of whole texts by a byte-level vocabulary, all parts of many texts at once.

Texts are cut at single blanks between two visible characters, which no piece of the pre-tokenizer reaches over; a part
begins with its blank. Parts are known by a 64-bit hash of their bytes. A worker keeps one table of parts, sorted by hash,
with their identifiers in one array; what is new in a stretch of text is encoded once and added, and the identifiers of
all parts are copied together. Texts that hold a special string are encoded one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from rowloom.llm.bpe_tokens import Vocabulary, vocabulary
from rowloom.llm.common import row_chunks, span_hashes, text_bytes, worker_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STRETCH_BYTES = 1 << 20
MOST_PARTS = 1_000_000
MOST_IDS = 8_000_000
_ASCII_WHITE = np.zeros(256, dtype=bool)
_ASCII_WHITE[[*range(9, 14), *range(28, 33)]] = True


def _wide_white(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whether three bytes are, or their last two are, white space beyond ASCII (c is the last byte)."""
    return (
        ((b == 0xC2) & ((c == 0x85) | (c == 0xA0)))
        | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
        | ((a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
        | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
        | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    )


def part_begins(body: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where parts begin: at each row that is not empty, and at each blank with a visible character on both sides."""
    opens = starts[:-1][np.diff(starts) > 0]
    blank = np.flatnonzero(body == 32)
    if not len(blank):
        return opens
    padded = np.concatenate([np.zeros(3, np.uint8), body, np.zeros(3, np.uint8)])
    at = blank + 3
    before, after = padded[at - 1], padded[at + 1]
    seen = ~_ASCII_WHITE[before] & ~_ASCII_WHITE[after]
    wide = (before >= 0x80) | (after >= 0x80)
    some = np.flatnonzero(seen & wide)
    p = at[some]
    seen[some] &= ~_wide_white(padded[p - 3], padded[p - 2], padded[p - 1])
    seen[some] &= ~(_wide_white(np.zeros(len(p), np.uint8), padded[p + 1], padded[p + 2]) | _wide_white(padded[p + 1], padded[p + 2], padded[p + 3]))
    blank = blank[seen]
    # The first and last byte of a row have a neighbour on one side only.
    edge = np.zeros(len(body) + 1, dtype=bool)
    edge[starts] = True
    blank = blank[~edge[blank] & ~edge[blank + 1]]
    return np.sort(np.concatenate([opens, blank]))


def visible_at(body: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the character that begins at byte ``first`` and the one that ends at byte ``last`` are both no white space."""
    padded = np.concatenate([np.zeros(2, np.uint8), body, np.zeros(3, np.uint8)])
    a, b, c = (padded[first + 2 + i] for i in range(3))
    x, y, z = (padded[last + i] for i in range(3))
    out = ~_ASCII_WHITE[a] & ~_ASCII_WHITE[z]
    out &= ~(_wide_white(np.zeros(len(a), np.uint8), a, b) | _wide_white(a, b, c))
    return out & ~_wide_white(x, y, z)


class PartTable:
    """The parts a worker has met, with their identifiers."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.lengths = np.zeros(max(words.bytes_of) + 1, dtype=np.int64)
        for i, raw in words.bytes_of.items():
            self.lengths[i] = len(raw)
        self.forget()

    def forget(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def learn(self, body: np.ndarray, keys: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Add parts with new, sorted keys; a table that has become too large begins anew (``keys`` then hold all parts in use)."""
        ids, sizes = self.encoded(body, begin, end)
        slots = len(self.at) - 1 + np.arange(len(keys))
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        spot = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, spot, keys), np.insert(self.slots, spot, slots)

    def encoded(self, body: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of the parts, and how many each has.

        Parts that begin with a blank and end with a visible character are encoded as one text: no piece reaches over their
        borders, which are found again by the bytes of the identifiers. Others are encoded one by one.
        """
        fine = (body[begin] == 32) & (end - begin > 1) & visible_at(body, begin + 1, end - 1)
        sizes = np.zeros(len(begin), dtype=np.int64)
        a, length = begin[fine], (end - begin)[fine]
        at = np.concatenate([[0], np.cumsum(length)])
        text = body[np.repeat(a - at[:-1], length) + np.arange(at[-1])].tobytes().decode()
        together = np.frombuffer(self.words.ids_part(text), dtype="<u4")
        upto = np.searchsorted(np.cumsum(self.lengths[together]), at[1:]) + 1
        sizes[fine] = np.diff(upto, prepend=0)
        alone = [np.frombuffer(self.words.ids_part(body[i:j].tobytes().decode()), dtype="<u4") for i, j in zip(begin[~fine].tolist(), end[~fine].tolist())]
        sizes[~fine] = [len(x) for x in alone]
        out = np.empty(int(sizes.sum()), dtype=np.uint32)
        mine = np.repeat(fine, sizes)
        out[mine] = together
        out[~mine] = np.concatenate(alone) if alone else np.zeros(0, np.uint32)
        return out, sizes

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def stretch(self, body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of the rows of a stretch, each followed by one free place, and where each row's begin."""
        begin = part_begins(body, starts)
        end = np.append(begin[1:], len(body))
        keys, first, inverse = np.unique(span_hashes(body, begin, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > MOST_PARTS or len(self.ids) > MOST_IDS:
            self.forget()
        new = np.flatnonzero(~self._known(keys))
        if len(new):
            self.learn(body, keys[new], begin[first[new]], end[first[new]])
        slots = self.slots[np.searchsorted(self.keys, keys)][inverse] if len(keys) else np.zeros(0, np.int64)
        sizes = self.at[slots + 1] - self.at[slots]
        row_of = np.searchsorted(starts, begin, side="right") - 1
        # Rows without bytes share their start with the row after, which is the one that a part belongs to.
        total = np.bincount(row_of, weights=sizes, minlength=len(starts) - 1).astype(np.int64) + 1
        at = np.concatenate([[0], np.cumsum(total)])
        out = np.zeros(int(at[-1]), dtype=np.uint32)
        to = np.cumsum(sizes) - sizes + row_of
        out[np.repeat(to - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))] = self.ids[
            np.repeat(self.at[slots] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        ]
        return out, at

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per range of rows: its first row, identifiers with a free place behind each row's, and where each row's begin."""
        body, starts = text_bytes(texts)
        special = [s.encode() for s in self.words.special]
        for i, j in row_chunks(starts, STRETCH_BYTES):
            part, at = body[starts[i]:starts[j]], starts[i:j + 1] - starts[i]
            raw = part.tobytes()
            if any(s in raw for s in special):
                for row in range(i, j):
                    ids = self.words.encode(raw[at[row - i]:at[row - i + 1]].decode())
                    yield row, np.append(np.frombuffer(ids, dtype="<u4"), np.uint32(0)), np.array([0, len(ids) // 4 + 1])
            else:
                yield i, *self.stretch(part, at)


def part_table(path: str) -> PartTable:
    """The table of this worker for the vocabulary of ``path``."""
    store = worker_store()
    if ("parts", path) not in store:
        store["parts", path] = PartTable(vocabulary(path))
    return store["parts", path]

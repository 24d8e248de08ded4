"""Byte-level byte-pair encoding: token counts by a heap over a linked list, and identifiers of whole texts.

A text is cut at its special strings, then at single blanks between two visible characters. No piece of the
pre-tokenizer reaches over such a blank, so the parts can be worked out one by one and remembered for the life of a
worker; a text of millions of characters is a sum over its parts.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import quoted, worker_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the pre-tokenizer's pattern that the byte-level kind stands for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_REMEMBERED = 500_000
_BLANK = re.compile(r"(?<=\S) (?=\S)")
_TWO_SPACES = re.compile(r"\s\s|^\s|\s$")
_ID_BITS = 20


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """A byte-level vocabulary file (.json): byte symbols, merges by rank, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        before = file.get("pre_tokenizer") or {}
        if file["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or file.get("normalizer"):
            raise ValueError(f"{path} is not a byte-level BPE vocabulary without normalizer")
        vocabulary, letters = file["model"]["vocab"], _byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if all(c in letters for c in token)}
        self.symbol = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocabulary[a] << _ID_BITS | vocabulary[b]] = rank << _ID_BITS | vocabulary[a + b]
        self.pattern = regex.compile(PATTERN)
        self.split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.counts: dict[str, int] = {}
        self.ids: dict[str, bytes] = {}
        self._encoding: tiktoken.Encoding | None = None

    def merged(self, raw: bytes) -> int:
        """Symbols left of ``raw`` when no adjacent pair has a rank: initial symbols minus merges."""
        symbol = [self.symbol[b] for b in raw]
        n, merges = len(symbol), self.merges
        heap = [(m, i) for i in range(n - 1) if (m := merges.get(symbol[i] << _ID_BITS | symbol[i + 1])) is not None]
        if not heap:
            return n
        heapq.heapify(heap)
        after, before, left = list(range(1, n + 1)), list(range(-1, n - 1)), n
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            # A pair that has changed since it was pushed is stale.
            if symbol[i] < 0 or j >= n or merges.get(symbol[i] << _ID_BITS | symbol[j]) != m:
                continue
            symbol[i], symbol[j] = m & (1 << _ID_BITS) - 1, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := merges.get(symbol[i] << _ID_BITS | symbol[k])) is not None:
                    heapq.heappush(heap, (new, i))
            h = before[i]
            if h >= 0 and (new := merges.get(symbol[h] << _ID_BITS | symbol[i])) is not None:
                heapq.heappush(heap, (new, h))
        return left

    def count_part(self, part: str) -> int:
        return sum(self.merged(piece.encode()) for piece in self.pattern.findall(part))

    def ids_part(self, part: str) -> bytes:
        if self._encoding is None:
            ranks = {self.bytes_of[i]: i for i in self.bytes_of}
            self._encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return np.asarray(self._encoding.encode_ordinary(part), dtype="<u4").tobytes()

    @staticmethod
    def remember(known: dict, key: str, part: str, value: Callable):
        got = known.get(key)
        if got is None:
            got = value(part)
            if len(key) <= 256:
                if len(known) >= MOST_REMEMBERED:
                    known.clear()
                known[key] = got
        return got

    def values(self, text: str, known: dict, value: Callable, special: Callable) -> list:
        """``value`` of each part of ``text`` in order, remembered in ``known``; ``special`` of each special string."""
        out: list = []
        for piece in self.split.split(text) if self.split and any(s in text for s in self.special) else (text,):
            if piece in self.special:
                out.append(special(piece))
                continue
            if not piece:
                continue
            parts = _BLANK.split(piece) if _TWO_SPACES.search(piece) else piece.split(" ")
            # All parts but the first begin with their blank; they are remembered without it, the first with a line
            # feed before it, which no other part begins with.
            key = "\n" + parts[0]
            out.append(self.remember(known, key, parts[0], value))
            done, rest = len(out), parts[1:]
            try:
                out.extend(map(known.__getitem__, rest))
            except KeyError:
                del out[done:]
                out.extend(known[p] if p in known else self.remember(known, p, " " + p, value) for p in rest)
        return out

    def count(self, text: str) -> int:
        return sum(self.values(text, self.counts, self.count_part, lambda s: 1))

    def encode(self, text: str) -> bytes:
        """Identifiers as little-endian unsigned 32-bit numbers."""
        return b"".join(self.values(text, self.ids, self.ids_part, lambda s: np.uint32(self.special[s]).astype("<u4").tobytes()))


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of ``path``, loaded once in each worker."""
    store = worker_store()
    if ("bpe", path) not in store:
        store["bpe", path] = Vocabulary(path)
    return store["bpe", path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of each row: tokens of the whole text without added ones; special strings count one each.

    Counts come from merges alone, no identifiers are made. Null and empty texts have no bytes and no tokens; null ids
    stay null, repeated rows give a row each, an empty table an empty result. Only the two columns named are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            counts = [words.count(t) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    text = quoted(text_col).cast("string")
    rows = docs.select(
        quoted(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"),
    )
    return rows.mapInArrow(run, "id bigint, n_bytes bigint, n_tokens bigint")

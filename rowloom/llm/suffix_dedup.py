"""Removal of repeated byte strings by sorted suffixes.

Every string of ``min_bytes`` bytes that also starts in a document with a smaller id is removed, overlaps included.

1. *Anchors.* In each window of ``min_bytes`` bytes the run of ``GRAM`` bytes with the least hash is its anchor. Equal
   windows have equal anchors at equal places, so only suffixes that begin at anchors need to be compared: about one in
   eighteen. Successive windows of one anchor form one stretch of text.
2. *Filter.* Blocks of documents send the 40-bit hashes of their anchors; anchors that occur once in the whole corpus
   drop out, because no window of theirs can repeat.
3. *Suffixes.* What stays is dealt by range: sampled splitters cut the suffixes by the whole bytes of their anchors, so
   equal anchors always meet in one bucket. A block sends each different stretch once, with the least and greatest id that
   hold it; a passage in a third of all documents is then one entry for each block, not one for each document.
4. *Sort.* A bucket sorts its suffixes by multikey quicksort (word after word, only among those still tied). Splitters
   cut between different anchors only, and a run of equal anchors reaches across no boundary. Where different stretches
   share an anchor, their windows are compared by the same sort; each window learns the least id.
5. *Hot anchors.* A short phrase between ever different surroundings gives a different stretch at each place. Anchors with
   more than ``hot`` stretches (each block counts its different ones) are parted by the content of their windows: a block
   sends two 64-bit hashes of each different window once, dealt by hash, so a window has at most one entry of each block.
6. *Cut.* The answers go back to the blocks, which mark and cut the repeated bytes.

Blocks hold about ``block_bytes`` of whole documents, dealt by id and text, so that a hot or null id fills no block by
itself; long documents are worked through in pieces. Nothing is capped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import freeing_group, mix, quoted, row_chunks, span_hashes, text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 16
PIECE = 1 << 20
NO_ID = np.iinfo(np.int64).max
HOT_STRETCHES = 1 << 16
_POSITION = np.uint64((1 << 24) - 1)
_OTHER = mix(np.arange(1, 257, dtype=np.uint64))


# ---------------------------------------------------------------- packing of arrays into binary columns

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; integers are stored by byte planes, which compress well."""
    parts = [np.uint32(len(arrays)).tobytes()]
    for a in arrays:
        kind = a.dtype.str.encode().ljust(8)
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T) if len(a) else a
        parts += [kind, np.uint64(len(a)).tobytes(), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 4, []
    for _ in range(int(np.frombuffer(raw, np.uint32, 1)[0])):
        kind, n = np.dtype(raw[at:at + 8].decode().strip()), int(np.frombuffer(raw, np.uint64, 1, at + 8)[0])
        size = n * kind.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at + 16)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).reshape(n) if n else np.zeros(0, kind))
        at += 16 + size
    return out


# ---------------------------------------------------------------- anchors

def _gram_hashes(body: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each place, by doubling."""
    h = (body.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    length = 1
    while length < GRAM:
        h = h[:-length] * np.uint64(pow(0x2545F4914F6CDD1D, length, 1 << 64)) + h[length:]
        length *= 2
    return mix(h)


def _window_minimum(h: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while length * 2 <= width:
        h = np.minimum(h[:-length], h[length:])
        length *= 2
    return np.minimum(h[:len(h) - (width - length)], h[width - length:]) if length < width else h


def stretches(body: np.ndarray, starts: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of successive windows with one anchor: first window, number of windows, place and 40-bit hash of the anchor."""
    width = min_bytes - GRAM + 1
    out: list[list[np.ndarray]] = [[], [], [], []]
    n = len(body)
    for base in range(0, max(0, n - min_bytes + 1), PIECE):
        part = body[base:min(n, base + PIECE + min_bytes - 1)]
        h = _gram_hashes(part)
        # The hash above, the place below: the least is the leftmost of equal hashes.
        h = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
        least = _window_minimum(h, width)[:PIECE]
        bad = np.zeros(len(least) + 1, dtype=np.int32)  # windows that would cross the end of a document
        inner = starts[1:-1][(starts[1:-1] > base) & (starts[1:-1] < base + len(least) + min_bytes)] - base
        np.add.at(bad, np.clip(inner - min_bytes + 1, 0, len(least)), 1)
        np.add.at(bad, np.clip(inner, 0, len(least)), -1)
        good = np.cumsum(bad[:-1]) == 0
        begins = good.copy()
        begins[1:] &= (least[1:] != least[:-1]) | ~good[:-1]
        ends = good.copy()
        ends[:-1] &= (least[1:] != least[:-1]) | ~good[1:]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends)
        out[0].append(first + base)
        out[1].append(last - first + 1)
        out[2].append((least[first] & _POSITION).astype(np.int64) + base)
        out[3].append(least[first] >> np.uint64(24))
    if not out[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in out)  # type: ignore[return-value]


class Block:
    """The documents of a block in order of id, so that every pass sees the same bytes at the same places."""

    def __init__(self, rows: pa.Table, min_bytes: int):
        ids = rows.column("id").combine_chunks()
        body, starts = text_bytes(rows.column("text"))
        plain = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.diff(starts)
        # Equal ids are ordered by content; the order of shuffled rows must not matter.
        tie = span_hashes(body, starts[:-1], starts[1:]) if len(np.unique(plain)) < len(plain) else np.zeros(len(plain), np.uint64)
        self.order = np.lexsort((size, tie, plain))
        self.ids, size = plain[self.order], size[self.order]
        self.starts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        self.body = body[np.repeat(starts[:-1][self.order] - self.starts[:-1], size) + np.arange(self.starts[-1])]
        self.first, self.count, self.anchor, self.hash = stretches(self.body, self.starts, min_bytes)
        self.doc = self.ids[np.searchsorted(self.starts, self.first, side="right") - 1] if len(self.first) else np.zeros(0, np.int64)

    def contents(self, of: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
        """For stretches ``of``: number of the content, and for each content its first stretch."""
        first = self.first[of]
        key = np.zeros(len(of), np.uint64)
        # The closing entry makes the last stretch a row of its own.
        ends = first[-1:] + self.count[of[-1:]] + min_bytes - 1
        for a, b in row_chunks(np.append(first, ends), PIECE) if len(of) else ():
            lo = first[a]
            hi = first[b - 1] + self.count[of[b - 1]] + min_bytes
            key[a:b] = span_hashes(self.body[lo:hi], first[a:b] - lo, first[a:b] - lo + self.count[of[a:b]] + min_bytes - 1)
        # The anchor's place inside belongs to the content.
        key = mix(key + (self.anchor[of] - first).astype(np.uint64))
        _, example, number = np.unique(key, return_index=True, return_inverse=True)
        return number, of[example]

    def windows(self, of: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All windows of the stretches ``of``: two hashes, place and document of each."""
        count = self.count[of]
        total = np.concatenate([[0], np.cumsum(count)])
        place = np.repeat(self.first[of] - total[:-1], count) + np.arange(total[-1])
        one, two = np.zeros(len(place), np.uint64), np.zeros(len(place), np.uint64)
        for a, b in row_chunks(np.append(place, place[-1:] + 1), PIECE) if len(place) else ():
            lo = place[a]
            body, begin = self.body[lo:place[b - 1] + min_bytes], place[a:b] - lo
            one[a:b] = span_hashes(body, begin, begin + min_bytes)
            two[a:b] = span_hashes(_OTHER[body], begin, begin + min_bytes)
        return one, two, place, np.repeat(self.doc[of], count)


# ---------------------------------------------------------------- pass 1: anchors that occur twice, and hot ones

def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal values of a sorted array."""
    edge = np.flatnonzero(np.diff(bucket)) + 1
    at = [0, *edge.tolist(), len(bucket)]
    for a, b in zip(at[:-1], at[1:]):
        if b > a:
            yield int(bucket[a]), a, b


def _hash_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(8)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _send_hashes(min_bytes: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("blob", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        block = Block(rows, min_bytes)
        hashes, count = np.unique(block.hash, return_counts=True)
        _, example = block.contents(np.arange(len(block.hash)), min_bytes)
        kinds = np.bincount(np.searchsorted(hashes, block.hash[example]), minlength=len(hashes)).astype(np.uint32)
        out: list[list] = [[], [], []]
        for bucket, a, b in _dealt(_hash_bucket(hashes, buckets)):
            out[0].append(bucket)
            out[1].append(key[0].as_py())
            out[2].append(pack(np.diff(hashes[a:b], prepend=np.uint64(0)), np.packbits(count[a:b] > 1), kinds[a:b]))
        return pa.table(out, schema=schema)

    return run


def _repeated(hot: int):
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        """For each block: which of the hashes that it sent occur more than once, and which have over ``hot`` stretches."""
        sent, many, kinds = [], [], []
        for blob in rows.column("blob").to_pylist():
            steps, bits, n = unpack(blob)
            sent.append(np.cumsum(steps, dtype=np.uint64))
            many.append(np.unpackbits(bits, count=len(steps)).astype(bool))
            kinds.append(n)
        whole = np.concatenate(sent)
        order = np.argsort(whole, kind="stable")
        ranked, n = whole[order], np.concatenate(kinds)[order].astype(np.int64)
        twice = np.unique(np.concatenate([ranked[1:][ranked[1:] == ranked[:-1]], *(s[m] for s, m in zip(sent, many))]))
        first = np.flatnonzero(np.diff(ranked, prepend=ranked[:1] + np.uint64(1)))
        heated = ranked[first][np.add.reduceat(n, first) > hot] if len(first) else ranked
        answers = [pack(*(np.packbits(np.isin(s, x, assume_unique=True, kind="sort")) for x in (twice, heated))) for s in sent]
        return pa.table([rows.column("block").cast(pa.int32()), rows.column("bucket").cast(pa.int32()), pa.array(answers, pa.binary())], schema=schema)

    return run


# ---------------------------------------------------------------- pass 2: sorted suffixes

def _leading(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number that sorts like the bytes; past the end: zeros."""
    out = np.zeros(len(at), np.uint64)
    n = len(body)
    for k in range(8):
        place = at + k
        inside = place < n
        byte = np.where(inside, body[np.minimum(place, max(0, n - 1))], 0) if n else np.zeros(len(at), np.uint8)
        out = (out << np.uint64(8)) | byte.astype(np.uint64)
    return out


def _gram_bytes(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The anchors' bytes as strings that sort like them."""
    words = np.stack([_leading(body, at + 8 * k) for k in range(GRAM // 8)], axis=1)
    return np.ascontiguousarray(words.astype(">u8")).view(f"S{GRAM}").reshape(len(at))


def _send_suffixes(min_bytes: int, buckets: int, splitters: np.ndarray):
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("blob", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if rows.num_rows and answers.num_rows:
            block = Block(rows, min_bytes)
            hashes = np.unique(block.hash)
            bucket = _hash_bucket(hashes, buckets)
            twice, hot = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
            for b, blob in zip(answers.column("bucket").to_pylist(), answers.column("blob").to_pylist()):
                a, z = np.searchsorted(bucket, [b, b + 1])
                twice[a:z], hot[a:z] = (np.unpackbits(bits, count=z - a) for bits in unpack(blob))
            mine = np.searchsorted(hashes, block.hash)
            of = np.flatnonzero((twice & ~hot)[mine])
            number, example = block.contents(of, min_bytes)
            least = np.full(len(example), NO_ID)
            most = np.full(len(example), np.iinfo(np.int64).min)
            np.minimum.at(least, number, block.doc[of])
            np.maximum.at(most, number, block.doc[of])
            to = np.searchsorted(splitters, _gram_bytes(block.body, block.anchor[example]), side="right")
            order = np.argsort(to, kind="stable")
            for b, x, y in _dealt(to[order]):
                e, i = example[order[x:y]], order[x:y]
                size = block.count[e] + min_bytes - 1
                place = np.concatenate([[0], np.cumsum(size)])
                text = block.body[np.repeat(block.first[e] - place[:-1], size) + np.arange(place[-1])]
                out[0].append(b)
                out[1].append(key[0].as_py())
                out[2].append(pack(
                    text, block.count[e].astype(np.uint8), (block.anchor[e] - block.first[e]).astype(np.uint8),
                    block.first[e], least[i], most[i] - least[i],
                ))
            _send_windows(block, np.flatnonzero(hot[mine]), min_bytes, buckets, key[0].as_py(), out)
        return pa.table(out, schema=schema)

    return run


def _send_windows(block: Block, of: np.ndarray, min_bytes: int, buckets: int, number: int, out: list[list]) -> None:
    """Each different window of hot anchors once, to the buckets behind those of the suffixes."""
    one, two, place, doc = block.windows(of, min_bytes)
    order = np.lexsort((place, two, one))
    one, two, place, doc = one[order], two[order], place[order], doc[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    at = np.flatnonzero(new)
    if len(at):
        least, most = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
        to = ((one[at] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        for b, x, y in _dealt(to):
            out[0].append(buckets + b)
            out[1].append(number)
            out[2].append(pack(one[at[x:y]], two[at[x:y]], place[at[x:y]], least[x:y], most[x:y] - least[x:y]))


def multikey(word, n: int, levels: int) -> np.ndarray:
    """Group numbers of equal strings of ``levels`` words, by multikey quicksort: ``word(level, which)`` gives a word.

    Each level sorts only the strings still tied with another one; groups are numbered in sorted order.
    """
    group = np.zeros(n, dtype=np.int64)  # the place at which a string's group begins
    active = np.arange(n)
    for level in range(levels):
        if not len(active):
            break
        w, g = word(level, active), group[active]
        order = np.lexsort((w, g)) if level else np.argsort(w, kind="stable")
        g, w, which = g[order], w[order], active[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
        at = np.flatnonzero(new)
        # Places inside the group so far: groups keep their range of places.
        first_of_old = np.ones(len(g), bool)
        first_of_old[1:] = g[1:] != g[:-1]
        old_at = np.maximum.accumulate(np.where(first_of_old, np.arange(len(g)), 0))
        new_at = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
        group[which] = g + (new_at - old_at)
        tied = np.repeat(np.diff(np.append(at, len(g))) > 1, np.diff(np.append(at, len(g))))
        active = which[tied]
    return group


def _window_least(text, place, count, anchor, least, gram, min_bytes) -> np.ndarray:
    """The least id of each window of different stretches that share their anchor's bytes with others."""
    total = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(count)), count)
    at = place[owner] + np.arange(total[-1]) - total[owner]
    before = (anchor[owner] - (at - place[owner])).astype(np.uint64)  # bytes of the window before its anchor
    levels = -(-min_bytes // 8)
    last = min_bytes - 8  # the last word overlaps the one before

    def word(level: int, which: np.ndarray) -> np.ndarray:
        if level == 0:
            return (gram[owner[which]].astype(np.uint64) << np.uint64(8)) | before[which]
        return _leading(text, at[which] + min(8 * (level - 1), last))

    group = multikey(word, len(at), levels + 1)
    low = np.full(len(at), NO_ID)
    np.minimum.at(low, group, least[owner])
    return low[group]


def _compare_windows(rows: pa.Table, schema: pa.Schema) -> pa.Table:
    """The least id of each window that a block sent, where it is less than the greatest of the block."""
    sent = [unpack(b) for b in rows.column("blob").to_pylist()]
    one, two, place, least, spread = (np.concatenate([s[i] for s in sent]) for i in range(5))
    source = np.repeat(np.arange(len(sent)), [len(s[0]) for s in sent])
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
    low = np.empty(len(order), np.int64)
    low[order] = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    useful = np.flatnonzero(low < least + spread)
    out: list[list] = [[], [], []]
    for s, a, b in _dealt(source[useful]):
        i = useful[a:b][np.argsort(place[useful[a:b]])]
        out[0].append(rows.column("block")[s].as_py())
        out[1].append(1)
        out[2].append(pack(np.diff(place[i], prepend=0), low[i]))
    return pa.table(out, schema=schema)


def _compare(min_bytes: int, buckets: int):
    schema = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        if key[0].as_py() >= buckets:
            return _compare_windows(rows, schema)
        sent = [unpack(b) for b in rows.column("blob").to_pylist()]
        blocks = rows.column("block").to_pylist()
        text, count, anchor, first, least, spread = (np.concatenate([s[i] for s in sent]) for i in range(6))
        source = np.repeat(np.arange(len(sent)), [len(s[1]) for s in sent])
        count, anchor = count.astype(np.int64), anchor.astype(np.int64)
        size = count + min_bytes - 1
        place = np.concatenate([[0], np.cumsum(size)])[:-1]
        longest = int(size.max())

        def word(level: int, which: np.ndarray) -> np.ndarray:
            # From the anchor to the end, then from the beginning to the anchor, then how they lie.
            here = place[which] + anchor[which] + 8 * level
            left = place[which] + size[which] - here
            w = _leading(text, here)
            cut = np.clip(8 - left, 0, 8).astype(np.uint64)
            full = cut >= 8
            w = np.where(full, np.uint64(0), w >> np.where(full, np.uint64(0), cut * np.uint64(8)) << np.where(full, np.uint64(0), cut * np.uint64(8)))
            return w

        right = -(-longest // 8)
        n = len(count)
        gram = multikey(lambda level, which: _leading(text, place[which] + anchor[which] + 8 * level), n, GRAM // 8)

        def whole(level: int, which: np.ndarray) -> np.ndarray:
            if level == 0:
                return gram[which].astype(np.uint64)
            if level == 1:
                return (size[which] << 8 | anchor[which]).astype(np.uint64)
            if level < 2 + right:
                return word(level - 2, which)
            here = place[which] + 8 * (level - 2 - right)
            return np.where(8 * (level - 2 - right) < anchor[which], _leading(text, here), np.uint64(0))

        same = multikey(whole, n, 2 + right + -(-(min_bytes - GRAM) // 8))
        low = np.full(n, NO_ID)
        np.minimum.at(low, same, least)
        # One entry for each different stretch; those alone with their anchor's bytes need no comparison of windows.
        example = np.full(n, -1, dtype=np.int64)
        example[same] = np.arange(n)
        which = example[example >= 0]
        kinds = np.bincount(gram[which], minlength=n)
        several = kinds[gram] > 1
        value, run_length, run_owner = [], [], []
        alone = np.flatnonzero(~several)
        value.append(low[same[alone]])
        run_length.append(count[alone])
        run_owner.append(alone)
        mixed = which[several[which]]
        if len(mixed):
            wanted = np.zeros(n, np.int64)
            wanted[mixed] = np.arange(len(mixed))
            answer = _window_least(text, place[mixed], count[mixed], anchor[mixed], low[same[mixed]], gram[mixed], min_bytes)
            total = np.concatenate([[0], np.cumsum(count[mixed])])
            owner = np.repeat(np.arange(len(mixed)), count[mixed])
            new = np.ones(len(answer), bool)
            new[1:] = (answer[1:] != answer[:-1]) | (owner[1:] != owner[:-1])
            at = np.flatnonzero(new)
            length = np.diff(np.append(at, total[-1]))
            runs_at = np.searchsorted(at, total)  # runs of each different stretch
            mine = np.flatnonzero(several)
            kind = wanted[example[same[mine]]]
            runs = (runs_at[1:] - runs_at[:-1])[kind]
            flat = np.repeat(runs_at[kind] - np.concatenate([[0], np.cumsum(runs)])[:-1], runs) + np.arange(runs.sum())
            value.append(answer[at][flat])
            run_length.append(length[flat])
            run_owner.append(np.repeat(mine, runs))
        value, run_length, run_owner = np.concatenate(value), np.concatenate(run_length), np.concatenate(run_owner)
        most = least + spread
        useful = np.zeros(n, bool)
        useful[run_owner[value < most[run_owner]]] = True
        keep = useful[run_owner]
        value, run_length, run_owner = value[keep], run_length[keep], run_owner[keep]
        order = np.lexsort((np.arange(len(value)), first[run_owner], source[run_owner])) if len(value) else np.zeros(0, np.int64)
        out: list[list] = [[], [], []]
        for s, a, b in _dealt(source[run_owner[order]]):
            i = order[a:b]
            begin = first[run_owner[i]]
            out[0].append(blocks[s])
            out[1].append(0)
            out[2].append(pack(np.diff(begin, prepend=0), run_length[i].astype(np.uint8), value[i]))
        return pa.table(out, schema=schema)

    return run


# ---------------------------------------------------------------- pass 3: cut

def _mark_windows(block: Block, sent: list[list[np.ndarray]], min_bytes: int, hit: np.ndarray) -> None:
    """Mark the windows of hot anchors that a document with a smaller id holds."""
    place = np.concatenate([np.cumsum(s[0]) for s in sent])
    value = np.concatenate([s[1] for s in sent])
    # The stretch of an answered window names its anchor; all windows of that anchor may be equal to it.
    anchors = np.unique(block.hash[np.searchsorted(block.first, place, side="right") - 1])
    one, two, at, doc = block.windows(np.flatnonzero(np.isin(block.hash, anchors)), min_bytes)
    order = np.lexsort((at, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    low = np.full(int(new.sum()), NO_ID)
    low[number[np.searchsorted(at, place)]] = value
    repeated = at[low[number] < doc]
    np.add.at(hit, repeated, 1)
    np.add.at(hit, repeated + min_bytes, -1)


def _cut(min_bytes: int, passed: list[str]):
    names = ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept", *passed]

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows, min_bytes)
        body, starts = block.body, block.starts
        hit = np.zeros(len(body) + 1, np.int32)
        windows = np.array(answers.column("bucket").to_pylist(), dtype=bool)
        if windows.any():
            _mark_windows(block, [unpack(b) for b in answers.column("blob").filter(pa.array(windows)).to_pylist()], min_bytes, hit)
        if not windows.all():
            sent = [unpack(b) for b in answers.column("blob").filter(pa.array(~windows)).to_pylist()]
            begin = np.concatenate([np.cumsum(s[0]) for s in sent])
            length = np.concatenate([s[1] for s in sent]).astype(np.int64)
            value = np.concatenate([s[2] for s in sent])
            order = np.argsort(begin, kind="stable")
            begin, length, value = begin[order], length[order], value[order]
            number, example = block.contents(np.arange(len(block.first)), min_bytes)
            # The block sent the first stretch of each content; which of the answers belong to each stretch?
            lead = block.first[example][number]
            a, b = np.searchsorted(begin, lead, side="left"), np.searchsorted(begin, lead, side="right")
            mine = np.flatnonzero(b > a)
            runs = (b - a)[mine]
            flat = np.repeat(a[mine] - np.concatenate([[0], np.cumsum(runs)])[:-1], runs) + np.arange(runs.sum())
            owner = np.repeat(mine, runs)
            long_ = length[flat]
            done = np.concatenate([[0], np.cumsum(long_)])
            base = np.repeat(done[:-1][np.concatenate([[0], np.cumsum(runs)])[:-1]] if len(runs) else np.zeros(0, np.int64), runs)
            window = block.first[owner] + done[:-1] - base
            repeated = value[flat] < block.doc[owner]
            # From the first repeated window of a run to the last byte of its last one.
            np.add.at(hit, window[repeated], 1)
            np.add.at(hit, window[repeated] + long_[repeated] - 1 + min_bytes, -1)
        gone = np.cumsum(hit[:-1]) > 0
        edge = np.zeros(len(body) + 1, np.int8)
        edge[:-1] = gone
        new = gone.copy()
        if len(gone):
            new[1:] &= ~gone[:-1]
            begins = starts[:-1][starts[:-1] < len(body)]
            new[begins] = gone[begins]
        total = np.concatenate([[0], np.cumsum(gone)]).astype(np.int64)
        spans_to = np.concatenate([[0], np.cumsum(new)]).astype(np.int64)
        removed = total[starts[1:]] - total[starts[:-1]]
        n_spans = spans_to[starts[1:]] - spans_to[starts[:-1]]
        last = gone.copy()
        if len(gone):
            last[:-1] &= ~gone[1:]
            ends = starts[1:][(starts[1:] > 0)] - 1
            last[ends] = gone[ends]
        span_from, span_to = np.flatnonzero(new), np.flatnonzero(last) + 1
        doc = np.searchsorted(starts, span_from, side="right") - 1
        pairs = np.stack([span_from - starts[doc], span_to - starts[doc]], axis=1).reshape(-1) if len(doc) else np.zeros(0, np.int64)
        kept_starts = starts - total[starts]
        kept = body[~gone].tobytes()
        ids = pa.array(block.ids, mask=block.ids == NO_ID)
        return pa.table([
            ids, pa.array(np.diff(starts)), pa.array(removed), pa.array(n_spans),
            pa.ListArray.from_arrays(pa.array(spans_to[starts] * 2, pa.int32()), pa.array(pairs)),
            pa.array([kept[x:y] for x, y in zip(kept_starts[:-1].tolist(), kept_starts[1:].tolist())], pa.binary()),
            *(rows.column(c).take(pa.array(block.order)) for c in passed),
        ], names=names)

    return run


def _sample_splitters(docs: DataFrame, total: int, buckets: int, min_bytes: int, sample_bytes: int) -> np.ndarray:
    """Splitters of the anchors' bytes, from about ``sample_bytes`` of documents chosen by hash.

    The sample only balances the buckets; results do not depend on it.
    """
    if buckets < 2:
        return np.zeros(0, f"S{GRAM}")
    share = max(1, total // sample_bytes)

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, starts = text_bytes(batch.column(0))
            _, _, anchor, _ = stretches(body, starts, min_bytes)
            seen = np.sort(_gram_bytes(body, anchor))
            # At most 512 quantiles of each batch go to the driver.
            at = np.unique(np.linspace(0, len(seen) - 1, min(512, len(seen))).astype(np.int64)) if len(seen) else []
            yield pa.RecordBatch.from_arrays([pa.array(seen[at].tolist() if len(seen) else [], pa.binary())], ["word"])

    some = docs.where(F.pmod(F.xxhash64("id", F.lit("splitters")), F.lit(share)) == 0).select("text")
    found = np.sort(np.array([bytes(r[0]) for r in some.mapInArrow(leading, "word binary").collect()], dtype=f"S{GRAM}"))
    if not len(found):
        return found
    return np.unique(found[np.rint(np.arange(1, buckets) / buckets * (len(found) - 1)).astype(np.int64)])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 50, block_bytes: int = 4 << 20,
    sample_bytes: int = 4 << 20, extra: list[str] | None = None, hot: int = HOT_STRETCHES,
) -> DataFrame:
    """Cut each byte covered by a ``min_bytes`` string that also starts in a document with a smaller id.

    Returns (id, n_bytes, n_removed, n_spans, spans [begin, end, begin, end, ...] in bytes of the input, kept binary), then
    the columns ``extra`` of ``docs`` as extra_0, extra_1 and so on.
    Texts are UTF-8 bytes; null is the empty text. A null id counts as greater than any other. Rows of equal id do not
    remove each other's bytes. Texts shorter than ``min_bytes`` keep all. An empty table gives an empty result. Only the
    columns named are read; others, whatever their names, play no part.
    """
    if min_bytes < 2 * GRAM or min_bytes > 120:
        raise ValueError(f"min_bytes must be from {2 * GRAM} to 120")
    passed = {f"extra_{i}": quoted(c) for i, c in enumerate(extra or [])}
    rows = docs.select(
        quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"), *[c.alias(n) for n, c in passed.items()]
    )
    total = int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    blocks = max(1, total // block_bytes)
    splitters = _sample_splitters(rows, total, blocks, min_bytes, sample_bytes)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
    by_block = dealt.groupBy("block")
    hashes = by_block.applyInArrow(freeing_group(_send_hashes(min_bytes, blocks)), "bucket int, block int, blob binary")
    twice = hashes.groupBy("bucket").applyInArrow(_repeated(hot), "block int, bucket int, blob binary")
    suffixes = by_block.cogroup(twice.groupBy("block")).applyInArrow(
        freeing_group(_send_suffixes(min_bytes, blocks, splitters)), "bucket int, block int, blob binary"
    )
    answers = suffixes.groupBy("bucket").applyInArrow(freeing_group(_compare(min_bytes, blocks)), "block int, bucket int, blob binary")
    fields = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        freeing_group(_cut(min_bytes, list(passed))),
        "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<bigint>, kept binary" + fields,
    )


def as_valid_text(kept: Column) -> Column:
    """Bytes left as text: of a character that was cut through, the bytes left are dropped.

    Incomplete characters are found by their bytes in the hexadecimal form of Latin-1 decoding, one letter for each byte, so
    that a character U+FFFD of the text itself stays.
    """
    letters = F.decode(kept, "ISO-8859-1")
    whole = (
        "([\\x00-\\x7F]|[\\xC2-\\xDF][\\x80-\\xBF]|\\xE0[\\xA0-\\xBF][\\x80-\\xBF]|[\\xE1-\\xEC\\xEE\\xEF][\\x80-\\xBF]{2}"
        "|\\xED[\\x80-\\x9F][\\x80-\\xBF]|\\xF0[\\x90-\\xBF][\\x80-\\xBF]{2}|[\\xF1-\\xF3][\\x80-\\xBF]{3}|\\xF4[\\x80-\\x8F][\\x80-\\xBF]{2})"
    )
    repaired = F.encode(F.regexp_replace(letters, whole + "|[\\x80-\\xFF]", "$1"), "ISO-8859-1")
    return F.when(F.is_valid_utf8(kept.cast("string")), kept.cast("string")).otherwise(F.decode(repaired, "UTF-8"))

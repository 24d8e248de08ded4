"""Packing of documents into sequences of a fixed number of tokens by bound-certified best-fit decreasing.

Pieces of documents are dealt over partitions, and each partition packs its own by best-fit decreasing. Dual-feasible
functions give a lower bound of the sequences that any packing needs. A partition whose count meets its bound is
certified; while the corpus as a whole stays above the bound of all its pieces, partitions with gaps put the pieces of
their sequences that are not full together, deal them anew over fewer partitions and pack again. Full sequences stay.

Only lengths and identifiers move. The bound of all pieces comes from a histogram of at most ``capacity`` rows.
"""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.bpe_parts import part_table
from rowloom.llm.common import freeing, quoted
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASK_PIECES = 100_000
MOST_ROUNDS = 6
MOST_GROWTH = 16


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs, as the best of several dual-feasible functions.

    The volume; stretched volumes u_k (sizes rounded to k parts, multiples of 1/(k+1) kept); and for each threshold the
    function that lifts sizes above ``capacity - t`` to whole sequences and drops those below ``t``.
    """
    if not len(sizes):
        return 0
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    best = -(-int((sizes * counts).sum()) // capacity)
    for k in range(1, 41):
        scaled = sizes * (k + 1)
        # In units of 1 / (k * capacity), so that all stays whole.
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    for t in sizes[sizes <= capacity // 2].tolist():
        value = np.where(sizes > capacity - t, capacity, np.where(sizes >= t, sizes, 0))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    large = sizes * 2 > capacity
    best = max(best, int(counts[large].sum()))
    # Pieces over half a sequence never share one; what fits beside them none of them can exceed.
    for t in sizes[sizes * 2 <= capacity].tolist():
        small = (sizes >= t) & ~large
        room = large & (sizes <= capacity - t)
        free = int(((capacity - sizes) * counts)[room].sum())
        over = int((sizes * counts)[small].sum()) - free
        best = max(best, int(counts[large].sum()) + max(0, -(-over // capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length. Equal lengths are placed together: each takes the fullest sequence
    that has room, which keeps being the fullest until no further one fits."""
    order = np.argsort(-lengths, kind="stable")
    sizes, at = np.unique(-lengths[order], return_index=True)
    at = np.append(at, len(order))
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: dict[int, list[np.ndarray]] = {}  # room left -> sequences
    rooms: list[int] = []
    made = 0

    def put(room: int, which: np.ndarray) -> None:
        if room and len(which):
            if room not in free:
                insort(rooms, room)
                free[room] = []
            free[room].append(which)

    for s, begin, end in zip((-sizes).tolist(), at[:-1].tolist(), at[1:].tolist()):
        while begin < end:
            i = bisect_left(rooms, s)
            if i < len(rooms):
                room = rooms.pop(i)
                which = np.concatenate(free.pop(room))
            else:
                room = capacity
                which = np.arange(made, made - (-(end - begin) // (capacity // s)))
                made += len(which)
            each = room // s
            whole = min(len(which), (end - begin) // each)
            rest = min(end - begin - whole * each, each) if whole < len(which) else 0
            if whole:
                here = order[begin:begin + whole * each]
                sequence[here] = np.repeat(which[:whole], each)
                offset[here] = np.tile(capacity - room + s * np.arange(each), whole)
                begin += whole * each
            if rest:
                here = order[begin:begin + rest]
                sequence[here] = which[whole]
                offset[here] = capacity - room + s * np.arange(rest)
                begin += rest
            put(room - each * s, which[:whole])
            if rest:
                put(room - rest * s, which[whole:whole + 1])
            if room < capacity:
                put(room, which[whole + (rest > 0):])
    return sequence, offset


def _pack_partition(capacity: int, turn: int, names: list[str]):
    def run(rows: pa.Table) -> pa.Table:
        # In an order that no shuffle changes.
        columns = [rows.column(c).to_numpy() for c in ("_length", "_id")]
        order = np.lexsort((columns[1], -columns[0]))
        rows = rows.take(pa.array(order))
        lengths = columns[0][order].astype(np.int64)
        sequence, offset = best_fit_decreasing(lengths, capacity)
        made = int(sequence.max()) + 1
        room = capacity - np.bincount(sequence, weights=lengths, minlength=made).astype(np.int64)
        sizes, counts = np.unique(lengths, return_counts=True)
        certified = made == lower_bound(sizes, counts, capacity)
        part = rows.column("_part")[0].as_py()
        number = (np.int64(turn) << np.int64(56)) + (np.int64(part) << np.int64(24)) + sequence
        out = [rows.column(c) for c in names]
        # A certified partition may still hold one sequence that its rounding up leaves open.
        settled = (room[sequence] == 0) | (certified & (room[sequence] * 64 < capacity))
        return pa.table([*out, pa.array(number), pa.array(offset), pa.array(settled)], names=[*names, "sequence_id", "offset", "_settled"])

    return run


def pack(pieces: DataFrame, length_col: str, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with lengths from 1 to ``capacity``; columns of these names are replaced.

    Offsets of a sequence are gapless from 0. Null or other lengths raise. An empty table gives an empty result.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_id", "_length", "_part", "_settled")]
    names = [*kept, "_id", "_length"]
    rows = durable(
        pieces.select(*[quoted(c) for c in kept], F.monotonically_increasing_id().alias("_id"), quoted(length_col).cast("long").alias("_length"))
    )
    histogram = rows.groupBy("_length").count().orderBy("_length").limit(capacity + 2).collect()
    if any(r[0] is None or not 0 < r[0] <= capacity for r in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    bound = lower_bound(np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram]), capacity)
    pool, done, settled_sequences, before = rows, None, 0, None
    n = sum(r[1] for r in histogram)
    schema = rows.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    for turn in range(MOST_ROUNDS):
        # What is left is little, and mixes the better the fewer partitions it is dealt over.
        parts = max(1, -(-n // (TASK_PIECES * min(4**turn, MOST_GROWTH))))
        dealt = pool.select(*[quoted(c) for c in names], F.pmod(F.xxhash64("_id", F.lit(turn)), F.lit(parts)).alias("_part"))
        packed = durable(
            dealt.groupBy("_part").applyInArrow(
                _pack_partition(capacity, turn, names), f"{fields}, sequence_id bigint, offset bigint, _settled boolean"
            )
        )
        counts = {
            r["_settled"]: (r["s"], r["n"])
            for r in packed.where("offset = 0").groupBy("_settled").agg(F.count(F.lit(1)).alias("s"), F.lit(0).alias("n")).collect()
        }
        open_sequences = counts.get(False, (0, 0))[0]
        all_sequences = settled_sequences + sum(c[0] for c in counts.values())
        if before is not None and all_sequences >= before[0]:
            packed, done = before[1], before[2]  # dealing anew did not help: the packing before stays
            break
        if all_sequences <= bound or open_sequences < 2 or turn == MOST_ROUNDS - 1:
            break
        before = (all_sequences, packed, done)
        settled_sequences += counts.get(True, (0, 0))[0]
        here = packed.where("_settled")
        done = here if done is None else done.unionByName(here)
        pool = packed.where(~F.col("_settled")).drop("sequence_id", "offset", "_settled")
        n = pool.count()
    result = packed if done is None else done.unionByName(packed)
    return result.select(*[quoted(c) for c in kept], "sequence_id", "offset")


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Token identifiers of each whole text, then ``end_id``, in pieces of at most ``capacity``.

    Returns (id, piece, start, length, ids_crc32), and the identifiers themselves as ``ids`` if asked for. Texts that are
    longer are cut so that all pieces but the first are full. Null and empty texts are one piece that holds ``end_id``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = part_table(path)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            keys = batch.column(0).to_pylist()
            for first, ids, at in words.encode(batch.column(1)):
                raw = memoryview(ids).cast("B")
                for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist()), first):
                    # The end follows the row's own identifiers: its place in ``ids`` is kept free for it.
                    ids[b - 1] = end_id
                    n = b - a
                    pieces = -(-n // capacity)
                    start, stop = 0, n - capacity * (pieces - 1)
                    for piece in range(pieces):
                        here = raw[4 * (a + start):4 * (a + stop)]
                        for column, value in zip(out, (keys[row], piece, start, stop - start, zlib.crc32(here), bytes(here) if with_ids else None)):
                            column.append(value)
                        start, stop = stop, stop + capacity
            arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:5])]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                flat = np.frombuffer(b"".join(out[5]), dtype="<u4").astype(np.int32)
                at = np.concatenate([[0], np.cumsum(out[3])]).astype(np.int32) if out[3] else np.zeros(1, np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(at), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    schema = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(freeing(run), schema)


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents (see ``token_pieces``) with their place in a sequence (see ``pack``).

    Repeated rows are packed as often as they occur; null ids stay null; an empty table gives an empty result; columns
    other than the two named play no part.
    """
    return pack(token_pieces(docs, path, capacity, end_id, id_col, text_col, with_ids), "length", capacity)

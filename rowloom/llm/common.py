"""Helpers shared by the operators of this subpackage: reading, chunking, hashing of words, components."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.session import durable

# The functions below travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 2 << 20
LEAST_PARTS, PART_ROWS = 8, 20_000
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x2545F4914F6CDD1D
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(taken: list[str], label: str) -> str:
    """A column name that no column of ``taken`` has, in any case of letters."""
    used = {t.lower() for t in taken}
    while label.lower() in used:
        label = "_" + label
    return label


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, for tables and caches loaded once."""
    module = sys.modules.setdefault("_rowloom_worker", types.ModuleType("_rowloom_worker"))
    return module.__dict__.setdefault("store", {})


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its tasks, and what it keeps counts for its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library, which holds what numpy frees
    if trim is not None:
        trim(0)


def freeing(task: Callable) -> Callable:
    """``task`` over Arrow batches, which gives back what it freed when they are done."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def freeing_group(task: Callable) -> Callable:
    """``task`` over an Arrow group, its key and group, or its key and two groups, which gives back what it freed after each."""
    def done(*given: object) -> pa.Table:
        out = task(*given)
        give_back()
        return out

    def alone(rows: pa.Table) -> pa.Table:
        return done(rows)

    def keyed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return done(key, rows)

    def paired(key: tuple[pa.Scalar, ...], rows: pa.Table, others: pa.Table) -> pa.Table:
        return done(key, rows, others)

    return {1: alone, 2: keyed, 3: paired}[task.__code__.co_argcount]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x *= _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte buffer, and where each begins (one more entry than rows); null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string() if not pa.types.is_large_binary(column.type) else column.type)
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    starts = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + n + 1)[column.offset:] if n else np.zeros(1, np.int64)
    data = column.buffers()[2] if n else None
    body = np.frombuffer(data, dtype=np.uint8)[starts[0]:starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, starts - starts[0]


def row_chunks(starts: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes, or of one row if that is longer."""
    n, i = len(starts) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _next_cut(body: np.ndarray, begin: int, end: int, separates: np.ndarray, blank: np.ndarray, ahead: int) -> tuple[int, int]:
    """Where a part of a long text that begins at ``begin`` ends, and how far it must be read.

    It ends behind a separator where one is near; else behind a blank, and is read ``ahead`` words further. A word is
    never cut.
    """
    stop = min(end, begin + CHUNK_BYTES)
    if stop == end:
        return end, end
    cut = np.flatnonzero(separates[body[begin:stop]])
    if len(cut):
        return begin + int(cut[-1]) + 1, begin + int(cut[-1]) + 1
    within = ~(separates | blank)
    cut = np.flatnonzero(blank[body[begin:stop]])
    if len(cut):
        stop = begin + int(cut[-1]) + 1
    else:
        while stop < end and within[body[stop]]:
            some = np.flatnonzero(~within[body[stop:min(end, stop + CHUNK_BYTES)]])
            stop = stop + int(some[0]) if len(some) else min(end, stop + CHUNK_BYTES)
    reach = 1 << 12
    while ahead and stop < end:
        look = min(end, stop + reach)
        inside = within[body[stop:look]]
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        if len(ends) >= ahead:
            return stop, stop + int(ends[ahead - 1]) + 1
        if look == end:
            return stop, end
        reach *= 4
    return stop, stop


def text_parts(
    body: np.ndarray, starts: np.ndarray, separates: np.ndarray, blank: np.ndarray, ahead: int = 0
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, bool, bool]]:
    """Ranges of rows of bounded size: (first row, bytes, starts, bytes of which words are its own, whether its rows begin
    in it, whether they end in it). Long rows are parted between words, each part with ``ahead`` words of the next."""
    for i, j in row_chunks(starts, CHUNK_BYTES):
        a, b = int(starts[i]), int(starts[j])
        if j - i > 1 or b - a <= 2 * CHUNK_BYTES:
            yield i, body[a:b], starts[i:j + 1] - a, b - a, True, True
            continue
        begin = a
        while a < b:
            stop, look = _next_cut(body, a, b, separates, blank, ahead)
            yield i, body[a:look], np.array([0, look - a]), stop - a, a == begin, stop == b
            a = stop


def span_strings(body: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as an Arrow column of strings, without a loop over them."""
    at = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    data = body[np.repeat(begin - at[:-1], end - begin) + np.arange(at[-1])]
    return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(data)).cast(pa.string())


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.ones(max(1, n), dtype=np.uint64)
        filled, step = 1, base
        while filled < n:
            more = min(filled, n - filled)
            p[filled:filled + more] = p[:more] * np.uint64(step)
            step = step * step & _MASK
            filled += more
        out.append(p)
    return out[0], out[1]


def span_hashes(body: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal content wherever it stands."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    p, inverse = _powers(len(body) + 1)
    total = np.zeros(len(body) + 1, dtype=np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * p[:-1], out=total[1:])
    return mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def runs(body: np.ndarray, starts: np.ndarray, inside_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each run of the bytes that ``inside_of`` marks, texts being apart, and where each text's runs
    begin in these arrays (one more entry than texts)."""
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    inside = inside_of[body]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = starts[(starts > 0) & (starts < len(body))]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, starts).astype(np.int64)


def words(body: np.ndarray, starts: np.ndarray, inside_of: np.ndarray = ~_IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text (runs without ASCII white space unless told otherwise, ASCII letters lowered),
    and where each text's words begin in that array (one more entry than texts)."""
    begin, end, at = runs(body, starts, inside_of)
    return span_hashes(_LOWER[body], begin, end), at


def shingles(hashes: np.ndarray, starts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each ``size`` successive words of each text; a shorter text with any word gives one shingle of all."""
    n = np.diff(starts)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    out_starts = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    if not out_starts[-1]:
        return np.zeros(0, np.uint64), out_starts
    at = np.repeat(starts[:-1] - out_starts[:-1], count) + np.arange(out_starts[-1])
    stop = np.repeat(starts[1:], count)
    total = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for k in range(size):
        word = np.where(at + k < stop, padded[at + k], np.uint64(0))
        total = (total ^ word) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        total ^= total >> np.uint64(32)
    return mix(total), out_starts


def in_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of about ``rows`` small rows in no more partitions than these fill, for a checkpoint: each partition is a file, and on
    a local file system each file starts processes beside its executor."""
    return df.coalesce(max(LEAST_PARTS, -(-rows // PART_ROWS)))


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, nodes: int | None = None) -> DataFrame:
    """Connected components of links between long ids: one row (node, component) with the least id as component.

    Rounds of large-star and small-star, each a grouped job over the links; a node with very many links is only
    an aggregate's key. Every round is written to the shared folder, so that a lost executor costs one round at most.
    ``nodes``, if known, is about how many different ids there are.
    """
    def both(df: DataFrame) -> DataFrame:
        return df.select(F.col("u"), F.col("v")).unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v")))

    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = durable(links if nodes is None else in_parts(links, nodes))
    rows = links.count()
    for _ in range(most_rounds):
        # large star: neighbours above a node go to the least of its neighbourhood
        near = both(links)
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: neighbours below a node, and itself, go to the least of them
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(floor.select("u", F.col("m").alias("v")))
        after = durable(in_parts(small.where("u <> v").distinct(), rows))
        # done when each node has one link and no root has any: the links are stars
        roots = after.select(F.col("v").alias("u")).distinct()
        loose = after.groupBy("u").count().where("count > 1").select("u").unionByName(after.join(roots, "u", "left_semi").select("u")).limit(1)
        links = after
        if not loose.take(1):
            break
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

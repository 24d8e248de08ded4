"""Phrases whose words occur together far more often than apart, mined by vertical partitioning of word suffixes.

Texts become pieces of words; every suffix of a piece, cut to ``most_words`` words, is a path of a suffix tree. The tree
is never held whole. Its vertical partitioning counts prefixes of one word (in cells of their hash) and extends those that
exceed the memory budget by a further word, until each fits. Prefixes are put together to groups within the budget, every group builds
its subtree by itself (one sort of its suffixes), and the count of a phrase is the total of the leaves below it.

Before that, suffixes end where no phrase can be frequent: at a word, or a pair of words, below ``min_count``. Words
are counted exactly; pairs in a table of fixed size, whose counters never fall short. Both filters have a fixed size,
are sent to all tasks, and only leave out what cannot count.

Words are known by 64-bit hashes of language and word.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import _LOWER, mix, quoted, runs, span_hashes, span_strings, text_bytes, text_parts
from rowloom.operators.sizing import lookup
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP_ROWS = 250_000
MOST_HEAVY = 10_000
FIRST_BITS = 12
MORE_BITS = 6
WORD_BITS = 24
PAIR_BITS = 22
CELL_BYTES = 4096
HELD_ROWS = 400_000

_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9]] = True
_IN_WORD = ~(_SEPARATES | _BLANK)


def _lang_salts(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """A 64-bit salt of each row's language, and the language; null is ``und``."""
    names = ["und" if v is None else v for v in column.to_pylist()]
    salts = {n: int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in set(names)}
    return np.array([salts[n] for n in names], dtype=np.uint64), names


def _scan(batches: Iterator[pa.RecordBatch], ahead: int):
    """Words of all texts: (lower-cased bytes, begin, end, key, next word is of the same piece, own words, row, languages)."""
    for batch in batches:
        body, starts = text_bytes(batch.column(1))
        salts, names = _lang_salts(batch.column(0))
        for first, part, at, own_bytes, _, _ in text_parts(body, starts, _SEPARATES, _BLANK, ahead):
            lowered = _LOWER[part]
            begin, end, rows_at = runs(lowered, at, _IN_WORD)
            if not len(begin):
                continue
            row = first + np.repeat(np.arange(len(at) - 1), np.diff(rows_at))
            key = mix(span_hashes(lowered, begin, end) + salts[row])
            key += (key == 0).astype(np.uint64)
            piece = np.cumsum(_SEPARATES[part])[begin]
            joined = np.zeros(len(begin), dtype=bool)
            joined[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
            yield lowered, begin, end, key, joined, int(np.searchsorted(begin, own_bytes)), row, names


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for body, begin, end, key, _, own, row, names in _scan(batches, 0):
        word, at, count = np.unique(key[:own], return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(word.view(np.int64)), pa.array([names[r] for r in row[at].tolist()], pa.string()),
                span_strings(body, begin[at], end[at]), pa.array(count.astype(np.int64)),
            ],
            names=["key", "lang", "word", "n"],
        )


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Occurrences of each word per language: (key, lang, word, f). Null texts are empty, a null language is ``und``."""
    rows = docs.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(_count_words, "key bigint, lang string, word string, n bigint")
    # The key decides language and word; grouping by all three keeps the aggregation hashed.
    return counted.groupBy("key", "lang", "word").agg(F.sum("n").alias("f"))


def _has(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _word_filter(words: DataFrame) -> np.ndarray:
    """A table of 2**WORD_BITS bits with those of the given words set."""
    slot = F.shiftrightunsigned("key", 64 - WORD_BITS)
    rows = words.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(key, %d) & 63 AS int))" % (64 - WORD_BITS))).alias("bits")).toPandas()
    out = np.zeros(1 << (WORD_BITS - 6), dtype=np.uint64)
    out[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out.view(np.uint8)


def _pair_slots(key: np.ndarray) -> np.ndarray:
    return (mix(key[:-1] * np.uint64(3) + key[1:]) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _likely(key: np.ndarray, joined: np.ndarray, word_bits: np.ndarray) -> np.ndarray:
    """Places whose word and next word both may be frequent."""
    known = _has(word_bits, (key >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    out = joined & known
    out[:-1] &= known[1:]
    return out


def _pair_filter(rows: DataFrame, word_bits: np.ndarray, min_count: int, most_words: int) -> np.ndarray:
    """A table of 2**PAIR_BITS bits: the counters of pairs that reach ``min_count``.

    A task sends its counters as rows of fixed size, cut off at ``min_count``; they are summed as a stream.
    """
    kind = np.uint8 if min_count <= 255 else np.int64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << PAIR_BITS, dtype=np.int64)
        for _, _, _, key, joined, own, _, _ in _scan(batches, most_words - 1):
            here = np.flatnonzero(_likely(key, joined, word_bits)[:own])
            np.add.at(counters, _pair_slots(key)[here[here < len(key) - 1]], 1)
        cut = np.minimum(counters, min_count).astype(kind).reshape(-1, CELL_BYTES)
        some = np.flatnonzero(cut.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([cut[i].tobytes() for i in some], pa.binary())], names=["part", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = totals.setdefault(part, np.zeros(CELL_BYTES, np.int64))
                held += np.frombuffer(counts.as_buffer(), dtype=kind)
        bits = [np.packbits(t >= min_count, bitorder="little").tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(bits, pa.binary())], names=["part", "bits"])

    summed = rows.mapInArrow(count, "part int, counts binary").repartition("part").mapInArrow(add, "part int, bits binary")
    out = np.zeros((1 << PAIR_BITS) // CELL_BYTES * (CELL_BYTES // 8), dtype=np.uint8).reshape(-1, CELL_BYTES // 8)
    for part, bits in summed.toLocalIterator():
        out[part] = np.frombuffer(bytes(bits), dtype=np.uint8)
    return out.reshape(-1)


def _suffix_rows(columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    """Suffixes with equal words put together."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], at) if len(at) else counts
    arrays = [pa.array(c[at].view(np.int64)) for c in columns] + [pa.array(total)]
    return pa.RecordBatch.from_arrays(arrays, names=[*(f"w{i + 1}" for i in range(len(columns))), "n"])


def _suffixes(word_bits: np.ndarray, pair_bits: np.ndarray, most_words: int):
    """Of a task's texts the suffixes of two words and more, cut where no longer phrase can be frequent: (w1, w2, ..., n); 0 is
    no word. They are made anew in each scan, alike every time, so they are never stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows_held = 0
        for _, _, _, key, joined, own, _, _ in _scan(batches, most_words - 1):
            good = _likely(key, joined, word_bits)
            good[:-1] &= _has(pair_bits, _pair_slots(key))
            good[-1] = False
            at = np.flatnonzero(good[:own])
            padded = np.concatenate([key, np.zeros(most_words, np.uint64)])
            follows = np.concatenate([good, np.zeros(most_words, bool)])
            columns, on = [key[at]], np.ones(len(at), dtype=bool)
            for k in range(1, most_words):
                on = on & follows[at + k - 1]
                columns.append(np.where(on, padded[at + k], np.uint64(0)))
            held.append(columns)
            rows_held += len(at)
            if rows_held >= HELD_ROWS:
                yield _suffix_rows([np.concatenate(c) for c in zip(*held)], np.ones(rows_held, np.int64))
                held, rows_held = [], 0
        if rows_held:
            yield _suffix_rows([np.concatenate(c) for c in zip(*held)], np.ones(rows_held, np.int64))

    return run


def _prefix_cells(batch: pa.RecordBatch, most_words: int, heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of prefixes that each suffix is partitioned by, the words of these prefixes, and whether it may be parted further.

    ``heavy`` holds, per length, the sorted cells whose prefixes are extended by a further word. Suffixes that are equal to
    their last word have none left, and are dealt by their place.
    """
    columns = [batch.column(i).to_numpy().view(np.uint64) for i in range(most_words)]
    key = mix(columns[0].copy())
    cell = (1 << FIRST_BITS) + (key >> np.uint64(64 - FIRST_BITS)).astype(np.int64)
    long, alive = np.ones(len(key), dtype=np.int64), np.ones(len(key), dtype=bool)
    for level, cells in enumerate(heavy, 1):
        alive &= cells[np.minimum(np.searchsorted(cells, cell), len(cells) - 1)] == cell
        more = columns[level] if level < most_words else np.arange(len(key), dtype=np.uint64)
        key = np.where(alive, mix(key * np.uint64(3) + more), key)
        cell = np.where(alive, cell << MORE_BITS | (key >> np.uint64(64 - MORE_BITS)).astype(np.int64), cell)
        long += alive
    return cell, long, alive


def _grouped(rows: DataFrame, suffixes, most_words: int, group_rows: int) -> DataFrame:
    """The suffixes of all texts (w1, w2, ..., n) with ``long``, the words of the prefixes they are partitioned by, and ``group``.

    Prefixes of a word are counted in cells of their hash, in a scan; the prefixes of a cell beyond the budget are extended by
    a word in a further scan, and so on. Cells in order are closed to a group whenever the budget is reached. The number of
    cells beyond the budget is at most rows / budget of a length, and the budget grows so that these are never more than
    ``MOST_HEAVY``.
    """
    def counted(heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for batch in suffixes(batches):
                cell, _, alive = _prefix_cells(batch, most_words, heavy)
                cells, inverse = np.unique(np.concatenate([cells, cell[alive]]), return_inverse=True)
                new = np.bincount(inverse[len(held):], minlength=len(cells))
                new[inverse[:len(held)]] += held
                held = new
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(held.astype(np.int64))], names=["cell", "rows"])

        found = rows.mapInArrow(count, "cell bigint, rows bigint").groupBy("cell").agg(F.sum("rows").alias("rows")).toPandas()
        return found["cell"].to_numpy(dtype=np.int64), found["rows"].to_numpy(dtype=np.int64)

    heavy: list[np.ndarray] = []
    light: list[tuple[np.ndarray, np.ndarray]] = []
    budget = 0
    for level in range(most_words + 1):
        cells, sizes = counted(heavy)
        budget = budget or max(group_rows, int(sizes.sum()) // MOST_HEAVY)
        over = (sizes > budget) & (level < most_words)
        light.append((cells[~over], sizes[~over]))
        if not over.any():
            break
        heavy.append(np.sort(cells[over]))
    cells, sizes = (np.concatenate(x) for x in zip(*light))
    order = np.argsort(cells)
    cells, group, filled, number = cells[order], np.zeros(len(cells), dtype=np.int64), 0, 0
    for i, size in enumerate(sizes[order].tolist()):
        if filled and filled + size > budget:
            number, filled = number + 1, 0
        group[i], filled = number, filled + size

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in suffixes(batches):
            cell, long, _ = _prefix_cells(batch, most_words, heavy)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(long), pa.array(group[np.searchsorted(cells, cell)])], names=[*batch.schema.names, "long", "group"]
            )

    names = [*(f"w{i + 1}" for i in range(most_words)), "n", "long", "group"]
    return rows.mapInArrow(deal, ", ".join(f"{c} bigint" for c in names))


def _subtree(most_words: int, min_count: int):
    """Counts of all phrases below the prefixes of one group, from the leaves of its subtree."""
    names = [f"w{i + 1}" for i in range(most_words)]

    def run(rows: pa.Table) -> pa.Table:
        columns = [rows.column(c).to_numpy() for c in names]
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        n, long = rows.column("n").to_numpy()[order], rows.column("long").to_numpy()[order]
        leaves = np.concatenate([[0], np.cumsum(n)])
        new = np.zeros(len(n), dtype=bool)
        new[:1] = True
        found = []
        for depth, words in enumerate(columns, 1):
            new[1:] |= words[1:] != words[:-1]
            if depth < 2:
                continue
            at = np.flatnonzero(new)
            total = leaves[np.append(at[1:], len(n))] - leaves[at]
            # A prefix that was extended has further leaves in other groups.
            keep = (words[at] != 0) & ((total >= min_count) | (long[at] > depth))
            at, total = at[keep], total[keep]
            found.append([c[at] if i < depth else np.zeros(len(at), np.int64) for i, c in enumerate(columns)] + [total])
        out = [np.concatenate(c) for c in zip(*found)]
        return pa.table([pa.array(c) for c in out], names=[*names, "n"])

    return run


def frequent_phrases(
    docs: DataFrame, words: DataFrame, min_count: int = 100, most_words: int = 5, text_col: str = "text", lang_col: str = "lang",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Phrases of 2 to ``most_words`` words that occur at least ``min_count`` times in a language: (words, f).

    ``words`` are keys of words as ``word_counts`` gives them, of which the frequent ones are used.
    """
    rows = docs.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text"))
    word_bits = _word_filter(words.where(F.col("f") >= min_count))
    pair_bits = _pair_filter(rows, word_bits, min_count, most_words)
    w = [f"w{i + 1}" for i in range(most_words)]
    suffixes = _grouped(rows, _suffixes(word_bits, pair_bits, most_words), most_words, group_rows)
    counted = suffixes.groupBy("group").applyInArrow(_subtree(most_words, min_count), ", ".join(f"{c} bigint" for c in w) + ", n bigint")
    total = counted.groupBy(*w).agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    return total.select(F.filter(F.array(*w), lambda x: x != 0).alias("words"), "f")


def collocations(
    docs: DataFrame, min_count: int = 100, most_words: int = 5, top: int = 2000, absorb_percent: int = 100,
    text_col: str = "text", lang_col: str = "lang", group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The ``top`` phrases of each language by how much more often their parts occur together than apart.

    A to Z are lowered; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. A phrase of a occurrences cut into
    parts of l and r, of n words, scores floor(1000 * a * n / (l * r)); the cut of least score counts, then the shortest
    first part. A phrase inside a longer one that occurs at least ``absorb_percent`` % as often is dropped. Order: score,
    a, both descending, phrase by bytes. Returns (lang, rank, phrase, a, l, r, n, score).

    Null texts are empty, a null language is ``und``, ids and other columns play no part, repeated rows count as often as
    they occur. No frequent phrase, no row.
    """
    words = durable(word_counts(docs, text_col, lang_col))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = durable(words.where(F.col("f") >= min_count))
    phrases = durable(frequent_phrases(docs, known, min_count, most_words, text_col, lang_col, group_rows))
    counts = phrases.unionByName(known.select(F.array("key").alias("words"), "f"))
    cuts = phrases.select("words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k")).select(
        "words", "a", "k", F.expr("slice(words, 1, k)").alias("head"), F.expr("slice(words, k + 1, size(words))").alias("tail"),
        F.col("words")[0].alias("key"),
    )
    cuts = lookup(cuts, counts.select(F.col("words").alias("head"), F.col("f").alias("l")), "head")
    cuts = lookup(cuts, counts.select(F.col("words").alias("tail"), F.col("f").alias("r")), "tail")
    cuts = lookup(lookup(cuts, known.select("key", "lang"), "key"), totals, "lang")
    # Exact: up to 38 digits.
    wide = {c: f"cast({c} AS decimal(19, 0))" for c in ("a", "n", "l", "r")}
    score = F.expr(f"(cast(1000 AS decimal(4, 0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    best = cuts.groupBy("words", "lang", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # Where a far longer phrase absorbs one, so does one that is longer by a word, since counts only fall.
    longer = phrases.where(F.size("words") > 2).select(
        F.explode(F.expr("array(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1))")).alias("words"), "f"
    ).groupBy("words").agg(F.max("f").alias("longer"))
    free = best.join(longer, "words", "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(absorb_percent) * F.col("a"))
    ).select("words", "lang", "a", "n", F.col("cut.score").alias("score"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"))
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    ahead = durable(free.withColumn("place", F.rank().over(by)).where(F.col("place") <= top).drop("place"))
    spelled = lookup(ahead.select("words", F.posexplode("words").alias("at", "key")), known.select("key", "word"), "key")
    texts = spelled.groupBy("words").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = ahead.join(texts, "words").withColumn("rank", F.row_number().over(by).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))

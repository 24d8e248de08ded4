"""Scores of texts by a small causal self-attention model over subword ids, trained in numpy on Spark.

A text is its words (A to Z lowered, white space apart), each spelled in subwords of a public vocabulary, and one end.
The ``SLOTS - 2`` most frequent subwords, the end and "any other" are what the model predicts; another subword shares
the probability of its slot evenly. The output is a softmax of two levels: class of the slot, slot within the class. Its
logits are what attention gives, added to the logarithm of how often a slot follows the one before, counted over all
training texts; so attention starts from pairs and learns what more of the past tells.

Training: windows over all training texts, in which every place is a target, are stored as minibatches; small inputs are
gone over several times. In each round every task starts from the same weights and works through its minibatches of that
round; the weights are then averaged by minibatches seen. Tasks grow in number as the minibatches do; only one set of
weights is on the driver.

Scoring: windows of ``WINDOW`` tokens overlap by ``WINDOW - STRIDE``; each token is scored once, in the window in
which it has the most context. Beside it stands the score of a unigram model of words with one added to each count:
counts of the most frequent words travel to the tasks (a fixed number), all others are joined.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.bpe_parts import part_table
from rowloom.llm.common import _IS_SPACE, _LOWER, quoted, row_chunks, runs, span_hashes, span_strings, text_bytes, text_parts
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, STRIDE, WIDTH, HIDDEN = 16, 14, 16, 32
CLASSES, MEMBERS = 32, 32
SLOTS = CLASSES * MEMBERS
END, OTHER = 0, SLOTS - 1
NOTHING = 65535
ROUNDS = 4
SPREAD = 10_000
TASK_STEPS = 1000
LEAST_WINDOWS, MOST_WINDOWS = 32, 256
RATE = 0.01
FREQUENT_WORDS = 1 << 18
LONGEST_FREQUENT = 64
SCORED_AT_ONCE = 256
CELL = 1024
PAIR_PRIOR = 5.0

SHAPES = {
    "E": (SLOTS, WIDTH), "P": (WINDOW, WIDTH), "Wqkv": (WIDTH, 3 * WIDTH), "Wo": (WIDTH, WIDTH), "W1": (WIDTH, HIDDEN), "b1": (HIDDEN,),
    "W2": (HIDDEN, WIDTH), "Wc": (WIDTH, CLASSES), "bc": (CLASSES,), "Wi": (CLASSES, WIDTH, MEMBERS), "bi": (CLASSES, MEMBERS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The weights by name, as views of one flat vector."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def first_weights() -> np.ndarray:
    """Small random weights; the output weights are zero, so that the model starts as the pairs it is given."""
    flat = (np.random.default_rng(7).standard_normal(SIZE) * 0.1).astype(np.float32)
    w = views(flat)
    for name in ("b1", "Wc", "bc", "Wi", "bi"):
        w[name][:] = 0
    return flat


def log_pairs(pairs: np.ndarray, first: np.ndarray, final: np.ndarray, n_texts: int) -> np.ndarray:
    """Logarithms of how likely a slot (within its class; the class) is after each slot, one row per slot before.

    ``pairs`` are counts inside words, ``first`` and ``final`` of slots that begin and end words. Which word follows
    which is not counted: after the end of a word comes any first slot, or the end, by their numbers.
    """
    opening = first.astype(np.float64)
    opening[END] += n_texts
    opening /= max(1.0, opening.sum())
    counts = pairs + final[:, None] * opening[None, :]
    counts[END] += opening * n_texts
    alone = counts.sum(0) + 0.1
    alone /= alone.sum()
    share = (counts + PAIR_PRIOR * alone) / (counts.sum(1, keepdims=True) + PAIR_PRIOR)
    share = share.reshape(SLOTS, CLASSES, MEMBERS)
    mass = share.sum(2)
    return np.concatenate([np.log(share / mass[:, :, None]).reshape(SLOTS, SLOTS), np.log(mass)], axis=1).astype(np.float32)


_EARLIER = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_SCALE = np.float32(1 / np.sqrt(WIDTH))
_STEEPEST = np.float32(40)


def _attend(w: dict, ids: np.ndarray, spread: tuple | None = None) -> tuple:
    """Hidden values of all places of windows, each from its own and earlier places; and what the gradient needs.

    ``spread`` may hold the products of embeddings and places with Wqkv, where many windows are to be read.
    """
    n = len(ids)
    x = w["E"][ids]
    x += w["P"]
    flat = x.reshape(-1, WIDTH)
    if spread is None:
        qkv = (flat @ w["Wqkv"]).reshape(n, WINDOW, 3 * WIDTH)
    else:
        qkv = spread[0][ids]
        qkv += spread[1]
    q, k, v = qkv[:, :, :WIDTH], qkv[:, :, WIDTH:2 * WIDTH], qkv[:, :, 2 * WIDTH:]
    a = q @ k.transpose(0, 2, 1)
    a *= _SCALE
    np.clip(a, -_STEEPEST, _STEEPEST, out=a)
    np.exp(a, out=a)
    a *= _EARLIER
    total = (a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(n, WINDOW, 1)
    o = a @ v
    o /= total
    o = o.reshape(-1, WIDTH)
    y = flat + o @ w["Wo"]
    m = y @ w["W1"]
    m += w["b1"]
    np.maximum(m, 0, out=m)
    return y + m @ w["W2"], (flat, q, k, v, a, total, o, y, m)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _log_share(x: np.ndarray, at: np.ndarray, which: np.ndarray) -> np.ndarray:
    """``_log_softmax`` at one entry a row."""
    told = x[at, which]
    with np.errstate(over="ignore"):
        total = np.exp(x) @ np.ones(x.shape[1], x.dtype)
    if not np.isfinite(total).all() or not total.all():
        return _log_softmax(x)[at, which]
    return told - np.log(total)


def offsets(w: dict, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What is added to the logits after each slot: of classes, and of the members of each class; pairs and biases."""
    return after[:, SLOTS:] + w["bc"], after[:, :SLOTS].reshape(SLOTS * CLASSES, MEMBERS) + np.tile(w["bi"], (SLOTS, 1))


def log_probabilities(w: dict, added: tuple, hidden: np.ndarray, before: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each target slot, given the slot before and the hidden values."""
    kind = targets // MEMBERS
    order = np.argsort(kind.astype(np.int16), kind="stable")
    near, kind, member, before = hidden[order], kind[order], targets[order] % MEMBERS, before[order]
    at = np.arange(len(targets))
    logits = near @ w["Wc"]
    logits += added[0][before]
    told = _log_share(logits, at, kind)
    bounds = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    inner = np.empty((len(targets), MEMBERS), near.dtype)
    for c, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if b > a:
            np.matmul(near[a:b], w["Wi"][c], out=inner[a:b])
    inner += added[1][before * CLASSES + kind]
    told += _log_share(inner, at, member)
    out = np.empty_like(told)
    out[order] = told
    return out


def _softmax(x: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The softmax of each row, and its logarithm at one entry a row."""
    told = x[at, which]
    with np.errstate(over="ignore"):
        share = np.exp(x)
        total = share @ np.ones(x.shape[1], x.dtype)
    if not np.isfinite(total).all() or not total.all():
        logs = _log_softmax(x)
        return np.exp(logs), logs[at, which]
    share /= total[:, None]
    return share, told - np.log(total)


def gradient(flat: np.ndarray, after: np.ndarray, batch: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss of a minibatch of windows of WINDOW + 1 slots, and its gradient."""
    w, grad = views(flat), np.zeros_like(flat)
    g = views(grad)
    ids, targets = batch[:, :-1], batch[:, 1:].reshape(-1)
    ids = np.where(ids == NOTHING, END, ids)
    z, (x, q, k, v, a, total, o, y, m) = _attend(w, ids)
    a /= total
    # Targets by their class, so that the members of a class are one product.
    told = np.flatnonzero(targets != NOTHING)
    told = told[np.argsort((targets[told] // MEMBERS).astype(np.int16), kind="stable")]
    h, t = z[told], targets[told].astype(np.int64)
    n = max(1, len(told))
    kind, member = t // MEMBERS, t % MEMBERS
    before = ids.reshape(-1)[told]
    at = np.arange(len(t))
    logits = h @ w["Wc"]
    logits += w["bc"]
    logits += after[before, SLOTS:]
    dc, loss = _softmax(logits, at, kind)
    dc[at, kind] -= 1
    dc /= n
    g["Wc"][:], g["bc"][:] = h.T @ dc, np.ones(len(dc), dc.dtype) @ dc
    dh = dc @ w["Wc"].T
    bounds = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    inner, back = np.empty((len(t), MEMBERS), h.dtype), np.empty_like(h)
    spans = [(c, i, j) for c, (i, j) in enumerate(zip(bounds[:-1], bounds[1:])) if j > i]
    for c, i, j in spans:
        np.matmul(h[i:j], w["Wi"][c], out=inner[i:j])
        inner[i:j] += w["bi"][c]
    inner += after[:, :SLOTS].reshape(SLOTS, CLASSES, MEMBERS)[before, kind]
    di, more = _softmax(inner, at, member)
    di[at, member] -= 1
    di /= n
    for c, i, j in spans:
        np.matmul(h[i:j].T, di[i:j], out=g["Wi"][c])
        np.matmul(di[i:j], w["Wi"][c].T, out=back[i:j])
        g["bi"][c] = np.ones(j - i, di.dtype) @ di[i:j]
    dh += back
    dz = np.zeros_like(z)
    dz[told] = dh
    g["W2"][:] = m.T @ dz
    dm = dz @ w["W2"].T
    dm *= m > 0
    every = np.ones(len(z), z.dtype)
    g["W1"][:], g["b1"][:] = y.T @ dm, every @ dm
    dy = dz + dm @ w["W1"].T
    g["Wo"][:] = o.T @ dy
    do = (dy @ w["Wo"].T).reshape(q.shape)
    ds = do @ v.transpose(0, 2, 1)
    # What a place's weights gain together is what its output gains.
    ds -= ((do * o.reshape(q.shape)).reshape(-1, WIDTH) @ np.ones(WIDTH, z.dtype)).reshape(len(q), WINDOW, 1)
    ds *= a
    ds *= _SCALE
    dqkv = np.empty((len(q), WINDOW, 3 * WIDTH), z.dtype)
    np.matmul(ds, k, out=dqkv[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[:, :, WIDTH:2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), do, out=dqkv[:, :, 2 * WIDTH:])
    dqkv = dqkv.reshape(-1, 3 * WIDTH)
    g["Wqkv"][:] = x.T @ dqkv
    dx = dy + dqkv @ w["Wqkv"].T
    g["P"][:] = (every[:len(ids)] @ dx.reshape(len(ids), -1)).reshape(WINDOW, WIDTH)
    flat_ids = ids.reshape(-1)
    order = np.argsort(flat_ids.astype(np.int16), kind="stable")
    which, first = np.unique(flat_ids[order], return_index=True)
    g["E"][which] = np.add.reduceat(dx[order], first, axis=0)
    return -float(loss.sum() + more.sum()) / n, grad


def train(flat: np.ndarray, after: np.ndarray, batches: Iterator[np.ndarray], rate: float = RATE) -> tuple[np.ndarray, int]:
    """Weights after Adam over the minibatches, and their number."""
    flat = flat.copy()
    # In double precision, where moments that fade away do not become subnormal numbers, which are slow.
    first, second, step = np.zeros(len(flat)), np.zeros(len(flat)), 0
    for batch in batches:
        step += 1
        _, grad = gradient(flat, after, batch)
        first += 0.1 * (grad - first)
        second += 0.02 * (np.square(grad, dtype=np.float64) - second)
        now = rate * np.sqrt(1 - 0.98**step) / (1 - 0.9**step)
        flat -= (now * first / (np.sqrt(second) + 1e-8)).astype(flat.dtype)
    return flat, step


def _spelled(path: str, words: pa.Array, slot_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all words, each with a blank before it, and where each word's begin (one more entry than words)."""
    body, starts = text_bytes(words)
    n = np.diff(starts)
    begin = starts[:-1] + np.arange(len(n))
    spaced = np.full(len(body) + len(n), 32, np.uint8)
    spaced[np.repeat(begin + 1 - starts[:-1], n) + np.arange(len(body))] = body
    table = part_table(path)
    ids: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    for i, j in row_chunks(np.append(begin, len(spaced))):
        part = spaced[begin[i]:begin[j] if j < len(n) else len(spaced)]
        here = begin[i:j] - begin[i]
        found, size = table.encoded(part, here, np.append(here[1:], len(part)))
        ids.append(found)
        sizes.append(size)
    at = np.concatenate([[0], *sizes]).astype(np.int64).cumsum()
    return slot_of[np.concatenate(ids).astype(np.int64)] if ids else np.zeros(0, np.int64), at


def vocabulary_size(path: str) -> int:
    """One more than the greatest identifier of an ordinary subword."""
    return len(part_table(path).lengths)


def _words(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lowered = _LOWER[body]
    begin, end, at = runs(lowered, starts, ~_IS_SPACE)
    return lowered, begin, end, at, span_hashes(lowered, begin, end)


def held_out(id_column: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether a document takes no part in learning: crc32 of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body, starts = text_bytes(batch.column(0))
        for _, part, at, _, _, _ in text_parts(body, starts, _IS_SPACE, _IS_SPACE):
            lowered, begin, end, _, key = _words(part, at)
            word, first, count = np.unique(key, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), span_strings(lowered, begin[first], end[first]), pa.array(count)], names=["key", "word", "n"]
            )


def word_table(texts: DataFrame) -> DataFrame:
    """Occurrences of each word in a table of one column of texts: (key, word, c)."""
    return texts.mapInArrow(_count, "key bigint, word string, n bigint").groupBy("key", "word").agg(F.sum("n").alias("c"))


def _spelled_words(words: DataFrame, path: str) -> DataFrame:
    """The subwords of each word and its count: (c, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.arange(vocabulary_size(path))
        for batch in batches:
            ids, at = _spelled(path, batch.column(0), every)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))], names=["c", "ids"]
            )

    return words.select("word", "c").mapInArrow(run, "c bigint, ids array<int>")


def _summed(rows: DataFrame, of_task, size: int) -> np.ndarray:
    """The sum over all tasks of vectors of ``size`` numbers, which ``of_task`` makes of a task's batches.

    Vectors travel in cells of fixed size and are summed as a stream, whatever the number of tasks.
    """
    width = -(-size // CELL) * CELL

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(width)
        cells[:size] = of_task(batches)
        cells = cells.reshape(-1, CELL)
        some = np.flatnonzero(cells.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([cells[i].tobytes() for i in some], pa.binary())], names=["cell", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for cell, total in zip(batch.column(0).to_pylist(), batch.column(1)):
                totals.setdefault(cell, np.zeros(CELL)).__iadd__(np.frombuffer(total.as_buffer()))
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["cell", "total"])

    schema = "cell int, total binary"
    out = np.zeros(width).reshape(-1, CELL)
    for cell, total in rows.mapInArrow(send, schema).repartition("cell").mapInArrow(add, schema).toLocalIterator():
        out[cell] = np.frombuffer(bytes(total))
    return out.reshape(-1)[:size]


def _subword_counts(spelled: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of each subword."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(vocabulary)
        for batch in batches:
            lists = batch.column(1)
            np.add.at(total, lists.flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy())))
        return total

    return _summed(spelled, of_task, vocabulary)


def _pair_counts(spelled: DataFrame, slot_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often a slot follows another inside words, begins a word, ends a word."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((SLOTS + 2) * SLOTS)
        for batch in batches:
            lists = batch.column(1)
            slots, at = slot_of[lists.flatten().to_numpy()], lists.offsets.to_numpy() - lists.offsets[0].as_py()
            each = np.repeat(batch.column(0).to_numpy().astype(np.float64), np.diff(at))
            some = np.diff(at) > 0
            begin, last = at[:-1][some], at[1:][some] - 1
            inside = np.ones(len(slots), bool)
            inside[last] = False
            here = np.flatnonzero(inside)
            np.add.at(total, slots[here] * SLOTS + slots[np.minimum(here + 1, max(0, len(slots) - 1))], each[here])
            np.add.at(total, SLOTS * SLOTS + slots[begin], each[begin])
            np.add.at(total, (SLOTS + 1) * SLOTS + slots[last], each[last])
        return total

    total = _summed(spelled, of_task, (SLOTS + 2) * SLOTS).reshape(SLOTS + 2, SLOTS)
    return total[:SLOTS], total[SLOTS], total[SLOTS + 1]


class LanguageModel:
    """What a fit learns: slots, weights, the counts of words and of the most frequent ones by themselves."""

    def __init__(self, path, slot_of, others, after, weights, words, frequent, n_tokens, n_distinct, n_texts):
        self.path, self.slot_of, self.others, self.after, self.weights = path, slot_of, others, after, weights
        self.words, self.frequent = words, frequent
        self.n_tokens, self.n_distinct, self.n_texts = n_tokens, n_distinct, n_texts


def _frequent_words(words: DataFrame, path: str, slot_of: np.ndarray) -> tuple[np.ndarray, ...]:
    """At most ``FREQUENT_WORDS`` words of the highest counts: sorted keys, counts, slots, and where a word's slots begin."""
    size = F.floor(F.log2("c") * 16).cast("int")
    short = words.where(F.octet_length("word") <= LONGEST_FREQUENT)
    total, least = 0, None
    for row in sorted(short.groupBy(size.alias("size")).count().collect(), reverse=True):
        if total + row["count"] > FREQUENT_WORDS:
            break
        total, least = total + row["count"], row["size"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    rows = short.where(size >= least).select("key", "word", "c").toPandas()
    key = rows["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(key)
    slots, at = _spelled(path, pa.array(rows["word"].to_numpy()[order].tolist(), pa.string()), slot_of)
    return key[order], rows["c"].to_numpy(dtype=np.int64)[order], slots.astype(np.int64), at


def _slots_of_words(path, slot_of, frequent, lowered, begin, end, key):
    """Slots of a sequence of words, where each word's begin, and which words are frequent (their number, or -1)."""
    keys, _, slots, at = frequent
    place = np.searchsorted(keys, key) if len(keys) else np.zeros(len(key), np.int64)
    place = np.minimum(place, max(0, len(keys) - 1))
    known = keys[place] == key if len(keys) else np.zeros(len(key), bool)
    other = np.flatnonzero(~known)
    _, first, inverse = np.unique(key[other], return_index=True, return_inverse=True)
    here = other[first]
    new_slots, new_at = _spelled(path, span_strings(lowered, begin[here], end[here]), slot_of)
    pool = np.concatenate([slots, new_slots])
    starts = np.concatenate([at[:-1], len(slots) + new_at[:-1]])
    sizes = np.concatenate([np.diff(at), np.diff(new_at)])
    which = place.copy()
    which[other] = len(at) - 1 + inverse
    length = sizes[which]
    out_at = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    out = pool[np.repeat(starts[which] - out_at[:-1], length) + np.arange(out_at[-1])]
    return out, out_at, np.where(known, place, -1)


def training_windows(slots: np.ndarray, at: np.ndarray, before: int, closes: bool, shift: int) -> np.ndarray:
    """Windows of rows of slots (``at``: where each row's begin), in which every slot is a target once.

    A window is the slot before and up to WINDOW targets, then NOTHING. The first window of a row is shorter by ``shift``.
    ``before`` precedes each row; with ``closes`` the end is its last target.
    """
    n = np.diff(at) + closes
    count = np.where(n > 0, -(-(n + shift) // WINDOW), 0)
    row = np.repeat(np.arange(len(n)), count)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.maximum(0, turn * WINDOW - shift)
    size = np.minimum(n[row], (turn + 1) * WINDOW - shift) - begin
    # Place p of a row's sequence is its slot p - 1; place 0 the one before.
    place = begin[:, None] + np.arange(WINDOW + 1)
    padded = np.append(slots, END)
    rows = padded[np.clip(at[row][:, None] + place - 1, 0, len(slots))]
    rows[place == 0] = before
    rows[place > np.diff(at)[row][:, None]] = END
    rows[np.arange(WINDOW + 1) > size[:, None]] = NOTHING
    return rows.astype(np.uint16)


def _minibatches(texts: DataFrame, path: str, slot_of: np.ndarray, frequent: tuple, passes: int, size: int) -> DataFrame:
    """Windows over all places of all texts, ``passes`` times, as stored minibatches (round, windows) of ``size`` windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = np.zeros((0, WINDOW + 1), np.uint16), 0
        for batch in batches:
            body, starts = text_bytes(batch.column(0))
            for _, part, at, _, opens, closes in text_parts(body, starts, _IS_SPACE, _IS_SPACE):
                lowered, begin, end, words_at, key = _words(part, at)
                slots, slots_at, _ = _slots_of_words(path, slot_of, frequent, lowered, begin, end, key)
                row_at, before = slots_at[words_at], END if opens else tail
                tail = int(slots[-1]) if len(slots) else before
                for turn in range(passes):
                    rows = training_windows(slots, row_at, before, closes, turn % WINDOW)
                    # Neighbours go to different minibatches, the same ones in every run.
                    held = np.concatenate([held, np.random.default_rng(turn).permutation(rows)])
                    cut = len(held) // size * size
                    if cut:
                        yield _stored(number, held[:cut].reshape(-1, size, WINDOW + 1))
                        held, number = held[cut:], number + cut // size
        if len(held):
            yield _stored(number, held[None])

    def _stored(number: int, windows: np.ndarray) -> pa.RecordBatch:
        rounds = (number + np.arange(len(windows))) % ROUNDS
        return pa.RecordBatch.from_arrays([pa.array(rounds.astype(np.int32)), pa.array([w.tobytes() for w in windows], pa.binary())], names=["round", "windows"])

    return texts.mapInArrow(run, "round int, windows binary")


def _one_round(minibatches: DataFrame, turn: int, flat: np.ndarray, after: np.ndarray, rate: float) -> np.ndarray:
    """The average of what all tasks make of the weights, by the minibatches they saw."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        def rows():
            for batch in batches:
                for raw in batch.column(0):
                    yield np.frombuffer(raw.as_buffer(), dtype=np.uint16).reshape(-1, WINDOW + 1).astype(np.int64)

        learned, steps = train(flat, after, rows(), rate)
        return np.append(learned * float(steps), steps)

    total = _summed(minibatches.where(F.col("round") == turn).select("windows"), of_task, SIZE + 1)
    return (total[:-1] / total[-1]).astype(np.float32) if total[-1] else flat


def fit_language_model(texts: DataFrame, path: str) -> LanguageModel:
    """Learn from a table of one column of texts. No text gives a model without knowledge: all slots alike."""
    words = durable(word_table(texts))
    n_texts = texts.count()
    row = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_tokens, n_distinct = int(row["n"] or 0) + n_texts, int(row["v"]) + (n_texts > 0)
    vocabulary = vocabulary_size(path)
    spelled = durable(_spelled_words(words, path))
    counts = _subword_counts(spelled, vocabulary)
    found = np.lexsort((np.arange(vocabulary), -counts))[:SLOTS - 2]
    found = found[counts[found] > 0]
    slot_of = np.full(vocabulary, OTHER, dtype=np.int64)
    slot_of[found] = np.arange(1, len(found) + 1)
    after = log_pairs(*_pair_counts(spelled, slot_of), n_texts)
    frequent = _frequent_words(words, path, slot_of)
    weights = first_weights()
    # Small inputs are gone over several times; minibatches grow with the input up to a bound, then the tasks do.
    slots = max(1, int(counts.sum()) + n_texts)
    passes = max(1, round(SPREAD / slots ** (2 / 3)))
    windows = min(MOST_WINDOWS, max(LEAST_WINDOWS, passes * slots // (WINDOW * ROUNDS * TASK_STEPS)))
    minibatches = durable(_minibatches(texts, path, slot_of, frequent, passes, windows))
    tasks = -(-minibatches.count() // (ROUNDS * TASK_STEPS)) or 1
    for turn in range(ROUNDS):
        weights = _one_round(minibatches.coalesce(tasks), turn, weights, after, RATE * (1 - turn / ROUNDS))
    return LanguageModel(path, slot_of, vocabulary - len(found), after, weights, words.select("key", "c"), frequent, n_tokens, n_distinct, n_texts)


def _window_scores(w: dict, added: tuple, inputs: np.ndarray, targets: np.ndarray, starts: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Natural logarithm of each target's probability; sequences begin at ``starts`` and their first ``lead`` targets are
    context only (they stay 0)."""
    n = np.diff(starts)
    windows = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(n)), windows)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    out = np.zeros(len(targets))
    places = np.arange(WINDOW)
    spread = w["E"] @ w["Wqkv"], w["P"] @ w["Wqkv"]
    for i in range(0, len(row), SCORED_AT_ONCE):
        r, k = row[i:i + SCORED_AT_ONCE], turn[i:i + SCORED_AT_ONCE]
        at = starts[r][:, None] + (k * STRIDE)[:, None] + places
        stop = starts[r + 1][:, None]
        own = (at < stop) & (places >= np.where(k == 0, lead[r], WINDOW - STRIDE)[:, None])
        at = np.minimum(at, stop - 1)
        hidden, _ = _attend(w, inputs[at], spread)
        told = own.reshape(-1)
        here = at.reshape(-1)[told]
        out[here] = log_probabilities(w, added, hidden[told], inputs[here], targets[here])
    return out


def score_texts(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of whole texts: (id, n_tokens, n_known, base_score, score), logarithms to base 10.

    ``n_tokens`` counts words and the end; ``n_known`` those that occur in the learned texts. Null texts are empty: the end
    alone. Repeated rows and null ids are rows of their own. An empty table gives an empty result.
    """
    path, slot_of, others, frequent = model.path, model.slot_of, model.others, model.frequent
    flat, after, end_known = model.weights, model.after, float(model.n_texts > 0)
    end_part = float(np.log10(model.n_texts + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = views(flat)
        added = offsets(w, after)
        parts = np.log10(frequent[1] + 1.0)
        for batch in batches:
            n = batch.num_rows
            body, starts = text_bytes(batch.column(2))
            tokens, known, base, score = np.ones(n), np.full(n, end_known), np.full(n, end_part), np.zeros(n)
            rare: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for first, part, at, _, opens, closes in text_parts(body, starts, _IS_SPACE, _IS_SPACE):
                rows = np.arange(first, first + len(at) - 1)
                lowered, begin, end, words_at, key = _words(part, at)
                slots, slots_at, which = _slots_of_words(path, slot_of, frequent, lowered, begin, end, key)
                word_row = np.repeat(rows, np.diff(words_at))
                tokens += np.bincount(word_row, minlength=n)
                met = which >= 0
                known += np.bincount(word_row[met], minlength=n)
                if met.any():
                    base += np.bincount(word_row[met], weights=parts[which[met]], minlength=n)
                # Words beyond the frequent ones, once a row.
                order = np.lexsort((key[~met], word_row[~met]))
                r, u = word_row[~met][order], key[~met][order]
                new = np.ones(len(r), dtype=bool)
                new[1:] = (r[1:] != r[:-1]) | (u[1:] != u[:-1])
                spots = np.flatnonzero(new)
                rare.append((r[spots], u[spots], np.diff(np.append(spots, len(r)))))
                # Sequences: a slot before, the row's slots, and the end where the text ends in this part.
                before = np.array([END]) if opens else tail
                sizes = np.diff(slots_at[words_at])
                total = len(before) + sizes + closes
                seq_at = np.concatenate([[0], np.cumsum(total)]).astype(np.int64)
                seq = np.full(int(seq_at[-1]), END, dtype=np.int64)
                put = np.repeat(seq_at[:-1] + len(before) - slots_at[words_at[:-1]], sizes) + np.arange(len(slots))
                seq[put] = slots
                if not opens:
                    seq[:len(before)] = before
                tail = seq[-(WINDOW - STRIDE + 1):]
                # Inputs are all but a row's last slot, targets all but its first.
                last = np.zeros(len(seq), bool)
                last[seq_at[1:] - 1] = True
                opening = np.zeros(len(seq), bool)
                opening[seq_at[:-1]] = True
                inputs, targets = seq[~last], seq[~opening]
                got = _window_scores(w, added, inputs, targets, seq_at - np.arange(len(seq_at)), np.full(len(rows), len(before) - 1))
                got[targets == OTHER] -= np.log(others)
                if not opens:
                    got[:len(before) - 1] = 0
                score += np.bincount(np.repeat(rows, total - 1), weights=got, minlength=n)
            r, u, c = (np.concatenate(x) for x in zip(*rare)) if rare else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
            order = np.argsort(r, kind="stable")
            r, u, c = r[order], u[order], c[order]
            at = pa.array(np.searchsorted(r, np.arange(n + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base),
                    pa.array(score / np.log(10)), pa.ListArray.from_arrays(at, pa.array(u.view(np.int64))), pa.ListArray.from_arrays(at, pa.array(c.astype(np.int64))),
                ],
                names=["row", "id", "n_tokens", "n_known", "base", "score", "rare", "times"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")
    )
    scored = durable(
        rows.mapInArrow(run, "row bigint, id bigint, n_tokens bigint, n_known bigint, base double, score double, rare array<bigint>, times array<bigint>")
    )
    met = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("key"), F.col("x.times").alias("n"))
    parts = met.join(model.words, "key").groupBy("row").agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_base")
    )
    each = float(np.log10(model.n_tokens + model.n_distinct + 1))
    nothing = F.lit(0)
    return scored.join(parts, "row", "left").select(
        "id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", nothing)).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(each)).alias("base_score"), "score",
    )


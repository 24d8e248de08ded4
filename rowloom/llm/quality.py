"""Quality classifier by co-training of two views: a text's content, and the page metadata that comes with it.

The content view sees words and shares of kinds of characters; the metadata view sees language, source and length. Each
is fitted on labelled documents, then over rounds the two score all unlabelled ones and each hands those that it is sure
of to the other. Sure means: above a confidence at which the view was right on held-out labels as often as asked. Last,
both views are calibrated on held-out labels and joined by a logistic function, and every document is scored.

Fits see bounded samples of documents: at most ``max_labelled`` labelled ones, and in each round at most ``max_pseudo``
pseudo-labelled ones (chosen by hash). Scoring, and the choice of whom a view is sure of, cover all documents.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import freeing, give_back, quoted, row_chunks, runs, text_bytes, words
from rowloom.llm.suffix_dedup import pack, unpack
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD_SLOTS = 1 << 18
MOST_WORDS = 400
LEAST_CLASS = 10
META_SLOTS = 512
KEEP_FROM = 0.5
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CLASS = np.full(256, 5, np.int64)  # 0 lower case and beyond ASCII, 1 upper case, 2 digit, 3 blank, 4 line end, 5 rest
_CLASS[97:123] = _CLASS[128:] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[9, 32]] = 3
_CLASS[[10, 13]] = 4


def content_features(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense features of each text; slots of its different words, and where each text's slots begin."""
    n = len(starts) - 1
    hashes, at = words(body, starts, _LETTER)
    slot = (hashes >> np.uint64(46)).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(at))
    unique = np.unique(doc * WORD_SLOTS + slot)
    doc_u, slot_u = unique // WORD_SLOTS, unique % WORD_SLOTS
    slots_at = np.searchsorted(doc_u, np.arange(n + 1))
    size = np.diff(starts).astype(np.float64)
    of = np.repeat(np.arange(n), np.diff(starts))
    kinds = np.bincount(of * 6 + _CLASS[body], minlength=6 * n).reshape(n, 6)[:, 1:]
    bars = np.bincount(of[body == 124], minlength=n)
    begin, end, tokens_at = runs(body, starts, ~_SPACE)
    n_tokens = np.diff(tokens_at).astype(np.float64)
    n_words = np.diff(at).astype(np.float64)
    # A token that has letters and more than one other character at its end is marked up or shouted.
    tail = np.zeros(len(begin), bool)
    if len(begin):
        tail = (end - begin > 2) & (_CLASS[body[end - 1]] == 5) & (_CLASS[body[np.maximum(end - 2, 0)]] == 5)
    token_doc = np.repeat(np.arange(n), np.diff(tokens_at))
    tails = np.bincount(token_doc[tail], minlength=n)
    total = np.maximum(size, 1.0)[:, None]
    dense = np.concatenate([
        kinds / total, (bars / total[:, 0])[:, None], (tails / np.maximum(n_tokens, 1))[:, None],
        (size / np.maximum(n_tokens, 1))[:, None].clip(0, 40) / 10, np.log1p(n_tokens)[:, None] / 5,
        (np.diff(slots_at) / np.maximum(n_words, 1))[:, None], (n_words / np.maximum(n_tokens, 1))[:, None].clip(0, 3),
    ], axis=1)
    return dense, slot_u, slots_at


def metadata_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Slots of each row: language, source, both, and length by powers of the square root of two."""
    def slot(*parts: object) -> int:
        return zlib.crc32("\x1f".join(map(str, parts)).encode()) % META_SLOTS

    out = np.empty((len(lang), 4), np.int64)
    for i, (a, b, n) in enumerate(zip(lang, source, n_chars)):
        out[i] = slot("l", a), slot("s", b), slot("b", a, b), slot("n", "none" if n is None else int(2 * np.log2(max(0, n) + 1)))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Coefficients and, last, the constant of a logistic function, by accelerated gradient descent."""
    return _fit_with_constant(np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(np.float64, copy=False), y, weight, l2, steps)


def _fit_with_constant(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 400) -> np.ndarray:
    """``fit_logistic`` of a matrix whose last column is one, which is read where it stands."""
    weight = weight / weight.sum()
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 0.0
    # A bound of the curvature: the greatest eigenvalue of the second moments, by power iteration.
    v = np.ones(x.shape[1])
    for _ in range(20):
        v = x.T @ (weight * (x @ v))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1.0 / (0.25 * 1.1 * float(v @ (x.T @ (weight * (x @ v)))) + l2 + 1e-9)
    w = z = np.zeros(x.shape[1])
    for i in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ z, -40, 40)))
        after = z - step * (x.T @ (weight * (p - y)) + penalty * z)
        z = after + i / (i + 3) * (after - w)
        w = after
    return w


@dataclass
class ContentView:
    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def matrix(self, dense: np.ndarray, slots: np.ndarray, at: np.ndarray, constant: bool = False) -> np.ndarray:
        """Scaled dense features, their squares and the words kept; with ``constant``, a last column of ones."""
        z = ((dense - self.mean) / self.scale).clip(-8, 8)
        place = np.searchsorted(self.slots, slots)
        place_safe = np.minimum(place, max(0, len(self.slots) - 1))
        hit = self.slots[place_safe] == slots if len(self.slots) else np.zeros(len(slots), bool)
        n = z.shape[1]
        x = np.zeros((len(dense), 2 * n + len(self.slots) + constant))
        x[:, :n], x[:, n:2 * n] = z, z * z / 4
        doc = np.repeat(np.arange(len(dense)), np.diff(at))
        x[doc[hit], 2 * n + place[hit]] = 1.0
        if constant:
            x[:, -1] = 1.0
        return x

    def margin(self, dense: np.ndarray, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.matrix(dense, slots, at) @ self.weights[:-1] + self.weights[-1]

    @classmethod
    def fit(cls, dense: np.ndarray, slots: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "ContentView":
        doc = np.repeat(np.arange(len(dense)), np.diff(at))
        positive = np.bincount(slots[y[doc] == 1], minlength=WORD_SLOTS).astype(np.float64)
        every = np.bincount(slots, minlength=WORD_SLOTS).astype(np.float64)
        n1, n = float((y == 1).sum()), float(len(y))
        share = every / n
        spread = np.sqrt(np.maximum(share * (1 - share) * (1 / n1 + 1 / (n - n1)), 1e-12))
        z = np.abs(positive / n1 - (every - positive) / (n - n1)) / spread
        # Words whose link with the class no chance explains, the strongest first.
        good = np.flatnonzero((z >= 4.5) & (every >= 3))
        good = np.sort(good[np.argsort(-z[good], kind="stable")][:MOST_WORDS])
        view = cls(good, dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6))
        view.weights = _fit_with_constant(view.matrix(dense, slots, at, constant=True), y, weight)
        return view


@dataclass
class CoTrained:
    """Fitted views, their calibrations (slope, constant), the joint function and the cut."""

    content: ContentView
    metadata: np.ndarray
    calibration: np.ndarray  # content slope, constant, metadata slope, constant, joint: content, metadata, constant
    trained: bool


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _meta_matrix(slots: np.ndarray) -> np.ndarray:
    """The slots of each row as ones, and a last column of ones."""
    x = np.zeros((len(slots), META_SLOTS + 1))
    x[np.arange(len(slots))[:, None], slots] = 1.0
    x[:, -1] = 1.0
    return x


def _margins(model: CoTrained, body: np.ndarray, starts: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    c = np.concatenate([
        model.content.margin(*content_features(body[starts[a]:starts[b]], starts[a:b + 1] - starts[a])) for a, b in row_chunks(starts)
    ]) if len(starts) > 1 else np.zeros(0)
    return c, model.metadata[meta].sum(axis=1) + model.metadata[-1]


def _collected(rows: pa.Table) -> tuple:
    """Features of a bounded table of documents, in an order that no shuffle changes."""
    order = np.lexsort((rows.column("id").fill_null(-1).to_numpy(), rows.column("h").to_numpy()))
    # Texts are read where they stand; only their features are put in order.
    parts = []
    for chunk in rows.column("text").chunks:
        body, starts = text_bytes(chunk)
        parts += [content_features(body[starts[a]:starts[b]], starts[a:b + 1] - starts[a]) for a, b in row_chunks(starts)]
    dense = np.concatenate([p[0] for p in parts])[order]
    at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[2]) for p in parts]))])
    slots, at = _take(np.concatenate([p[1] for p in parts]), at, order)
    rows = rows.drop_columns(["text"]).take(pa.array(order))
    meta = metadata_features(*(rows.column(c).to_pylist() for c in ("lang", "source", "n_chars")))
    y = rows.column("y").to_numpy().astype(np.float64)
    return dense, slots, at, meta, y, rows.column("held").to_numpy(), rows.column("origin").to_numpy()


def _take(slots: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(at)[which]
    new_at = np.concatenate([[0], np.cumsum(size)])
    return slots[np.repeat(at[:-1][which] - new_at[:-1], size) + np.arange(new_at[-1])], new_at


def _sure(margin: np.ndarray, y: np.ndarray, right: float, least: int = 30) -> tuple[float, float]:
    """Margins from which a view is sure of either class: held-out rows beyond them were right as often as asked."""
    order = np.argsort(margin, kind="stable")
    m, t = margin[order], y[order]
    low = high = np.inf
    bad = np.cumsum(t) / np.arange(1, len(t) + 1)  # wrong ones among the lowest
    ok = np.flatnonzero((bad <= 1 - right) & (np.arange(1, len(t) + 1) >= least))
    low = m[ok[-1]] if len(ok) else -np.inf
    wrong = np.cumsum((1 - t)[::-1]) / np.arange(1, len(t) + 1)
    ok = np.flatnonzero((wrong <= 1 - right) & (np.arange(1, len(t) + 1) >= least))
    high = m[::-1][ok[-1]] if len(ok) else np.inf
    return float(low), float(max(high, low))


def _fit_task(right: float, pseudo_weight: float):
    """Fit both views on a bounded table; the answer is one row of packed arrays."""
    def run(rows: pa.Table) -> pa.Table:
        dense, slots, at, meta, y, held, origin = _collected(rows)
        given = origin == 0
        # Origin 1: the metadata view was sure, for the content view. Origin 2: the other way.
        empty = pa.table([pa.array([b""], pa.binary())], names=["model"])
        train = given & ~held
        if min((y[train] == 1).sum(), (y[train] == 0).sum()) < LEAST_CLASS or min((y[given & held] == 1).sum(), (y[given & held] == 0).sum()) < 2:
            return empty

        def balanced(of: np.ndarray) -> np.ndarray:
            return np.where(origin[of] == 0, 1.0, pseudo_weight)

        for_content = np.flatnonzero(train | (origin == 1))
        view = ContentView.fit(dense[for_content], *_take(slots, at, for_content), y[for_content], balanced(for_content))
        for_meta = np.flatnonzero(train | (origin == 2))
        metadata = _fit_with_constant(_meta_matrix(meta[for_meta]), y[for_meta], balanced(for_meta), l2=1e-2)
        test = np.flatnonzero(given & held)
        c = view.margin(dense[test], *_take(slots, at, test))
        m = metadata[meta[test]].sum(axis=1) + metadata[-1]
        one = np.ones(len(test))
        scale_c = fit_logistic(c[:, None].clip(-20, 20), y[test], one, l2=1e-2)
        scale_m = fit_logistic(m[:, None].clip(-20, 20), y[test], one, l2=1e-2)
        both = np.stack([c.clip(-20, 20) * scale_c[0] + scale_c[1], m.clip(-20, 20) * scale_m[0] + scale_m[1]], axis=1)
        joint = fit_logistic(both, y[test], one, l2=1e-3)
        sure = np.array([*_sure(c, y[test], right), *_sure(m, y[test], right)])
        blob = pack(view.slots, view.mean, view.scale, view.weights, metadata, np.concatenate([scale_c, scale_m, joint]), sure)
        del dense, slots, at, meta, y, held, origin
        give_back()
        return pa.table([pa.array([blob], pa.binary())], names=["model"])

    return run


def _unpacked(blob: bytes | None) -> tuple[CoTrained, np.ndarray]:
    if not blob:
        return CoTrained(ContentView(), np.zeros(META_SLOTS + 1), np.zeros(7), False), np.array([-np.inf, np.inf, -np.inf, np.inf])
    slots, mean, scale, weights, metadata, calibration, sure = unpack(blob)
    return CoTrained(ContentView(slots, mean, scale, weights), metadata, calibration, True), sure


def _read(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The columns that the views read; metadata that ``docs`` lacks is null."""
    given = {c.lower(): c for c in docs.columns}
    meta = (("lang", "string"), ("source", "string"), ("n_chars", "long"))
    return [
        quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"),
        *((quoted(given[name]) if name in given else F.lit(None)).cast(kind).alias(name) for name, kind in meta),
    ]


def fit_cotraining(
    docs: DataFrame, labels: DataFrame, rounds: int = 2, max_labelled: int = 12_000, max_pseudo: int = 6_000,
    right: float = 0.98, pseudo_weight: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
) -> CoTrained:
    """Co-train on ``labels`` (id, quality, toxic): good is quality 1 and not toxic; rows without quality are unlabelled.

    A fourth of the labelled documents, by hash, is held out of all fits for confidence and calibration. Several labels of a
    document are good only if all are. With fewer than ten documents of either class the result is not trained and scores 1.
    """
    rows = docs.select(*_read(docs, id_col, text_col))
    toxic = F.coalesce(quoted("toxic").cast("int"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    good = labels.where(quoted("quality").isNotNull() & quoted(id_col).isNotNull()).groupBy(quoted(id_col).cast("long").alias("id")).agg(
        F.min(F.when((quoted("quality").cast("int") == 1) & (toxic == 0), 1).otherwise(0)).alias("y")
    )
    key = F.xxhash64("id", F.lit("cotrain"))
    # Only ids are shuffled. The sample's ids are few enough to be broadcast, at most ``max_labelled`` pairs of numbers, so
    # that texts stay where they are read.
    sample = durable(good.join(rows.select("id"), "id", "left_semi").withColumn("h", key).orderBy("h", "id").limit(max_labelled))
    labelled = (
        rows.join(F.broadcast(sample), "id").withColumn("held", F.pmod(F.col("h"), F.lit(4)) == 0).withColumn("origin", F.lit(0))
    )
    labelled = durable(labelled.select(*rows.columns, "y", "h", "held", "origin").orderBy("h", "id", F.xxhash64("text")).limit(max_labelled))

    def fit(table: DataFrame) -> tuple[CoTrained, np.ndarray]:
        found = table.withColumn("task", F.pmod("h", F.lit(1))).groupBy("task").applyInArrow(_fit_task(right, pseudo_weight), "model binary").collect()
        return _unpacked(found[0][0] if found else None)

    model, sure = fit(labelled)
    for _ in range(rounds if model.trained else 0):
        fixed, bounds = model, sure

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                body, starts = text_bytes(batch.column(1))
                meta = metadata_features(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
                c, m = _margins(fixed, body, starts, meta)
                by_c = np.where(c >= bounds[1], 1, np.where(c <= bounds[0], 0, -1))
                by_m = np.where(m >= bounds[3], 1, np.where(m <= bounds[2], 0, -1))
                # One that only one view is sure of teaches the other; in a quarrel nobody learns.
                origin = np.where((by_m >= 0) & (by_c < 0), 1, np.where((by_c >= 0) & (by_m < 0), 2, 0))
                y = np.where(origin == 1, by_m, by_c)
                which = np.flatnonzero(origin)
                picked = batch.select([0]).take(pa.array(which))
                yield pa.RecordBatch.from_arrays(
                    [picked.column(0), pa.array(y[which], pa.int32()), pa.array(origin[which], pa.int32())], ["id", "y", "origin"]
                )

        judged = rows.where("id is not null").mapInArrow(freeing(judge), "id bigint, y int, origin int")
        told = judged.join(good.select("id"), "id", "left_anti").withColumn("h", key)
        # As many of each class and origin, by hash.
        chosen = None
        told = durable(told)
        for origin in (1, 2):
            for y in (0, 1):
                part = told.where((F.col("origin") == origin) & (F.col("y") == y)).orderBy("h", "id").limit(max_pseudo // 4)
                chosen = part if chosen is None else chosen.unionByName(part)
        pseudo = rows.join(F.broadcast(chosen.dropDuplicates(["id"])), "id").withColumn("held", F.lit(False))
        pseudo = pseudo.select(labelled.columns).orderBy("h", "id", F.xxhash64("text")).limit(max_pseudo)
        model, sure = fit(labelled.unionByName(pseudo))
        if not model.trained:
            model, sure = fixed, bounds
    return model


def score_documents(docs: DataFrame, model: CoTrained, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """(id, content_score, metadata_score, score) of every row: calibrated probabilities that it is good; then ``extra`` columns.

    Null text is empty. Without lang, source or n_chars columns, or where they are null, the metadata view takes them as
    unknown. An untrained model scores 1. An empty table gives an empty result.
    """
    names = [f"extra_{i}" for i in range(len(extra or []))]
    rows = docs.select(*_read(docs, id_col, text_col), *[quoted(c).alias(n) for c, n in zip(extra or [], names)])
    passed = [f for f in rows.schema.fields if f.name in names]
    # The text goes to the tasks once, even if it is passed on.
    again = [n for c, n in zip(extra or [], names) if c == text_col and rows.schema[n].dataType == rows.schema["text"].dataType]
    rows = rows.drop(*again)
    place = {n: rows.columns.index("text" if n in again else n) for n in names}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, c_, d, j1, j2, j0 = model.calibration
        for batch in batches:
            body, starts = text_bytes(batch.column(1))
            if model.trained:
                meta = metadata_features(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
                content, metadata = _margins(model, body, starts, meta)
                content, metadata = content.clip(-20, 20) * a + b, metadata.clip(-20, 20) * c_ + d
                joint = content * j1 + metadata * j2 + j0
                scores = [_sigmoid(content), _sigmoid(metadata), _sigmoid(joint)]
            else:
                scores = [np.ones(batch.num_rows)] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, scores), *(batch.column(place[n]) for n in names)], ["id", "content_score", "metadata_score", "score", *names]
            )

    schema = "id bigint, content_score double, metadata_score double, score double" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in passed)
    return rows.mapInArrow(freeing(run), schema)

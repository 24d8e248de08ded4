"""Gradient boosting of several classes at once, by histograms of gradients.

In a round every class gets a tree. One pass over the rows sums gradients and hessians of all classes by (class, node, slot,
bin); the sums are the only thing that leaves the tasks, their number is set by parameters alone, and the driver picks the
best cut of each node from them. A tree of depth d takes d passes, whatever the number of classes. Rows are stored once as
bins; what earlier trees say of a row is worked out again in each pass, so nothing is written between rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.models import SCORERS, Fit, Fitted, normalised
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_BINS = 255


def _cuts(df: DataFrame, slots: int, bins: int) -> list[np.ndarray]:
    """Per slot the values that part its rows into at most ``bins`` about equal bins; few different values part exactly."""
    shares = [i / bins for i in range(1, bins)] + [1.0]
    row = df.agg(*[F.percentile_approx(F.get("x", F.lit(i)), shares, 10_000).alias(f"c{i}") for i in range(slots)]).first()
    return [np.unique(np.array(row[f"c{i}"] or [], dtype=np.float64)) for i in range(slots)]


def _node_of(bins: np.ndarray, slot: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after ``levels`` levels of one tree, counted from the left; a node without a cut sends all left."""
    node = np.zeros(len(bins), dtype=np.int64)
    for level in range(levels):
        at = node + 2**level - 1
        node = 2 * node + (bins[np.arange(len(bins)), slot[at]] > cut[at])
    return node


def _shares(bins: np.ndarray, trees: list, depth: int, k: int) -> np.ndarray:
    score = np.zeros((len(bins), k))
    for of_round in trees:
        for c, (slot, cut, leaf) in enumerate(of_round):
            score[:, c] += leaf[_node_of(bins, slot, cut, depth)]
    score = np.exp(score - score.max(axis=1, keepdims=True))
    return score / score.sum(axis=1, keepdims=True)


def boosting(rounds: int = 10, depth: int = 3, step: float = 0.1, bins: int = 32, penalty: float = 1.0) -> Fit:
    """Softmax boosting; a leaf is worth ``-step * G / (H + penalty)``. Equal gains go to the first slot and the lowest cut."""
    if not 2 <= bins <= MOST_BINS:
        raise ValueError(f"bins must be from 2 to {MOST_BINS}")

    def fit(df: DataFrame, k: int) -> Fitted:
        weight = F.col("weight").cast("double") if "weight" in df.columns else F.lit(1.0)
        rows = df.select(vector_to_array("features").alias("x"), F.col("y").cast("int").alias("y"), weight.alias("w"))
        slots = len(rows.first()["x"])
        cuts = _cuts(rows, slots, bins)

        def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, slots)
                out = np.stack([np.searchsorted(cuts[i], x[:, i]) for i in range(slots)], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in out], pa.binary()), batch.column(1), batch.column(2)], names=["b", "y", "w"])

        binned = durable(rows.mapInArrow(to_bins, "b binary, y int, w double"))
        size = bins + 1

        def sums(trees: list, growing: list, level: int) -> tuple[np.ndarray, np.ndarray]:
            """Gradients and hessians by class, node of the level, slot and bin."""
            shape = (k, 2**level, slots, size)

            def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                g, h = np.zeros(shape), np.zeros(shape)
                for batch in batches:
                    b = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint8).reshape(-1, slots).astype(np.int64)
                    y, w = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                    p = _shares(b, trees, depth, k)
                    for c in range(k):
                        node = _node_of(b, *growing[c], level)
                        at = ((node[:, None] * slots + np.arange(slots)) * size + b).reshape(-1)
                        n = 2**level * slots * size
                        for out, value in ((g, w * (p[:, c] - (y == c))), (h, w * p[:, c] * (1 - p[:, c]))):
                            out[c] += np.bincount(at, weights=np.repeat(value, slots), minlength=n).reshape(shape[1:])
                some = np.flatnonzero(h.reshape(-1))
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(g.reshape(-1)[some]), pa.array(h.reshape(-1)[some])], names=["at", "g", "h"])

            found = binned.mapInArrow(add, "at bigint, g double, h double").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            told = found.toPandas()  # at most k * nodes * slots * bins rows
            g, h = np.zeros(int(np.prod(shape))), np.zeros(int(np.prod(shape)))
            g[told["at"].to_numpy()], h[told["at"].to_numpy()] = told["g"].to_numpy(), told["h"].to_numpy()
            return g.reshape(shape), h.reshape(shape)

        trees, gains = [], np.zeros(slots)
        for _ in range(rounds):
            nodes = 2**depth - 1
            growing = [(np.zeros(nodes, np.int64), np.full(nodes, size, np.int64)) for _ in range(k)]
            leaves = [np.zeros(2**depth) for _ in range(k)]
            for level in range(depth):
                g, h = sums(trees, growing, level)
                for c in range(k):
                    for node in range(2**level):
                        left_g, left_h = g[c, node].cumsum(axis=1)[:, :-1], h[c, node].cumsum(axis=1)[:, :-1]
                        all_g, all_h = g[c, node, 0].sum(), h[c, node, 0].sum()
                        right_g, right_h = all_g - left_g, all_h - left_h
                        gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - all_g**2 / (all_h + penalty)
                        gain = np.where((left_h > 1e-12) & (right_h > 1e-12), gain, -np.inf)
                        # Rounded, so that equal gains are equal whatever the order of their sums.
                        best = int(np.argmax(np.round(gain, 9)))
                        slot, cut = divmod(best, gain.shape[1])
                        ends = [-step * all_g / (all_h + penalty)] * 2
                        if gain.reshape(-1)[best] > 1e-9:
                            growing[c][0][2**level - 1 + node], growing[c][1][2**level - 1 + node] = slot, cut
                            gains[slot] += gain.reshape(-1)[best]
                            ends = [-step * left_g[slot, cut] / (left_h[slot, cut] + penalty), -step * right_g[slot, cut] / (right_h[slot, cut] + penalty)]
                        if level == depth - 1:
                            leaves[c][2 * node:2 * node + 2] = ends
            trees.append([(*growing[c], leaves[c]) for c in range(k)])

        told = [float(depth), float(rounds)]
        for of_round in trees:
            for slot, cut, leaf in of_round:
                values = [cuts[s][b] if b < len(cuts[s]) else np.inf for s, b in zip(slot, cut)]
                told += [*map(float, slot), *map(float, values), *map(float, leaf)]
        importances = (gains / gains.sum()).tolist() if gains.sum() else [0.0] * slots
        return Fitted(k, SCORERS["trees"]([], told, k), importances, [], "trees", told)

    return fit


def _by_trees(parts: list, told: list[float], k: int):
    """Score with the trees written out as numbers: per tree its slots, its cuts and its leaves, in the order of rounds and classes."""
    depth, rounds = int(told[0]), int(told[1])
    nodes = 2**depth - 1

    def value(x: Column, slot: list, cut: list, leaf: list, node: int, level: int) -> Column:
        at = node + 2**level - 1
        if level == depth:
            return F.lit(leaf[node])
        left = value(x, slot, cut, leaf, 2 * node, level + 1)
        if cut[at] == float("inf"):
            return left
        return F.when(F.get(x, F.lit(int(slot[at]))) <= cut[at], left).otherwise(value(x, slot, cut, leaf, 2 * node + 1, level + 1))

    def add(table: DataFrame) -> DataFrame:
        x, at, scores = F.col("_x"), 2, [F.lit(0.0)] * k
        for _ in range(rounds):
            for c in range(k):
                slot, cut, leaf = told[at:at + nodes], told[at + nodes:at + 2 * nodes], told[at + 2 * nodes:at + 2 * nodes + 2**depth]
                scores[c] = scores[c] + value(x, slot, cut, leaf, 0, 0)
                at += 2 * nodes + 2**depth
        scored = table.withColumn("_x", vector_to_array("features")).withColumn("_scores", F.array(*scores))
        top = F.array_max("_scores")
        return scored.select(*table.columns, normalised(F.transform("_scores", lambda s: F.exp(s - top)), k).alias("probs"))

    return add


SCORERS["trees"] = _by_trees

"""Approximate nearest neighbours by largest inner product, over one navigable small-world graph for each shard.

Different vectors are dealt over shards by hash; copies of a vector are one node with the least ids that any result can
need, so a vector that a third of all rows share is one node. In a task, each shard becomes a hierarchy of graphs held in
flat neighbour arrays: every node is in the bottom layer, ever fewer reach the layers above. Vectors get one further
component that makes all of equal length, so that the nearest by distance are the ones with the largest product. Nodes
are inserted in batches that search the graph so far together; neighbours are chosen by the diversity rule.

A search descends from the top layer to a beam over the bottom one, for a block of queries at a time. What each shard
finds is scored in double precision on the original vectors, and the best over all shards stay.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import mix, quoted
from rowloom.llm.suffix_dedup import pack, unpack
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_VECTORS = 8192
QUERY_BLOCK = 4096
BATCH = 256
EXPAND = 4


def _distances(of: np.ndarray, to: np.ndarray, to_square: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``of`` (q, d) to their own candidates ``to`` (q, c, d), up to a constant of each row."""
    return to_square - 2.0 * np.einsum("qcd,qd->qc", to, of, optimize=False)


class Layer:
    """One layer: the nodes that reach it, and ``width`` neighbours of each in a flat array (-1: none)."""

    def __init__(self, nodes: np.ndarray, total: int, width: int):
        self.nodes, self.width = nodes, width
        self.place = np.full(total, -1, np.int32)
        self.place[nodes] = np.arange(len(nodes), dtype=np.int32)
        self.near = np.full((len(nodes), width), -1, np.int32)


class Graph:
    def __init__(self, vectors: np.ndarray, layers: list[Layer]):
        self.x, self.layers = vectors, layers
        self.square = (vectors * vectors).sum(axis=1)

    def beam(self, queries: np.ndarray, layer: Layer, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest nodes found for each query in ascending distance; -1 where fewer were found."""
        q = len(queries)
        ids = np.full((q, ef), -1, np.int32)
        dist = np.full((q, ef), np.inf, np.float32)
        done = np.ones((q, ef), bool)
        seen = np.zeros((q, len(self.x)), bool)
        k = min(ef, entry.shape[1])
        first = _distances(queries, self.x[np.maximum(entry, 0)], self.square[np.maximum(entry, 0)])
        first[entry < 0] = np.inf
        order = np.argsort(first, axis=1, kind="stable")[:, :k]
        ids[:, :k] = np.take_along_axis(entry, order, 1)
        dist[:, :k] = np.take_along_axis(first, order, 1)
        done[:, :k] = ids[:, :k] < 0
        row = np.arange(q)[:, None]
        seen[np.broadcast_to(row, entry.shape)[entry >= 0], entry[entry >= 0]] = True
        active = np.arange(q)
        while len(active):
            d = np.where(done[active], np.inf, dist[active])
            pick = np.argsort(d, axis=1, kind="stable")[:, :EXPAND]
            chosen = np.isfinite(np.take_along_axis(d, pick, 1))
            some = chosen.any(axis=1)
            active, pick, chosen = active[some], pick[some], chosen[some]
            if not len(active):
                break
            node = np.where(chosen, ids[active[:, None], pick], -1)
            r, c = np.nonzero(chosen)
            done[active[r], pick[r, c]] = True
            near = np.where(node[:, :, None] >= 0, layer.near[layer.place[np.maximum(node, 0)]], -1).reshape(len(active), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[(near >= 0) & seen[active[:, None], np.maximum(near, 0)]] = -1
            r, c = np.nonzero(near >= 0)
            seen[active[r], near[r, c]] = True
            new = np.full(near.shape, np.inf, np.float32)
            if len(r):
                to = near[r, c]
                new[r, c] = self.square[to] - 2.0 * np.einsum("nd,nd->n", self.x[to], queries[active[r]])
            all_d = np.concatenate([dist[active], new], axis=1)
            all_i = np.concatenate([ids[active], near], axis=1)
            all_done = np.concatenate([done[active], near < 0], axis=1)
            keep = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
            dist[active] = np.take_along_axis(all_d, keep, 1)
            ids[active] = np.take_along_axis(all_i, keep, 1)
            done[active] = np.take_along_axis(all_done, keep, 1)
        ids[~np.isfinite(dist)] = -1
        return ids, dist

    def entries(self, queries: np.ndarray, above: int) -> np.ndarray:
        """Entry nodes for the layer below ``above`` layers, by a narrow search of each layer from the top."""
        top = self.layers[0].nodes
        entry = np.broadcast_to(top[:8].astype(np.int32), (len(queries), min(8, len(top))))
        for layer in self.layers[:above]:
            entry, _ = self.beam(queries, layer, entry, 8)
        return entry

    def choose(self, of: np.ndarray, candidates: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` of each node's candidates: nearest first, passing over those nearer to one chosen before;
        what room is left goes to the nearest passed over."""
        n, c = candidates.shape
        safe = np.maximum(candidates, 0)
        vectors = self.x[safe]
        dist = self.square[of][:, None] + _distances(self.x[of], vectors, self.square[safe])
        dist[(candidates < 0) | (candidates == of[:, None])] = np.inf
        order = np.argsort(dist, axis=1, kind="stable")
        dist, candidates = np.take_along_axis(dist, order, 1), np.take_along_axis(candidates, order, 1)
        vectors = np.take_along_axis(vectors, order[:, :, None], 1)
        square = np.take_along_axis(self.square[safe], order, 1)
        between = square[:, :, None] + square[:, None, :] - 2.0 * np.matmul(vectors, vectors.transpose(0, 2, 1))
        chosen = np.zeros((n, c), bool)
        closest = np.full((n, c), np.inf, np.float32)
        for k in range(c):
            take = np.isfinite(dist[:, k]) & (dist[:, k] < closest[:, k]) & (chosen.sum(axis=1) < width)
            chosen[:, k] = take
            closest[take] = np.minimum(closest[take], between[take, k])
        rank = np.where(np.isfinite(dist), np.where(chosen, 0, 1), 2) * c + np.arange(c)
        best = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.where(np.isfinite(np.take_along_axis(dist, best, 1)), np.take_along_axis(candidates, best, 1), -1)
        return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1).astype(np.int32)

    def fill(self, number: int, ef: int) -> None:
        """Insert all nodes of a layer, the layers above being complete."""
        layer = self.layers[number]
        nodes, width = layer.nodes, layer.width
        at = 0
        while at < len(nodes):
            # A batch never outgrows what it searches.
            batch = nodes[at:at + min(BATCH, max(32, at))]
            own = self.x[batch]
            inside = self.square[batch][None, :] - 2.0 * own @ own.T
            np.fill_diagonal(inside, np.inf)
            k = min(len(batch) - 1, width)
            mates = batch[np.argsort(inside, axis=1, kind="stable")[:, :k]] if k > 0 else np.zeros((len(batch), 0), np.int64)
            if at:
                entry = self.entries(own, number) if number else np.broadcast_to(nodes[:1].astype(np.int32), (len(batch), 1))
                entry = np.where(layer.place[np.maximum(entry, 0)] < at, entry, -1)
                entry = np.concatenate([entry, np.full((len(batch), 1), nodes[0], np.int32)], axis=1)
                found, _ = self.beam(own, layer, entry, ef)
                candidates = np.concatenate([found[:, : 2 * width], mates], axis=1)
            else:
                candidates = mates
            near = self.choose(batch, candidates.astype(np.int64), width // 2 if at else width)
            layer.near[at:at + len(batch), : near.shape[1]] = near
            # The way back, for nodes that got new neighbours.
            r, c = np.nonzero(near >= 0)
            to, new = near[r, c], batch[r]
            order = np.argsort(to, kind="stable")
            to, new = to[order], new[order]
            who, first, count = np.unique(to, return_index=True, return_counts=True)
            most = int(count.max()) if len(count) else 0
            if most:
                for begin in range(0, len(who), BATCH):
                    part = slice(begin, begin + BATCH)
                    wide = int(count[part].max())
                    extra = np.full((len(who[part]), wide), -1, np.int64)
                    owner = np.repeat(np.arange(len(who[part])), count[part])
                    extra[owner, np.arange(len(owner)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])] = new[
                        first[part][0]:first[part][0] + len(owner)
                    ]
                    old = layer.near[layer.place[who[part]]].astype(np.int64)
                    both = np.concatenate([old, extra], axis=1)
                    both.sort(axis=1)
                    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
                    if both.shape[1] > 3 * width:  # only the nearest compete, else a hub would compare all with all
                        d = _distances(self.x[who[part]], self.x[np.maximum(both, 0)], self.square[np.maximum(both, 0)])
                        d[both < 0] = np.inf
                        both = np.take_along_axis(both, np.argsort(d, axis=1, kind="stable")[:, : 3 * width], 1)
                    layer.near[layer.place[who[part]]] = self.choose(who[part].astype(np.int64), both, width)
            at += len(batch)


def build(vectors: np.ndarray, keys: np.ndarray, width: int, ef: int) -> Graph:
    """The hierarchy over augmented vectors; the layers that a node reaches follow from its key."""
    square = (vectors * vectors).sum(axis=1)
    x = np.concatenate([vectors, np.sqrt(np.maximum(square.max() - square, 0.0))[:, None]], axis=1).astype(np.float32)
    chance = (mix(keys.view(np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    level = np.minimum(np.floor(-np.log(np.maximum(chance, 1e-300)) / np.log(width // 2)), 8).astype(int)
    order = np.lexsort((keys, -level))
    layers = []
    for at in range(int(level.max()), -1, -1):
        layers.append(Layer(order[level[order] >= at], len(x), width if at else 2 * width))
    graph = Graph(x, layers)
    for number in range(len(layers)):
        graph.fill(number, ef)
    return graph


def _stack(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _index(dim: int, width: int, ef: int):
    def run(rows: pa.Table) -> pa.Table:
        vectors = _stack(rows.column("vec"), dim).astype(np.float64)
        ids = rows.column("ids").combine_chunks()
        first = np.array([v[0] for v in ids.to_pylist()], np.int64)
        order = np.argsort(first, kind="stable")  # an order that no shuffle changes
        vectors = vectors[order]
        ids = ids.take(pa.array(order))
        graph = build(vectors, first[order], width, ef)
        many = ids.value_lengths().to_numpy().astype(np.int32)
        parts = [graph.x.reshape(-1), vectors.reshape(-1), many, ids.flatten().to_numpy(), np.array([len(la.nodes) for la in graph.layers])]
        for layer in graph.layers:
            parts += [layer.nodes.astype(np.int32), layer.near.reshape(-1)]
        return pa.table([rows.column("shard").slice(0, 1), pa.array([pack(*parts)], pa.binary())], names=["shard", "graph"])

    return run


def _search(dim: int, k: int, width: int, ef: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key: tuple[pa.Scalar, ...], index: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if index.num_rows and rows.num_rows:
            parts = unpack(index.column("graph")[0].as_py())
            x, vectors = parts[0].reshape(-1, dim + 1), parts[1].reshape(-1, dim)
            at = np.concatenate([[0], np.cumsum(parts[2])])
            ids, sizes = parts[3], parts[4]
            layers = []
            for i, n in enumerate(sizes.tolist()):
                layer = Layer(parts[5 + 2 * i].astype(np.int64), len(x), width if i < len(sizes) - 1 else 2 * width)
                layer.near = parts[6 + 2 * i].reshape(n, layer.width)
                layers.append(layer)
            graph = Graph(x, layers)
            queries = _stack(rows.column("vec"), dim).astype(np.float64)
            query_id = rows.column("query_id").to_numpy()
            for a in range(0, len(queries), BATCH):
                q = queries[a:a + BATCH]
                flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
                found, _ = graph.beam(flat, layers[-1], graph.entries(flat, len(layers) - 1), ef)
                for i, near in enumerate(found):
                    near = near[near >= 0]
                    score = (vectors[near] * q[i]).sum(axis=1)
                    many = at[near + 1] - at[near]
                    flat_at = np.repeat(at[near] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                    vec_id, score = ids[flat_at], np.repeat(score, many)
                    other = vec_id != query_id[a + i]
                    vec_id, score = vec_id[other], score[other]
                    best = np.lexsort((vec_id, -score))[:k]
                    out[0].append(np.full(len(best), query_id[a + i]))
                    out[1].append(vec_id[best])
                    out[2].append(score[best])
        arrays = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table([pa.array(c, f.type) for c, f in zip([arrays[0].astype(np.int64), arrays[1].astype(np.int64), arrays[2]], schema)], schema=schema)

    return run


def nearest_by_product(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 16,
    ef_build: int = 96, ef_search: int = 192, shard_vectors: int = SHARD_VECTORS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` rows of ``vectors`` found nearest, other
    than those of its own id, by largest inner product in double precision; ties go to the smaller id.

    Takes no part: a null id; a vector that is null, zero, or holds null or non-finite components; and one whose number of
    components is not the most frequent (of equally frequent ones, the largest). Rows repeated with id and vector count
    once. Fewer candidates than ``k`` give fewer rows; no candidate or query, no row. Both tables need the two columns
    named; others play no part.
    """
    def usable(df: DataFrame) -> DataFrame:
        vec = quoted(vector_col).cast("array<double>")
        good = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
        return df.select(quoted(id_col).cast("long").alias("id"), vec.alias("vec")).where(F.col("id").isNotNull() & good)

    rows, asked = usable(vectors), usable(queries)
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dim = sizes[0]["n"] if sizes else 1
    rows, asked = rows.where(F.size("vec") == dim), asked.where(F.size("vec") == dim).dropDuplicates(["id", "vec"])
    # Only the k + 1 least ids of equal vectors can be in any result; the limit by rank works before the shuffle, too.
    rows = rows.dropDuplicates(["id", "vec"])
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("r") <= k + 1)
    nodes = durable(ranked.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    shards = max(1, -(-nodes.count() // shard_vectors))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int"))
    index = durable(dealt.groupBy("shard").applyInArrow(_index(dim, width, ef_build), "shard int, graph binary"))
    asked = durable(asked)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    pairs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    spread = asked.select(
        F.col("id").alias("query_id"), "vec", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    found = pairs.groupBy("shard", "block").cogroup(spread.groupBy("shard", "block")).applyInArrow(
        _search(dim, k, width, ef_search), "query_id bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


"""k nearest neighbours: exactly, in rounds over blocks of cells, or by hash tables with exact re-ranking.

Exact: every data row belongs to the cell of its nearest pivot, and cells are packed into blocks, one row a block; the
queries of a cell are packed into chunks alike. Per cell the least and greatest distances to a few reference pivots are
known, so the triangle inequality gives a lower bound for each query and cell. A round lets each chunk visit its next
blocks, nearest cells first, and merges what was found into one list of k rows per query; the k-th distance is carried
to the next round, where it rules out cells and, inside a visited block, all rows beyond it. What is shuffled are packed
chunks and blocks: a query costs a share of a row per block visited. Where nothing can be ruled out (directions spread
evenly in many dimensions) every block is visited, still in bounded memory.

By hash tables: signs of random projections put rows into buckets, several tables of them; a query is compared exactly
with the rows that share a bucket with it in any table. The caller chooses tables and bits, and so the recall.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.keys import hash_hex
from rowloom.operators.sizing import fits, size_of
from rowloom.session import durable

# The functions below travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
BUCKET_ROWS = 16384
CHUNK_ROWS = 1024
LARGEST_CHUNK = 16384
MAX_PIVOTS = 1024
MOST_CELLS = 4096
REFERENCES = 32
MOST_BLOCKS_A_ROUND = 1024
FIRST_ROWS = 256


def _stack(values: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in values])


def _order(metric: str) -> float:
    """The power of the sum that a metric is the root of; infinite where it is the greatest difference."""
    if metric.startswith("minkowski"):
        return float(metric.removeprefix("minkowski"))
    orders = {"euclidean": 2.0, "manhattan": 1.0, "chebyshev": math.inf}
    if metric not in orders:
        raise ValueError(f"unknown metric {metric}")
    return orders[metric]


def _power(gap: np.ndarray, p: float) -> np.ndarray:
    return gap if p in (1, math.inf) else gap * gap if p == 2 else gap * gap * gap if p == 3 else gap**p


def _root(total: np.ndarray, p: float) -> np.ndarray:
    return total if p in (1, math.inf) else np.sqrt(total) if p == 2 else total ** (1 / p)


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between the rows of two small matrices, by differences, in tiles that stay in the cache."""
    p = _order(metric)
    add = np.maximum if p == math.inf else np.add
    out = np.zeros((len(a), len(b)))
    across, along = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    for i in range(0, len(a), 64):
        for j in range(0, len(b), 512):
            total = out[i:i + 64, j:j + 512]
            for x, y in zip(across[:, i:i + 64], along[:, j:j + 512]):
                add(total, _power(np.abs(np.subtract.outer(x, y)), p), out=total)
    return _root(out, p)


def _pairwise(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """The distance of each row of one matrix to the same row of the other. All results come from here."""
    p = _order(metric)
    gap = np.abs(a - b)
    return gap.max(axis=1) if p == math.inf else _root(_power(gap, p).sum(axis=1), p)


class _Sieve:
    """Which rows may lie within a bound of which queries, by one matrix product of single precision.

    Euclidean distances are estimated themselves. For other sums the values of each dimension are cut into bins, and within
    a bin a line lies below the power of the difference to the query's value (it is convex, so any tangent does): rows
    know their bins, queries their lines, and the product sums up the lines. For the greatest difference the product
    counts the dimensions in which a row's bin lies beyond the bound. Nothing within a bound is lost, as the error of
    the product is allowed for; what passes is compared exactly.
    """

    def __init__(self, centres: np.ndarray, metric: str):
        self.p, width = _order(metric), centres.shape[1]
        self.usable = bool(np.isfinite(centres).all())
        bins = 8 if self.p == math.inf else 4
        self.terms = 2 * width + 16
        if not self.usable:
            return
        self.middle = centres.mean(axis=0)
        self.edges = np.quantile(centres, np.arange(1, bins) / bins, axis=0).T
        self.spots = np.quantile(centres, (np.arange(bins) + 0.5) / bins, axis=0).T

    def _bins(self, x: np.ndarray) -> np.ndarray:
        """Whether a value lies in a bin: (row, dimension, bin)."""
        place = np.zeros(x.shape, np.int8)
        for edge in self.edges.T:
            place += x > edge
        return place[:, :, None] == np.arange(self.edges.shape[1] + 1, dtype=np.int8)

    def rows(self, d: np.ndarray) -> np.ndarray | None:
        """What the product needs of rows; none where their values do not allow it."""
        if not self.usable or not np.isfinite(d).all():
            return None
        if self.p == 2:
            moved = d - self.middle
            out = np.column_stack([moved, (moved**2).sum(1)])
        else:
            own = self._bins(d)
            out = own.reshape(len(d), -1) if self.p == math.inf else np.concatenate([own, own * (d[:, :, None] - self.spots)], axis=2).reshape(len(d), -1)
        return out.astype(np.float32) if np.abs(out).max(initial=0) < 1e16 else None

    def asks(self, q: np.ndarray) -> np.ndarray | None:
        """The same of queries; for the greatest difference their values."""
        if not self.usable or not np.isfinite(q).all():
            return None
        if self.p == math.inf:
            return q
        if self.p == 2:
            out = np.column_stack([-2 * (q - self.middle), np.ones(len(q))])
        else:
            out = np.empty((len(q), len(self.spots), 2 * self.spots.shape[1]), np.float32)
            for i in range(0, len(q), 1024):
                part, k = q[i:i + 1024], self.spots.shape[1]
                gap = self.spots - part[:, :, None]
                gap[self._bins(part)] = 0
                rise = _power(np.abs(gap), self.p - 1) if self.p != 1 else np.ones_like(gap)
                out[i:i + 1024, :, :k] = _power(np.abs(gap), self.p)
                out[i:i + 1024, :, k:] = self.p * rise * np.sign(gap)
            out = out.reshape(len(q), -1)
        return out.astype(np.float32, copy=False) if np.abs(out).max(initial=0) < 1e16 else None

    def passes(self, asks: np.ndarray, q: np.ndarray, rows: np.ndarray, size: float, bound: np.ndarray) -> np.ndarray:
        """Whether a row may lie within the bound of a query; ``size`` is the greatest norm of ``rows``."""
        if self.p == math.inf:
            none = np.full((len(self.edges), 1), np.inf)
            low, high = np.hstack([-none, self.edges]), np.hstack([self.edges, none])
            most = (bound * (1 + 1e-9))[:, None, None]
            beyond = (low - q[:, :, None] > most) | (q[:, :, None] - high > most)
            return beyond.reshape(len(q), -1).astype(np.float32) @ rows.T < 0.5
        limit = _power(bound * (1 + 1e-9), self.p)
        own = ((q - self.middle) ** 2).sum(1) if self.p == 2 else np.zeros(len(q))
        error = self.terms * 2.4e-7 * (np.sqrt(np.einsum("ij,ij->i", asks, asks, dtype=np.float64)) * size + limit + own)
        return asks @ rows.T <= (limit - own + error).astype(np.float32)[:, None]


def _nearest_in_block(
    q: np.ndarray, q_id: np.ndarray, d: np.ndarray, d_id: np.ndarray, k: int, metric: str, bound: np.ndarray,
    sieve: _Sieve | None = None, asks: np.ndarray | None = None, rows: np.ndarray | None = None,
) -> tuple:
    """The k nearest rows of one block for each query, none beyond its bound: (query, row, distance), in order.

    A row is not its own neighbour. ``asks`` and ``rows`` are what the sieve needs of both sides, if it is of use.
    """
    keep = min(k + 1, len(d))
    step = max(1, 2_000_000 // max(1, len(d)))
    size = float(np.sqrt((rows.astype(np.float64) ** 2).sum(1).max(initial=0))) if rows is not None else 0.0
    parts = []
    for i in range(0, len(q), step):
        here, most = q[i:i + step], bound[i:i + step]
        passed = None
        if asks is not None and rows is not None and np.isfinite(most).all():
            passed = sieve.passes(asks[i:i + step], here, rows, size, most)
            if np.count_nonzero(passed) > 0.15 * passed.size:
                passed = None
        if passed is None:
            if metric == "euclidean":
                # A fast estimate selects candidates with a margin; the exact distance decides.
                estimate = (here**2).sum(1)[:, None] + (d**2).sum(1)[None, :] - 2.0 * here @ d.T
                limit = most**2
            else:
                estimate, limit = _distances(here, d, metric), most
            margin = 1e-9 * (1.0 + np.abs(estimate).max())
            kth = np.minimum(np.partition(estimate, keep - 1, axis=1)[:, keep - 1], limit)
            passed = estimate <= kth[:, None] + margin
        # Few pass: one flat search is several times faster than one by both axes.
        r, c = np.divmod(np.flatnonzero(passed), len(d))
        other = q_id[i + r] != d_id[c]
        r, c = r[other], c[other]
        some = max(1, 2**16 // max(1, d.shape[1]))
        exact = np.concatenate([_pairwise(here[r[j:j + some]], d[c[j:j + some]], metric) for j in range(0, len(r), some)] or [np.zeros(0)])
        near = exact <= bound[i + r]
        parts.append(_first_of_each(i + r[near], exact[near], d_id[c[near]], k, c[near]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*[(q, row, distance) for q, distance, row in parts]))


def _first_of_each(group: np.ndarray, distance: np.ndarray, ids: np.ndarray, k: int, payload: np.ndarray) -> tuple:
    """The first k rows of each group by distance, then id."""
    order = np.lexsort((ids, distance, group))
    group, distance, payload = group[order], distance[order], payload[order]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
    first = place < k
    return group[first], distance[first], payload[first]


def _nearest_by_parts(q: np.ndarray, q_id: np.ndarray, d: np.ndarray, d_id: np.ndarray, k: int, metric: str) -> tuple:
    """The k nearest rows for each query: (query, row, distance), in order.

    Of more than a block, ``FIRST_ROWS`` rows are ranked; how far the k-th of them is rules out nearly all others by a product of single
    precision, and what passes brings it nearer.
    """
    if len(d) <= BLOCK_ROWS:
        return _nearest_in_block(q, q_id, d, d_id, k, metric, np.full(len(q), np.inf))
    sieve = _Sieve(d[:FIRST_ROWS], metric)
    asks = sieve.asks(q)
    none = np.zeros(0, np.int64)
    query, row, distance, bound = none, none, np.zeros(0), np.full(len(q), np.inf)
    at = 0
    while at < len(d):
        # As many rows as before, so that about k of them lie within the bound.
        end = min(len(d), at + max(FIRST_ROWS, min(at, BLOCK_ROWS)))
        r, c, far = _nearest_in_block(q, q_id, d[at:end], d_id[at:end], k, metric, bound, sieve, asks, sieve.rows(d[at:end]) if at else None)
        both = np.concatenate([query, r]), np.concatenate([distance, far]), np.concatenate([row, c + at])
        query, distance, row = _first_of_each(both[0], both[1], d_id[both[2]], k, both[2])
        full = np.bincount(query, minlength=len(q)) == k
        last = np.cumsum(np.bincount(query, minlength=len(q))) - 1
        bound[full] = distance[last[full]]
        at = end
    return query, row, distance


def _choose_pivots(data: DataFrame, limit: int | None, parts: int) -> np.ndarray:
    """Distinct rows with the smallest hash, about sqrt(n) / 2 of them for n rows a part, and so few that cells stay few."""
    if limit is None:
        limit = min(MAX_PIVOTS, max(1, int(math.sqrt(data.count() / max(1, parts)) / 2)))
    rows = data.select("vec", hash_hex("pivot", "id").alias("h")).orderBy("h").limit(max(1, min(limit, MOST_CELLS // max(1, parts)))).collect()
    return np.unique(np.array([r["vec"] for r in rows], dtype=np.float64), axis=0)


def _raw(matrix: np.ndarray) -> bytes:
    """The numbers in single precision where that loses nothing, so that half as much is shuffled, else in double."""
    with np.errstate(over="ignore"):
        single = matrix.astype(np.float32)
    return single.tobytes() if (single == matrix).all() else matrix.tobytes()


def _matrix(raw: bytes, rows: int, slots: int) -> np.ndarray:
    """What ``_raw`` packed, in double precision."""
    kind = np.float32 if len(raw) == 4 * rows * slots else np.float64
    return np.frombuffer(raw, dtype=kind).reshape(rows, slots).astype(np.float64, copy=False)


def _unpacked(column: pd.Series, slots: int) -> np.ndarray:
    """The rows that ``_raw`` packed one by one, in double precision."""
    sizes = column.str.len().to_numpy()
    out = np.empty((len(column), slots))
    for size in np.unique(sizes):
        some = np.flatnonzero(sizes == size)
        out[some] = _matrix(b"".join(column.iloc[some]), len(some), slots)
    return out


class _Cells:
    """What is known of the cells of one part: blocks, greatest distance to the own pivot, rings around the references."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["cell"])
        self.cell = np.array([r["cell"] for r in rows])
        self.blocks = np.array([r["blocks"] for r in rows])
        self.radius = np.array([r["radius"] for r in rows])
        self.reach = np.array([np.inf if r["reach"] is None else r["reach"] for r in rows])
        self.low, self.high = np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])


def _bounds(q: np.ndarray, carried: np.ndarray, cells: _Cells, centres: np.ndarray, between: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """For each query and cell a distance that no row of the cell is nearer than; and for each query one that its k-th
    neighbour is not beyond: the carried one, or that of a cell whose first rows lie near enough to its pivot."""
    gaps = _distances(q, centres, metric)
    mine = gaps[:, cells.cell]
    out = np.maximum(0.0, mine - cells.radius[None, :])
    for j in range(cells.low.shape[1]):
        to = gaps[:, [j]]
        np.maximum(out, to - cells.high[None, :, j], out=out)
        np.maximum(out, cells.low[None, :, j] - to, out=out)
    if metric == "euclidean":
        # Rows of another cell lie beyond the half-way plane to that cell's pivot.
        own = gaps.argmin(axis=1)
        far = between[own][:, cells.cell]
        plane = (mine**2 - gaps.min(axis=1)[:, None] ** 2) / np.where(far > 0, 2 * far, np.inf)
        np.maximum(out, plane, out=out)
    return out, np.minimum(carried, (mine + cells.reach[None, :]).min(axis=1)) * (1 + 1e-9) + 1e-9


def knn_rounds(
    queries: DataFrame, data: DataFrame, k: int, metric: str = "euclidean", within: bool = False, pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The chunks of queries after the last round, with the k nearest rows found for each query.

    ``compared`` counts the pairs of a query and a block that were compared, ``pairs`` all such pairs.
    """
    part = F.col("label").cast("string") if within else F.lit("")
    id_type, label_type = (data.schema[c].dataType.simpleString() for c in ("id", "label"))
    points = data.select("id", "label", "vec", part.alias("part"))
    asks = queries.select("id", "label", "vec", part.alias("part"))
    parts = points.select("part").distinct().count() if within else 1
    # With more parts than cells may be, a part is one cell, and nothing of them goes to the driver.
    few = parts <= MOST_CELLS
    centres = _choose_pivots(points, pivots if few else 1, parts if few else 1)
    references = min(REFERENCES, len(centres)) if few else 0

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                gaps = _distances(_stack(batch["vec"]), centres, metric)
                yield batch.assign(cell=gaps.argmin(axis=1).astype("int32"), r=gaps.min(axis=1), to=list(gaps[:, :references]))

    columns = f"id {id_type}, label {label_type}, vec array<double>, part string, cell int, r double, to array<double>"
    celled = durable(points.mapInPandas(to_cells, columns))
    asked = durable(asks.mapInPandas(to_cells, columns).drop("r", "to"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            **{c: [rows[c].iloc[0]] for c in ("part", "cell", "block")}, "ids": [rows["id"].to_numpy()], "labels": [rows["label"].to_numpy()], "vecs": [_raw(_stack(rows["vec"]))],
        })

    def packed(rows: DataFrame, most: int = block_rows) -> tuple[DataFrame, DataFrame]:
        cut = rows.groupBy("part", "cell").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"))
        dealt = rows.join(cut, ["part", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        schema = f"part string, cell int, block int, ids array<{id_type}>, labels array<{label_type}>, vecs binary"
        return durable(dealt.select("part", "cell", "block", "id", "label", "vec").groupBy("part", "cell", "block").applyInPandas(pack, schema)), cut

    blocks, cut = packed(celled)
    # Chunks hold queries of neighbouring cells, so that few and full ones visit the blocks: what is shuffled is the data
    # once for each chunk. They are as large as memory and an even load of all cores allow.
    n = asked.count()
    largest = min(LARGEST_CHUNK, 2**20 // max(1, centres.shape[1]))
    most = max(CHUNK_ROWS, min(largest, n // (3 * queries.sparkSession.sparkContext.defaultParallelism)))
    cells_a_chunk = max(1, most * len(centres) * parts // max(1, n))
    chunks, _ = packed(asked.withColumn("cell", (F.col("cell") / cells_a_chunk).cast("int")), most)
    rings = celled.groupBy("part", "cell").agg(
        F.max("r").alias("radius"), F.array(*[F.min(F.col("to")[j]) for j in range(references)]).cast("array<double>").alias("low"),
        F.array(*[F.max(F.col("to")[j]) for j in range(references)]).cast("array<double>").alias("high"),
    )
    # One of the k + 1 rows nearest to a pivot may be the query itself.
    near = Window.partitionBy("part", "cell").orderBy("r", "id")
    reach = celled.select("part", "cell", "r", "id").withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1)
    reach = reach.where(F.col("place") == k + 1).select("part", "cell", F.col("r").alias("reach"))
    known: dict[str, _Cells] = {}
    if few:
        rows = rings.join(cut, ["part", "cell"]).join(reach, ["part", "cell"], "left").collect()  # at most MOST_CELLS
        for name in {r["part"] for r in rows}:
            known[name] = _Cells([r for r in rows if r["part"] == name])
    between = _distances(centres, centres, metric)

    sieve = _Sieve(centres, metric)

    class Visit:
        """One chunk in one round: the blocks it asked for come one after the other, and what they hold tightens its bounds."""

        def __init__(self, state: dict):
            self.state, n = state, len(state["ids"])
            self.q, self.ids = _matrix(state["vecs"], n, centres.shape[1]), np.asarray(state["ids"])
            self.near, self.labels = (np.asarray(state[c], dtype=object).reshape(n, k) for c in ("near", "near_labels"))
            self.distances = np.array(state["distances"], dtype=np.float64).reshape(n, k)
            self.needed, self.asks, self.cells = 0, None, known.get(state["part"])
            self.bound = self.distances[:, k - 1].copy()
            if self.cells is not None:
                self.at = {c: j for j, c in enumerate(self.cells.cell.tolist())}
                self.low = np.empty((n, len(self.at)), np.float32)
                for i in range(0, n, CHUNK_ROWS):
                    part = slice(i, i + CHUNK_ROWS)
                    low, self.bound[part] = _bounds(self.q[part], self.bound[part], self.cells, centres, between, metric)
                    self.low[part] = low * (1 - 1e-6)

        def compare(self, block: dict) -> None:
            rows = np.arange(len(self.q))
            if self.cells is not None:
                rows = np.flatnonzero(self.low[:, self.at[block["cell"]]] <= self.bound)
            self.needed += len(rows)
            if not len(rows):
                return
            if self.asks is None:
                self.asks = (sieve.asks(self.q),)
            d, ids = _matrix(block["vecs"], len(block["ids"]), centres.shape[1]), np.asarray(block["ids"])
            asks = self.asks[0] if self.asks[0] is None or len(rows) == len(self.q) else self.asks[0][rows]
            r, c, distance = _nearest_in_block(self.q[rows], self.ids[rows], d, ids, k, metric, self.bound[rows], sieve, asks, sieve.rows(d))
            if not len(r):
                return
            # Only queries that got something are merged.
            some, group = np.unique(rows[r], return_inverse=True)
            held = np.flatnonzero(np.isfinite(self.distances[some].reshape(-1)))
            group = np.concatenate([held // k, group])
            near = np.concatenate([self.near[some].reshape(-1)[held], ids[c].astype(object)])
            labels = np.concatenate([self.labels[some].reshape(-1)[held], np.asarray(block["labels"])[c].astype(object)])
            distance = np.concatenate([self.distances[some].reshape(-1)[held], distance])
            order = near.astype(ids.dtype) if ids.dtype != object else near
            group, distance, at = _first_of_each(group, distance, order, k, np.arange(len(group)))
            spot = np.arange(len(group)) - np.searchsorted(group, np.arange(len(some)))[group]
            self.near[some[group], spot], self.labels[some[group], spot], self.distances[some[group], spot] = near[at], labels[at], distance
            self.bound[some] = np.minimum(self.bound[some], self.distances[some, k - 1])

        def after(self, turn: int) -> dict:
            """The chunk as it is now, and the blocks it visits next: nearest cells first, none that its bounds rule out."""
            state, cells = self.state, self.cells
            done = {
                **{c: state[c] for c in ("chunk", "part", "ids", "labels", "vecs")}, "near": self.near.reshape(-1), "near_labels": self.labels.reshape(-1),
                "distances": self.distances.reshape(-1), "needed": int(state["needed"]) + self.needed,
            }
            if cells is None:
                return {**done, "seen": [], "next_cell": [], "next_block": [], "pairs": 0}
            need = self.low <= self.bound[:, None]
            order = np.lexsort((cells.cell, self.low.mean(axis=0), -need.sum(axis=0) if turn else self.low.min(axis=0)))
            unit_cell = np.repeat(order, cells.blocks[order])
            unit_block = np.concatenate([np.arange(b) for b in cells.blocks[order]])
            units = cells.cell[unit_cell].astype(np.int64) << 32 | unit_block
            seen = np.array(state["seen"], dtype=np.int64)
            left = np.flatnonzero(need.any(axis=0)[unit_cell] & ~np.isin(units, seen))[:min(32**turn, MOST_BLOCKS_A_ROUND)]
            return {
                **done, "seen": np.concatenate([seen, units[left]]), "next_cell": cells.cell[unit_cell[left]], "next_block": unit_block[left],
                "pairs": len(self.q) * int(cells.blocks.sum()),
            }

    schema = (
        f"chunk bigint, part string, ids array<{id_type}>, labels array<{label_type}>, vecs binary, near array<{id_type}>, "
        f"near_labels array<{label_type}>, distances array<double>, seen array<bigint>, next_cell array<int>, next_block array<int>, "
        "needed bigint, pairs bigint"
    )

    def visits(turn: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            visit = None
            for batch in batches:
                for row in batch.to_dict("records"):
                    if row["place"] >= 0:
                        visit.compare(row)
                        continue
                    if visit is not None:
                        yield pd.DataFrame([visit.after(turn)])
                    visit = Visit(row)
            if visit is not None:
                yield pd.DataFrame([visit.after(turn)])
        return run

    size = F.size("ids") * k
    state = durable(chunks.select(
        F.monotonically_increasing_id().alias("chunk"), "part", "ids", "labels", "vecs",
        F.array_repeat(F.lit(None).cast(id_type), size).alias("near"), F.array_repeat(F.lit(None).cast(label_type), size).alias("near_labels"),
        F.array_repeat(F.lit(float("inf")), size).alias("distances"), F.array().cast("array<bigint>").alias("seen"),
        F.array().cast("array<int>").alias("next_cell"), F.array().cast("array<int>").alias("next_block"),
        F.lit(0).cast("long").alias("needed"), F.lit(0).cast("long").alias("pairs"),
    ))
    # Chunks are few; with more tasks than chunks, hardly two of them meet in one.
    tasks = min(4 * state.count() + 4, 2048)
    turn = 0
    while True:
        own = state.withColumn("place", F.lit(-1)).withColumn("cell", F.lit(-1))
        if few:
            asked_for = state.select("chunk", "part", F.posexplode(F.arrays_zip("next_cell", "next_block")).alias("place", "u")).select(
                "chunk", "part", "place", F.col("u.next_cell").alias("cell"), F.col("u.next_block").alias("block")
            )
            if turn and not asked_for.take(1):
                return state
        else:
            asked_for = state.select("chunk", "part").join(cut, "part").select(
                "chunk", "part", "cell", F.posexplode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("place", "block")
            )
        brought = asked_for.join(blocks, ["part", "cell", "block"]).select("chunk", "place", "cell", "ids", "labels", "vecs")
        # A chunk and the blocks it asked for meet in one task, which reads them one by one.
        together = own.unionByName(brought, allowMissingColumns=True).repartition(tasks, "chunk").sortWithinPartitions("chunk", "place")
        state = durable(together.mapInPandas(visits(turn), schema))
        if not few:
            return state
        turn += 1


def _no_neighbours(data: DataFrame) -> DataFrame:
    types = [data.schema[c].dataType.simpleString() for c in ("id", "label")]
    schema = "id {0}, label {1}, neighbour {0}, neighbour_label {1}, distance double, rank int".format(*types)
    return data.sparkSession.createDataFrame([], schema)


def knn_join(
    queries: DataFrame,
    data: DataFrame,
    k: int,
    metric: str = "euclidean",
    within: bool = False,
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest ``data`` rows of every ``queries`` row.

    Both sides have a unique ``id``, a ``label`` and ``vec array<double>``. The result is (id,
    label, neighbour, neighbour_label, distance, rank); a row is never its own neighbour, and equal
    distances rank by neighbour id. With ``within`` only rows with an equal ``label`` are compared.
    Labels travel along, so voting needs no join on hub rows. ``metric`` is euclidean, manhattan,
    chebyshev or minkowski with its power, as minkowski3.
    """
    if not data.take(1):
        return _no_neighbours(data)
    state = knn_rounds(queries, data, k, metric, within, pivots, block_rows)
    each = state.select("near", "near_labels", "distances", F.posexplode(F.arrays_zip("ids", "labels")).alias("at", "query"))
    lists = F.arrays_zip(*[F.slice(c, F.col("at") * k + 1, F.lit(k)).alias(c) for c in ("near", "near_labels", "distances")])
    return each.select(F.col("query.ids").alias("id"), F.col("query.labels").alias("label"), F.posexplode(lists).alias("place", "x")).select(
        "id", "label", F.col("x.near").alias("neighbour"), F.col("x.near_labels").alias("neighbour_label"),
        F.col("x.distances").alias("distance"), (F.col("place") + 1).cast("int").alias("rank"),
    ).where(F.col("distance") < float("inf"))


def knn_by_hashing(
    queries: DataFrame, data: DataFrame, k: int, tables: int, bits: int, metric: str = "euclidean", seed: int = 42, block_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The k nearest rows among those that share a bucket with the query in any of ``tables`` hash tables.

    Columns and order as in ``knn_join``; distances are exact, rows may be missing. A bucket is the side of ``bits`` random
    planes, drawn from ``seed``, that a row lies on. Large buckets are cut into blocks and chunks, and a query keeps k
    rows per block.
    """
    id_type, label_type = (data.schema[c].dataType.simpleString() for c in ("id", "label"))
    first = data.select(F.size("vec").alias("n")).first()
    if first is None:
        return _no_neighbours(data)
    width = first["n"]
    planes = np.random.default_rng(seed).standard_normal((tables * bits, width))
    weights = 1 << np.arange(bits, dtype=np.int64)

    def to_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vecs = _stack(batch["vec"])
                sides = (vecs @ planes.T > 0).reshape(len(batch), tables, bits)
                yield batch.assign(vec=[_raw(v) for v in vecs], buckets=list(sides @ weights))

    def hashed(rows: DataFrame) -> DataFrame:
        schema = f"id {id_type}, label {label_type}, vec binary, buckets array<bigint>"
        return durable(rows.select("id", "label", "vec").mapInPandas(to_buckets, schema))

    def placed(rows: DataFrame) -> DataFrame:
        # New names of columns, as both sides may come from one table.
        return rows.select(*[F.col(c).alias(c) for c in ("id", "label", "vec")], F.posexplode("buckets").alias("table", "bucket"))

    stored = hashed(data)
    points, asks = placed(stored), placed(stored if queries is data else hashed(queries))
    keys = ["table", "bucket"]
    # Spark sizes exploded rows as if there were none, and would broadcast them: the counts are joined by shuffle, and measured then.
    cuts = points.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")).join(
        asks.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("chunks")).hint("merge"), keys
    ).persist()
    known = F.broadcast(cuts) if fits(*size_of(cuts)) else cuts.hint("merge")
    spot = F.xxhash64("id")
    left = asks.join(known, keys).select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(spot, F.col("chunks")).cast("int").alias("chunk"), "id", "label", "vec",
    )
    right = points.join(known, keys).select(
        *keys, F.pmod(spot, F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "id", "label", "vec",
    )

    def compare(ask: pd.DataFrame, point: pd.DataFrame) -> pd.DataFrame:
        if ask.empty or point.empty:
            return pd.DataFrame({"id": [], "label": [], "neighbour": [], "neighbour_label": [], "distance": []})
        q_id, d_id = ask["id"].to_numpy(), point["id"].to_numpy()
        r, c, distance = _nearest_by_parts(_unpacked(ask["vec"], width), q_id, _unpacked(point["vec"], width), d_id, k, metric)
        return pd.DataFrame({
            "id": q_id[r], "label": ask["label"].to_numpy()[r], "neighbour": d_id[c], "neighbour_label": point["label"].to_numpy()[c], "distance": distance,
        })

    keys += ["block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        compare, f"id {id_type}, label {label_type}, neighbour {id_type}, neighbour_label {label_type}, distance double"
    )
    # A pair may meet in several tables.
    once = found.groupBy("id", "label", "neighbour", "neighbour_label").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_votes(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """Weight per (id, class) of the neighbours' labels; a distance of 0 outweighs all others."""
    if weights == "distance":
        zero = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("id"))
        vote = F.when(zero == 1, (F.col("distance") == 0).cast("double")).otherwise(1 / F.col("distance"))
    else:
        vote = F.lit(1.0)
    voted = neighbours.select("id", F.col("neighbour_label").alias("class"), vote.alias("vote"))
    return voted.groupBy("id", "class").agg(F.sum("vote").alias("votes"))


def knn_classify(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """The class with the greatest weight, ties to the smallest class."""
    votes = knn_votes(neighbours, weights)
    best = F.max_by("class", F.struct("votes", -F.col("class")))
    return votes.groupBy("id").agg(best.alias("prediction"))

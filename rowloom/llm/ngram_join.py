"""Similarity join of documents on word shingles by banded MinHash signatures, with exact verification.

Each text becomes the set of its five-word shingles; texts with equal sets are copies and go on as one class. A class
gets one MinHash signature for each of several trees. All trees are cut at one depth, worked out from threshold, number of
trees and target recall alone; this is fixed banding, not a forest whose prefixes adapt to the data (see the README).

Classes under one node of a tree are tied to the node's least class (an aggregate, so a node with very many classes is
one row for each task), and what hangs together forms a candidate group. Groups are verified exactly: all pairs inside
a group are counted by products of incidence matrices, large groups in pairs of blocks, each its own task. No pair is
emitted: a task returns how many links each class has, and which classes hang together. Nothing is capped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import components, freeing, freeing_group, in_parts, mix, quoted, row_chunks, shingles, text_bytes, words
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_SHINGLES = 200_000
BLOCK_CLASSES = 1024


def forest_depth(threshold: float, trees: int, depth: int, target: float) -> int:
    """Shorten the prefix from ``depth`` until a pair at ``threshold`` meets in some tree with probability ``target``."""
    while depth > 1 and 1.0 - (1.0 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingle_sets(body: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different shingles of each text, where each text's begin, and two sums that name the set."""
    found, at = shingles(*words(body, starts), size)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    found, doc = found[new], doc[new]
    sets = np.searchsorted(doc, np.arange(len(at)))
    total = np.zeros((2, len(found) + 1), np.uint64)
    np.cumsum(mix(found), out=total[0, 1:])
    np.cumsum(mix(found ^ np.uint64(0x5851F42D4C957F2D)), out=total[1, 1:])
    key = total[:, sets[1:]] - total[:, sets[:-1]]
    return found, sets, key[0].view(np.int64), key[1].view(np.int64)


def _signatures(size: int, trees: int, levels: int):
    seeds = mix(np.arange(2 * trees * levels, dtype=np.uint64) + np.uint64(1))
    masks, factors = seeds[: trees * levels], seeds[trees * levels:] | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, starts = text_bytes(batch.column(1))
            for a, b in row_chunks(starts):
                found, sets, high, low = shingle_sets(body[starts[a]:starts[b]], starts[a:b + 1] - starts[a], size)
                filled = np.flatnonzero(np.diff(sets) > 0)
                at = sets[filled]
                prefix = np.zeros((b - a, trees), np.uint64)
                for t in range(trees if len(filled) else 0):
                    folded = np.full(len(filled), t, np.uint64)
                    for k in range(t * levels, (t + 1) * levels):
                        folded = mix(folded ^ np.minimum.reduceat((found ^ masks[k]) * factors[k], at))
                    prefix[filled, t] = folded
                count = np.diff(sets)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(count > 0, trees, 0))]), pa.int32()),
                    pa.array(prefix[filled].reshape(-1).view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(high), pa.array(low), pa.array(count, pa.int64()), lists],
                    ["id", "mark", "high", "low", "n", "prefixes"],
                )

    return run


def _linked(share: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    union = sizes[:, None] + sizes[None, :] - share
    return share >= threshold * union - 1e-9


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, by products of incidence matrices over slices of the shingles."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    common = df[column] > 1
    _, column = np.unique(column[common], return_inverse=True)
    row = row[common]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    share = np.zeros((n, n), np.float32)
    width = max(256, 4_000_000 // n)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [begin, begin + width])
        m = np.zeros((n, min(width, int(column[-1]) + 1 - begin)), np.float32)
        m[row[a:b], column[a:b] - begin] = 1.0
        share += m @ m.T
    share[np.arange(n), np.arange(n)] = size
    return share


def _verify(size: int, threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("texts", pa.int64()), ("docs", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        body, starts = text_bytes(rows.column("text"))
        high, low, group, block, copies, first = (
            rows.column(c).to_numpy() for c in ("high", "low", "group", "block", "copies", "first")
        )
        two_blocks = rows.column("bi")[0].as_py() != rows.column("bj")[0].as_py()
        sets: list[np.ndarray] = []
        right = np.zeros(len(low), bool)
        for x, y in row_chunks(starts):
            found, at, h, l = shingle_sets(body[starts[x]:starts[y]], starts[x:y + 1] - starts[x], size)
            right[x:y] = (h == high[x:y]) & (l == low[x:y])  # another text may have the same id
            sets += [found[i:j] for i, j in zip(at[:-1], at[1:])]
        order = np.flatnonzero(right)
        order = order[np.lexsort((low[order], group[order]))]
        keep = np.ones(len(order), bool)
        keep[1:] = (low[order][1:] != low[order][:-1]) | (group[order][1:] != group[order][:-1])
        order = order[keep]
        out: list[list[np.ndarray]] = [[], [], [], []]
        edges = np.flatnonzero(np.diff(group[order])) + 1
        for x, y in zip([0, *edges], [*edges, len(order)]):
            which = order[x:y]
            if len(which) < 2:
                continue
            share = _shared_counts([sets[i] for i in which])
            link = _linked(share, np.array([len(sets[i]) for i in which], np.float32), threshold)
            np.fill_diagonal(link, False)
            if two_blocks:
                link &= block[which][:, None] != block[which][None, :]
            label = np.arange(len(which))
            while link.any():
                least = np.minimum(label, np.where(link, label[None, :], len(which)).min(axis=1))
                if (least == label).all():
                    break
                label = least
            has = np.flatnonzero(link.any(axis=1))
            key = low[which]
            out[0].append(key[has])
            out[1].append(key[label[has]])
            out[2].append(link[has].sum(axis=1).astype(np.int64))
            out[3].append((link[has] @ copies[which].astype(np.float64)).astype(np.int64))
        return pa.table([np.concatenate(c) if c else np.zeros(0, np.int64) for c in out], schema=schema)

    return run


def with_texts(members: DataFrame, rows: DataFrame) -> DataFrame:
    """The text of each class's least row, by its id and the mark of its text; rows without id are told apart by the mark.

    A row has the text of one class only, so no more texts are sent than there are rows, whatever ids repeat.
    """
    texts = rows.select(F.col("id").alias("text_id"), F.col("mark").alias("text_mark"), "text")
    return members.join(texts, F.col("rep").eqNullSafe(F.col("text_id")) & (F.col("rep_mark") == F.col("text_mark")))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, shingle_words: int = 5,
    trees: int = 32, depth: int = 12, target_recall: float = 0.9999,
) -> DataFrame:
    """Classes of documents that are linked by Jaccard similarity of their shingle sets of at least ``threshold``.

    Returns one row per row of ``docs``: (id, class_id, n_links, n_copies). ``n_links`` counts the other documents
    linked to it (copies included), ``n_copies`` the other documents with an equal set; ``class_id`` is the least id that
    is reached over links. Words are runs without ASCII white space, with ASCII letters lowered. A text of fewer words
    than a shingle is one shingle; texts without a word (null and empty ones) are copies of each other and linked to
    nothing else. Repeated rows count as documents of their own. Null ids keep their row; the class id is the least id that is not
    null. An empty table gives an empty result. Only the two columns named are read.
    """
    levels = forest_depth(threshold, trees, depth, target_recall)
    rows = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    signed = durable(rows.mapInArrow(
        freeing(_signatures(shingle_words, trees, levels)), "id bigint, mark bigint, high bigint, low bigint, n bigint, prefixes array<bigint>"
    ))
    # A class is known by its least row: the least id, or a null one, and the mark of that row's text.
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark"))
    n_rows = signed.count()
    classes = durable(in_parts(
        signed.groupBy("high", "low").agg(
            least.alias("least"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.any_value("prefixes").alias("prefixes"),
        ).select("high", "low", F.col("least.id").alias("rep"), F.col("least.mark").alias("rep_mark"), "copies", "n", "prefixes"),
        n_rows,
    ))
    nodes = classes.select("low", F.posexplode("prefixes").alias("tree", "prefix"))
    heads = nodes.groupBy("tree", "prefix").agg(F.min("low").alias("head"), F.max("low").alias("other")).where("head <> other")
    tied = nodes.join(heads, ["tree", "prefix"]).where("low <> head").select("low", "head").distinct()
    groups = components(tied, "low", "head", nodes=n_rows).select(F.col("node").alias("low"), F.col("component").alias("candidates"))
    members = classes.drop("prefixes").join(groups, "low")
    extent = members.groupBy("candidates").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("members"))
    blocks = F.greatest(F.ceil(F.col("weight") / BLOCK_SHINGLES), F.ceil(F.col("members") / BLOCK_CLASSES)).cast("int")
    extent = extent.select("candidates", blocks.alias("blocks"))
    members = members.join(extent, "candidates").withColumn("block", F.pmod(F.xxhash64("low"), F.col("blocks")).cast("int"))
    members = durable(in_parts(members, n_rows))
    total = int(members.agg(F.sum("n")).first()[0] or 0)
    bins = max(1, total // (2 * BLOCK_SHINGLES))
    # Small groups share a task by hash; a large one takes part in a task for each pair of its blocks.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        with_texts(members, rows)
        .withColumn("other", other)
        .select(
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("candidates"), F.lit(bins))).otherwise(F.col("candidates")).alias("task"),
            (F.col("blocks") > 1).alias("large"), F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
            F.col("candidates").alias("group"), "block", "high", "low", "copies", F.col("rep").alias("first"), "text",
        )
    )
    checked = durable(
        dealt.groupBy("task", "large", "bi", "bj").applyInArrow(
            freeing_group(_verify(shingle_words, threshold)), "a bigint, b bigint, texts bigint, docs bigint"
        )
    )
    links = checked.groupBy(F.col("a").alias("low")).agg(F.sum("docs").alias("docs"))
    joined = components(checked.select("a", "b"), nodes=n_rows)
    named = classes.select("low", "high", "rep", "copies").join(joined.withColumnRenamed("node", "low"), "low", "left")
    least = named.where("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    known = (
        named.join(least, "component", "left").join(links, "low", "left")
        .select(
            "low", "high", F.coalesce("least", "rep").alias("class_id"),
            (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"), (F.col("copies") - 1).alias("n_copies"),
        )
    )
    return signed.select("id", "low", "high").join(known, ["low", "high"]).select("id", "class_id", "n_links", "n_copies")

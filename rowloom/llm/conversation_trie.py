"""The trie of conversation prefixes by ROLLUP over positional columns of turn ids.

A conversation is cut into blocks of ``BLOCK_TURNS`` turns, each a row with one column per position. ROLLUP over these
columns, told apart by grouping_id, aggregates all prefixes of a block together. Further blocks of long conversations
are rolled up at the same time, keyed by the node that the block before ends in: its key is the sum of hashes of
(place, turn) over all turns before, four sums of 32 bits, which running totals give without a round per block.

Sums over subtrees need no walk over the tree. Each node belongs to its smallest member, and what a conversation owns
is the end of its path. So a sum over the nodes of a subtree is a sum over its members of what they own, which a
second ROLLUP gives for all prefixes at once.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import quoted
from rowloom.operators.ranking import running_totals
from rowloom.operators.sizing import split_join
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_TURNS = 8
IDS_A_ROW = 1024
KEYS = ["k0", "k1", "k2", "k3"]
_TURNS = [f"t{i}" for i in range(BLOCK_TURNS)]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """20 bytes that stand for a turn: 128 bits of SHA-256 over role and text, and the code points of the text."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    size = F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 8, "0"))
    return F.concat(F.substring(F.unhex(F.sha2(told, 256)), 1, 16), size)


def _points(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def _parts(place: Column, turn: Column) -> list[Column]:
    """Four 32-bit hashes of a turn at its place; their sums over a prefix stay far from overflow."""
    out = []
    for seed in (11, 29):
        h = F.xxhash64(place.cast("long"), turn, F.lit(seed))
        out += [h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)]
    return out


def placed_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Turns in order as (conv_id, place from 1, turn_id).

    Null turns come first; equal ones are ordered by role and text. Null roles and texts are empty. Rows without a
    conversation id belong to none and take no part. Other columns play no part; an empty table gives none.
    """
    text, role = (F.coalesce(quoted(c).cast("string"), F.lit("")) for c in (text_col, role_col))
    rows = conversations.select(
        quoted(id_col).cast("long").alias("conv_id"), quoted(turn_col).alias("turn"), role.alias("role"), text.alias("text")
    ).where("conv_id IS NOT NULL")
    placed = running_totals(
        rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()], {"place": F.lit(1).cast("long")}
    )
    return placed.select("conv_id", "place", turn_id(F.col("role"), F.col("text")).alias("turn_id"))


def with_shared_openings(turns: DataFrame, group: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are those of conversation c - c % group, h being crc32(c) % (most + 1).

    Takes the result of ``placed_turns``; returns the rebuilt turns, and the ids of all conversations (some may have
    become empty). What is shared is at most ``most`` turns of one conversation in ``group``, sent by a join on its id.
    """
    openings = turns.where(F.col("place") <= most).groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "turn_id"))), lambda x: x["turn_id"]).alias("opening")
    )
    ids = turns.select("conv_id").distinct()
    told = ids.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).alias("h"),
    )
    lead = told.join(openings.withColumnRenamed("conv_id", "base"), "base", "left").select(
        "conv_id", "h", F.coalesce(F.expr("slice(opening, 1, cast(h AS int))"), F.array().cast("array<binary>")).alias("taken")
    )
    lead = durable(lead)
    given = lead.select("conv_id", F.posexplode("taken").alias("at", "turn_id")).select("conv_id", (F.col("at") + 1).cast("long").alias("place"), "turn_id")
    kept = turns.join(lead.select("conv_id", "h", F.size("taken").alias("k")), "conv_id").where("place > h")
    own = kept.select("conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("place"), "turn_id")
    return given.unionByName(own), ids


def _blocks(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A row per conversation and block of positions: its turns, the key of all turns before, and how far it reaches.

    ``reach`` is the number of turns in the block where the conversation ends there, else one more than the block holds.
    """
    slot = (F.col("place") - 1) % BLOCK_TURNS
    parts = _parts(F.col("place"), F.col("turn_id"))
    rows = turns.groupBy("conv_id", F.expr(f"(place - 1) div {BLOCK_TURNS}").alias("block")).agg(
        *[F.max(F.when(slot == i, F.col("turn_id"))).alias(t) for i, t in enumerate(_TURNS)],
        F.count(F.lit(1)).alias("held"), F.sum(_points(F.col("turn_id"))).alias("points"),
        *[F.sum(p).alias(f"own_{k}") for k, p in zip(KEYS, parts)],
    )
    # A conversation without turns has a block as well.
    bare = ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("block"), *[F.lit(None).cast("binary").alias(t) for t in _TURNS],
        *[F.lit(0).cast("long").alias(c) for c in ("held", "points", *(f"own_{k}" for k in KEYS))],
    )
    rows = durable(rows.unionByName(bare))
    summed = running_totals(
        rows, ["conv_id"], [F.col("block").asc()],
        {"upto": F.col("points"), **{f"to_{k}": F.col(f"own_{k}") for k in KEYS}},
    )
    told = rows.groupBy("conv_id").agg(
        F.max("block").alias("last_block"), F.sum("points").alias("total"), F.sum("held").alias("length"),
        *[F.sum(f"own_{k}").alias(f"end_{k}") for k in KEYS],
    )
    return durable(
        summed.join(told, "conv_id").select(
            "conv_id", "block", *_TURNS, "total", "length", *[f"end_{k}" for k in KEYS],
            (F.col("upto") - F.col("points")).alias("before"), *[(F.col(f"to_{k}") - F.col(f"own_{k}")).alias(k) for k in KEYS],
            F.when(F.col("block") == F.col("last_block"), F.col("held")).otherwise(BLOCK_TURNS + 1).alias("reach"),
        )
    )


def _rolled_up(blocks: DataFrame, measures: str) -> DataFrame:
    """All prefixes of all blocks with their aggregates; a prefix is known by its depth and key.

    ``last`` is the turn it ends in, ``f0..f3`` the key of the prefix one turn shorter, ``until`` the code points up to
    the turn before the last one.
    """
    keys, turns = ", ".join(KEYS), ", ".join(_TURNS)
    rolled = blocks.sparkSession.sql(
        f"SELECT block, before, {keys}, {turns}, {BLOCK_TURNS} - bit_count(grouping_id()) AS level, {measures} "
        f"FROM {{blocks}} GROUP BY block, before, {keys}, ROLLUP ({turns})",
        blocks=blocks,
    )
    # A prefix may not reach beyond the turns there are, and the empty prefix of a further block is the node before.
    there = sum((F.col(t).isNotNull().cast("int") for t in _TURNS), F.lit(0))
    rolled = rolled.where((there == F.col("level")) & ((F.col("level") > 0) | (F.col("block") == 0)))
    depth = F.col("block") * BLOCK_TURNS + F.col("level")
    last = F.coalesce(*[F.col(t) for t in reversed(_TURNS)])
    until, sums = F.col("before"), [F.col(k) for k in KEYS]
    for i, t in enumerate(_TURNS[:-1]):
        inside = F.col("level") > i + 1
        until = until + F.when(inside, _points(F.col(t))).otherwise(0)
        parts = _parts(F.col("block") * BLOCK_TURNS + (i + 1), F.col(t))
        sums = [s + F.when(inside, p).otherwise(0) for s, p in zip(sums, parts)]
    measured = [c for c in rolled.columns if c not in ("block", "before", *KEYS, *_TURNS)]
    shorter = rolled.select(
        *measured, depth.alias("depth"), last.alias("last"), until.alias("until"), *[s.alias(f"f{i}") for i, s in enumerate(sums)],
        F.coalesce(_points(last), F.lit(0)).alias("points"),
    )
    ends = _parts(F.col("depth"), F.col("last"))
    return shorter.select(
        *measured, "depth", "until", "points", *[f"f{i}" for i in range(4)],
        *[(F.col(f"f{i}") + F.when(F.col("last").isNull(), 0).otherwise(p)).alias(k) for i, (k, p) in enumerate(zip(KEYS, ends))],
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conversation) rows as rows of up to ``IDS_A_ROW`` comma-joined ids of one key."""
    names = [*KEYS, "depth", "first", "ids"]
    key, held, out = None, [], []

    def close() -> None:
        if held:
            out.append((*key, held[0], ",".join(map(str, held))))
            held.clear()

    def table() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 7
        out.clear()
        types = [pa.int64()] * 6 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for *here, conv in zip(*columns):
            if here != key or len(held) == IDS_A_ROW:
                close()
                key = here
            held.append(conv)
        yield table()
    close()
    yield table()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the ids of each key; rows come sorted by key and first id, and only the state of one key is held."""
    names = [*KEYS, "depth", "ends_sha256"]
    key, state = None, None
    for batch in batches:
        out = []
        columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6)]
        for *here, ids in zip(*columns):
            if here != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = here, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        columns = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.string()])], names)
    last = [[k] for k in key] + [[state.hexdigest()]] if key is not None else [[]] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(last, [pa.int64()] * 5 + [pa.string()])], names)


def _ends(blocks: DataFrame) -> DataFrame:
    """Per node in which conversations end, the hash of their ids in ascending order.

    A node may be the end of a third of all conversations, so ids are first joined to rows of ``IDS_A_ROW`` by range
    partitions; what one task then reads in order are these rows, one state being all it holds.
    """
    order = [*KEYS, "depth", "conv_id"]
    ends = blocks.where("block = 0").select(*[F.col(f"end_{k}").alias(k) for k in KEYS], F.col("length").alias("depth"), "conv_id")
    fields = ", ".join(f"{c} bigint" for c in [*KEYS, "depth"])
    lists = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_listed, f"{fields}, first bigint, ids string")
    order = [*KEYS, "depth", "first"]
    return lists.repartition(*KEYS, "depth").sortWithinPartitions(*order).mapInArrow(_hashed, f"{fields}, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``ids`` with the turns (conv_id, place, turn_id).

    Places of a conversation are 1, 2, ... without gaps. Returns conv_id (smallest member), depth, parent_conv_id (null
    for the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256. No conversation, no row.
    """
    blocks = _blocks(turns, ids)
    nodes = durable(
        _rolled_up(
            blocks,
            "count(1) AS n_convs, min(conv_id) AS conv_id, max(reach) AS furthest, min_by(reach, conv_id) AS rep_reach, sum(total) AS totals",
        )
    )
    # What each conversation owns: the nodes of which it is the smallest member, the end of its path.
    owners = durable(
        nodes.groupBy("conv_id").agg(
            F.min("depth").alias("depth"), (F.max(F.col("until") + F.col("points")) - F.min("until")).alias("owned"),
            F.max((F.col("furthest") == F.col("level")).cast("long")).alias("leaves"),
            F.min_by(F.struct(*[f"f{i}" for i in range(4)]), "depth").alias("parent"),
        )
    )
    shared = blocks.join(owners.select("conv_id", "owned", "leaves"), "conv_id")
    below = _rolled_up(
        shared, "sum(owned) AS owned, sum(leaves) AS n_leaves, min_by(struct(owned, total), conv_id) AS rep"
    ).select("depth", *KEYS, "owned", "n_leaves", F.col("rep.owned").alias("rep_owned"), F.col("rep.total").alias("rep_total"))
    first = owners.where("depth > 0").select(
        "conv_id", (F.col("depth") - 1).alias("depth"), *[F.col(f"parent.f{i}").alias(k) for i, k in enumerate(KEYS)]
    )
    branches = first.groupBy("depth", *KEYS).agg(F.count(F.lit(1)).alias("branches"))
    tops = nodes.select("depth", *KEYS, F.col("conv_id").alias("above"))
    # Very many branches may leave one node, so its keys are joined by their measured number.
    parents = split_join(first, tops, ["depth", *KEYS]).select("conv_id", (F.col("depth") + 1).alias("depth"), "above")
    joined = (
        nodes.join(below, ["depth", *KEYS]).join(branches, ["depth", *KEYS], "left").join(_ends(blocks), ["depth", *KEYS], "left")
        .join(parents, ["conv_id", "depth"], "left")
    )
    own_path = F.col("rep_total") - F.col("until")
    distinct_points = F.col("owned") - F.col("rep_owned") + own_path
    return joined.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs",
        (F.coalesce("branches", F.lit(0)) + (F.col("rep_reach") > F.col("level")).cast("long")).alias("n_children"), "n_leaves",
        (F.col("totals") - F.col("n_convs") * F.col("until") - distinct_points).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The prefix trie of the given conversations, see ``placed_turns`` and ``prefix_trie``."""
    turns = durable(placed_turns(conversations, id_col, turn_col, role_col, text_col))
    return prefix_trie(turns, turns.select("conv_id").distinct())

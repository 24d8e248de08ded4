"""Chat formatting into budgeted windows, in DataFrame functions only.

Prefix sums of the turns' tokens choose spans of whole turns. A window is a span, before it the system turn and as many
of the turns just before the span as the history budget allows. Assistant texts are targets in the one window to whose
span they belong; where they are repeated as history they are masked.

Prefix sums are taken inside slices of successive turns and carried over by a window on the slices' totals, so that a
conversation that holds much of the table is spread. Turns never meet all turns of their conversation: history is joined
by stretches of the prefix sum as long as the history budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import quoted

START, END = "<|im_start|>", "<|im_end|>"
JOINER = "⁠"
TURN_OVERHEAD = 4
SLICE_TURNS = 256


def escape(text: Column) -> Column:
    """Put a word joiner into each ``<|``, and one more into each such string that has some; then no marker is left."""
    return F.regexp_replace(text, f"<({JOINER}*)\\|", f"<{JOINER}$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"<{JOINER}({JOINER}*)\\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def estimated_tokens(text: Column) -> Column:
    """A token for every four bytes, rounded up; callers with a better count pass their own column."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def chat_windows(
    turns: DataFrame, budget: int = 1024, history: int = 256, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", token_col: str | None = None,
) -> DataFrame:
    """One row for each window: (conv_id, window_start, n_turns, n_repeated, n_tokens, over_budget, formatted, loss).

    ``window_start`` is the place of the span's first turn in its conversation, from 1. ``formatted`` holds each turn as
    ``<|im_start|>role\\ntext<|im_end|>\\n``, strings like markers being escaped; its first ``n_repeated`` turns stand in an
    earlier window, too. ``loss`` is an array of (begin, end) in code points of ``formatted``: the assistant texts of the
    span. A turn counts its tokens and four for its markers. A span holds turns that begin in one half of the room which
    system turn and history leave; a turn that is longer than this half stands alone, and a window exceeds the budget only by
    such a turn or a long system turn, which is never cut (``over_budget``).

    Rows are ordered by turn (null first), role, tokens, text. Null role and text are empty; a null conversation id is a
    conversation of its own; rows repeated are turns of their own; a system turn counts as such at the beginning only. An
    empty table gives an empty result. Other columns play no part.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be at least 0 and below budget")
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    tokens = (quoted(token_col).cast("long") if token_col else estimated_tokens(text)) + TURN_OVERHEAD
    rows = turns.select(
        F.coalesce(quoted(conv_col).cast("string"), F.lit("")).alias("conv"), quoted(conv_col).alias("conv_id"),
        quoted(conv_col).isNull().alias("no_id"), quoted(turn_col).cast("long").alias("turn"),
        F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"), tokens.alias("tokens"), text.alias("text"),
    ).withColumn("slice", F.coalesce(F.floor(F.col("turn") / SLICE_TURNS), F.lit(-(1 << 62))).cast("long"))
    key = ["conv", "no_id"]
    first = rows.groupBy(*key).agg(F.min(F.struct("turn", "role", "tokens")).alias("first"), F.count(F.lit(1)).alias("turns"))
    system_tokens = F.when(F.col("first.role") == "system", F.col("first.tokens")).otherwise(F.lit(0))
    half = F.greatest(F.floor((F.lit(budget - history) - system_tokens) / 2), F.lit(1)).cast("long")
    known = rows.join(first.select(*key, "turns", system_tokens.alias("system_tokens"), half.alias("half")), key)

    inside = Window.partitionBy(*key, "slice").orderBy(F.asc_nulls_first("turn"), "role", "tokens", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    long_turn = (F.col("tokens") > F.col("half")).cast("long")
    summed = (
        known.withColumn("is_long", long_turn)
        .withColumn("in_at", F.row_number().over(inside))
        .withColumn("in_tokens", F.sum("tokens").over(upto))
        .withColumn("in_short", F.sum(F.col("tokens") * (1 - F.col("is_long"))).over(upto))
        .withColumn("in_long", F.sum("is_long").over(upto))
    )
    totals = known.groupBy(*key, "slice").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.sum(F.col("tokens") * (1 - long_turn)).alias("s"), F.sum(long_turn).alias("l"),
    )
    before = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*key, "slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in "ntsl"])
    placed = summed.join(carried, [*key, "slice"]).select(
        *key, "conv_id", "role", "text", "tokens", "half", "turns", "is_long",
        (F.col("n_before") + F.col("in_at")).alias("at"),
        (F.col("t_before") + F.col("in_tokens") - F.col("tokens")).alias("start"),
        (F.col("s_before") + F.col("in_short") - F.when(F.col("is_long") == 0, F.col("tokens")).otherwise(0)).alias("short_start"),
        (F.col("l_before") + F.col("in_long")).alias("longs"),
    )
    is_system = (F.col("at") == 1) & (F.col("role") == "system")
    system = placed.where(is_system).select(*key, F.col("role").alias("system_role"), F.col("text").alias("system_text"), F.col("tokens").alias("system_tokens"))
    # A conversation that is a system turn only is a span of its own.
    own = placed.where(~is_system | (F.col("turns") == 1)).withColumn(
        "bucket", F.when(F.col("is_long") == 1, F.lit(-1)).otherwise(F.floor(F.col("short_start") / F.col("half"))).cast("long")
    )
    span = [*key, "longs", "bucket"]
    spans = own.groupBy(*span).agg(F.min("at").alias("window_start"), F.min("start").alias("span_start"), F.first("turns").alias("turns"))
    new = own.join(spans.drop("turns"), span).select(
        *key, "window_start", "at", F.lit(False).alias("repeated"), "role", "text", "tokens",
    )
    parts = new
    if history:
        stretch = F.floor(F.col("span_start") / history)
        wanted = spans.select(*key, "window_start", "span_start", F.explode(F.array(stretch - 1, stretch)).alias("stretch"))
        earlier = placed.where(~is_system).withColumn("stretch", F.floor(F.col("start") / history))
        parts = parts.unionByName(
            wanted.join(earlier, [*key, "stretch"])
            .where((F.col("at") < F.col("window_start")) & (F.col("start") >= F.col("span_start") - history))
            .select(*key, "window_start", "at", F.lit(True).alias("repeated"), "role", "text", "tokens")
        )
    lead = spans.where("turns > 1").select(*key, "window_start").join(system, key).select(
        *key, "window_start", F.lit(1).cast("long").alias("at"), (F.col("window_start") > 2).alias("repeated"),
        F.col("system_role").alias("role"), F.col("system_text").alias("text"), F.col("system_tokens").alias("tokens"),
    )
    parts = parts.unionByName(lead)
    role, body = escape_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    segment = F.concat(head, body, F.lit(f"{END}\n"))
    pieces = parts.select(
        *key, "window_start", "tokens",
        F.struct(
            "at", "repeated", segment.alias("segment"), F.length(segment).alias("size"),
            F.length(head).alias("from"), (F.length(head) + F.length(body)).alias("to"),
            (~F.col("repeated") & (F.col("role") == "assistant")).alias("target"),
        ).alias("piece"),
    )
    windows = pieces.groupBy(*key, "window_start").agg(F.sum("tokens").alias("n_tokens"), F.sort_array(F.collect_list("piece")).alias("pieces"))
    walk = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("loss")),
        lambda done, p: F.struct(
            (done["at"] + p["size"]).alias("at"),
            F.when(p["target"], F.concat(done["loss"], F.array(F.struct((done["at"] + p["from"]).alias("begin"), (done["at"] + p["to"]).alias("end")))))
            .otherwise(done["loss"]).alias("loss"),
        ),
    )
    kind = rows.schema["conv_id"].dataType
    return windows.select(
        F.when(~F.col("no_id"), F.col("conv").cast(kind)).alias("conv_id"), "window_start", F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["repeated"])).cast("long").alias("n_repeated"), "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
        F.array_join(F.transform("pieces", lambda p: p["segment"]), "").alias("formatted"), walk["loss"].alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """What windows say, from ``formatted`` and ``loss`` alone: (conv_id, window_start, turns, targets).

    ``turns`` is an array of (role, text) of the turns that no earlier window holds, ``targets`` the texts under the loss mask.
    """
    segments = F.split("formatted", START.replace("|", "\\|"))
    fresh = F.slice(segments, F.col("n_repeated") + 2, F.size(segments))

    def turn(s: Column) -> Column:
        head = F.locate("\n", s) if isinstance(s, str) else F.instr(s, "\n")
        return F.struct(
            unescape_role(F.substring(s, F.lit(1), head - 1)).alias("role"),
            unescape(F.substring(s, head + 1, F.length(s) - head - len(END) - 1)).alias("text"),
        )

    targets = F.transform("loss", lambda x: unescape(F.substring(F.col("formatted"), x["begin"] + 1, x["end"] - x["begin"])))
    return windows.select("conv_id", "window_start", F.transform(fresh, turn).alias("turns"), targets.alias("targets"), "formatted")

"""SimHash fingerprints of whole texts, and all pairs within a Hamming radius, in DataFrame functions only.

A term is three successive words. Its two hashes of 63 bits vote on 126 signed bits with the term's weight; a bit is set
where more than half of the weight votes for it. Votes are summed three to a long: lanes of 21 bits, which the weights
of ``CHUNK_TERMS`` terms cannot overflow; longer texts are summed chunk by chunk. Nothing of a text is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import quoted
from rowloom.operators.sizing import split_join
from rowloom.session import durable

BITS = 126
TERM_WORDS = 3
MOST_WEIGHT = 8
CHUNK_TERMS = 200_000
LANES = 21
_LANE_MASK = 1 | 1 << 21 | 1 << 42
SLICE = 512
GROUP = 4096
# The same share of the bits as the usual 3 of 64.
RADIUS = 6
BUCKET_PRINTS = 256


def term_hashes(text: Column) -> Column:
    """Array of (two hashes, weight) of each term; a text of fewer words is one term, one without words has none."""
    words = F.filter(F.split(F.lower(text), r"[ \t\n\r\f\x0B]+"), lambda w: w != "")

    def terms(w: Column) -> Column:
        def term(at: Column) -> Column:
            parts = [F.coalesce(F.get(w, at + k), F.lit("")) for k in range(TERM_WORDS)]
            size = sum((F.length(p) for p in parts[1:]), F.length(parts[0]))
            first = F.xxhash64(*parts)
            return F.struct(
                first.alias("a"), F.xxhash64(first, F.lit(1)).alias("b"),
                F.least(F.greatest(F.shiftright(size, 2), F.lit(1)), F.lit(MOST_WEIGHT)).cast("long").alias("w"),
            )

        count = F.greatest(F.size(w) - (TERM_WORDS - 1), F.least(F.size(w), F.lit(1)))
        return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: i < count), term)

    # Bound once by a one-element array, so that the words are split once and not for each use.
    return F.flatten(F.transform(F.array(words), terms))


def fingerprint_rows(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, high, low): the two halves of the fingerprint of each row's text; keys must name a row.

    Grouping by the keys needs no shuffle where the rows are dealt by some of them.
    """
    exploded = rows.select(*keys, F.posexplode_outer(term_hashes(F.coalesce(F.col(text), F.lit("")))).alias("_at", "_term"))
    at = F.coalesce(F.floor(F.col("_at") / CHUNK_TERMS), F.lit(0)).cast("int").alias("chunk")
    weight = F.coalesce(F.col("_term.w"), F.lit(0))
    votes = exploded.select(*keys, at, F.coalesce("_term.a", F.lit(0)).alias("a"), F.coalesce("_term.b", F.lit(0)).alias("b"), weight.alias("w"))
    lanes = [
        F.sum(F.shiftright(h, i).bitwiseAND(F.lit(_LANE_MASK)) * F.col("w")).alias(f"{h}{i}") for h in ("a", "b") for i in range(LANES)
    ]
    chunks = votes.groupBy(*keys, "chunk").agg(F.sum("w").alias("total"), *lanes)
    one = F.lit((1 << 21) - 1)
    sums = [
        F.sum(F.shiftrightunsigned(f"{h}{i}", 21 * part).bitwiseAND(one)).alias(f"{h}{i + LANES * part}")
        for h in ("a", "b") for i in range(LANES) for part in range(3)
    ]
    summed = chunks.groupBy(*keys).agg(F.sum("total").alias("total"), *sums)

    def half(h: str) -> Column:
        bits = [F.when(F.col(f"{h}{j}") * 2 > F.col("total"), F.lit(1 << j)).otherwise(F.lit(0)) for j in range(63)]
        out = bits[0]
        for b in bits[1:]:
            out = out.bitwiseOR(b)
        return out

    return summed.select(*keys, half("a").alias("high"), half("b").alias("low"))


def as_text(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def likeness(a_high: Column, a_low: Column, b_high: Column, b_low: Column) -> Column:
    """Share of equal bits."""
    differ = F.bit_count(a_high.bitwiseXOR(b_high)) + F.bit_count(a_low.bitwiseXOR(b_low))
    return F.lit(1.0) - differ / F.lit(float(BITS))


def _near_by_table(prints: DataFrame, radius: int) -> DataFrame:
    """(high, low, near): a fingerprint, and those within the radius that one block of one bucket holds.

    The bits are cut into ``radius + 2`` blocks; of two fingerprints within the radius at least two blocks are equal, so
    one table for each pair of blocks, with the two moved to the front as its key, finds every pair. Only the first table
    that finds a pair reports it. Buckets of one fingerprint drop out by a count; large ones are cut into blocks by hash, and
    the blocks are compared two by two: what moves are blocks, never pairs.
    """
    if not 0 <= radius <= 40:
        raise ValueError("radius must be from 0 to 40")
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    # Of each block the masks of its bits in the high half, which has the first 63, and in the low one.
    masks = [
        [sum(1 << (bit - base) for bit in range(edges[i], edges[i + 1]) if base <= bit < base + 63) for base in (0, 63)]
        for i in range(blocks)
    ]
    unique = prints.select("high", "low").distinct()
    cut = unique.withColumn("blocks", F.array(*[
        F.xxhash64(F.col("high").bitwiseAND(F.lit(m)), F.col("low").bitwiseAND(F.lit(n))) for m, n in masks
    ]))
    tables = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.xxhash64(F.col("blocks")[i], F.col("blocks")[j]).alias("key"))
        for i in range(blocks) for j in range(i + 1, blocks)
    ])
    bucket = ["i", "j", "key"]
    rows = cut.select("high", "low", F.explode(tables).alias("t")).select("high", "low", "t.*")
    sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / BUCKET_PRINTS).cast("long")
    # Rows made by an explode are sized as if it made none, and would be broadcast: both sides stay where they are.
    dealt = rows.join(sizes.hint("merge"), bucket).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("high", "low"), F.col("parts")))
    held = durable(dealt.groupBy(*bucket, "parts", "part").agg(F.collect_list(F.struct("high", "low")).alias("held")))
    small = held.where("parts = 1").select("i", "j", F.col("held").alias("asked"), "held")
    large = held.where("parts > 1")
    asked = large.select(*bucket, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("held").alias("asked"))
    met = small.unionByName(asked.join(large.hint("merge"), [*bucket, "part"]).select("i", "j", "asked", "held"))

    def distance(x: Column, y: Column) -> Column:
        return F.bit_count(x["high"].bitwiseXOR(y["high"])) + F.bit_count(x["low"].bitwiseXOR(y["low"]))

    def first_here(x: Column, y: Column) -> Column:
        high, low = x["high"].bitwiseXOR(y["high"]), x["low"].bitwiseXOR(y["low"])
        equal = [high.bitwiseAND(F.lit(m)).bitwiseOR(low.bitwiseAND(F.lit(n))) == 0 for m, n in masks]
        numbers = F.filter(F.array(*[F.when(e, F.lit(k)).otherwise(F.lit(-1)) for k, e in enumerate(equal)]), lambda k: k >= 0)
        return F.slice(numbers, 1, 2) == F.array("i", "j")

    def near(x: Column) -> Column:
        return F.filter("held", lambda y: distance(x, y).between(1, radius) & first_here(x, y))

    found = met.select(F.explode(F.transform("asked", lambda x: F.struct(x["high"].alias("high"), x["low"].alias("low"), near(x).alias("near")))).alias("f"))
    return found.select("f.*").where(F.size("near") > 0)


def within_radius(prints: DataFrame, radius: int) -> DataFrame:
    """All pairs of different fingerprints (a, b, distance), a < b as text, whose Hamming distance is at most ``radius``.

    ``prints`` has the halves ``high`` and ``low``. Fingerprints that documents share count once.
    """
    pairs = _near_by_table(prints, radius).select("high", "low", F.explode("near").alias("b"))
    a, b = as_text(F.col("high"), F.col("low")), as_text(F.col("b.high"), F.col("b.low"))
    differ = F.bit_count(F.col("high").bitwiseXOR(F.col("b.high"))) + F.bit_count(F.col("low").bitwiseXOR(F.col("b.low")))
    return pairs.select(a.alias("a"), b.alias("b"), differ.alias("distance")).where("a < b")


def count_within_radius(prints: DataFrame, radius: int) -> DataFrame:
    """(high, low, n_within): of each fingerprint that has some, the number of other fingerprints within the radius."""
    near = _near_by_table(prints, radius)
    return near.groupBy("high", "low").agg(F.sum(F.size("near")).cast("long").alias("n_within"))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Each row with the next one's text in descending order of id; after the last comes the first.

    Ids are cut into slices of equal width, so wide that a slice has about ``SLICE`` rows where ids lie evenly, be they
    successive numbers, times or hashes. A window orders each slice; the last row of a slice gets the first text of the next
    slice that has rows. Slices are tied to each other in groups; groups, one for ``SLICE * GROUP`` rows, in one small window.
    Returns the rows (slice, at, id, text, next_text, last) and the ties (slice, next_slice).
    """
    told = docs.agg(F.min(quoted(id_col).cast("long")).alias("low"), F.max(quoted(id_col).cast("long")).alias("high"), F.count(F.lit(1)).alias("n")).first()
    low, high = told["low"] or 0, told["high"] or 0
    width = max(1, (high - low + 1) * SLICE // max(SLICE, told["n"]))
    wide = F.col("id").cast("decimal(20, 0)") - F.lit(low).cast("decimal(20, 0)")
    # Rows without id are a slice below all others.
    number = F.coalesce(F.floor(wide / F.lit(width).cast("decimal(20, 0)")).cast("long"), F.lit(-1))
    rows = docs.select(quoted(id_col).cast("long").alias("id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    sliced = rows.withColumn("slice", number)
    order = Window.partitionBy("slice").orderBy(F.col("id").desc_nulls_last(), F.xxhash64("text"), "text")
    numbered = sliced.withColumn("at", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
    numbered = numbered.withColumn("last", F.col("next_text").isNull())
    slices = rows.select(number.alias("slice")).distinct()
    slices = slices.withColumn("part", F.floor(F.col("slice") / GROUP))
    inside = slices.withColumn("lower", F.lead("slice").over(Window.partitionBy("part").orderBy(F.desc("slice"))))
    parts = slices.groupBy("part").agg(F.max("slice").alias("head"))
    down = Window.orderBy(F.desc("part"))
    parts = parts.withColumn("below", F.lead("head").over(down)).withColumn("top", F.max("head").over(Window.partitionBy()))
    ties = inside.join(parts, "part").select("slice", F.coalesce("lower", "below", "top").alias("next_slice"))
    heads = numbered.where("at = 1").select(F.col("slice").alias("next_slice"), F.col("text").alias("head_text"))
    first_of_next = ties.join(heads, "next_slice").select("slice", "head_text", F.lit(True).alias("tail"))
    joined = numbered.alias("n").join(
        first_of_next.alias("f"), (F.col("n.slice") == F.col("f.slice")) & (F.col("n.last") == F.col("f.tail")), "left"
    )
    return joined.select(
        F.col("n.slice").alias("slice"), "at", "id", "text", F.coalesce("next_text", "head_text").alias("next_text"), "last"
    ), ties


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Fingerprints of each row's text and of its edited text, their likeness (share of equal bits), and what is near.

    Edited: the last third of the code points is replaced by as many of the beginning of the next text (all of it if it is
    shorter) in descending order of id. Returns (id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_within); ``n_within`` is the number of other fingerprints in the table within the Hamming
    radius, those that documents share counted once. Null is the empty text; a text without words has the fingerprint of zeros. Null ids come
    last; rows of equal id follow each other in order of their text's hash. A single row follows itself; an empty table gives
    an empty result. Only the two columns named are read.
    """
    rows, ties = with_next(docs, id_col, text_col)
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut))
    both = rows.select(
        "slice", "at", "id", "last", size.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("sha"),
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")), F.struct(F.lit(1).alias("kind"), edited.alias("body")))).alias("v"),
    ).select("slice", "at", "id", "last", "n_chars", "sha", "v.*")
    prints = fingerprint_rows(both, ["slice", "at", "id", "last", "n_chars", "sha", "kind"], "body")

    def of(kind: int, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    whole = durable(
        prints.groupBy("slice", "at", "id", "last", "n_chars", "sha").agg(
            of(0, "high").alias("high"), of(0, "low").alias("low"), of(1, "high").alias("edited_high"), of(1, "low").alias("edited_low"),
        )
    )
    after = whole.select(
        F.col("slice").alias("to_slice"), F.col("at").alias("to_at"), F.col("high").alias("next_high"), F.col("low").alias("next_low")
    )
    tails = whole.where("last").join(ties, "slice").select("slice", "at", F.col("next_slice").alias("to_slice"), F.lit(1).alias("to_at"))
    steps = whole.where(~F.col("last")).select("slice", "at", F.col("slice").alias("to_slice"), (F.col("at") + 1).alias("to_at")).unionByName(tails)
    known = split_join(whole, count_within_radius(whole, radius), ["high", "low"])
    linked = known.join(steps.join(after, ["to_slice", "to_at"]), ["slice", "at"])
    high, low = F.col("high"), F.col("low")
    return linked.select(
        "id", "n_chars", F.col("sha").alias("edited_sha256"), as_text(high, low).alias("fingerprint"),
        as_text(F.col("edited_high"), F.col("edited_low")).alias("edited_fingerprint"),
        likeness(high, low, F.col("edited_high"), F.col("edited_low")).alias("near_edited"),
        likeness(high, low, F.col("next_high"), F.col("next_low")).alias("near_next"),
        F.coalesce("n_within", F.lit(0)).cast("long").alias("n_within"),
    )

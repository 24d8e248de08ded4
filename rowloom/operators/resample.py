"""Class balancing: synthetic minority rows, and removal of opposing nearest pairs.

Tables have a unique ``id``, a ``label`` and ``vec array<double>``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.keys import hash_hex, hash_int, hash_unit
from rowloom.operators.neighbours import knn_join
from rowloom.operators.ranking import hash_rank
from rowloom.operators.sizing import lookup, split_join
from rowloom.session import durable


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))

COPIES_A_ROW = 10_000


def smote(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows (id, copy, label, neighbour, u, vec) that raise every class to the largest.

    Each row of a class takes an equal share of the missing rows, the remainder goes to the first
    rows in hash order. The neighbour and the position on the segment come from hashes.
    """
    counts = class_distribution(df).persist()
    largest = counts.agg(F.max("n")).first()[0]
    need = counts.select("label", F.col("n").alias("_n"), (F.lit(largest) - F.col("n")).alias("_need"))
    short = lookup(df.select("id", "label", "vec"), need.where(F.col("_need") > 0), "label", "inner")
    near = knn_join(short, df, k, within=True).select("id", "neighbour", "rank")

    ranked = hash_rank(short, ["label"], hash_hex(seed, "id"), "id", "_rank")
    extra = (F.col("_rank") <= F.col("_need") % F.col("_n")).cast("long")
    copies = F.floor(F.col("_need") / F.col("_n")) + extra
    choices = F.least(F.lit(k), F.col("_n") - 1)
    made = ranked.where(copies > 0).select(
        "id", "label", "vec", choices.alias("_choices"),
        copies.alias("_copies"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((copies - 1) / COPIES_A_ROW))).alias("_part"),
    )
    # The copies of one row are dealt out in parts, so that no row ever holds all of them.
    made = made.repartition("id", "_part")
    first, last = F.col("_part") * COPIES_A_ROW + 1, F.least(F.col("_copies"), (F.col("_part") + 1) * COPIES_A_ROW)
    made = made.select("id", "label", "vec", "_choices", F.explode(F.sequence(first, last)).alias("copy"))
    pick = hash_int(hash_hex(seed, "id", "copy", F.lit("pick"))) % F.greatest("_choices", F.lit(1)) + 1
    made = made.withColumn("rank", pick.cast("int")).withColumn("u", hash_unit(hash_hex(seed, "id", "copy", F.lit("u"))))
    # A class of one row has no neighbour; its copies equal the row.
    paired = made.join(near, ["id", "rank"], "left").withColumn("neighbour", F.coalesce("neighbour", "id"))
    # Many rows may share one neighbour (copies, hubs), so the join treats hot ids apart.
    ends = df.select(F.col("id").alias("neighbour"), F.col("vec").alias("_end"))
    moved = F.zip_with("vec", "_end", lambda x, e: x + F.col("u") * (e - x))
    joined = split_join(paired, ends, "neighbour", "inner")
    return joined.select("id", "copy", "label", "neighbour", "u", moved.alias("vec"))


def oversample(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Original and synthetic rows together; ids become text, synthetic ones carry their copy number."""
    original = df.select(F.col("id").cast("string").alias("id"), "label", "vec")
    made = smote(df, k, seed).select(F.concat_ws("#", "id", "copy").alias("id"), "label", "vec")
    return original.unionByName(made)


def tomek_links(df: DataFrame) -> DataFrame:
    """Pairs (id, other) of different labels that are each other's nearest row."""
    near = knn_join(df, df, 1).where(F.col("label") != F.col("neighbour_label")).select("id", "neighbour").persist()
    back = near.select(F.col("id").alias("neighbour"), F.col("neighbour").alias("id"))
    # Joined on both ids, so a row that is nearest to many others is no hot key.
    pairs = near.join(back, ["id", "neighbour"])
    return pairs.where(F.col("id") < F.col("neighbour")).select("id", F.col("neighbour").alias("other"))


def remove_tomek(df: DataFrame) -> DataFrame:
    links = tomek_links(df)
    both = links.select("id").union(links.select(F.col("other").alias("id")))
    return df.join(both, "id", "left_anti")


def smote_tomek(df: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    return remove_tomek(durable(oversample(df, k, seed)))


def balanced_folds(folded: DataFrame, folds: int, k: int = 5, seed: int = 42) -> DataFrame:
    """For each fold the rows that a model of it is fitted on, balanced: (fold, id, label, vec, synthetic).

    ``folded`` has ``id``, ``label``, ``vec`` and ``fold``. ``fold`` of the result is the one held out; synthetic rows lie
    between rows of the others, so nothing of a held-out row is in what its model learns.
    """
    out = None
    for f in range(folds):
        part = folded.where(F.col("fold") != f).drop("fold")
        made = smote(part, k, seed).select(F.concat_ws("#", "id", "copy").alias("id"), "label", "vec", F.lit(True).alias("synthetic"))
        own = part.select(F.col("id").cast("string").alias("id"), "label", "vec", F.lit(False).alias("synthetic"))
        both = own.unionByName(made).select(F.lit(f).alias("fold"), "id", "label", "vec", "synthetic")
        out = both if out is None else out.unionByName(both)
    return out


def balanced_training(key: str, k: int = 5, seed: int = 42):
    """How ``oof_predict`` balances the part of a fold that is fitted on: original and synthetic rows as (y, features)."""
    def balance(train: DataFrame) -> DataFrame:
        rows = train.select(F.col(key).alias("id"), F.col("y").alias("label"), vector_to_array("features").alias("vec"))
        made = smote(rows, k, seed).select(F.col("label").alias("y"), array_to_vector("vec").alias("features"))
        return train.select("y", "features").unionByName(made)

    return balance

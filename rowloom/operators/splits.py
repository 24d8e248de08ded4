"""Splits, folds, samples and weights. Order comes from a seeded hash of the row key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.keys import hash_hex
from rowloom.operators.ranking import hash_rank
from rowloom.operators.sizing import lookup


def _ranked(df: DataFrame, key: str, group: list[str], seed: int) -> DataFrame:
    return hash_rank(df, group, hash_hex(seed, key), key, "_rank")


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: the first round(test_size * n_c) rows of each class in hash order are the test."""
    sizes = df.groupBy(label).agg(F.floor(F.count(F.lit(1)) * F.lit(test_size) + 0.5).alias("_test"))
    ranked = lookup(_ranked(df, key, [label], seed), sizes, label)
    split = F.when(F.col("_rank") <= F.col("_test"), "test").otherwise("train")
    return ranked.select(*df.columns, split.alias("split"))


def three_way_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, val_size: float = 0.1, seed: int = 42
) -> DataFrame:
    """Add ``split``: test first, then validation out of the rest as val / (1 - test), per class."""
    n = F.count(F.lit(1))
    test = F.floor(n * F.lit(test_size) + 0.5)
    val = F.floor((n - test) * F.lit(val_size / (1 - test_size)) + 0.5)
    sizes = df.groupBy(label).agg(test.alias("_test"), val.alias("_val"))
    ranked = lookup(_ranked(df, key, [label], seed), sizes, label)
    split = F.when(F.col("_rank") <= F.col("_test"), "test")
    split = split.when(F.col("_rank") <= F.col("_test") + F.col("_val"), "val").otherwise("train")
    return ranked.select(*df.columns, split.alias("split"))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1: the rows of a class are dealt out in hash order."""
    ranked = _ranked(df, key, [label], seed)
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias("fold"))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash."""
    if n <= 10_000:
        return df.withColumn("_key", hash_hex(seed, key)).orderBy("_key", key).limit(n).drop("_key")
    ranked = _ranked(df, key, [], seed)
    return ranked.where(F.col("_rank") <= n).select(*df.columns)


def balanced_class_weight(df: DataFrame, label: str, emphasis: dict[int | str, float] | None = None) -> DataFrame:
    """Weight n / (k * n_c) per class, times an optional factor per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).persist()
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    weight = F.lit(float(total["n"] or 0)) / (F.lit(float(max(total["k"], 1))) * F.col("n"))
    for value, factor in (emphasis or {}).items():
        weight = weight * F.when(F.col(label) == F.lit(value), factor).otherwise(1.0)
    return counts.select(label, "n", weight.alias("weight"))


def apply_class_weight(df: DataFrame, weights: DataFrame, label: str) -> DataFrame:
    return lookup(df, weights.select(label, "weight"), label)

"""Feature importances and selection. Feature vectors have a name table (slot, feature)."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.keys import hash_hex
from rowloom.operators.models import Fit, Fitted, cross_validate
from rowloom.operators.ranking import hash_rank

_TABLE = "slot int, feature string, importance double"


def importance_table(fitted: Fitted, names: list[str], df: DataFrame) -> DataFrame:
    """Importance per feature, greatest first; non-finite scores are left out."""
    rows = [
        (i, n, float(v)) for i, (n, v) in enumerate(zip(names, fitted.importances or [])) if math.isfinite(v)
    ]
    return df.sparkSession.createDataFrame(rows, _TABLE).orderBy(F.desc("importance"), "slot")


def select_by_importance(table: DataFrame, threshold: float | str = "mean") -> DataFrame:
    """Features whose importance reaches the mean, the median or a number; none at all is an error."""
    if threshold in ("mean", "median"):
        stat = F.avg if threshold == "mean" else F.median  # the table has one row per feature
        threshold = table.agg(stat("importance")).first()[0]
    kept = table.where(F.col("importance") >= F.lit(float(threshold)))
    if kept.isEmpty():
        raise ValueError("no feature reaches the threshold")
    return kept


def select_topn(table: DataFrame, n: int) -> DataFrame:
    return table.orderBy(F.desc("importance"), "slot").limit(n)


def missing_features(saved: DataFrame, names: list[str]) -> list[str]:
    """Saved features a table does not have."""
    return sorted(r["feature"] for r in saved.select("feature").collect() if r["feature"] not in names)


def slice_features(df: DataFrame, slots: list[int]) -> DataFrame:
    """Keep the given slots of ``features``."""
    sliced = VectorSlicer(inputCol="features", outputCol="_kept", indices=sorted(slots)).transform(df)
    return sliced.drop("features").withColumnRenamed("_kept", "features")


def permutation_importance(
    fitted: Fitted, df: DataFrame, key: str, names: list[str], repeats: int = 3, seed: int = 42
) -> DataFrame:
    """Mean and deviation of the accuracy lost when one feature is shuffled.

    A shuffle pairs each row with another one by joining two hash orders on their ranks. All shuffles
    of a row stand beside each other, so each order is placed once, and a shuffled copy carries one
    foreign value. All copies are scored in one pass.
    """
    base = df.select(key, "y", vector_to_array("features").alias("x")).persist()
    rows = hash_rank(base, [], hash_hex(seed, key), key, "place").select("place", "y", "x")
    for r in range(repeats):
        other = hash_rank(base.select(key, "x"), [], hash_hex(f"{seed}/{r}", key), key, "place")
        rows = rows.join(other.select("place", F.col("x").alias(f"z{r}")), "place")
    drawn = rows.select("y", "x", F.array(*[F.col(f"z{r}") for r in range(repeats)]).alias("z"), F.explode(F.sequence(F.lit(0), F.lit(repeats * len(names) - 1))).alias("copy"))
    slot, repeat = (F.col("copy") % len(names)).cast("int"), F.floor(F.col("copy") / len(names)).cast("int")
    copies = drawn.select("y", "x", slot.alias("slot"), repeat.alias("repeat"), F.get(F.get("z", repeat), slot).alias("other"))
    mixed = F.transform("x", lambda v, i: F.when(i == F.col("slot"), F.col("other")).otherwise(v))
    shuffled = copies.select("y", "repeat", "slot", array_to_vector(mixed).alias("features"))
    hit = (F.col("prediction") == F.col("y")).cast("double")
    baseline = fitted.score(base.select("y", array_to_vector("x").alias("features"))).agg(F.avg(hit)).first()[0]
    drops = fitted.score(shuffled).groupBy("slot", "repeat").agg((F.lit(baseline) - F.avg(hit)).alias("lost"))
    table = drops.groupBy("slot").agg(F.avg("lost").alias("importance_mean"), F.stddev_pop("lost").alias("importance_std"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("slot") + 1)
    return table.select("slot", label.alias("feature"), "importance_mean", "importance_std").orderBy(
        F.desc("importance_mean"), "slot"
    )


def rfe_cv(
    train: DataFrame, fit: Fit, k: int, key: str, names: list[str],
    folds: int = 3, floor: int = 5, step: float = 0.25,
) -> DataFrame:
    """CV accuracy per number of kept features; each step drops a share of the least important ones."""
    slots = list(range(len(names)))
    rows = []
    while True:
        current = slice_features(train, slots)
        score = cross_validate(current, fit, k, key, "rfe", folds)
        rows.append((len(slots), [names[s] for s in slots], float(score)))
        if len(slots) <= floor:
            break
        ranked = fit(current.drop("fold"), k).importances
        if ranked is None:
            raise ValueError("this model has no importances; rank its features by permutation_importance")
        keep = max(floor, len(slots) - max(1, int(len(slots) * step)))
        best = sorted(range(len(slots)), key=lambda i: (-ranked[i], i))[:keep]
        slots = sorted(slots[i] for i in best)
    top = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return train.sparkSession.createDataFrame(
        [(*r, r[0] == top) for r in rows], "n_features int, features array<string>, cv_accuracy double, best boolean"
    )

"""Probability calibration, one class against the rest, on held-out long probabilities.

A monotone curve is pooled in slices of its scores first, each slice by itself, then over the blocks of neighbouring
slices, until a curve is one run of blocks. The curve stays a table; a row finds its block by a running count of the
blocks that begin at or below its score.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.models import side_by_side
from rowloom.operators.ranking import running_totals
from rowloom.operators.sizing import lookup
from rowloom.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_ROWS = 200
SLICES_AT_ONCE = 16
SLICE_ROWS = 100_000


def _pooled(held: DataFrame) -> DataFrame:
    """Rows counted per model, class and score, which is all a calibration curve depends on; stored, as each fit reads it."""
    hit = (F.col("y") == F.col("class")).cast("double")
    return durable(held.groupBy("model", "class", "p").agg(F.avg(hit).alias("rate"), F.count(F.lit(1)).cast("double").alias("n")))


def _renormalise(df: DataFrame, key: str, k: int) -> DataFrame:
    """Shares of one row and model; summed in the order of classes as rows lie beside each other, no list of them is made."""
    cells = Window.partitionBy(key, "model").orderBy("class", "p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    told = F.count("p").over(cells) == F.count(F.lit(1)).over(cells)
    summed = df.select(key, "model", "class", "p", F.when(told, F.sum("p").over(cells)).alias("_t"))
    return summed.select(key, "model", "class", F.when(F.col("_t") > 0, F.col("p") / F.col("_t")).otherwise(1.0 / k).alias("p"))


def enough_rows(held: DataFrame, min_rows: int) -> list[str]:
    """Models with at least ``min_rows`` held-out rows, each counted once over its classes."""
    per_class = held.groupBy("model", "class").agg(F.count(F.lit(1)).alias("n"))
    counts = per_class.groupBy("model").agg(F.max("n").alias("n"))
    return sorted(r["model"] for r in counts.where(F.col("n") >= min_rows).collect())


def _moved(df: DataFrame, key: str, k: int, models: list[str], curve) -> DataFrame:
    """``curve(part, model, class)`` on the rows of each fitted model; other models stay as they are."""
    rows = df.select(key, "model", "class", "p")
    if not models:
        return rows
    parts = None
    for m in models:
        for c in range(k):
            part = curve(rows.where((F.col("model") == m) & (F.col("class") == c)), m, c).select(key, "model", "class", "p")
            parts = part if parts is None else parts.unionByName(part)
    rest = rows.where(~F.col("model").isin(models) | F.col("model").isNull())
    return _renormalise(parts, key, k).unionByName(rest)


def _merged_falls(low: np.ndarray, high: np.ndarray, mean: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks in the order of their scores; each run of means that do not rise becomes one, whatever the order of merging."""
    while len(mean) > 1:
        rises = np.flatnonzero(mean[1:] > mean[:-1]) + 1
        if 2 * (len(rises) + 1) > len(mean):
            break
        first = np.append(0, rises)
        total = np.add.reduceat(n, first)
        low, high = low[first], high[np.append(rises, len(high)) - 1]
        mean, n = np.add.reduceat(mean * n, first) / total, total
    return low, high, mean, n


def pool_adjacent_violators(low: np.ndarray, high: np.ndarray, mean: np.ndarray, n: np.ndarray) -> tuple[list, ...]:
    """Blocks in the order of their scores, put together wherever a mean is not above the one before."""
    lows, highs, means, sizes = [], [], [], []
    for a, b, m, w in zip(low.tolist(), high.tolist(), mean.tolist(), n.tolist()):
        while means and means[-1] >= m:
            m = (means[-1] * sizes[-1] + m * w) / (sizes[-1] + w)
            w += sizes[-1]
            a = lows[-1]
            for part in (lows, highs, means, sizes):
                part.pop()
        for part, value in ((lows, a), (highs, b), (means, m), (sizes, w)):
            part.append(value)
    return lows, highs, means, sizes


def _pool(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("low")
    low, high, mean, n = pool_adjacent_violators(*_merged_falls(*(rows[c].to_numpy(dtype=np.float64) for c in ("low", "high", "fitted", "n"))))
    return pd.DataFrame({
        "model": rows["model"].iloc[0], "class": rows["class"].iloc[0], "slice": rows["slice"].iloc[0],
        "low": low, "high": high, "fitted": mean, "n": n,
    })


def fit_isotonic(held: DataFrame) -> DataFrame:
    """Monotone curves of all models and classes: (model, class, no, low, high, fitted, next_low, next_fitted).

    ``no`` counts the blocks of a curve from 1. Rows are counted per score first. A slice holds a range of scores; it is
    pooled in parts of ``SLICE_ROWS`` scores first, so that no task holds more. The blocks of ``SLICES_AT_ONCE`` neighbouring
    slices are pooled together until one is left; n scores that do not repeat end in blocks of the order of n to the power
    2/3 at most. Rows without score, model or class play no part.
    """
    hit = (F.col("y") == F.col("class")).cast("double")
    told = held.where(F.col("p").isNotNull() & F.col("model").isNotNull() & F.col("class").isNotNull())
    pooled = told.groupBy("model", "class", "p").agg(F.avg(hit).alias("fitted"), F.count(F.lit(1)).cast("double").alias("n"))
    spread = pooled.repartitionByRange("model", "class", "p")
    # Which slice a score is in depends on sampled bounds, so it is stored.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    blocks = durable(spread.sortWithinPartitions("model", "class", "p").select(
        "model", "class", F.spark_partition_id().alias("slice"), F.col("p").alias("low"), F.col("p").alias("high"), "fitted", "n",
        F.floor(place / SLICE_ROWS).alias("part"),
    ))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.drop("part").schema.fields)
    slices = spread.rdd.getNumPartitions()
    blocks = blocks.groupBy("model", "class", "slice", "part").applyInPandas(_pool, schema)
    blocks = blocks.groupBy("model", "class", "slice").applyInPandas(_pool, schema)
    while slices > 1:
        slices = -(-slices // SLICES_AT_ONCE)
        wider = blocks.withColumn("slice", (F.col("slice") / SLICES_AT_ONCE).cast("int"))
        blocks = wider.groupBy("model", "class", "slice").applyInPandas(_pool, schema)
    order = Window.partitionBy("model", "class").orderBy("low")
    return durable(blocks.select(
        "model", "class", F.row_number().over(order).cast("long").alias("no"), "low", "high", "fitted",
        F.lead("low").over(order).alias("next_low"), F.lead("fitted").over(order).alias("next_fitted"),
    ))


def apply_isotonic(curves: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, model, class, p) with ``p`` moved onto the curves, linearly between two blocks; other rows stay as they are.

    Equal scores of a class must differ in ``key``.
    """
    marks = curves.select(F.lit(None).cast(rows.schema[key].dataType).alias(key), "model", "class", F.col("low").alias("p"), F.lit(1).cast("long").alias("_mark"))
    both = rows.select(key, "model", "class", "p", F.lit(0).cast("long").alias("_mark")).unionByName(marks)
    order = [F.col("p").asc(), F.col("_mark").desc(), F.col(key).asc()]
    counted = running_totals(both, ["model", "class"], order, {"_at": F.col("_mark")}).where("_mark = 0")
    placed = counted.withColumn("no", F.greatest("_at", F.lit(1).cast("long"))).drop("_mark", "_at")
    found = lookup(placed, curves, ["model", "class", "no"])
    between = F.col("fitted") + (F.col("next_fitted") - F.col("fitted")) * (F.col("p") - F.col("high")) / (F.col("next_low") - F.col("high"))
    moved = F.when(F.col("fitted").isNull() | F.col("p").isNull(), F.col("p")).when(
        (F.col("p") <= F.col("high")) | F.col("next_low").isNull(), F.col("fitted")
    ).otherwise(between)
    return found.select(key, "model", "class", moved.alias("p"))


def isotonic_calibration(held: DataFrame, df: DataFrame, key: str, k: int, min_rows: int = MIN_ROWS) -> DataFrame:
    """Monotone curve per model and class, then a sum of 1; a model with fewer held-out rows stays as it is."""
    models = enough_rows(held, min_rows)
    rows = df.select(key, "model", "class", "p")
    if not models:
        return rows
    curves = fit_isotonic(held.where(F.col("model").isin(models)))
    moved = apply_isotonic(curves, rows.where(F.col("model").isin(models)), key)
    return _renormalise(moved, key, k).unionByName(rows.where(~F.col("model").isin(models) | F.col("model").isNull()))


def _fit_pooled(pooled: DataFrame) -> tuple[float, float]:
    pooled = VectorAssembler(inputCols=["p"], outputCol="_v").transform(pooled)
    # Each score carries its positives and its negatives as two weighted rows.
    both = pooled.select("_v", F.lit(1.0).alias("_y"), (F.col("rate") * F.col("n")).alias("_w")).unionByName(
        pooled.select("_v", F.lit(0.0).alias("_y"), ((1 - F.col("rate")) * F.col("n")).alias("_w"))
    ).where(F.col("_w") > 0)
    fitted = LogisticRegression(featuresCol="_v", labelCol="_y", weightCol="_w", family="binomial", tol=1e-9).fit(both)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def fit_sigmoids(held: DataFrame, models: list[str], k: int) -> dict[tuple[str, int], tuple[float, float]]:
    """Slope and constant of the logistic curve of each model and class. Rows are counted per score once for all of them."""
    pooled = _pooled(held)
    names = [(m, c) for m in models for c in range(k)]

    def fit(m: str, c: int):
        return lambda: _fit_pooled(pooled.where((F.col("model") == m) & (F.col("class") == c)))

    return dict(zip(names, side_by_side([fit(m, c) for m, c in names])))


def fit_sigmoid(held: DataFrame, model: str, c: int) -> tuple[float, float]:
    """Slope and constant of the logistic curve of one model's class."""
    return _fit_pooled(_pooled(held.where((F.col("model") == model) & (F.col("class") == c))))


def sigmoid_calibration(held: DataFrame, df: DataFrame, key: str, k: int, min_rows: int = MIN_ROWS) -> DataFrame:
    """Logistic curve per model and class on the score, then a sum of 1; as for ``isotonic_calibration``."""
    models = enough_rows(held, min_rows)
    fitted = fit_sigmoids(held.where(F.col("model").isin(models)), models, k) if models else {}

    def curve(part: DataFrame, model: str, c: int) -> DataFrame:
        slope, base = fitted[model, c]
        return part.withColumn("p", 1 / (1 + F.exp(-(F.col("p") * slope + base))))

    return _moved(df, key, k, models, curve)


def calibration_gain(before: DataFrame, after: DataFrame, positive: Column) -> DataFrame:
    """Log loss and Brier score per model and class, before and after, from long rows with ``y``, ``class`` and ``p``."""
    def scored(df: DataFrame, when: str) -> DataFrame:
        p = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
        hit = positive.cast("double")
        loss = -(hit * F.log(p) + (1 - hit) * F.log(1 - p))
        gap = F.col("p") - hit
        return df.groupBy("model", "class").agg(F.avg(loss).alias(f"log_loss_{when}"), F.avg(gap * gap).alias(f"brier_{when}"))

    return scored(before, "before").join(scored(after, "after"), ["model", "class"])

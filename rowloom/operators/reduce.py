"""Dimensionality reduction and clustering of a numeric block."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.sums import summed

_STATE = "component int, share double, loadings array<double>, shift double"


def _vectors(df: DataFrame, block: str) -> DataFrame:
    return df.select(array_to_vector(F.col(block).cast("array<double>")).alias("_v"))


def _signed(matrix: np.ndarray) -> np.ndarray:
    """Columns turned so that the loading of largest size is positive."""
    top = np.abs(matrix).argmax(axis=0)
    return matrix * np.where(matrix[top, np.arange(matrix.shape[1])] < 0, -1.0, 1.0)


def fit_pca(df: DataFrame, block: str, k: int) -> DataFrame:
    """State: per component its share of the variance, its loadings and its score at the mean."""
    vectors = _vectors(df, block).persist()
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vectors)
    mean = vectors.select(Summarizer.mean(F.col("_v"))).first()[0].toArray()
    vectors.unpersist()
    loadings = _signed(model.pc.toArray())
    rows = [
        (i, float(model.explainedVariance[i]), loadings[:, i].tolist(), float(mean @ loadings[:, i]))
        for i in range(k)
    ]
    return df.sparkSession.createDataFrame(rows, _STATE)


def fit_svd(df: DataFrame, block: str, k: int) -> DataFrame:
    """State of an uncentred reduction: right singular vectors from the slot-by-slot product matrix."""
    vectors = _vectors(df, block).persist()
    stats = vectors.select(Summarizer.metrics("count", "mean", "std").summary(F.col("_v")).alias("s")).first()["s"]
    corr = np.nan_to_num(Correlation.corr(vectors, "_v").first()[0].toArray())
    vectors.unpersist()
    n, mean, std = stats["count"], stats["mean"].toArray(), stats["std"].toArray()
    np.fill_diagonal(corr, 1.0)
    gram = corr * np.outer(std, std) * (n - 1) + n * np.outer(mean, mean)
    values, sides = np.linalg.eigh(gram)
    order = np.argsort(values)[::-1][:k]
    loadings = _signed(sides[:, order])
    share = values[order] / max(values.sum(), 1e-300)
    rows = [(i, float(share[i]), loadings[:, i].tolist(), 0.0) for i in range(len(order))]
    return df.sparkSession.createDataFrame(rows, _STATE)


def fit_wide(df: DataFrame, block: str, k: int, centred: bool = True, oversample: int = 16, passes: int = 6, seed: int = 42) -> DataFrame:
    """State of a reduction of very many slots by a randomised range finder, as of ``fit_pca`` (``centred``) or ``fit_svd``.

    A few more directions than asked for, drawn from ``seed``, are multiplied with the rows' product matrix again and again
    and made orthonormal in between. A pass is one scan; what it sends is slots x directions, and no matrix of slots x slots
    exists anywhere. The more the leading components stand out, the fewer passes are needed; with as many directions as
    slots the result is exact. ``share`` is of the whole variance (or sum of squares).
    """
    rows = df.select(F.col(block).cast("array<double>").alias("x"))
    first = rows.first()
    if first is None:
        raise ValueError("no rows to reduce")
    slots = len(first["x"])
    wide = min(slots, k + oversample)

    def blocks_of(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, slots)

    def moments(batches) -> np.ndarray:
        out = np.zeros(slots + 2)
        for x in blocks_of(batches):
            out[:slots] += x.sum(axis=0)
            out[slots] += (x * x).sum()
            out[slots + 1] += len(x)
        return out

    told = summed(rows, moments, slots + 2)
    n = told[slots + 1]
    mean = told[:slots] / n if centred else np.zeros(slots)
    energy = told[slots] - n * float(mean @ mean) if centred else told[slots]
    sides, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((slots, wide)))

    def product(sides: np.ndarray) -> np.ndarray:
        def of_task(batches) -> np.ndarray:
            out = np.zeros((slots, wide))
            for x in blocks_of(batches):
                near = x - mean
                out += near.T @ (near @ sides)
            return out.reshape(-1)

        return summed(rows, of_task, slots * wide).reshape(slots, wide)

    for _ in range(passes if wide < slots else 1):
        sides, _ = np.linalg.qr(product(sides))
    values, turn = np.linalg.eigh(sides.T @ product(sides))
    order = np.argsort(values)[::-1][:k]
    loadings = _signed(sides @ turn[:, order])
    shares = values[order] / max(energy, 1e-300)
    found = [(i, float(shares[i]), loadings[:, i].tolist(), float(mean @ loadings[:, i])) for i in range(len(order))]
    return df.sparkSession.createDataFrame(found, _STATE)


def project(state: DataFrame, block: str) -> Column:
    """Scores of a block under a fitted state, one matrix product per Arrow batch."""
    rows = state.orderBy("component").collect()  # one row per component
    matrix = np.array([r["loadings"] for r in rows]).T
    shift = np.array([r["shift"] for r in rows])

    @F.pandas_udf("array<double>")
    def scores(values: pd.Series) -> pd.Series:
        if len(values) == 0:
            return pd.Series([], dtype=object)
        stacked = np.vstack([np.asarray(v, dtype=np.float64) for v in values])
        return pd.Series(list(stacked @ matrix - shift))

    return scores(F.col(block).cast("array<double>"))


def fit_kmeans(df: DataFrame, block: str, k: int = 15, seed: int = 42):
    return KMeans(k=k, seed=seed, initMode="k-means||", featuresCol="_v", predictionCol="cluster").fit(_vectors(df, block).persist())


def apply_kmeans(model, df: DataFrame, block: str) -> DataFrame:
    vectors = df.withColumn("_v", array_to_vector(F.col(block).cast("array<double>")))
    return model.transform(vectors).drop("_v")


def cluster_flags(k: int, column: str = "cluster") -> list[Column]:
    return [(F.col(column) == i).cast("int").alias(f"cluster_{i}") for i in range(k)]

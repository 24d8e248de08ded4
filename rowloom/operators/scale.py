"""Scaling, binning and power transforms that need a statistic of the whole column."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.numeric import equal_width_bin, yeo_johnson
from rowloom.operators.quantiles import is_after, rows_at_ranks
from rowloom.operators.settled import settled
from rowloom.operators.sizing import ONE_TASK_ROWS

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows, per column: values, their mean, and the sum of squared distances from it. A constant column has none."""
    found: dict[int, tuple[int, float, float]] = {}
    with np.errstate(invalid="ignore"):
        for batch in batches:
            for i, column in enumerate(batch.columns):
                x = column.drop_null().to_numpy()
                if len(x):
                    apart = x - x[0]
                    shift = apart.mean()
                    apart -= shift
                    n, mean, m2 = found.get(i, (0, 0.0, 0.0))
                    own, total = len(x), n + len(x)
                    step = x[0] + shift - mean if n else 0.0
                    mean = mean + step * own / total if n else x[0] + shift
                    found[i] = total, mean, m2 + apart @ apart + step * step * n * own / total
    arrays = [[found[i][k] for i in found] for k in range(3)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int32()), pa.array(arrays[0], pa.int64()), pa.array(arrays[1], pa.float64()), pa.array(arrays[2], pa.float64())],
        names=["i", "n", "mean", "m2"],
    )


def fit_standard(df: DataFrame, columns: list[str]) -> DataFrame:
    """State row: mean and population standard deviation per column, a deviation of 0 read as 1."""
    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).mapInArrow(_moments, "i int, n bigint, mean double, m2 double")
    one = Window.partitionBy("i")  # a row per task
    # From the least mean on, so that equal means give exactly that mean.
    least = F.min("mean").over(one)
    parts = parts.withColumn("_least", least).withColumn("_all", F.col("_least") + F.sum(F.col("n") * (F.col("mean") - F.col("_least"))).over(one) / F.sum("n").over(one))
    apart = F.col("mean") - F.col("_all")
    sums = parts.groupBy("i").agg(F.first("_all").alias("mean"), F.sqrt(F.sum(F.col("m2") + F.col("n") * apart * apart) / F.sum("n")).alias("sd"))
    rows = sums.select("i", "mean", F.when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0)).alias("sd")).collect()  # one row per column
    found = {r["i"]: (r["mean"], r["sd"]) for r in rows}
    state = [(f"{c}__{name}", found.get(i, (None, 1.0))[k]) for i, c in enumerate(columns) for k, name in enumerate(("mean", "sd"))]
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name, _ in state])
    return df.sparkSession.createDataFrame([tuple(v for _, v in state)], schema)


def apply_standard(df: DataFrame, state: DataFrame, columns: list[str]) -> DataFrame:
    s = state.first()
    scaled = {c: ((F.col(f"`{c}`") - F.lit(s[f"{c}__mean"])) / F.lit(s[f"{c}__sd"])).alias(c) for c in columns}
    return df.select(*[scaled.get(c, F.col(f"`{c}`")) for c in df.columns])


def fit_quantile_cuts(
    df: DataFrame, value: str, key: str, bins: int = 5, one_task_rows: int = ONE_TASK_ROWS
) -> list[tuple]:
    """The last (value, key) of every bin but the final one, found without sorting the table."""
    total = df.agg(F.count(value)).first()[0]
    steps = max(total - 1, 1)
    # The largest rank r with ceil((r - 1) * bins / steps) <= bin + 1.
    last = [min((b + 1) * steps // bins + 1, total) for b in range(bins - 1)]
    return rows_at_ranks(df, value, key, last, one_task_rows) if total else []


def quantile_bins(
    df: DataFrame, value: str, key: str, out: str, bins: int = 5, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Bins of equal count in the order of value, then row key; a projection over the fitted cuts."""
    cuts = fit_quantile_cuts(df, value, key, bins, one_task_rows)
    place = F.lit(0)
    for cut in cuts:
        place = place + is_after(value, key, cut).cast("int")
    return df.select(*df.columns, F.when(F.col(value).isNotNull(), place).alias(out))


def fit_range(df: DataFrame, column: str) -> tuple[float, float]:
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def equal_width_bins(df: DataFrame, column: str, out: str, bins: int = 5) -> DataFrame:
    low, high = fit_range(df, column)
    return df.withColumn(out, equal_width_bin(F.col(column), low, high, bins))


def polynomial_interactions(columns: list[str]) -> list[Column]:
    """The columns and the product of every pair, missing values as 0; names follow the columns."""
    filled = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns}
    out = [filled[c].alias(c) for c in columns]
    for i, a in enumerate(columns):
        out += [(filled[a] * filled[b]).alias(f"{a} {b}") for b in columns[i + 1:]]
    return out


def log_likelihoods(df: DataFrame, column: str, lambdas: list[float]) -> list[float]:
    """Yeo-Johnson profile log-likelihood of every candidate, in one pass."""
    x = F.col(column).cast("double")
    aggs = [F.count(x).alias("n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("jac")]
    aggs += [F.var_pop(yeo_johnson(x, lam)).alias(f"v{i}") for i, lam in enumerate(lambdas)]
    row = df.agg(*aggs).first()
    n = row["n"]
    return [
        -n / 2 * math.log(row[f"v{i}"]) + (lam - 1) * row["jac"] if row[f"v{i}"] else -math.inf
        for i, lam in enumerate(lambdas)
    ]


def fit_yeo_johnson(df: DataFrame, column: str, low=-3.0, high=5.0, width=17, tolerance=1e-3) -> DataFrame:
    """State row (lambda, mean, sd): a grid is narrowed around its best point, one pass per grid."""
    data = df.select(column)
    while high - low > tolerance:
        step = (high - low) / (width - 1)
        grid = [low + step * i for i in range(width)]
        scores = log_likelihoods(data, column, grid)
        best = grid[max(range(width), key=scores.__getitem__)]
        low, high = best - step, best + step
    lam = (low + high) / 2
    moved = yeo_johnson(F.col(column).cast("double"), lam)
    sd = F.stddev_pop(moved)
    return settled(data.agg(
        F.lit(lam).alias("lam"), F.avg(moved).alias("mean"),
        F.when(sd > 0, sd).otherwise(F.lit(1.0)).alias("sd"),
    ))


def apply_yeo_johnson(df: DataFrame, state: DataFrame, column: str, out: str) -> DataFrame:
    s = state.first()
    moved = yeo_johnson(F.col(column).cast("double"), s["lam"])
    return df.withColumn(out, (moved - F.lit(s["mean"])) / F.lit(s["sd"]))

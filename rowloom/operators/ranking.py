"""Running totals and exact ranks over groups of any size.

A plain window holds a whole group in one task. Here every group is cut into slices that are
ordered among themselves, totals run inside a slice, and the totals of earlier slices are added
from a small offset table. Groups that hold most of the rows are spread like all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.keys import hash_slice
from rowloom.operators.sizing import ONE_TASK_ROWS
from rowloom.session import durable, sweep


# About so many rows are a slice.
SLICE_ROWS = 500_000


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    sums: dict[str, Column],
    slice_by: Column | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Add inclusive running sums along ``order`` within ``group``.

    ``order`` must identify a row within its group. ``slice_by`` may give a column that never
    decreases along ``order`` and spreads evenly (a hash prefix); it needs no sampling pass.
    Without it, inputs counted as small use one window and others a range partitioning.
    """
    rows = 0 if slice_by is not None else df.count()
    if slice_by is not None:
        sliced = df.withColumn("_slice", slice_by)
    elif rows <= one_task_rows:
        window = Window.partitionBy(*group).orderBy(*order)
        window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select("*", *[F.sum(e).over(window).alias(n) for n, e in sums.items()])
    else:
        # The slice number depends on sampled bounds, so it is stored before it is read twice. More rows are more slices, not longer ones.
        slices = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // SLICE_ROWS))
        spread = df.repartitionByRange(slices, *[F.col(f"`{g}`") for g in group], *order)
        sliced = durable(spread.withColumn("_slice", F.spark_partition_id()))
        sweep(df.sparkSession)

    sliced = sliced.withColumn("_group", F.struct(F.lit(0), *[F.col(f"`{g}`") for g in group]))
    keys = ["_group", "_slice"]
    earlier = Window.partitionBy("_group").orderBy("_slice")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys)
        .agg(*[F.sum(e).alias(f"_part_{n}") for n, e in sums.items()])
        .select(*keys, *[F.coalesce(F.sum(f"_part_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums])
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.select("*", *[F.sum(e).over(inside).alias(f"_local_{n}") for n, e in sums.items()])
    # The window already placed the rows by (_group, _slice); the join reuses that placement.
    return local.join(offsets, on=keys, how="left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.col(f"_local_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums],
    )


def rank_first(
    df: DataFrame, value: str, tie: str, name: str = "rank", one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Rank 1..n by ``value``; equal values rank by ``tie``."""
    order = [F.col(value).asc(), F.col(tie).asc()]
    return running_totals(df, [], order, {name: F.lit(1).cast("long")}, one_task_rows=one_task_rows)


def hash_rank(df: DataFrame, group: list[str], key: Column, tie: str, name: str = "rank") -> DataFrame:
    """Rank 1..n within ``group`` in the order of a seeded hash key, without a sampling pass."""
    spark = df.sparkSession
    keyed = df.withColumn("_key", key)
    ranked = running_totals(
        keyed,
        group,
        [F.col("_key").asc(), F.col(tie).asc()],
        {name: F.lit(1).cast("long")},
        slice_by=hash_slice(spark, F.col("_key")),
    )
    return ranked.drop("_key")

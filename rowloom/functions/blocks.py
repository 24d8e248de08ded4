"""Per-row statistics of a numeric block held as one ``array<double>`` column. No shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def filled_block(block: Column) -> Column:
    """The block as doubles with missing entries (null or NaN) set to 0."""
    return F.transform(
        block.cast("array<double>"),
        lambda x: F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x),
    )


def block_sum(block: Column) -> Column:
    return F.aggregate(block, F.lit(0.0), lambda acc, x: acc + x)


def block_std(block: Column) -> Column:
    """Sample standard deviation (n-1); 0 for a block of one entry. One walk with a running mean."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(acc: Column, x: Column) -> Column:
        n = acc["n"] + 1
        gap = x - acc["mean"]
        # gap * (x - new mean) = gap^2 * (n - 1) / n
        return F.struct(
            n.alias("n"), (acc["mean"] + gap / n).alias("mean"), (acc["m2"] + gap * gap * (acc["n"] / n)).alias("m2")
        )

    return F.aggregate(
        block, start, add, lambda acc: F.when(acc["n"] > 1, F.sqrt(acc["m2"] / F.greatest(acc["n"] - 1, F.lit(1.0)))).otherwise(F.lit(0.0))
    )


def sorted_quantile(ordered: Column, q: float) -> Column:
    """Quantile of an already sorted block, interpolating linearly between neighbours."""
    position = (F.size(ordered) - 1) * F.lit(q)
    low = F.floor(position).cast("int")
    high = F.ceil(position).cast("int")
    below, above = F.get(ordered, low), F.get(ordered, high)
    return below + (above - below) * (position - low)


def row_stats(block: Column, prefix: str) -> list[Column]:
    ordered = F.sort_array(block)
    total = block_sum(block)
    return [
        (total / F.size(block)).alias(f"{prefix}_mean"),
        block_std(block).alias(f"{prefix}_std"),
        total.alias(f"{prefix}_sum"),
        F.array_min(block).alias(f"{prefix}_min"),
        F.array_max(block).alias(f"{prefix}_max"),
        sorted_quantile(ordered, 0.5).alias(f"{prefix}_median"),
    ]


def row_nonzero(block: Column, prefix: str) -> list[Column]:
    count = F.size(F.filter(block, lambda x: x != 0))
    return [
        count.alias(f"{prefix}_non_zero_count"),
        (count / F.size(block)).alias(f"{prefix}_non_zero_ratio"),
    ]


def row_quantiles(block: Column, prefix: str) -> list[Column]:
    ordered = F.sort_array(block)
    q25, q75 = sorted_quantile(ordered, 0.25), sorted_quantile(ordered, 0.75)
    return [
        q25.alias(f"{prefix}_q25"),
        q75.alias(f"{prefix}_q75"),
        (q75 - q25).alias(f"{prefix}_iqr"),
    ]

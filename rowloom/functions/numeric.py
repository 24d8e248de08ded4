"""Numeric transforms of single columns, pairs and flag groups."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F


def power_terms(name: str) -> list[Column]:
    x = F.col(name)
    return [
        (x * x).alias(f"{name}_squared"),
        (x * x * x).alias(f"{name}_cubed"),
        F.sqrt(F.abs(x)).alias(f"{name}_sqrt"),
        F.log1p(x).alias(f"{name}_log1p"),
    ]


def shifted_log(x: Column, minimum: float) -> Column:
    return F.log1p(x - F.lit(minimum) + F.lit(1e-6))


def quantile_bin_of_rank(rank: Column, total: Column | int, bins: int = 5) -> Column:
    """Equal-count bin 0..bins-1 of rank 1..total, in integer arithmetic."""
    total = total if isinstance(total, Column) else F.lit(total)
    steps = total - 1
    whole = ((rank - 1) * bins + steps - 1) / F.greatest(steps, F.lit(1))
    return F.greatest(F.floor(whole) - 1, F.lit(0)).cast("int")


def equal_width_bin(x: Column, low: float, high: float, bins: int = 5) -> Column:
    """Equal-width bin 0..bins-1; a constant column falls into bin 0."""
    if not high > low:
        return F.when(x.isNotNull(), F.lit(0))
    place = F.ceil((x - F.lit(low)) / F.lit(high - low) * bins) - 1
    return F.greatest(place, F.lit(0)).cast("int")


def pair_products(names: list[str], suffix: str = "interact") -> list[Column]:
    return [
        (F.col(a) * F.col(b)).alias(f"{a}_{b}_{suffix}")
        for a, b in combinations(names, 2)
    ]


def flag_sum(names: list[str]) -> Column:
    total = F.coalesce(F.col(names[0]), F.lit(0))
    for name in names[1:]:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total


def flag_pair_logic(names: list[str]) -> list[Column]:
    pairs = list(combinations(names, 2))
    both = [F.col(a).bitwiseAND(F.col(b)).alias(f"{a}_and_{b}") for a, b in pairs]
    either = [F.col(a).bitwiseOR(F.col(b)).alias(f"{a}_or_{b}") for a, b in pairs]
    return both + either


def yeo_johnson(x: Column, lam: float) -> Column:
    """Yeo-Johnson power transform for a fixed exponent."""
    up = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / F.lit(lam)
    rest = 2.0 - lam
    down = -F.log1p(-x) if abs(rest) < 1e-12 else -(F.pow(1 - x, F.lit(rest)) - 1) / F.lit(rest)
    return F.when(x >= 0, up).when(x < 0, down)

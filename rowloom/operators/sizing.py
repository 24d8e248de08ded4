"""Size checks that stand before every broadcast and every single-group computation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
ONE_TASK_ROWS = 2_000_000
HOT_ROWS = 5_000_000


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and an upper estimate of the bytes of ``df``, in one aggregate."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 24
        elif isinstance(field.dataType, T.AtomicType):
            width = width + 16
        else:
            width = width + F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))) * 4
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def fits(rows: int, size: int) -> bool:
    """Whether a frame of this measured size may be broadcast."""
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def lookup(df: DataFrame, table: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join a table of unique keys onto ``df``: by broadcast when it is small, else by ``split_join``.

    A stream cannot be counted by key before it arrives; beyond the bounds its micro-batches join by shuffle.
    """
    kept = table.persist()
    rows, size = size_of(kept)
    if fits(rows, size):
        return df.join(F.broadcast(kept), on=on, how=how)
    if df.isStreaming:
        return df.join(kept, on=on, how=how)
    return split_join(df, kept, on, how)


def split_join(
    df: DataFrame, table: DataFrame, on: str | list[str], how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join a large table of unique keys onto ``df`` when some keys may hold much of ``df``.

    Keys with more than ``hot_rows`` rows are few (rows of ``df`` / ``hot_rows``); their part of
    the table is broadcast, so hot rows stay where they are. All other rows join by shuffle.
    Where these keys are too many to broadcast, ``hot_rows`` is raised until the hottest ones fit.
    """
    keys = [on] if isinstance(on, str) else list(on)
    counts = df.where(all_of([F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    known = counts.where(F.col("_rows") > hot_rows).persist()
    while True:
        hot = known.where(F.col("_rows") > hot_rows).select(*keys)
        rows, size = size_of(hot)
        if rows == 0:
            return df.join(table, on=keys, how=how)
        if fits(rows, size):
            hot_part = table.join(F.broadcast(hot), keys, "left_semi")
            if fits(*size_of(hot_part)):
                break
        hot_rows *= 2
    marked = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    spread = marked.where(F.col("_hot")).drop("_hot").join(F.broadcast(hot_part), keys, how)
    rest = marked.where(F.col("_hot").isNull()).drop("_hot").join(table, keys, how)
    return spread.unionByName(rest)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)

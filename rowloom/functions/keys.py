"""Seeded hash keys: the only source of randomness, so reruns and partitionings agree."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def hash_hex(seed: int | str, *cols: str | Column) -> Column:
    """md5 hex of ``seed:col:col...``; equal rows get equal keys on every run."""
    parts = [F.lit(str(seed))]
    parts += [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_int(key: Column) -> Column:
    """First 32 bits of a hex key as a long in [0, 2^32)."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def hash_unit(key: Column) -> Column:
    """A hex key as a double in [0, 1)."""
    return hash_int(key) / F.lit(4294967296.0)


def hash_slice(spark: SparkSession, key: Column) -> Column:
    """A prefix of a hex key: monotone in the key, uniform, about 4+ slices per shuffle partition."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    digits = 1
    while 16**digits < wanted:
        digits += 1
    return F.substring(key, 1, digits)

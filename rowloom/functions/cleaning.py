"""Cleaning expressions: null tokens, coercion, booleans, non-finite values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens read as missing, and text read as a boolean.
NULL_TOKENS = ["", " ", "NA", "None", "NULL"]
TRUE_TEXT = ["true", "yes", "1"]


def null_tokens(col: Column) -> Column:
    return F.when(~col.isin(NULL_TOKENS), col)


def to_number(col: Column) -> Column:
    """Text to double; text that is no number, and NaN, become null."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def bool_to_int(col: Column, dtype: T.DataType) -> Column:
    """0/1 chosen by the declared type. Text is matched without trimming; the rest is 0."""
    if isinstance(dtype, T.BooleanType):
        hit = col
    elif isinstance(dtype, T.StringType):
        hit = F.lower(col).isin(TRUE_TEXT)
    else:
        # A missing number is not equal to zero, so it counts as true.
        hit = F.coalesce(col != 0, F.lit(True))
    return F.when(hit, 1).otherwise(0)


def is_finite(col: Column) -> Column:
    return ~(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))))


def nonfinite_to_null(col: Column) -> Column:
    return F.when(is_finite(col), col)


def nonfinite_to(col: Column, fill: float | Column = 0.0) -> Column:
    return F.coalesce(nonfinite_to_null(col), fill if isinstance(fill, Column) else F.lit(float(fill)))

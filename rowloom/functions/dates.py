"""Year-month text (``YYYY/MM``) to calendar features."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_year_month(col: Column, default_year: int = 1900, default_month: int = 1) -> tuple[Column, Column]:
    """Year from the first four characters and month from the part after ``/``, each with a default."""
    year = F.substring(col, 1, 4).try_cast("int")
    month = F.try_element_at(F.split(col, "/"), F.lit(2)).try_cast("int")
    return (
        F.coalesce(year, F.lit(default_year)),
        F.coalesce(month, F.lit(default_month)),
    )


def strict_year_month(col: Column, default_year: int = 2020, default_month: int = 1) -> tuple[Column, Column]:
    """All or nothing: text that is not a valid ``YYYY/MM`` takes both defaults."""
    valid = col.rlike(r"^[0-9]{4}/(0?[1-9]|1[0-2])$")
    year = F.when(valid, F.substring(col, 1, 4).try_cast("int")).otherwise(default_year)
    month = F.when(valid, F.try_element_at(F.split(col, "/"), F.lit(2)).try_cast("int")).otherwise(default_month)
    return year, month


def clip_month(month: Column) -> Column:
    return F.least(F.greatest(month, F.lit(1)), F.lit(12))


def cyclic_month(month: Column) -> tuple[Column, Column]:
    angle = month * F.lit(2 * math.pi) / F.lit(12.0)
    return F.sin(angle), F.cos(angle)


def absolute_month(year: Column, month: Column) -> Column:
    return year * 12 + month


def quarter_of(month: Column) -> Column:
    return (F.floor((month - 1) / 3) + 1).cast("int")

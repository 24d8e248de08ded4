"""Date features that need a statistic of the train table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.operators.settled import settled


def fit_latest_month(df: DataFrame) -> DataFrame:
    """State row: the latest year and the latest month in it; 2024/12 when no year is after 1900."""
    top = df.agg(F.max(F.struct("year", "month")).alias("top"))
    known = F.col("top.year") > 1900
    return settled(top.select(
        F.when(known, F.col("top.year")).otherwise(2024).alias("year"),
        F.when(known, F.col("top.month")).otherwise(12).alias("month"),
    ))


def recency_months(df: DataFrame, state: DataFrame) -> DataFrame:
    """Whole months before the reference month, never negative."""
    ref = state.first()
    months = (F.lit(ref["year"]) - F.col("year")) * 12 + (F.lit(ref["month"]) - F.col("month"))
    return df.withColumn("recency", F.greatest(months, F.lit(0)))


def fit_mean_year(df: DataFrame) -> DataFrame:
    """State row: mean of the years after 1900, or 2020."""
    return settled(df.agg(F.coalesce(F.avg(F.when(F.col("year") > 1900, F.col("year"))), F.lit(2020.0)).alias("mean_year")))


def year_norm(df: DataFrame, state: DataFrame) -> DataFrame:
    return df.withColumn("year_norm", F.col("year") - F.lit(state.first()["mean_year"]))

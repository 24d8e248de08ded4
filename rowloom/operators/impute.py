"""Missing values. A fit is one pass and returns one state row; applying it is a projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.cleaning import nonfinite_to_null
from rowloom.operators.quantiles import exact_quantiles
from rowloom.operators.settled import settled
from rowloom.operators.sizing import ONE_TASK_ROWS


def _state(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    fields = [T.StructField(c, T.DoubleType()) for c in values]
    row = tuple(None if v is None else float(v) for v in values.values())
    return df.sparkSession.createDataFrame([row], T.StructType(fields))


def fit_median(df: DataFrame, columns: list[str], one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Median per column; a column without any value gets 0."""
    medians = exact_quantiles(df.select(*columns), columns, 0.5, one_task_rows)
    return _state(df, {c: 0.0 if v is None else v for c, v in medians.items()})


def fit_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    return settled(df.agg(*[F.coalesce(F.avg(F.col(f"`{c}`")), F.lit(0.0)).alias(c) for c in columns]))


def apply_fill(df: DataFrame, state: DataFrame) -> DataFrame:
    """Fill the nulls of the columns in a one-row state with its values."""
    fill = state.first().asDict()
    return df.select(
        *[
            F.coalesce(F.col(f"`{c}`"), F.lit(fill[c])).alias(c) if c in fill else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def fill_constant(df: DataFrame, columns: list[str], value="Unknown") -> DataFrame:
    return df.fillna(value, subset=list(columns))


def bool_like_check(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per numeric column: are all values 0 or 1, how many are not, and what fills its nulls."""
    checks = []
    for c in columns:
        x = F.col(f"`{c}`")
        checks.append(F.count_if(~x.isin(0.0, 1.0)).alias(c))
    counted = df.agg(*checks).unpivot([], columns, "column_name", "n_other")
    state = fit_median(df, columns).unpivot([], columns, "column_name", "median")
    fill = F.when(F.col("n_other") == 0, F.lit(0.0)).otherwise(F.col("median"))
    # Both sides have one row per checked column.
    return counted.join(F.broadcast(state), "column_name").select(
        "column_name", (F.col("n_other") == 0).alias("is_boolean"), "n_other", fill.alias("fill")
    )


def apply_bool_like(df: DataFrame, report: DataFrame) -> DataFrame:
    """Fill as the report says; columns found boolean become integers."""
    rules = {r["column_name"]: r for r in report.collect()}  # one row per column

    def column(c: str) -> Column:
        if c not in rules:
            return F.col(f"`{c}`")
        filled = F.coalesce(F.col(f"`{c}`"), F.lit(rules[c]["fill"]))
        return (filled.cast("int") if rules[c]["is_boolean"] else filled).alias(c)

    return df.select(*[column(c) for c in df.columns])


def clean_nonfinite_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinite and NaN entries become the median of the finite ones."""
    cleaned = df.select(
        *[nonfinite_to_null(F.col(c)).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]
    )
    return apply_fill(cleaned, fit_median(cleaned, columns))

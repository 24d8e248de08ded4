"""Schema checks and alignment of a table with the one a model was fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.profile import count_distinct


def validate_schema(df: DataFrame, required: list[str], table: str) -> DataFrame:
    """One row per required column: whether it is there, and whether the table has any row."""
    spark = df.sparkSession
    has_rows = not df.isEmpty()
    rows = [(table, c, c in df.columns, has_rows) for c in required]
    return spark.createDataFrame(rows, "table_name string, column_name string, present boolean, has_rows boolean")


def require_schema(df: DataFrame, required: list[str], table: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    if df.isEmpty():
        raise ValueError(f"{table}: no rows")
    return df


def harmonise_types(df: DataFrame, train: T.StructType) -> DataFrame:
    """Cast shared columns to the train type: numbers by a lenient cast, the rest to text."""
    wanted = {f.name: f.dataType for f in train.fields}
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        target = wanted.get(field.name, field.dataType)
        if target != field.dataType:
            col = col.try_cast(target if isinstance(target, T.NumericType) else "string")
        out.append(col.alias(field.name))
    return df.select(*out)


def align_schema(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Exactly ``keep`` and ``columns``, in that order; a column that is missing is 0."""
    present = set(df.columns)
    return df.select(
        *keep,
        *[F.col(f"`{c}`") if c in present else F.lit(0).alias(c) for c in columns],
    )


def align_both(left: DataFrame, right: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables with the union of their columns, missing ones 0."""
    columns = [c for c in left.columns if c not in keep]
    columns += [c for c in right.columns if c not in columns and c not in keep]
    return align_schema(left, columns, keep), align_schema(right, columns, keep)


def concat_rows(*parts: DataFrame) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def detect_column_types(df: DataFrame, columns: list[str], limit: int = 10) -> DataFrame:
    """Text columns, and columns with fewer than ``limit`` distinct values, are categorical."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    long = count_distinct(df, columns).select("column_name", "n_distinct")
    kind = F.when(F.col("column_name").isin(text) | (F.col("n_distinct") < limit), "categorical")
    return long.withColumn("kind", kind.otherwise("continuous"))

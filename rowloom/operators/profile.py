"""Counts, shares, statistics and correlations of columns."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.quantiles import exact_quantiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).count().withColumnRenamed("count", "n").orderBy(F.desc("n"), column)


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value; the total comes from the counts, not from a second scan."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).persist()
    total = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select(column, "n", (F.col("n") * 100.0 / F.lit(total)).alias("pct"))


def _value_text(column: str, kind: T.DataType) -> Column:
    """A text that is equal for equal values only: zeros without sign, times as whole microseconds."""
    x = F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x = x + F.lit(0.0).cast(kind)
    elif isinstance(kind, T.TimestampType):
        x = F.unix_micros(x)
    elif isinstance(kind, (T.ArrayType, T.StructType)):
        return F.when(x.isNotNull(), F.to_json(F.struct(x)))
    return x.cast("string")


def count_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column, without and with null as a value; a table without rows has none.

    Each task keeps a (column, value) once before it is shuffled, whatever the number of columns.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), _value_text(c, kinds[c]).alias("value")) for c in columns])
    values = df.select(F.inline(cells)).distinct()
    counts = values.groupBy("column_name").agg(F.count("value").alias("n_distinct"), F.count(F.lit(1)).alias("n_distinct_with_null"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    # One row per column on both sides.
    return names.join(counts, "column_name", "left").fillna(0, subset=["n_distinct", "n_distinct_with_null"])


def constant_columns(df: DataFrame, columns: list[str], engineered: list[str] = ()) -> DataFrame:
    """Report constant columns (null counts as a value) and engineered ones with few values."""
    counts = count_distinct(df, columns)
    n = F.col("n_distinct_with_null")
    flag = F.when(n <= 1, "constant").when(
        (n <= 3) & F.col("column_name").isin(list(engineered)), "low_cardinality"
    ).otherwise("ok")
    return counts.select("column_name", n.alias("n_distinct"), flag.alias("flag"))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "n_null")


def column_stats(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Max, min, mean, median, sample std, and mean and max where a condition holds."""
    x = F.col(f"`{column}`")
    median = exact_quantiles(df.select(x), [column])[column]
    return df.agg(
        F.max(x).alias("max"),
        F.min(x).alias("min"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.avg(F.when(condition, x)).alias("mean_where"),
        F.max(F.when(condition, x)).alias("max_where"),
    ).withColumn("median", F.lit(median).cast("double"))


def corr_with_target(df: DataFrame, columns: list[str], target: str, top: int | None = None) -> DataFrame:
    """Absolute Pearson correlation of each column with the target, strongest first. One pass."""
    y = F.col(target).cast("double")
    wide = df.agg(*[F.corr(F.col(f"`{c}`").cast("double"), y).alias(c) for c in columns])
    long = wide.unpivot([], columns, "column_name", "r").where(F.col("r").isNotNull() & ~F.isnan("r"))
    ranked = long.select("column_name", F.abs("r").alias("abs_corr")).orderBy(F.desc("abs_corr"), "column_name")
    return ranked if top is None else ranked.limit(top)


def block_corr_with_target(df: DataFrame, block: str, target: str, top: int | None = None) -> DataFrame:
    """The same for each slot of a wide block, through one matrix product instead of many columns."""
    both = df.select(array_to_vector(F.col(block).cast("array<double>")).alias("_x"), F.col(target).cast("double").alias("_y"))
    joined = VectorAssembler(inputCols=["_x", "_y"], outputCol="_v").transform(both)
    matrix = Correlation.corr(joined, "_v").first()[0].toArray()
    rows = [(i, abs(float(r))) for i, r in enumerate(matrix[:-1, -1]) if r == r]
    table = df.sparkSession.createDataFrame(rows, "slot int, abs_corr double")
    ranked = table.orderBy(F.desc("abs_corr"), "slot")
    return ranked if top is None else ranked.limit(top)


def topk(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def distinct_union(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column in either table."""
    both = left.select(column).union(right.select(column))
    return both.where(F.col(column).isNotNull()).distinct()


def except_values(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    return left.select(column).subtract(right.select(column))

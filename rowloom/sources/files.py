"""Files in and out: CSV, parquet, JSON metadata, predictions, scoring of whole files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.operators.models import Fitted

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """CSV with a header and a declared schema; values that do not parse become null."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    return reader.options(**options).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, by: list[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return path


def write_predictions(df: DataFrame, path: str, key: str, label: str) -> str:
    """Two columns, key and label, as CSV with a header."""
    return write_csv(df.select(key, label), path)


def write_metadata(spark: SparkSession, path: str, values: dict[str, str | float | int | bool]) -> str:
    """One JSON object with the given entries."""
    fields = [F.lit(v).alias(k) for k, v in values.items()]
    spark.range(1).select(*fields).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, path: str, schema: T.StructType | str) -> dict:
    """The stored entries; a file that is not there reads as an empty dict."""
    try:
        row = spark.read.schema(schema).json(path).first()
    except AnalysisException:
        return {}
    return row.asDict() if row else {}


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet or CSV by the ending of the path."""
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            raise ValueError("CSV input needs a schema")
        return read_csv(spark, path, schema)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported file format: {path}")


def prediction_columns(scored: DataFrame, key: str, k: int, include_proba: bool) -> DataFrame:
    """Key and predicted class, with one column per class probability when asked for."""
    if not include_proba:
        return scored.select(key, "prediction")
    if k == 2:
        probs = [F.get("probs", F.lit(1)).alias("probability")]
    else:
        probs = [F.get("probs", F.lit(i)).alias(f"probability_class_{i}") for i in range(k)]
    return scored.select(key, "prediction", *probs)


def batch_score(
    source: DataFrame | str, prepare: Callable[[DataFrame], DataFrame], fitted: Fitted, key: str,
    include_proba: bool = False, output: str | None = None, spark: SparkSession | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame | None:
    """Score a table or file; return the predictions, or write them to CSV or parquet."""
    df = read_any(spark, source, schema) if isinstance(source, str) else source
    out = prediction_columns(fitted.score(prepare(df)), key, fitted.k, include_proba)
    if output is None:
        return out
    if output.endswith(".parquet"):
        write_parquet(out, output)
    else:
        write_csv(out, output)
    return None

"""Scoring of files as they arrive: stateless, so it equals the batch result row by row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowloom.operators.models import Fitted
from rowloom.sources.files import prediction_columns


def score_stream(
    spark: SparkSession, folder: str, schema: T.StructType, prepare: Callable[[DataFrame], DataFrame],
    fitted: Fitted, key: str, output: str, checkpoint: str,
    include_proba: bool = False, pattern: str = "*.parquet", files_per_trigger: int = 1000,
) -> str:
    """Score all files not seen before and append the predictions to a parquet folder.

    The checkpoint remembers the files done, so a restart goes on where the last run stopped.
    """
    arriving = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )
    scored = prediction_columns(fitted.score(prepare(arriving)), key, fitted.k, include_proba)
    query = (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return output
